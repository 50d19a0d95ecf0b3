"""Scalable numbering equals row_number, including one hot group spread over many tasks."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeworks.operators.sequence import sequence_within


def test_sequence_matches_row_number_with_hot_group(spark):
    n = 20000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        ((F.col("id") * 7919) % n).alias("k"))
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = sequence_within(df, ["g"], ["k"], out="seq")
        w = Window.partitionBy("g").orderBy("k")
        want = df.withColumn("want", F.row_number().over(w))
        bad = got.join(want, ["g", "k"]).where(F.col("seq") != F.col("want")).count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert bad == 0 and got.count() == n


def test_a_leading_number_changes_no_rank(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("g"), F.when(F.col("id") % 50 != 0, (F.col("id") * 7919) % 400).alias("a"), F.col("id").alias("b"))
    # it ties often, so the other columns have to decide
    lead = F.col("g") * 1000 + F.coalesce(F.expr("a div 100"), F.lit(0))
    got = sequence_within(df, ["g"], ["a", "b"], out="seq", lead=lead)
    want = df.withColumn("want", F.row_number().over(Window.partitionBy("g").orderBy("a", "b")))
    assert got.join(want, ["g", "b"]).where(F.col("seq") == F.col("want")).count() == 5000


def test_lead_of_report_rows_never_falls(spark):
    from tapeworks.fixtures.rendered import _lead
    keys = [None, -(1 << 63), -1, 0, 1, 997, (1 << 34) - 1, 1 << 34, (1 << 63) - 1]
    days = [None, -(1 << 31), -(1 << 26), -1, 0, 10000, 1 << 26, (1 << 31) - 1]
    rows = [(d, kind, k) for d in days for kind in (0, 1, 2) for k in keys]  # in sort order, nulls first
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, d int, kind int, k long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.col("d"))
    lead = df.withColumn("report_date", day).select("i", _lead("k").alias("lead"))
    got = [r.lead for r in lead.orderBy("i").collect()]
    found = [x for x in got if x is not None]
    assert got[:27] == [None] * 27 and len(found) == len(rows) - 27  # no date comes first
    assert found == sorted(found)
    assert len(set(found)) == 4 * 3 * 4 + 1  # days, kinds and keys within bounds; the days above

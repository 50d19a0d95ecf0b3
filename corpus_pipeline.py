"""A training corpus from raw documents: five stages, each reading what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``.  ``run`` writes every stage's rows
as Parquet to the shared folder and hands the re-read table on, so a lost
executor costs no earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.llm import mixing, packing, secrets, simhash, toxicity
from tapeworks.llm.common import WorkTables, documents, one_of_each

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, fitted on the labelled ones, rejects go.

    Null and empty texts are scored by the bias alone; long texts
    are scored whole; rows that repeat are scored alike; without labels of both
    classes all score the smoothed share of toxic ones; an empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit(docs, labels)
    return toxicity.score(docs, COLUMNS, model).where(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id.

    Null and empty texts have the fingerprint zero and are one group; a null
    id counts as the largest; rows that repeat id and text are one document;
    texts of any length have one fingerprint; an empty table stays empty.
    """
    return simhash.representatives(docs, COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark.

    A null text stays null and an empty one empty; a run of any length is one
    secret; ``n_chars`` changes with the text only where something was
    replaced; rows that repeat are redacted alike; an empty table stays empty.
    """
    found = secrets.find_secrets(docs, COLUMNS)
    hit = F.size("found") > 0
    text = F.when(hit, secrets.redacted(F.col("_text"), F.col("found"))).otherwise(F.col("text"))
    marked = found.select("doc_id", text.alias("text"), "lang", "source", "n_chars", hit.alias("_hit"))
    return marked.withColumn("n_chars", F.when(F.col("_hit"), F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times.

    The mix is worked out on narrow rows, named by id, source and a hash of
    the text; texts move once, to the names that are taken.  Rows that repeat
    a name are alike, so the name is written as often as all of them are taken.
    Null and empty texts have size zero; null ids and null sources are names
    like any other; a document is taken three times at most, whatever its
    length; an empty table stays empty.
    """
    name = F.xxhash64("text").alias("_h")
    docs, key = docs.select(*COLUMNS), ["doc_id", "source", "_h"]
    taken = (mixing.mix(docs.select("doc_id", "source", "text", name), key).groupBy(*key)
             .agg(F.sum("copies").cast("int").alias("_times")).where("_times > 0"))
    chosen = one_of_each(docs.withColumn("_h", name), taken, key)
    return chosen.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the mixed documents.

    A null or empty text is its end token alone; documents longer than a
    sequence are cut; rows that repeat, as the mix makes them, are packed each;
    an empty table gives an empty result.
    """
    return packing.pack(docs, ["doc_id"])


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL can express neither the trained classifier nor the sampling; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = WorkTables(spark, "pipeline")
    docs, last = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = tables.keep(stage(spark, docs, sf_dir), name)
        tables.drop(last)
        last = docs
    return docs

"""Archives and report files rendered from the driver tables (test support): real files in a shared folder."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.keys import archive_name, txt_prefix
from ..session import cut_lineage
from ..sources.inventory import arrow_file
from .rendered import BTB_ORDER, BTB_PREAMBLE, _comma2, _report_file


def write_archives(lines: DataFrame, root: str) -> DataFrame:
    """One ZIP per (feed, file_date) of tick lines, each written by its own task; returns their names.

    A feed-day of the tables is a few thousand lines, so a file is one group.
    """
    named = lines.select("feed", "file_date", "source_row", "line", archive_name(F.col("feed"), F.col("file_date")).alias("name"),
                         txt_prefix(F.col("feed"), F.col("file_date")).alias("txt"))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source_row")
        body = "\n".join(pdf["line"]) + "\n"
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(zipfile.ZipInfo(f"{pdf['txt'].iloc[0]}.txt"), body.encode(C.TEXT_ENCODING))
        fs, folder = arrow_file(root)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/{pdf['name'].iloc[0]}") as out:
            out.write(buffer.getvalue())
        return pdf[["feed", "file_date", "name"]].head(1)

    return cut_lineage(named.groupBy("feed", "file_date").applyInPandas(write, "feed string, file_date date, name string"))


def write_text_files(lines: DataFrame, root: str) -> None:
    """Tick lines as text, a folder per (feed, file_date), in line order; every line ends in a newline."""
    (lines.repartition("feed", "file_date").sortWithinPartitions("feed", "file_date", "source_row")
     .select("feed", "file_date", F.col("line").alias("value")).write.partitionBy("feed", "file_date").text(root))


# Fixed rendering rules of the yearly lending report with cells of several lines (mirrored by the oracle SQL).

def spanning_line():
    """A lending row whose company name spans two or three lines, one of them blank, for some parts."""
    key = F.col("l_partkey").cast("string")
    company = (F.when(F.col("l_partkey") % 29 == 0, F.concat(F.lit('"COMPANY '), key, F.lit('\n\n""B"""')))
                .when(F.col("l_partkey") % 23 == 0, F.concat(F.lit('"COMPANY '), key, F.lit('\nHOLDING; SA"')))
                .when(F.col("l_partkey") % 19 == 0, F.concat(F.lit("COMPANY "), key, F.lit(' 5" PIPE')))
                .otherwise(F.concat(F.lit("COMPANY "), key)))
    rate = F.concat(_comma2(F.col("l_discount") * 100), F.lit("%"))
    cells = [F.date_format("report_date", "dd/MM/yyyy"), F.col("l_suppkey").cast("string"),
             F.concat(F.lit("BRL"), F.lpad(key, 9, "0")), company, F.lit("Bolsa"), F.col("l_linenumber").cast("string"),
             F.col("l_quantity").cast("bigint").cast("string"), _comma2(F.col("l_extendedprice")), *[rate] * 6]
    return F.concat_ws(";", *cells)


def write_spanning_reports(lineitem: DataFrame, root: str) -> None:
    """One lending report file per ship year, as text whose cells break over lines."""
    raw = lineitem.select(F.to_date(F.date_trunc("year", "l_shipdate")).alias("report_date"), *BTB_ORDER,
                          "l_quantity", "l_discount")
    records = _report_file(raw, spanning_line, BTB_PREAMBLE, [], list(BTB_ORDER))
    (records.repartition("report_date").sortWithinPartitions("report_date", "line_no")
     .select("report_date", F.col("line").alias("value")).write.partitionBy("report_date").text(root))

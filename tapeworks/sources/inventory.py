"""File inventories and Parquet footer metadata.

An inventory is the ``binaryFile`` listing with ``content`` never selected,
so no file body is read: ``(path, name, length, modification_time)``.
Footer reads open only the last bytes of each Parquet file, inside tasks.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contract as C
from ..functions.keys import basename

INVENTORY_SCHEMA = "path string, name string, length bigint, modification_time timestamp"


def path_missing(exc: Exception) -> bool:
    """True when a read failed because its folder is not there (yet)."""
    return "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def list_files(spark: SparkSession, location: str, glob: str = "*") -> DataFrame:
    """Every file under ``location`` (recursively); empty if it does not exist."""
    try:
        raw = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
               .option("recursiveFileLookup", "true").load(location))
    except Exception as exc:  # noqa: BLE001
        if path_missing(exc):
            return spark.createDataFrame([], INVENTORY_SCHEMA)
        raise
    return raw.select("path", basename(F.col("path")).alias("name"), "length",
                      F.col("modificationTime").alias("modification_time"))


# --- Footer reader (runs in tasks) ---

FOOTER_SCHEMA = ("path string, readable boolean, provenance string, "
                 "schema_matches boolean, names string, fields string, error string")
_FOOTER_OUT = pa.schema([("path", pa.string()), ("readable", pa.bool_()),
                         ("provenance", pa.string()), ("schema_matches", pa.bool_()),
                         ("names", pa.string()), ("fields", pa.string()), ("error", pa.string())])


def _contract_arrow_schema() -> pa.Schema:
    types = {
        "source_row": pa.int32(), "symbol": pa.string(), "trade_date": pa.string(),
        "reference_date": pa.string(), "timestamp": pa.timestamp("ms", tz=C.TIMEZONE),
        "time_raw": pa.string(), "price": pa.float64(), "quantity": pa.uint32(),
        "update_action": pa.uint8(), "session_type": pa.uint8(), "channel_type": pa.uint8(),
        "trade_id": pa.int64(), "buyer_broker": pa.string(), "seller_broker": pa.string(),
    }
    return pa.schema([pa.field(n, types[n], nullable) for n, _, nullable in C.CONTRACT_FIELDS])


def schema_text(schema: pa.Schema) -> str:
    """Names, types and nullability of a schema in order, as one text that equal schemas share."""
    return ", ".join(f"{f.name} {f.type}{'' if f.nullable else ' not null'}" for f in schema)


def _footer_reader(footer_key: str):
    key = footer_key.encode()

    def read(batches):
        return _read_footers(batches, key)
    return read


# Schemes of object stores that Spark and Arrow spell differently.
_ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfs"}


def arrow_file(uri: str):
    """``(filesystem, path)`` Arrow needs for a URI as Spark writes it."""
    import pyarrow.fs as pafs
    scheme, mark, rest = uri.partition("://")
    if mark and scheme in _ARROW_SCHEMES:
        uri = f"{_ARROW_SCHEMES[scheme]}://{rest}"
    return pafs.FileSystem.from_uri(uri)


def arrow_reads(uri: str) -> bool:
    """True if Arrow has a file system for the URI's store."""
    try:
        arrow_file(uri)
    except Exception:  # noqa: BLE001 - a scheme or a library it does not have
        return False
    return True


def _read_footers(batches, key: bytes):
    import pyarrow.parquet as pq
    contract = _contract_arrow_schema()
    for batch in batches:
        out = {k: [] for k in _FOOTER_OUT.names}
        for path in batch.column("path").to_pylist():
            readable, prov, matches, names, fields, error = False, None, None, None, None, None
            try:
                fs, inner = arrow_file(path)
                schema = pq.read_schema(inner, filesystem=fs)
                readable = True
                meta = schema.metadata or {}
                raw = meta.get(key)
                prov = raw.decode("utf-8") if raw is not None else None
                matches = schema.remove_metadata().equals(contract)
                names = ",".join(schema.names)
                fields = schema_text(schema)
            except Exception as exc:  # noqa: BLE001 - reported per file
                error = f"{type(exc).__name__}: {exc}"
            out["path"].append(path)
            out["readable"].append(readable)
            out["provenance"].append(prov)
            out["schema_matches"].append(matches)
            out["names"].append(names)
            out["fields"].append(fields)
            out["error"].append(error)
        yield pa.RecordBatch.from_pydict(out, schema=_FOOTER_OUT)


def read_footers(paths: DataFrame, footer_key: str) -> DataFrame:
    """Footer facts of externally written Parquet tick files.

    ``paths`` has a ``path`` column (URIs); ``footer_key`` is the metadata key
    that holds the provenance JSON in those files.  The JSON is parsed
    with :data:`contract.PROVENANCE_DDL`; a missing key gives null, a
    malformed payload gives a null struct.
    """
    spark = paths.sparkSession
    n = max(1, spark.sparkContext.defaultParallelism)
    footers = paths.select("path").repartition(n).mapInArrow(_footer_reader(footer_key),
                                                             FOOTER_SCHEMA)
    return footers.withColumn("prov", F.from_json("provenance", C.PROVENANCE_DDL))


def provenance_json(p: dict) -> str:
    """Encode a provenance record the way reference-layout footers carry it."""
    return json.dumps(p, sort_keys=False)

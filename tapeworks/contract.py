"""Tick contract, version 1: names, order, types and the rule table.

Everything downstream (validation, conversion, sinks, verification) reads
its column lists from here, so the contract lives in one place.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (must match the exchange text format and contract v1) ---

SCHEMA_VERSION = 1
TIMEZONE = "America/Sao_Paulo"
FIELD_SEPARATOR = ";"
TEXT_ENCODING = "ISO-8859-1"  # latin-1

# Source TXT header, in order (line 1 of every file).
SOURCE_COLUMNS = (
    "DataReferencia",
    "CodigoInstrumento",
    "AcaoAtualizacao",
    "PrecoNegocio",
    "QuantidadeNegociada",
    "HoraFechamento",
    "CodigoIdentificadorNegocio",
    "TipoSessaoPregao",
    "DataNegocio",
    "CodigoParticipanteComprador",
    "CodigoParticipanteVendedor",
    "TipoDoCanal",
)
EXPECTED_HEADER = FIELD_SEPARATOR.join(SOURCE_COLUMNS)

# Contract columns, in order, with their Spark types (unsigned types widened).
CONTRACT_FIELDS = (
    ("source_row", T.IntegerType(), False),
    ("symbol", T.StringType(), False),
    ("trade_date", T.StringType(), False),
    ("reference_date", T.StringType(), False),
    ("timestamp", T.TimestampType(), True),
    ("time_raw", T.StringType(), False),
    ("price", T.DoubleType(), False),
    ("quantity", T.LongType(), False),  # uint32
    ("update_action", T.ShortType(), False),  # uint8
    ("session_type", T.ShortType(), False),  # uint8
    ("channel_type", T.ShortType(), False),  # uint8
    ("trade_id", T.LongType(), False),  # int64
    ("buyer_broker", T.StringType(), True),
    ("seller_broker", T.StringType(), True),
)
CONTRACT_COLUMNS = tuple(name for name, _, _ in CONTRACT_FIELDS)
CONTRACT_SCHEMA = T.StructType(
    [T.StructField(n, t, nullable) for n, t, nullable in CONTRACT_FIELDS]
)
NULLABLE_COLUMNS = frozenset(n for n, _, nullable in CONTRACT_FIELDS if nullable)

# Unsigned source integers: (source column, contract column, max value).
# The accepted text is 1..len(str(max)) ASCII digits, then <= max.
UINT8_MAX = 255
UINT32_MAX = 4294967295
INT64_MAX = 9223372036854775807

# Provenance record fields (one row per feed and file date).
PROVENANCE_FIELDS = (
    ("feed", T.StringType()),
    ("trade_date", T.StringType()),
    ("source_zip_name", T.StringType()),
    ("source_zip_sha256", T.StringType()),
    ("source_txt_name", T.StringType()),
    ("source_txt_row_count", T.LongType()),
    ("schema_version", T.IntegerType()),
    ("row_count", T.LongType()),
    ("timestamp_null_count", T.LongType()),
    ("timezone", T.StringType()),
    ("collector_version", T.StringType()),
    ("collector_commit", T.StringType()),
    ("created_at_utc", T.StringType()),
)
PROVENANCE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in PROVENANCE_FIELDS])
PROVENANCE_DDL = ", ".join(f"{n} {t.simpleString()}" for n, t in PROVENANCE_FIELDS)
# Footer metadata key under which externally written Parquet files carry
# their provenance JSON is given by the caller (see sources.inventory).

# Code meanings (unknown codes are published, never rejected).
UPDATE_ACTION_NEW = 0
UPDATE_ACTION_CANCELLED = 2
SESSION_REGULAR = 1
SESSION_AFTER_HOURS = 6

# Feed dimension: name, archive name template, TXT prefix template, archive
# prefix, ticks prefix, channel seen in practice.  Templates use Spark
# datetime patterns applied to the file date.
FEEDS = (
    ("RV", "yyyyMMdd'_NEGOCIOSAVISTA.zip'", "dd-MM-yyyy'_NEGOCIOSAVISTA_RV'",
     "b3/bdi/tick_by_tick_rv/", "b3/tick_by_tick/rv/ticks/", 2),
    ("DERIV", "dd-MM-yyyy'_NEGOCIOSAVISTA_DRV.zip'", "dd-MM-yyyy'_NEGOCIOSAVISTA_DRV'",
     "b3/bdi/tick_by_tick_deriv/", "b3/tick_by_tick/deriv/ticks/", 1),
)
# Regexes a file name must match exactly, and where the year, month and day
# sit in it as (start, length), 1-based - the inverse of the templates above.
FEED_NAME_PATTERNS = {
    "RV": (r"^[0-9]{8}_NEGOCIOSAVISTA\.zip$", ((1, 4), (5, 2), (7, 2))),
    "DERIV": (r"^[0-9]{2}-[0-9]{2}-[0-9]{4}_NEGOCIOSAVISTA_DRV\.zip$", ((7, 4), (4, 2), (1, 2))),
}
TICKS_NAME_PATTERN = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\.parquet$", ((1, 4), (6, 2), (9, 2)))

# --- Validation rules, in precedence order (the first failing rule wins) ---
# (rule id, source column it reports)
RULES = (
    ("header", "header"),
    ("field_count", "line"),
    ("trade_date", "DataNegocio"),
    ("reference_date", "DataReferencia"),
    ("price", "PrecoNegocio"),
    ("quantity_pattern", "QuantidadeNegociada"),
    ("quantity_range", "QuantidadeNegociada"),
    ("update_action_pattern", "AcaoAtualizacao"),
    ("update_action_range", "AcaoAtualizacao"),
    ("session_type_pattern", "TipoSessaoPregao"),
    ("session_type_range", "TipoSessaoPregao"),
    ("channel_type_pattern", "TipoDoCanal"),
    ("channel_type_range", "TipoDoCanal"),
    ("trade_id_pattern", "CodigoIdentificadorNegocio"),
    ("trade_id_range", "CodigoIdentificadorNegocio"),
    ("local_time_invalid", "HoraFechamento"),
    ("zero_rows", "rows"),
)
RULE_ORDER = {rule: i for i, (rule, _) in enumerate(RULES)}

MAX_REPORTED_BLANKS = 10
MAX_REPORTED_TIMES = 5

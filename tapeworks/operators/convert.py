"""Typed tick projection: source text fields -> contract v1 columns.

Runs only on lines of accepted files, so every conversion here is known to
succeed except the time, which is tolerated: an unreadable ``time_raw``
yields a null ``timestamp`` and the row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import contract as C
from ..functions import strict as S
from .validate import field, with_fields


def contract_columns() -> list[Column]:
    ref, hora = field("DataReferencia"), field("HoraFechamento")
    return [
        F.col("source_row").cast("int").alias("source_row"),
        field("CodigoInstrumento").alias("symbol"),
        field("DataNegocio").alias("trade_date"),
        ref.alias("reference_date"),
        # Built from the calendar day of the file, never from the session.
        S.local_timestamp(ref, hora).alias("timestamp"),
        hora.alias("time_raw"),
        S.price_value(field("PrecoNegocio")).alias("price"),
        S.uint_value(field("QuantidadeNegociada"), "bigint").alias("quantity"),
        S.uint_value(field("AcaoAtualizacao"), "smallint").alias("update_action"),
        S.uint_value(field("TipoSessaoPregao"), "smallint").alias("session_type"),
        S.uint_value(field("TipoDoCanal"), "smallint").alias("channel_type"),
        S.uint_value(field("CodigoIdentificadorNegocio"), "bigint").alias("trade_id"),
        S.empty_to_null(field("CodigoParticipanteComprador")).alias("buyer_broker"),
        S.empty_to_null(field("CodigoParticipanteVendedor")).alias("seller_broker"),
    ]


def typed_ticks(accepted: DataFrame, keep_keys: bool = True) -> DataFrame:
    """Contract-ordered typed rows (plus ``feed, file_date`` when asked)."""
    keys = [F.col("feed"), F.col("file_date")] if keep_keys else []
    return with_fields(accepted).select(*keys, *contract_columns())


def to_contract(ticks: DataFrame) -> DataFrame:
    """Exactly the 14 contract columns, in order, with contract types."""
    return ticks.select(*[F.col(n).cast(t) for n, t, _ in C.CONTRACT_FIELDS])


def epoch_millis(ts: Column | str = "timestamp") -> Column:
    """Instant as BIGINT milliseconds (comparison-friendly across engines)."""
    return F.unix_millis(F.col(ts) if isinstance(ts, str) else ts)

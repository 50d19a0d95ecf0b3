"""Registered queries of the training-data operators: thin calls on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, fim, licenses, mixing, packing, phrases, secrets, sharding, simhash, topk, toxicity, whitening
from .common import documents, embeddings
from .pii import pii_report


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(documents(spark, sf_dir))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(documents(spark, sf_dir))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(documents(spark, sf_dir))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.topk_report(embeddings(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(documents(spark, sf_dir))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.ann_report(embeddings(spark, sf_dir))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharding_report(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(embeddings(spark, sf_dir))


def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_report(documents(spark, sf_dir))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases_report(documents(spark, sf_dir))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_secrets": op2_secrets,
    "op3_licenses": op3_licenses,
    "op4_simhash": op4_simhash,
    "op8_topk": op8_topk,
    "op9_toxicity": op9_toxicity,
    "op10_mixing": op10_mixing,
    "op5_ann": op5_ann,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op11_whitening": op11_whitening,
    "op12_fim": op12_fim,
    "op13_phrases": op13_phrases,
}

ORACLE_SQL: dict[str, str] = {
    "op3_licenses": licenses.ORACLE,
    "op8_topk": topk.ORACLE,
    "op2_secrets": secrets.ORACLE,
    "op12_fim": fim.ORACLE,
    "op13_phrases": phrases.ORACLE,
}

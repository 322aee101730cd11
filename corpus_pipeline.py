"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scenequill.llm.common import discard, doc_id, documents, stage
from scenequill.llm.exact_dedup import exact_dedup
from scenequill.llm.mixing import mix
from scenequill.llm.packing import pack
from scenequill.llm.simhash import near_dedup
from scenequill.llm.suffix_rules import quality_filter


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs).select(doc_id(), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("quality rules", quality_rules), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies), ("mixing", mix_sources), ("packing", pack_sequences)]

#: SimHash groups and bit-set packing have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        before = docs
        docs = stage(step(spark, before, sf_dir), name.replace(" ", "-").lower())
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)

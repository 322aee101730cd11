"""Exact dedup against a persistent digest index. DataFrame operations only.

The index is a Parquet table bucketed and sorted by the SHA-256 digest of the normalised text. New documents are first
reduced to one row per digest (map-side partial aggregation, so a group of copies of any size costs one row per task),
the distinct digests are sort-merge anti-joined against the index, which needs no shuffle of the index, and those that
it lacks are appended. Texts are read once and never shuffled: only digests move.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, discard, distinct_rows, doc_id, documents, keyed, lower_ascii, partitions, shared_dir, stage


def digest(text: Column) -> Column:
    """32 bytes; texts are equal when identical after lower-casing A-Z only."""
    return F.unhex(F.sha2(lower_ascii(text), 256))


class DigestIndex:
    """digest -> keep_id, on disk at ``path``. Opening a path that holds an index continues it, in this session or a
    later one; the number of buckets is fixed when it is made."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.table = spark, path, f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")
        self.buckets = buckets

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, digests: DataFrame) -> DataFrame:
        """``digests``: digest, keep_id, one row per digest. Appends those the index lacks and returns them."""
        fresh = stage(digests.hint("merge").join(self.rows().select("digest"), "digest", "left_anti"), "fresh-digests")
        fresh.repartition(self.buckets, "digest").select("digest", "keep_id").write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.path).saveAsTable(self.table)
        self.spark.catalog.refreshTable(self.table)
        return fresh

    def close(self) -> None:
        """Forget the table's name; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def new_index(spark: SparkSession) -> DigestIndex:
    return DigestIndex(spark, f"{shared_dir(spark)}/corpus-stages/{spark.sparkContext.applicationId}/digest-index-{uuid.uuid4().hex}", partitions(spark))


def dedup_members(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per row of ``docs``: _id, _rk, digest, keep_id, group_size (rows of ``docs`` in the group), kept.

    Of equal texts the largest doc_id stays, unless the index held the digest before: then none stays and keep_id is the
    one in the index. Rows that repeat doc_id and text are equal in all columns, so ``kept`` holds for one of them only."""
    spark = docs.sparkSession
    rows = stage(keyed(docs).select("_id", "_rk", F.monotonically_increasing_id().alias("_row"), digest(F.col("text")).alias("digest")), "digests")
    groups = rows.groupBy("digest").agg(F.max(F.struct("_id", "_row")).alias("top"), F.count("*").alias("group_size"))
    groups = stage(groups.select("digest", F.col("top._id").alias("keep_id"), F.col("top._row").alias("keep_row"), "group_size"), "digest-groups")
    fresh = index.add(groups.select("digest", "keep_id")).select("digest", F.lit(True).alias("fresh"))
    held = index.rows().hint("merge")  # a digest comes once, its buckets are sorted: no shuffle of the index
    classes = groups.drop("keep_id").join(held, "digest", "left").join(fresh, "digest", "left")
    classes = stage(classes.withColumn("fresh", F.coalesce("fresh", F.lit(False))), "digest-classes")
    discard(groups)
    # both sides are shuffled by digest here, so that adaptive execution can split the partition of a hot group
    out = rows.join(classes.hint("merge"), "digest")
    kept = F.col("fresh") & (F.col("_row") == F.col("keep_row"))
    return out.select("_id", "_rk", "digest", "keep_id", "group_size", kept.alias("kept"))


def op3_exact_dedup(spark, sf_dir) -> DataFrame:
    """Every row and whole text of documents, in two batches that meet in one index: first the rows of the upper half of the
    doc_ids, then the others, whose digests the index may hold already. So the row with the largest doc_id of equal texts
    stays, whichever batch it comes in, and a text that the first batch left in the index drops all its copies in the second.
    A null text is the empty one; a null doc_id is smaller than every other; of rows that repeat doc_id and text one is kept.
    An empty table gives no rows, other columns are not read."""
    docs = documents(spark, sf_dir)
    index = new_index(spark)
    ids = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    middle = docs.agg(F.percentile_approx(ids, 0.5)).first()[0]
    late = docs if middle is None else docs.where(ids > middle)
    first = stage(dedup_members(late, index), "later-documents")
    second = dedup_members(docs.where(ids <= (NO_ID if middle is None else middle)), index)
    both = stage(first.union(second), "members")
    index.close()
    discard(first)
    # the two batches' counts of a digest add up; a sum over two rows at most for each digest and task
    sizes = stage(both.groupBy("digest").agg(F.count("*").alias("group_size")), "group-sizes")
    out = both.drop("group_size").join(sizes.hint("merge"), "digest")
    return out.select(doc_id(), F.nullif(F.col("keep_id"), F.lit(NO_ID)).alias("keep_id"), "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns: of equal texts the one with the largest doc_id, and none if the index
    has the text. Of rows that repeat doc_id and text one stays."""
    return distinct_rows(docs, dedup_members(docs, index or new_index(docs.sparkSession)).where("kept"))


OP3_SQL = """
WITH n AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS d FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY d) AS keep_id, CAST(count(*) OVER (PARTITION BY d) AS BIGINT) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY d) AS kept, d AS text_sha256 FROM n
"""

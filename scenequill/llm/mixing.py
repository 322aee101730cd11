"""Mixing sources to target weights by hash-threshold histograms. DataFrame operations only.

Each document gets a 60-bit hash of its doc_id. A histogram of sizes by source and hash bucket (map-side partial sums)
finds, per source, the bucket in which the running sum reaches the source's budget; only the documents of that boundary
bucket are counted again, by the next ten bits, until a single hash value remains. A document is then taken by comparing
its hash with its source's threshold: nothing is sorted, and reruns agree. Budgets nest: every document is taken ``base``
times, those below the threshold once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_id, documents, keyed, stage, whole_rows, word_count

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
BITS, LEVELS = 10, 6


def hash60(ident: Column) -> Column:
    """The first 15 hex digits of an md5: uniform, and the same in other engines."""
    return F.conv(F.substring(F.md5(F.concat(F.lit("mix:"), ident.cast("string"))), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, target. Sources in code-point order, null last, take the weights in turn and share
    ``share`` times the whole; a target stops at ``most`` times its source, and the excess goes to the others by weight:
    the smallest level L with target = min(most * size, weight * L). One row per source; no driver loop."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    r = per.select("source", "source_size", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).alias("r"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("r") - 1, F.lit(len(weights))) + 1).cast("int"))
    w = r.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(most))
    order = Window.orderBy(F.col("cap") / F.col("w"), "r")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    level = (total * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    v = w.withColumn("level", level).withColumn("free", F.col("w") * F.col("level") <= F.col("cap"))
    first = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), "r", "level"))).over(Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return v.withColumn("at", first["level"]).select("source", "source_size", F.when(F.col("at").isNull() | (F.col("cap") <= F.col("w") * F.col("at")), F.col("cap")).otherwise(F.col("w") * F.col("at")).alias("target"))


def thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """source, source_size, target, base, cut: a document of the source is taken base + (hash < cut) times."""
    base = F.when((F.col("source_size") > 0) & (F.col("target") >= F.col("source_size")), F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = targets.withColumn("base", base).withColumn("budget", F.col("target") - F.col("base") * F.col("source_size"))
    state = stage(state.withColumns({"prefix": F.lit(0).cast("long"), "done": F.lit(0).cast("long"), "all": F.lit(False), "left": F.lit(2).cast("long")}), "mix-targets")
    keys = ["source", "source_size", "target", "base", "budget", "prefix", "done", "all", "left"]
    for level in range(LEVELS):
        low = BITS * (LEVELS - 1 - level)
        above = F.shiftright("h", low + BITS)
        bucket = F.shiftright("h", low)
        at = sizes.join(state.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).where(~F.col("all") & (above == F.col("prefix")) & (F.col("size") > 0))
        hist = at.groupBy(*keys, bucket.alias("b")).agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
        run = F.sum("n").over(Window.partitionBy("source").orderBy("b"))
        edge = hist.withColumn("run", F.col("done") + run).where(F.col("run") >= F.col("budget"))
        edge = edge.groupBy("source").agg(F.min(F.struct("b", "run", "n", "lo", "hi")).alias("e")).withColumnRenamed("source", "s")
        state = state.join(edge, F.col("source").eqNullSafe(F.col("s")), "left")
        more = ~F.col("all") & F.col("e").isNotNull()
        state = state.select(
            "source", "source_size", "target", "base", "budget",
            F.when(more, F.col("e.b")).otherwise(F.col("prefix")).alias("prefix"),
            F.when(more, F.col("e.run") - F.col("e.n")).otherwise(F.col("done")).alias("done"),
            (~more).alias("all"),  # the whole source, at this level as before it, stays within its budget
            F.when(more, F.col("e.n")).otherwise(F.lit(0)).alias("left"),
        )
        state = stage(state, f"mix-level{level}")
    # prefix is now one hash value, whose documents go in if that brings the sum nearer to the budget
    nearer = F.abs(F.col("done") + F.col("left") - F.col("budget")) < F.abs(F.col("done") - F.col("budget"))
    cut = F.when(F.col("all"), F.lit(1 << 60)).when(nearer, F.col("prefix") + 1).otherwise(F.col("prefix"))
    return state.select("source", "source_size", "target", "base", cut.alias("cut"))


def mix_plan(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per document: _id, _rk, size (words), source_size, target, copies (how often the mix takes it). A null
    source is a source of its own, the last; a null text has no words. Documents that share a doc_id share a hash."""
    sizes = stage(keyed(docs, "source").select("_id", "_rk", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), hash60(F.col("_id")).alias("h")), "mix-sizes")
    cuts = thresholds(sizes, source_targets(sizes, weights, share, most)).withColumnRenamed("source", "s")
    out = sizes.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left")
    return out.select("_id", "_rk", "size", "source_size", "target", (F.col("base") + (F.col("h") < F.col("cut")).cast("long")).alias("copies"))


def op6_mixing(spark, sf_dir) -> DataFrame:
    """The mix of all documents, by ``mix_plan`` with production weights. A null text has no words and is never needed; a null
    source is the last one; documents that share a doc_id share a draw; an empty table gives no rows; other columns are not
    read."""
    return mix_plan(documents(spark, sf_dir)).select(doc_id(), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The mixed documents, all their columns: a document taken twice is two rows."""
    plan = mix_plan(docs, weights, share, most).where("copies > 0").groupBy("_id", "_rk").agg(F.max("copies").alias("copies"))
    out = whole_rows(docs).join(stage(plan, "mix-plan"), ["_id", "_rk"])
    return out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix:' || doc_id), 1, 15) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, source_size * 2.0::DOUBLE AS cap, ([5.0, 2.0, 1.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS r FROM s),
l AS (SELECT *, (CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / w, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
f AS (SELECT level FROM l WHERE w * level <= cap ORDER BY cap / w, r LIMIT 1),
t AS (SELECT l.source, l.source_size, CASE WHEN f.level IS NULL OR l.cap <= l.w * f.level THEN l.cap ELSE l.w * f.level END AS target FROM l LEFT JOIN f ON TRUE),
b AS (SELECT *, CASE WHEN source_size > 0 AND target >= source_size THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS base FROM t),
g AS (SELECT d.source, d.h, sum(d.size) AS n FROM d WHERE size > 0 GROUP BY d.source, d.h),
c AS (SELECT g.source, g.h, g.n, sum(g.n) OVER (PARTITION BY g.source ORDER BY g.h) AS run, b.target - b.base * b.source_size AS budget
  FROM g JOIN b ON g.source IS NOT DISTINCT FROM b.source),
e AS (SELECT source, min(h) FILTER (WHERE run >= budget) AS h0,
    coalesce(min(h) FILTER (WHERE run >= budget AND run - n < budget AND abs(run - budget) < abs(run - n - budget)) + 1,
             min(h) FILTER (WHERE run >= budget), 1152921504606846976) AS cut FROM c GROUP BY source)
SELECT d.doc_id, d.size, b.source_size, b.target,
  CAST((b.base + CASE WHEN d.h < coalesce(e.cut, 1152921504606846976) THEN 1 ELSE 0 END) * d.size AS BIGINT) AS taken
FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source LEFT JOIN e ON d.source IS NOT DISTINCT FROM e.source
"""

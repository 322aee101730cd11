"""Scores to reports: joins with missing predictions, roll-ups, histograms, normalised images and depth maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_predictions(items: DataFrame, predictions: DataFrame, key: str = "id") -> DataFrame:
    """Left join; a missing prediction is the empty text. Of repeated predictions the one with the largest seq counts."""
    last = predictions.groupBy(key).agg(F.max_by("prediction", "seq").alias("prediction"))
    return items.join(last, key, "left").withColumn("prediction", F.coalesce("prediction", F.lit("")))


def rollup(scored: DataFrame, by: tuple[str, ...] = ("category", "subcategory")) -> DataFrame:
    """level, key, accuracy, n, n_unscored: the whole and each grouping on its own, in one pass of grouping sets. Unscored
    items count as zero."""
    sets = [[]] + [[b] for b in by]
    g = scored.groupingSets([[F.col(c) for c in s] for s in sets], *by).agg(
        F.round(F.avg(F.coalesce("score", F.lit(0.0))), 6).alias("accuracy"), F.count("*").alias("n"), F.count_if(F.col("score").isNull()).alias("n_unscored"), F.grouping_id().alias("gid")
    )
    level = F.lit("overall")
    full = (1 << len(by)) - 1
    for i, b in enumerate(by):
        level = F.when(F.col("gid") == full - (1 << (len(by) - 1 - i)), b).otherwise(level)
    return g.select(level.alias("level"), F.coalesce(*by, F.lit("all")).alias("key"), "accuracy", "n", "n_unscored")


def score_histogram(scores: DataFrame) -> DataFrame:
    """bucket 1..5 and n, zero-filled; scores are rounded half-even and clamped."""
    b = F.greatest(F.lit(1), F.least(F.lit(5), F.bround("score").cast("int")))
    counts = scores.where(F.col("score").isNotNull()).groupBy(b.alias("bucket")).agg(F.count("*").alias("n"))
    five = scores.sparkSession.range(1, 6).select(F.col("id").cast("int").alias("bucket"))
    all5 = five.join(counts, "bucket", "left").select(F.col("bucket").cast("long").alias("bucket"), F.coalesce("n", F.lit(0)).alias("n"))
    return all5.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def quantiles(df: DataFrame, value: str, shares: list[float], buckets: int = 1024, few: int = 100_000) -> list[float | None]:
    """Exact quantiles, interpolated, without bringing all values together. A histogram of ``buckets`` ranges (map-side sums) tells
    in which range each wanted rank lies; that range alone is divided again, until it holds ``few`` values at most or one
    value only. What comes to the driver is a row for each bucket, and in the end the few values around a rank."""
    v = df.select(F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    whole = v.agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    n = whole["n"]
    if not n:
        return [None] * len(shares)

    known: dict[int, float] = {}

    def at(rank: int) -> float:
        """The value of a rank, from 0."""
        if rank in known:
            return known[rank]
        lo, hi, before, count = whole["lo"], whole["hi"], 0, n
        while count > few and lo < hi:
            step = (hi - lo) / buckets
            if not step > 0 or lo + step == lo:
                break
            b = F.least(F.lit(buckets - 1), F.floor((F.col("v") - lo) / step).cast("long"))
            rows = v.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy(b.alias("b")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy("b").collect()
            for r in rows:
                if before + r["n"] > rank:
                    lo, hi, count = r["lo"], r["hi"], r["n"]
                    break
                before += r["n"]
        if lo < hi:
            # equal values count once here, so a long run of one value is a row
            rows = v.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy("v").count().orderBy("v").collect()
            for r in rows:
                for k in range(max(before, rank - 1), min(before + r["count"], rank + 2)):
                    known[k] = r["v"]
                before += r["count"]
        else:
            known[rank] = lo
        return known[rank]

    out = []
    for q in shares:
        place = q * (n - 1)
        low = int(place)
        a = at(low)
        out.append(a if place == low else a + (at(low + 1) - a) * (place - low))
    return out


def stretch(df: DataFrame, value: str, low: float = 0.02, high: float = 0.85) -> DataFrame:
    """``value`` scaled to [0, 1] between two exact percentiles."""
    lo, hi = quantiles(df, value, [low, high])
    lo, hi = (F.lit(x).cast("double") for x in (lo, hi))
    scaled = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(F.col(value) - lo, hi - lo)))
    return df.withColumn("stretched", F.round(scaled, 6))


def median_fill(df: DataFrame, by: str, value: str) -> DataFrame:
    """Null, NaN and infinite values become the median of the group's valid ones, or 0."""
    ok = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), F.col(value))
    m = df.groupBy(by).agg(F.percentile(ok, F.lit(0.5)).alias("med"))
    return df.join(m, by).withColumn(value, F.coalesce(ok, "med", F.lit(0.0))).drop("med")


def options_text(options: Column) -> Column:
    lines = F.transform(options, lambda o, i: F.concat(F.lit("("), F.char(i + 65), F.lit(") "), o))
    return F.concat(F.array_join(lines, "\n"), F.lit("\nAnswer with the letter only."))

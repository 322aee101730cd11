"""Choosing rows: tag filters, random and farthest-point subsets, nearest neighbours."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import order_of


def not_null(df: DataFrame) -> Column:
    """All columns non-null. NaN, empty arrays and nulls inside a column pass."""
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in df.columns])


def tag_set(csv: str | None) -> list[str]:
    return [x for x in (p.strip() for p in (csv or "").split(",")) if x]


def tag_passes(tag: Column, include: str | None, exclude: str | None) -> Column:
    inc, exc = tag_set(include), tag_set(exclude)
    out = ~tag.isin(exc) if exc else F.lit(True)
    return out & tag.isin(inc) if inc else out


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda acc, x: acc + x))


def label_tags(emb: DataFrame, dims: int = 64) -> DataFrame:
    """label and unit mean vector, components rounded to six digits before normalising. A row for each label."""
    v = F.posexplode("embedding").alias("i", "v")
    m = emb.select("label", v).groupBy("label", "i").agg(F.round(F.avg(F.col("v").cast("double")), 6).alias("v"))
    t = m.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("i", "v"))).alias("p")).select("label", F.transform("p", lambda x: x["v"]).alias("t"))
    return t.select("label", F.transform("t", lambda x: x / F.sqrt(dot(F.col("t"), F.col("t")))).alias("tag_vec"))


#: So many tags are packed into one row and sent to all tasks.
MOST_TAGS = 10_000


def nearest_tag(emb: DataFrame, tags: DataFrame) -> DataFrame:
    """vec_id, tag, similarity; equal similarities go to the smaller label. The tag table is packed into one row and
    scanned within each row's expression: no product of rows is made."""
    if tags.limit(MOST_TAGS + 1).count() > MOST_TAGS:
        raise ValueError(f"over {MOST_TAGS} tags: they would not fit into a row; match blocks of them with ratio_matches")
    packed = tags.groupBy().agg(F.sort_array(F.collect_list(F.struct("label", "tag_vec"))).alias("tags"))
    sims = F.transform("tags", lambda t: F.struct(F.round(dot(F.col("embedding"), t["tag_vec"]), 6).alias("s"), (-t["label"]).alias("n")))
    best = F.array_max(sims)
    return emb.join(F.broadcast(packed)).select("vec_id", F.concat(F.lit("tag_"), (-best["n"]).cast("string")).alias("tag"), best["s"].alias("similarity"))


def random_subset(ids: Column, df: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """k rows in a draw order fixed by the seed: the least md5 values, kept by a bounded top-k."""
    return df.withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed).cast("string"), ids.cast("string")))).orderBy("draw").limit(k)


def resolve_k(n: int, fraction: float | None = None, count: int | None = None) -> int:
    if (fraction is None) == (count is None):
        raise ValueError("give exactly one of fraction and count")
    if fraction is not None and not 0 < fraction <= 1:
        raise ValueError(f"a fraction lies above 0 and up to 1, not at {fraction}")
    k = round(fraction * n) if fraction is not None else count
    if not 1 <= k <= n:
        raise ValueError(f"cannot choose {k} of {n}")
    return k


STEPS = 16


def farthest_points(emb: DataFrame, k: int, start: int = 0, metric: str = "euclidean") -> DataFrame:
    """(rank, vec_id): greedy max-min selection, ties to the smaller id. Each row carries ``near``, its distance to what is
    chosen; a round folds in the vector chosen last and finds the next by one map-side-combined aggregation. Every STEPS rounds
    ``near`` is written to memory anew, so a plan holds that many vectors at most, whatever k is."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric}")
    if k < 0:
        raise ValueError("k must not be negative")
    spark = emb.sparkSession
    if k == 0:
        return spark.createDataFrame([], "rank long, vec_id long")
    rows = emb.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    if metric == "cosine":
        norm = F.sqrt(dot(F.col("v"), F.col("v")))
        rows = rows.select("vec_id", F.transform("v", lambda x: x / F.when(norm == 0, 1.0).otherwise(norm)).alias("v"))
    rows = held = rows.withColumn("near", F.lit(float("inf"))).persist()
    first = rows.where(F.col("vec_id") == start).first()
    if first is None:
        raise ValueError(f"no row {start}")
    chosen, last = [start], list(first["v"])
    for i in range(1, k):
        to = F.array(*[F.lit(x) for x in last])
        apart = 1 - dot(F.col("v"), to) if metric == "cosine" else distance(F.col("v"), to)
        rows = rows.withColumn("near", F.when(F.col("vec_id") == chosen[-1], -1.0).otherwise(F.least("near", apart)))
        if i % STEPS == 0:
            rows = rows.persist()
            rows.count()
            held.unpersist()
            held = rows
        best = rows.select(F.struct("near", (-F.col("vec_id")).alias("n"), "v").alias("c")).agg(F.max_by("c", F.struct("c.near", "c.n")).alias("c")).first()["c"]
        if best is None or best["near"] < 0:
            raise ValueError("k is larger than the table")
        chosen.append(-best["n"])
        last = list(best["v"])
    held.unpersist()
    return spark.createDataFrame([(i, x) for i, x in enumerate(chosen)], "rank long, vec_id long")


METRICS, STRATEGIES = ("euclidean", "cosine"), ("farthest", "random")


def select_rows(emb: DataFrame, k: int, strategy: str = "farthest", seed: int = 0, metric: str = "euclidean", start: int | None = None) -> DataFrame:
    """(rank, vec_id) by one of STRATEGIES. Without a start the farthest one begins at a row drawn by the seed."""
    if strategy == "farthest":
        if start is None:
            top = emb.select("vec_id").withColumn("o", order_of(F.lit(seed), F.col("vec_id"))).agg(F.min_by("vec_id", "o")).first()[0]
            start = 0 if top is None else top
        return farthest_points(emb, k, start, metric)
    if strategy == "random":
        few = random_subset(F.col("vec_id"), emb.select("vec_id"), k, seed)  # k rows
        return few.select((F.row_number().over(Window.orderBy("draw")) - 1).cast("long").alias("rank"), "vec_id")
    raise ValueError(f"unknown strategy {strategy!r}; there are {', '.join(STRATEGIES)}")


METHODS = {"farthest": "farthest-point selection (greatest least distance)", "random": "random sampling"}


def manifest(selected: DataFrame, source_count: int, strategy: str, seed: int, metric: str, embedding_source: str, source_repo_id: str | None = None, split: str | None = None, fraction: float | None = None) -> DataFrame:
    """One row: what was chosen, in order, and how."""
    ids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "vec_id"))), lambda x: x["vec_id"])
    g = selected.agg(ids.alias("selected_ids"), F.count("*").alias("selected_count"))
    lit = lambda v, kind, name: F.lit(v).cast(kind).alias(name)
    return g.select(
        lit(source_repo_id, "string", "source_repo_id"), lit(split, "string", "split"), lit(source_count, "long", "source_count"), "selected_count", lit(fraction, "double", "fraction"), "selected_ids",
        lit(strategy, "string", "strategy"), lit(seed, "long", "seed"), lit(metric, "string", "metric"), lit(embedding_source, "string", "embedding_source"), lit(METHODS[strategy], "string", "method"),
    )


class Curator:
    """A dataset's uniform or random subset, and its manifest. Vectors come from the dataset's ``embedding`` column if it has
    one, else from ``source``, a function from a dataset to one with that column."""

    def __init__(self, source=None, seed: int = 0, metric: str = "euclidean", source_name: str = "custom"):
        if metric not in METRICS:
            raise ValueError(f"unknown metric {metric!r}; there are {', '.join(METRICS)}")
        self.source, self.seed, self.metric, self.source_name = source, seed, metric, source_name

    def vectors(self, df: DataFrame) -> tuple[DataFrame, str]:
        if "embedding" in df.columns:
            if df.where("embedding IS NULL").take(1):
                raise ValueError("the embedding column has nulls: filter them first")
            return df, "precomputed:embedding"
        if self.source is None:
            raise ValueError("no embedding column and no source of embeddings")
        return self.source(df), self.source_name

    def curate(self, df: DataFrame, fraction: float | None = None, count: int | None = None, strategy: str = "farthest", split: str | None = None, source_repo_id: str | None = None) -> tuple[DataFrame, DataFrame]:
        """(subset with ``rank``, manifest). ``split``: of a dataset with a column of that name, which one."""
        if strategy not in STRATEGIES:
            raise ValueError(f"unknown strategy {strategy!r}; there are {', '.join(STRATEGIES)}")
        if split is not None and "split" in df.columns:
            names = [r[0] for r in df.select("split").distinct().limit(1000).collect()]
            if split not in names:
                raise KeyError(f"split {split!r} not found; there are {', '.join(map(str, sorted(names)))}")
            df = df.where(F.col("split") == split)
        emb, source = self.vectors(df)
        n = emb.count()
        chosen = select_rows(emb, resolve_k(n, fraction, count), strategy, self.seed, self.metric)
        return df.join(chosen, "vec_id"), manifest(chosen, n, strategy, self.seed, self.metric, source, source_repo_id, split, fraction)


def ratio_matches(a: DataFrame, b: DataFrame, ratio: float = 0.8, by: list[str] | None = None, block: int = 2048) -> DataFrame:
    """For each row of ``a`` (vec_id, embedding) its nearest row of ``b`` if clearly nearer than the second: exact. ``by``: columns
    that both have and that name a pair of views; rows meet within a pair only. The rows of each side of a pair are dealt
    into blocks; two blocks at a time are compared by matrix products, and the two nearest of each row go on to a merge. So a
    pair of views costs the product of their sizes, as it must, and no task holds more than two blocks."""
    by = by or []
    a, b = (df.select(*by, "vec_id", "embedding").withColumn("_h", F.xxhash64("vec_id")) for df in (a, b))
    count = lambda df, name: df.groupBy(*by).agg(F.ceil(F.count("*") / block).cast("long").alias(name))
    na, nb = count(a, "na"), count(b, "nb")  # a row for each pair of views
    met = na.join(nb, by) if by else na.select("*").join(F.broadcast(nb))
    join = lambda df: df.join(met, by) if by else df.join(F.broadcast(met))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = join(a).withColumns({"i": F.pmod("_h", "na"), "j": spread("nb")})
    right = join(b).withColumns({"j": F.pmod("_h", "nb"), "i": spread("na")})
    left, right = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (left, right))  # the two may be of one table

    def nearest(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame(columns=["vec_id", "id", "d"])
        y = y.sort_values("vec_id")
        p, q = np.stack(x["embedding"]).astype(float), np.stack(y["embedding"]).astype(float)
        ids, out = y["vec_id"].to_numpy(), []
        rough = np.sqrt(np.maximum((p * p).sum(1)[:, None] + (q * q).sum(1)[None] - 2 * p @ q.T, 0))
        few = min(len(q), 8)
        part = np.argpartition(rough, few - 1, axis=1)[:, :few]
        for r, (c, v) in enumerate(zip(part, x["vec_id"], strict=True)):
            edge = rough[r, c].max() + 1e-6
            if few < len(q) and np.sort(rough[r, c])[min(1, few - 1)] > edge - 3e-6:
                c = np.flatnonzero(rough[r] <= edge)  # ties at the edge: all of them
            d = np.round(np.sqrt(((q[c] - p[r]) ** 2).sum(1)), 6)
            out += [(v, ids[c[k]], d[k]) for k in np.lexsort((ids[c], d))[:2]]
        return pd.DataFrame(out, columns=["vec_id", "id", "d"])

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        got = nearest(x, y)
        for c in by:
            got[c] = x[c].iloc[0] if len(x) else None
        return got[[*by, "vec_id", "id", "d"]]

    kinds = [f"{c} {dict(a.dtypes)[c]}" for c in by]
    near = left.groupBy(*by, "i", "j").cogroup(right.groupBy(*by, "i", "j")).applyInPandas(run, ", ".join([*kinds, "vec_id long, id long, d double"]))
    best = near.groupBy(*by, "vec_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("d", "id"))), 1, 2).alias("c"))  # two for each block
    d1, d2 = F.get("c", F.lit(0)), F.get("c", F.lit(1))
    return best.where(d1["d"] < ratio * d2["d"]).select(*by, "vec_id", d1["id"].alias("match_id"), d1["d"].alias("d1"), d2["d"].alias("d2"))


def top_k_per(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)

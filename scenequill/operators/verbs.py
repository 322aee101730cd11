"""What one does with a dataset as a whole: rows, columns, sets."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.draws import order_of


def rows_by_number(df: DataFrame, numbers: Iterable[int], number: str = "nth") -> DataFrame:
    """The rows with these numbers, in the order given (``rank``); a number that comes twice gives its row twice. ``numbers``
    is the caller's own list; a number that no row has is left out."""
    asked = df.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(numbers)], f"rank long, {number} long")
    return df.join(asked, number)


def capped(df: DataFrame, most: int | None) -> DataFrame:
    """At most so many rows; None, 0 or a negative number: all."""
    return df.limit(most) if most and most > 0 else df


def only(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"no columns {', '.join(missing)}")
    return df.select(*[F.col(f"`{c}`") for c in columns])


def without(df: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"no columns {', '.join(missing)}")
    return df.drop(*columns)


def cast(df: DataFrame, **kinds: str) -> DataFrame:
    return df.withColumns({c: F.col(f"`{c}`").cast(k) for c, k in kinds.items()})


def from_list(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    return df.orderBy(order_of(F.lit(seed), F.col(key)), key)


def mapped(df: DataFrame, f: Callable, schema: str, **kwargs) -> DataFrame:
    """``f(frame, **kwargs)`` over batches of rows as pandas frames."""
    return df.mapInPandas(lambda it: (f(x, **kwargs) for x in it), schema)


def filtered_and_mapped(df: DataFrame, keep, columns: dict) -> DataFrame:
    """Both in one pass: a condition and new columns."""
    return df.where(keep).withColumns(columns)


def distinct_first(df: DataFrame, key: str, order: str) -> DataFrame:
    """Of rows with one key the first by ``order``, empty and null keys left out."""
    rest = [c for c in df.columns if c != key]
    g = df.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("r"))
    return g.select(key, "r.*")


def zipped(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of two numbered tables (``nth``) side by side, as many as the shorter has."""
    return a.join(b, "nth")


def batch_rows(df: DataFrame, size: int) -> DataFrame:
    """``batch``: rows with ``nth`` in groups of so many."""
    return df.withColumn("batch", F.floor(F.col("nth") / size))

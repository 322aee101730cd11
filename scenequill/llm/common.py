"""What the corpus operators share: reading documents, staging tables in the shared folder, Arrow helpers.

Conventions that hold for every operator of this subpackage
-----------------------------------------------------------
* Only the columns an operator needs are read (``doc_id``, ``text``, sometimes ``source``); any other column,
  whatever its name, is ignored or carried through untouched.
* A null text counts as the empty text. A null doc_id counts as smaller than every other doc_id.
* Rows are told apart by (doc_id, 64-bit digest of the text): rows that share a doc_id but not the text are
  different documents, rows that share both are repeats of one document, and each row gets its own result row.
* An empty table gives an empty result with the full schema.
* A text of any length is handled whole. Batches are cut so that a long text stands alone in one; seeds, anchors and packed pieces
  of a text beyond some megabytes are found part by part, with the overlap that makes the parts equal to the whole.
* Ties go to the smaller doc_id, or as the operator's docstring says.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: The six ASCII white space characters of the contracts, ``[\x20\x09-\x0D]``.
WS = " \t\n\x0b\x0c\r"
#: Stands for a null doc_id inside the operators.
NO_ID = -(1 << 63)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``_id`` (doc_id, never null), ``_rk`` (digest of the text), ``text`` (never null) and the columns asked for."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_rk"), text.alias("text"), *[F.col(f"`{c}`") for c in more]
    )


def whole_rows(docs: DataFrame) -> DataFrame:
    """``_id``, ``_rk`` as in ``keyed``, and ``row``: the whole row as a struct, so that no column of it, whatever its name,
    meets one of ours. ``select("row.*")`` gives it back."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_rk"), row.alias("row"))


def distinct_rows(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """Of the rows of ``docs`` whose (``_id``, ``_rk``) ``stay`` has, one for each, all their columns. Rows that repeat doc_id
    and text are reduced map-side first, so that any number of them costs a row for each task."""
    one = whole_rows(docs).groupBy("_id", "_rk").agg(F.first("row").alias("row"))
    return one.join(stay.select("_id", "_rk").hint("merge"), ["_id", "_rk"], "left_semi").select("row.*")


def doc_id() -> Column:
    """The doc_id of a row of ``keyed``, null again where it was null."""
    return F.nullif(F.col("_id"), F.lit(NO_ID)).alias("doc_id")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else. A pure ASCII text takes the fast whole-string path, which does the same there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text."""
    bare = F.btrim(text, F.lit(WS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+"))).cast("long")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session. Where that is unset, as
    in tests on one machine, a temporary folder of our own."""
    set_to = spark.conf.get("spark.checkpoint.dir", None)
    if set_to:
        return set_to.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        own = tempfile.TemporaryDirectory(prefix="corpus-stages-")
        atexit.register(own.cleanup)
        _own[app] = f"file://{own.name}"
    return _own[app]


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to a new folder in the shared one and read it back: cuts the lineage, so that a lost
    executor costs a read and not a recomputation, and makes what was not determined by the rows alone fixed."""
    spark = df.sparkSession
    path = path or f"{shared_dir(spark)}/corpus-stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete tables of ``stage`` that no plan reads any more. Those that a result still reads stay until ``clean``."""
    for df in staged:
        if path := getattr(df, "staged_at", None):
            jvm = df.sparkSession.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clean(spark: SparkSession) -> None:
    """Delete all staged tables of this application: for when its results have been written or read."""
    df = spark.range(0)
    df.staged_at = f"{shared_dir(spark)}/corpus-stages/{spark.sparkContext.applicationId}"
    discard(df)


def free_shuffles(spark: SparkSession) -> None:
    """Shuffle files go when the driver's JVM collects the plans that own them, which it may not do for half an hour; after a
    staged step nothing needs them, so it is asked to collect now."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def python_ready(spark: SparkSession) -> None:
    """Before a step in Python: the package goes to the executors, and Arrow batches stay small, as they are bounded by rows and
    whole texts can be long. Plans run after the operator has returned, so the session keeps the smaller bound."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > 2000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def hot_keys(sample: DataFrame, key: str, share: float = 0.0005) -> np.ndarray:
    """Values of ``key`` that hold at least ``share`` of the rows of a sample: 1 / share at most, one row to the driver. They
    may only decide over how many tasks a key's rows are dealt, never what comes out."""
    got = sample.agg(F.expr(f"approx_top_k({key}, 500, 20000)").alias("top"), F.count("*").alias("n")).first()
    return np.array([x["item"] for x in got["top"] or [] if x["count"] >= max(20, share * got["n"])], np.int64)


def offsets(col: pa.Array) -> np.ndarray:
    """Byte offsets of a string or binary array without nulls, of length n + 1, from the start of its data buffer."""
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    if len(col) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)


def data(col: pa.Array) -> np.ndarray:
    buf = col.buffers()[2]
    return np.frombuffer(buf, np.uint8) if buf is not None and len(buf) else np.zeros(0, np.uint8)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``most`` bytes of the text column, or a single row."""
    for b in batches:
        if not b.num_rows:
            continue
        o = offsets(b.column(b.schema.get_field_index(column)))
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(o, o[i] + most, "right")) - 1)
            yield b.slice(i, j - i)
            i = j


def runs(starts: np.ndarray, n: int) -> np.ndarray:
    """Group number of each of n sorted rows, where ``starts`` marks the first row of each group."""
    return np.cumsum(starts[:n]) - 1


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... (count[0] of them), begin[1], ... as one array."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total) + np.repeat(begin - (ends - count), count)

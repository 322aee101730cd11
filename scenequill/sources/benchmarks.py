"""Benchmark files to the common item table (``tables.ITEM``, and ``nth``, the items' order).

Each reader takes the folder that holds the benchmark and reads with a fixed schema, so nothing is inferred and a missing
field is null. Archives are unpacked once, beside a marker."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import setting_of

COLUMNS = ["nth", "id", "question", "answer", "answer_text", "question_type", "category", "subcategory", "options", "images", "source"]
# The subsets of one benchmark and what they are called.
SUBSETS = {
    "ep": "Entity Presence", "eq": "Entity Quantification", "fr": "Functional Reasoning", "oo": "Object-Object Spatial Relationship",
    "os": "Object-Scene Spatial Relationship", "sa": "Size Assessment", "sp": "Spatial Planning", "sq": "Scene Quantification",
}
LETTERS = "ABCDEF"


def unpacked(archive: str, to: str) -> str:
    """The folder of an archive's files: unpacked if no marker says it has been. A file that would leave it is an error."""
    marker = os.path.join(to, ".unpacked")
    if not os.path.exists(marker):
        os.makedirs(to, exist_ok=True)
        with zipfile.ZipFile(archive) as z:
            for name in z.namelist():
                if not os.path.realpath(os.path.join(to, name)).startswith(os.path.realpath(to) + os.sep):
                    raise ValueError(f"{name} lies outside the archive's folder")
            z.extractall(to)
        with open(marker, "w") as f:
            f.write("ok")
    return to


def _numbered(df: DataFrame) -> DataFrame:
    """In file order: one file, read as one partition for a JSON array, by offset for JSON lines."""
    return df.withColumn("nth", F.monotonically_increasing_id())


def _under(root: str, path: Column) -> Column:
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def _items(df: DataFrame, source: str) -> DataFrame:
    return df.withColumn("source", F.lit(source)).select(*COLUMNS)


def embedded_options(question: Column) -> Column:
    """The options that a question's text lists as (A) ... (B) ..."""
    return F.transform(F.regexp_extract_all(question, F.lit(r"\([A-F]\)\s*([^(]+?)(?=\([A-F]\)|$)"), F.lit(1)), lambda x: F.trim(x))


def read_spatialscore(spark: SparkSession, root: str) -> DataFrame:
    kind = "id string, index string, question string, answer string, question_type string, category string, subcategory string, img_paths array<string>"
    t = _numbered(spark.read.schema(kind).option("multiLine", True).json(f"{root}/SpatialScore.json"))
    q_type = F.coalesce("question_type", F.lit("open-ended"))
    return _items(
        t.select(
            "nth",
            F.coalesce("id", "index", F.col("nth").cast("string")).alias("id"),
            F.coalesce("question", F.lit("")).alias("question"),
            F.coalesce("answer", F.lit("")).alias("answer"),
            F.lit(None).cast("string").alias("answer_text"),
            q_type.alias("question_type"),
            F.coalesce("category", F.lit("unknown")).alias("category"),
            F.coalesce("subcategory", F.lit("unknown")).alias("subcategory"),
            F.when(q_type == "multi-choice", embedded_options(F.col("question"))).otherwise(F.array().cast("array<string>")).alias("options"),
            F.transform(F.coalesce("img_paths", F.array()), lambda p: _under(root, p)).alias("images"),
        ),
        "SpatialScore",
    )


def read_omnispatial(spark: SparkSession, root: str, split: str = "test") -> DataFrame:
    base = f"{root}/OmniSpatial-{split}"
    kind = "id string, question string, options array<string>, answer string, task_type string, sub_task_type string"
    t = _numbered(spark.read.schema(kind).option("multiLine", True).json(f"{base}/data.json"))
    ident, task = F.coalesce("id", F.col("nth").cast("string")), F.coalesce("task_type", F.lit("unknown"))
    options = F.coalesce("options", F.array())
    i = F.when(F.col("answer").rlike("^[0-9]+$"), F.col("answer").try_cast("int"))
    inside = i.isNotNull() & (i < F.size(options))
    image = F.concat(F.lit(f"{base}/"), task, F.lit("/"), F.substring_index(ident, "_", 1), F.lit(".png"))
    return _items(
        t.select(
            "nth",
            ident.alias("id"),
            F.coalesce("question", F.lit("")).alias("question"),
            F.when(inside, F.char(i + 65)).otherwise(F.upper(F.left(F.trim(F.coalesce("answer", F.lit(""))), F.lit(1)))).alias("answer"),
            F.when(inside, F.get(options, i)).otherwise(F.coalesce("answer", F.lit(""))).alias("answer_text"),
            F.lit("multi-choice").alias("question_type"),
            task.alias("category"),
            F.coalesce("sub_task_type", F.lit("unknown")).alias("subcategory"),
            options.alias("options"),
            F.array(image).alias("images"),
        ),
        "OmniSpatial",
    )


def space10_items(rows: DataFrame, subset: str) -> DataFrame:
    """A subset's rows (nth, index, question, answer, A to F, image) as items; empty options are left out."""
    have = [c if c in rows.columns else None for c in LETTERS]
    options = F.filter(F.array(*[F.col(c).cast("string") if c else F.lit(None).cast("string") for c in have]), lambda o: F.coalesce(o, F.lit("")) != "")
    ident = F.concat(F.lit(f"{subset}_"), F.coalesce(F.col("index").cast("string"), F.col("nth").cast("string")))
    image = F.when(F.col("image").isNull(), F.array().cast("array<string>")).otherwise(F.array("image")) if "image" in rows.columns else F.array().cast("array<string>")
    return rows.select(
        "nth", ident.alias("id"), F.coalesce("question", F.lit("")).alias("question"), F.coalesce("answer", F.lit("")).alias("answer"), F.lit(None).cast("string").alias("answer_text"),
        F.lit("multi-choice").alias("question_type"), F.lit(subset).alias("category"), F.lit(SUBSETS.get(subset, subset)).alias("subcategory"), options.alias("options"), image.alias("images"), F.lit("SpaCE-10").alias("source"),
    )


def read_space10(spark: SparkSession, root: str, subsets: list[str] | None = None) -> DataFrame:
    """Parquet files under single-choice/<subset>, all subsets one below the other."""
    out = None
    for s in subsets or list(SUBSETS):
        one = space10_items(_numbered(spark.read.parquet(f"{root}/single-choice/{s}")), s)
        out = one if out is None else out.unionByName(one)
    return out


def read_mindcube(spark: SparkSession, root: str, name: str = "MindCube_tinybench.jsonl") -> DataFrame:
    base = f"{root}/data"
    t = _numbered(spark.read.schema("id string, question string, gt_answer string, answer string, images array<string>").json(f"{base}/raw/{name}"))
    ident = F.coalesce("id", F.col("nth").cast("string"))
    return _items(
        t.select(
            "nth", ident.alias("id"), F.coalesce("question", F.lit("")).alias("question"), F.coalesce("gt_answer", "answer", F.lit("")).alias("answer"), F.lit(None).cast("string").alias("answer_text"),
            F.lit("multi-choice").alias("question_type"), setting_of(ident).alias("category"), setting_of(ident).alias("subcategory"), F.array().cast("array<string>").alias("options"),
            F.transform(F.coalesce("images", F.array()), lambda p: _under(base, p)).alias("images"),
        ),
        "MindCube",
    )


READERS: dict[str, Callable[..., DataFrame]] = {"spatialscore": read_spatialscore, "omnispatial": read_omnispatial, "space10": read_space10, "mindcube": read_mindcube}


def read_benchmark(spark: SparkSession, name: str, root: str, **options) -> DataFrame:
    if name.lower() not in READERS:
        raise ValueError(f"unknown benchmark {name!r}; there are {', '.join(READERS)}")
    return READERS[name.lower()](spark, root, **options)

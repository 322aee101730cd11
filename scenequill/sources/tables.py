"""Reading and writing: versioned Parquet tables, JSON lines, mesh text, images, benchmark items."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEM = "id string, question string, answer string, answer_text string, question_type string, category string, subcategory string, options array<string>, images array<string>, source string"


def read_table(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A Parquet table; of one with a column ``split`` the named split, or the first one (by name) if there is no such."""
    df = spark.read.parquet(path)
    if split is None or "split" not in df.columns:
        return df
    if not df.where(F.col("split") == split).take(1):
        split = df.agg(F.min("split")).first()[0]
    return df.where(F.col("split") == split)


def cached_table(spark: SparkSession, path: str, cache: str) -> DataFrame:
    """Read through a copy: the table at ``path`` is written to ``cache`` once, and read from there."""
    try:
        return spark.read.parquet(cache)
    except AnalysisException:
        spark.read.parquet(path).write.mode("errorifexists").parquet(cache)
        return spark.read.parquet(cache)


def save_copies(df: DataFrame, roots: list[str], tag: str) -> list[str]:
    """The same table under several roots, each a new version, with a tag in the rows."""
    return [write_table(df.withColumn("tag", F.lit(tag)), r) for r in roots]


def load_config(path: str) -> dict:
    """A JSON file, or nested ``key: value`` lines indented by spaces."""
    with open(path) as f:
        text = f.read()
    if text.lstrip().startswith("{"):
        return json.loads(text)
    out: dict = {}
    open_at = [(-1, out)]
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare.strip() or bare.lstrip().startswith("#"):
            continue
        depth = len(bare) - len(bare.lstrip())
        key, _, value = bare.strip().partition(":")
        while depth <= open_at[-1][0]:
            open_at.pop()
        if value.strip():
            v = value.strip().strip("'\"")
            open_at[-1][1][key] = {"true": True, "false": False, "null": None}.get(v, v) if not v.replace(".", "", 1).lstrip("-").isdigit() else json.loads(v)
        else:
            open_at[-1][1][key] = inner = {}
            open_at.append((depth, inner))
    return out


def write_table(df: DataFrame, root: str) -> str:
    """To a new version under ``root``; returns its path. Nothing is deleted and nothing half-written is seen."""
    path = f"{root.rstrip('/')}/v-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return path


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)


def read_meshes(spark: SparkSession, path: str) -> DataFrame:
    t = spark.read.option("wholetext", True).option("pathGlobFilter", "*.obj").text(path)
    return t.select(F.regexp_extract("_metadata.file_name", r"^(.*)\.obj$", 1).alias("mesh_id"), F.col("value").alias("text"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.{png,jpg,jpeg}").load(path).select(F.col("path").alias("image_id"), "content")


def write_manifest(path: str, manifest: dict) -> str:
    """To a file of the driver, whose folders are made."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w") as f:
        json.dump(manifest, f, indent=2)
    return path


def read_clouds(spark: SparkSession, path: str) -> DataFrame:
    """Points (scene_id, object_id, point_id, x, y, z) of text files named <scene>_<object>.xyz, a point to a line."""
    t = spark.read.option("pathGlobFilter", "*.xyz").text(path).withColumn("f", F.regexp_extract("_metadata.file_name", r"^(.*)_([^_]*)\.xyz$", 1)).withColumn("o", F.regexp_extract("_metadata.file_name", r"^(.*)_([^_]*)\.xyz$", 2))
    p = F.split(F.trim("value"), "\\s+")
    at = [p[i].try_cast("double").alias(a) for i, a in enumerate("xyz")]
    return t.where(F.size(p) >= 3).select(F.col("f").alias("scene_id"), F.col("o").alias("object_id"), F.monotonically_increasing_id().alias("point_id"), *at)


def write_clouds(points: DataFrame, path: str) -> None:
    """A folder for each scene and object, with lines of x, y, z."""
    line = F.concat_ws(" ", "x", "y", "z").alias("value")
    points.select("scene_id", "object_id", line).write.mode("error").partitionBy("scene_id", "object_id").text(path)


def write_meshes(texts: DataFrame, path: str) -> None:
    """A folder for each mesh, with its text."""
    texts.select("mesh_id", F.rtrim("text").alias("value")).write.mode("error").partitionBy("mesh_id").text(path)


def union_subsets(parts: dict[str, DataFrame], names: dict[str, str]) -> DataFrame:
    """All subsets one below the other, with the subset's key and its display name."""
    out = None
    for key, df in parts.items():
        one = df.withColumns({"subset": F.lit(key), "category": F.lit(names.get(key, key))})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    if out is None:
        raise ValueError("no subsets")
    return out


def setting_of(ident: Column) -> Column:
    t, out = F.lower(ident), F.lit("other")
    for s in ("among", "translation", "rotation", "around"):
        out = F.when(t.contains(s), s).otherwise(out)
    return out


def answer_letter(answer: Column) -> Column:
    """An index to its letter, or a text's first character in upper case."""
    i = answer.try_cast("int")
    return F.when(i.isNotNull(), F.char(i + 65)).otherwise(F.upper(F.substring(answer, 1, 1)))


def data_uri(content: Column) -> Column:
    return F.concat(F.lit("data:image/png;base64,"), F.regexp_replace(F.base64(content), "[\\r\\n]", ""))

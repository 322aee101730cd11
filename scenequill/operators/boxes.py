"""3-D boxes of objects: aligned, and oriented where that saves volume; their texts and question rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import half_up, pick
from ..functions.text import fill
from .dialogue import messages_of

AXES, OBJECT = ("x", "y", "z"), ["scene_id", "object_id"]
QUESTIONS = [
    "Where in 3D is the [A]?", "What 3D box encloses the [A]?", "State the 3D coordinates of the [A].",
    "Find the [A] in this scene and give its 3D box.", "Report position and size of the [A] in 3D.", "Which 3D bounding box belongs to the [A]?",
]
ANSWERS = ["[X]", "The [A] is at [X].", "Its 3D box is [X].", "[A]: [X]."]


def boxes(points: DataFrame, threshold: float | None = 0.35) -> DataFrame:
    """scene_id, object_id, centre, extent (arrays of three), volume, n_points, oriented. ``oriented`` is a struct (centre,
    extent, rotation: the principal axes as rows) where the box along these axes saves at least ``threshold`` of the aligned
    one's volume, else null; 0 or None asks for none. Two aggregations; eigenvectors are found for a row of moments each."""
    pairs = [(a, b) for i, a in enumerate(AXES) for b in AXES[i:]]
    aggs = [f(a).alias(f"{n}{a}") for a in AXES for n, f in (("lo", F.min), ("hi", F.max), ("m", F.avg))]
    g = points.groupBy(*OBJECT).agg(*aggs, F.count("*").alias("n_points"), *[F.covar_pop(a, b).alias(f"v{a}{b}") for a, b in pairs])
    three = lambda f: F.array(*[f(a) for a in AXES])
    box = g.withColumns({"centre": three(lambda a: (F.col(f"lo{a}") + F.col(f"hi{a}")) / 2), "extent": three(lambda a: F.col(f"hi{a}") - F.col(f"lo{a}"))})
    box = box.withColumn("volume", F.col("extent")[0] * F.col("extent")[1] * F.col("extent")[2])
    kind = "struct<centre:array<double>,extent:array<double>,rotation:array<array<double>>>"
    if not threshold or threshold <= 0:
        return box.select(*OBJECT, "centre", "extent", "volume", "n_points", F.lit(None).cast(kind).alias("oriented"))

    @F.pandas_udf("array<double>")
    def principal(xx: pd.Series, xy: pd.Series, xz: pd.Series, yy: pd.Series, yz: pd.Series, zz: pd.Series) -> pd.Series:
        m = np.stack([np.stack([xx, xy, xz], 1), np.stack([xy, yy, yz], 1), np.stack([xz, yz, zz], 1)], 1)
        return pd.Series(list(np.linalg.eigh(m)[1].transpose(0, 2, 1).reshape(len(xx), 9)))

    axes = box.where("n_points > 1 AND volume > 0").select(*OBJECT, "mx", "my", "mz", principal(*[f"v{a}{b}" for a, b in pairs]).alias("r"))
    along = lambda k: sum(((F.col(a) - F.col(f"m{a}")) * F.col("r")[3 * k + i] for i, a in enumerate(AXES)), F.lit(0.0))
    turned = points.join(axes, OBJECT).select(*OBJECT, "r", "mx", "my", "mz", *[along(k).alias(f"p{k}") for k in range(3)])
    span = turned.groupBy(*OBJECT).agg(F.first("r").alias("r"), *[F.first(f"m{a}").alias(f"m{a}") for a in AXES], *[f(f"p{k}").alias(f"{n}{k}") for k in range(3) for n, f in (("lo", F.min), ("hi", F.max))])
    size = F.array(*[F.col(f"hi{k}") - F.col(f"lo{k}") for k in range(3)])
    mid = [(F.col(f"hi{k}") + F.col(f"lo{k}")) / 2 for k in range(3)]
    centre = F.array(*[F.col(f"m{a}") + sum((mid[k] * F.col("r")[3 * k + i] for k in range(3)), F.lit(0.0)) for i, a in enumerate(AXES)])
    rotation = F.array(*[F.slice("r", 3 * k + 1, 3) for k in range(3)])
    found = span.select(*OBJECT, F.struct(centre.alias("centre"), size.alias("extent"), rotation.alias("rotation")).alias("oriented"))
    out = box.select(*OBJECT, "centre", "extent", "volume", "n_points").join(found, OBJECT, "left")
    e = F.col("oriented.extent")
    own = e[0] * e[1] * e[2]
    keep = (own > 0) & (1 - own / F.col("volume") >= threshold)
    return out.withColumn("oriented", F.when(keep, F.col("oriented")))


def two(c: Column) -> Column:
    return F.format_string("%.2f", half_up(c, 2))


def point3d(centre: Column, extent: Column, label: Column) -> Column:
    """A pointing tag in 3-D."""
    at = [F.concat(F.lit(f' {a}="'), two(centre[i]), F.lit('"')) for i, a in enumerate(AXES)]
    return F.concat(F.lit("<point3d"), *at, F.lit(' extent="'), F.concat_ws(",", *[two(extent[i]) for i in range(3)]), F.lit('" alt="'), label, F.lit('"/>'))


def bracket(centre: Column, extent: Column) -> Column:
    """[centre, extent], each in brackets."""
    part = lambda v: F.concat(F.lit("["), F.concat_ws(",", *[two(v[i]) for i in range(3)]), F.lit("]"))
    return F.concat(F.lit("["), part(centre), F.lit(","), part(extent), F.lit("]"))


def box_prompts(labelled: DataFrame, n: int | None = 3, form: str = "point3d") -> DataFrame:
    """scene_id, object_id, nth, text: the first ``n`` questions (None: all) about each box, each with an answer drawn by its
    key. An empty label is "object"."""
    if form not in ("point3d", "bracket"):
        raise ValueError(f"unknown form {form!r}")
    label = F.coalesce(F.nullif(F.col("label"), F.lit("")), F.lit("object"))
    value = point3d(F.col("centre"), F.col("extent"), F.coalesce("label", F.lit(""))) if form == "point3d" else bracket(F.col("centre"), F.col("extent"))
    rows = labelled.select(*OBJECT, label.alias("l"), value.alias("v"), F.posexplode(F.array(*[F.lit(q) for q in QUESTIONS[:n]])).alias("nth", "q"))
    answer = pick(ANSWERS, "box", F.col("scene_id"), F.col("object_id"), F.col("nth"))
    text = F.concat(fill(F.col("q"), A=F.col("l")), F.lit(" Answer: "), fill(answer, A=F.col("l"), X=F.col("v")))
    return rows.select(*OBJECT, F.col("nth").cast("long").alias("nth"), text.alias("text"))


def detections(scenes: DataFrame, points: DataFrame, n: int = 3, form: str = "point3d", threshold: float | None = 0.35) -> DataFrame:
    """scene_id, boxes, prompts, truncated, messages for every row of ``scenes`` (scene_id, objects array<struct<object_id,
    label>>): objects without points are left out, and a scene without any has empty lists, never null."""
    named = scenes.select("scene_id", F.posexplode("objects").alias("at", "o")).select("scene_id", "at", "o.object_id", "o.label")
    found = boxes(points, threshold).join(named, OBJECT)
    box = F.struct("at", "object_id", F.col("centre"), F.col("extent"), "label", "oriented")
    per = found.groupBy("scene_id").agg(F.array_sort(F.collect_list(box)).alias("boxes"))
    said = box_prompts(found, n, form).join(named, OBJECT).groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct("at", "nth", "text"))).alias("p"))
    out = scenes.select("scene_id").join(per, "scene_id", "left").join(said, "scene_id", "left")
    texts = F.coalesce(F.transform("p", lambda x: x["text"]), F.array().cast("array<string>"))
    out = out.withColumns({"prompts": texts, "boxes": F.coalesce("boxes", F.array())})
    return out.select("scene_id", "boxes", "prompts", F.slice("prompts", 1, 5).alias("truncated"), messages_of(F.slice("prompts", 1, 5)).alias("messages"))


def box_json(row: Column) -> Column:
    """A box struct as JSON, with nulls written."""
    return F.to_json(row, {"ignoreNullFields": "false"})

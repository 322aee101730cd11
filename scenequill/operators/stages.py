"""The stages of a dataset, each a table in and a table out: embedding and tags, captions and places, depth and scenes,
orientation, descriptions, poses, matches, reasoning. Models stand behind the seams of ``models``; the rest is columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import imaging as I
from ..functions import text as T
from . import boxes, correspondences, curate, dialogue, models, poses


def tagged(images: DataFrame, tags: DataFrame, backend: str | type = "stub", include: str | None = None, exclude: str | None = None) -> DataFrame:
    """(vec_id, image) with ``embedding`` and the nearest of ``tags`` (label, tag_vec), filtered by tag in the same pass."""
    e = models.embeddings(images, "image", backend)
    best = curate.nearest_tag(e.where("embedding IS NOT NULL"), tags)
    out = e.join(best.select("vec_id", "tag"), "vec_id")
    return out.where(curate.tag_passes(F.col("tag"), include, exclude))


def merged_tags(own: Column, more: list[str]) -> Column:
    """A dataset's tags with ``more`` of them, each once; unchanged if it has one of them already."""
    new = F.array(*[F.lit(t) for t in more])
    own = F.coalesce(own, F.array().cast("array<string>"))
    return F.when(F.arrays_overlap(own, new), own).otherwise(F.array_union(own, new))


def localized(images: DataFrame, w: Column, h: Column, backend: str | type = "stub") -> DataFrame:
    """``images`` (image) with ``said`` by a pointing model, ``points`` in pixels, and ``captions`` of the same tags."""
    out = models.run_model(images, "locate", backend, "said", "image")
    return out.withColumns({"points": T.parse_points(F.col("said"), w, h), "captions": T.captions(F.col("said"))})


def refined(points: DataFrame, pixels: DataFrame, depth_radius: int = 8) -> DataFrame:
    """A mask (MASK columns, y, x) around each point (scene_id, mask_id, x, y): the pixels near it that a segmenter's table has."""
    at = points.select("scene_id", "mask_id", F.col("x").alias("px"), F.col("y").alias("py"))
    near = (F.abs(F.col("x") - F.col("px")) <= depth_radius) & (F.abs(F.col("y") - F.col("py")) <= depth_radius)
    return pixels.join(at, ["scene_id", "mask_id"]).where(near).select("scene_id", "mask_id", "y", "x")


def depths(images: DataFrame, backend: str | type = "stub") -> DataFrame:
    """``images`` (scene_id, image) to pixels (scene_id, y, x, z): a model's depth map, whose first number is its width; a failing
    image has none. Invalid depths become the map's median."""
    d = models.run_model(images, "depth", backend, "map", "image").where("map IS NOT NULL AND size(map) > 1")
    rows = d.select("scene_id", F.col("map")[0].cast("int").alias("w"), F.posexplode(F.slice("map", 2, F.size("map") - 1)).alias("i", "z"))
    from .reports import median_fill

    px = rows.select("scene_id", F.floor(F.col("i") / F.col("w")).alias("y"), (F.col("i") % F.col("w")).cast("long").alias("x"), F.col("z").cast("double").alias("z"))
    return median_fill(px, "scene_id", "z")


def scenes(pixels: DataFrame, masks: DataFrame, camera: tuple[float, float, float, float], canonical: bool = True) -> DataFrame:
    """Points of the masks (scene_id, object_id, point_id, x, y, z, canonical), without outliers, level if a main plane is found."""
    p = I.masked_points(masks, pixels, *camera).withColumnRenamed("mask_id", "object_id")
    p = I.without_outliers(p).withColumn("point_id", F.monotonically_increasing_id())
    return I.upright(p) if canonical else p.withColumn("canonical", F.lit(False))


def oriented(crops: DataFrame, backend: str | type = "stub") -> DataFrame:
    """``crops`` (image) with ``angles`` of a model's logits and ``description``; a crop that fails has nulls in its own row."""
    out = models.run_model(crops, "orientation", backend, "logits", "image")
    out = out.withColumn("angles", F.when(F.size("logits") >= 902, I.angles(F.col("logits"))))
    a = F.col("angles")
    return out.withColumn("description", F.when(a.isNotNull(), T.orientation_text(a["azimuth"], a["polar"], a["rotation"], a["confidence"]))).drop("logits")


def turned_by(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """How far each angle of ``b`` is from that of ``a``, wrapped to [-180, 180)."""
    both = a.select(key, F.col("angles").alias("p")).join(b.select(key, F.col("angles").alias("q")), key)
    d = lambda c: T.wrap_degrees(F.col("q")[c] - F.col("p")[c]).alias(c)
    return both.select(key, d("azimuth"), d("polar"), d("rotation"))


def described(regions: DataFrame, questions: list[str], n: int = 3, backend: str | type = "stub") -> DataFrame:
    """scene_id, captions, messages from scene_id, regions (array of crops): a caption of each region, and drawn questions about it."""
    r = models.run_model(regions.select("scene_id", F.posexplode("regions").alias("at", "region")), "describe", backend, "caption", "region")
    per = r.groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct("at", "caption", "region"))).alias("r"))
    per = per.select("scene_id", F.transform("r", lambda x: F.coalesce(x["caption"], F.lit(""))).alias("captions"), F.transform("r", lambda x: x["region"]).alias("regions"))
    said = dialogue.caption_questions(per, questions, n).groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct("nth", "text"))).alias("p"))
    out = per.join(said, "scene_id", "left").select("scene_id", "captions", F.coalesce(F.transform("p", lambda x: x["text"]), F.array().cast("array<string>")).alias("prompts"))
    return out.withColumn("messages", dialogue.messages_of(F.col("prompts")))


def posed(images: DataFrame, backend: str | type = "stub", most: int = 12, seed: int = 0) -> DataFrame:
    """``images`` (pose_id, image, w, h) with keypoints by a model and ``pose_messages``; joints of low visibility are the
    backend's to mark, and count as not visible."""
    return poses.pose_samples(models.run_model(images, "pose", backend, "keypoints", "image"), most, seed)


def matched_views(pairs: DataFrame, backend: str | type = "stub", least: int = 4) -> DataFrame:
    """``pairs`` (pair_id, a, b, sizes) with ``matches`` by a model; pairs with fewer than ``least`` have none. With ``messages``."""
    m = models.run_model(pairs, "match", backend, "matches", "a", "b")
    return correspondences.conversation(m.withColumn("matches", F.when(F.size("matches") >= least, F.col("matches"))))


def reasoned(conversations: DataFrame, backend: str | type = "stub", seed: int = 0) -> DataFrame:
    """conv_id, input, output: a drawn question of each conversation as a reasoning model is asked it, and what it says."""
    q = dialogue.chosen_pair(dialogue.adjacent_pairs(conversations), seed)
    return models.run_model(q.select("conv_id", "answer", dialogue.reasoner_input(F.col("question")).alias("input")), "reason", backend, "output", "input")


def detected(images: DataFrame, backend: str | type = "stub", larger: str | type | None = None, least: float = 0.0) -> DataFrame:
    """``images`` (image, phrase, w, h) with ``boxes``. Where a box covers nearly the whole image the ``larger`` model is asked."""
    out = models.run_model(images, "detect", backend, "boxes", "image", "phrase")
    if larger is not None:
        again = F.when(I.degenerate(F.col("boxes"), F.col("w"), F.col("h")), F.col("image"))
        out = models.run_model(out.withColumn("_again", again), "detect", larger, "_more", "_again", "phrase")
        out = out.withColumn("boxes", F.coalesce("_more", "boxes")).drop("_again", "_more")
    return out.withColumn("boxes", F.filter(F.coalesce("boxes", F.array()), lambda b: b["score"] >= least))


def lifted_boxes(objects: DataFrame, points: DataFrame, threshold: float | None = 0.35) -> DataFrame:
    """3-D boxes of masks with labels (scene_id, object_id, label); a missing label is object_ and the number."""
    b = boxes.boxes(points, threshold).join(objects, ["scene_id", "object_id"])
    return b.withColumn("label", F.coalesce(F.nullif(F.col("label"), F.lit("")), F.concat(F.lit("object_"), F.col("object_id").cast("string"))))


def generated_json(prompts: DataFrame, backend: str | type = "stub") -> DataFrame:
    """``prompts`` (prompt) with ``reply`` of a model and ``json`` found in it."""
    r = models.run_model(prompts, "answer", backend, "reply", "prompt")
    return r.withColumn("json", T.json_of(F.col("reply")))

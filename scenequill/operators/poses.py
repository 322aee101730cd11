"""Body keypoints: question rows of three families, and chat samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.draws import order_of, pick
from ..functions.text import fill, joint_tag
from .meshes import joint_relation
from .questions import TEMPLATES

# The names of the 17 joints, in order, and which of 33 body landmarks each one is.
JOINTS = ["nose", "left_eye", "right_eye", "left_ear", "right_ear", "left_shoulder", "right_shoulder", "left_elbow", "right_elbow",
          "left_wrist", "right_wrist", "left_hip", "right_hip", "left_knee", "right_knee", "left_ankle", "right_ankle"]
LANDMARKS = [0, 2, 5, 7, 8, 11, 12, 13, 14, 15, 16, 23, 24, 25, 26, 27, 28]

ONE_Q = ["Where is the person's [A]?", "Mark the [A] of this person.", "At which point is the [A]?"]
ONE_A = ["[X]", "The [A] is at [X].", "You find the [A] at [X]."]
ALL_Q = ["Mark all joints of this person that can be seen.", "Where are the visible joints of this person?"]

KEYPOINT = "array<struct<name:string,x:double,y:double,visible:boolean>>"


def from_landmarks(landmarks: Column) -> Column:
    """17 of 33 landmarks (an array of anything), in the order of JOINTS."""
    return F.transform(F.array(*[F.lit(i) for i in LANDMARKS]), lambda i: F.get(landmarks, i))


def keypoints(points: DataFrame, by: str = "pose_id") -> DataFrame:
    """(pose_id, joint, x, y) with joints by number or by name to pose_id, keypoints (KEYPOINT): all 17, a joint that is
    missing or has no place is not visible."""
    names = F.array(*[F.lit(n) for n in JOINTS])
    nth = F.coalesce(F.col("joint").try_cast("int"), F.nullif(F.array_position(names, F.col("joint").cast("string")), F.lit(0)) - 1)
    g = points.withColumn("_n", nth).where("_n BETWEEN 0 AND 16").groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("_n", F.struct("x", "y")))).alias("m"))
    one = lambda n, i: F.struct(n.alias("name"), F.try_element_at("m", i)["x"].cast("double").alias("x"), F.try_element_at("m", i)["y"].cast("double").alias("y"))
    k = F.transform(names, one)
    seen = F.transform(k, lambda j: F.struct(j["name"].alias("name"), j["x"].alias("x"), j["y"].alias("y"), (j["x"].isNotNull() & j["y"].isNotNull()).alias("visible")))
    return g.select(by, seen.alias("keypoints"))


def shown(name: Column) -> Column:
    return F.replace(name, F.lit("_"), F.lit(" "))


def visible(keypoints: Column) -> Column:
    return F.filter(keypoints, lambda k: k["visible"])


def person_box(keypoints: Column) -> Column:
    """struct<x1,y1,x2,y2> around the visible joints, rounded; null if there are none."""
    v = visible(keypoints)
    side = lambda f, c: F.bround(f(F.transform(v, lambda k: k[c]))).cast("int")
    return F.when(F.size(v) > 0, F.struct(side(F.array_min, "x").alias("x1"), side(F.array_min, "y").alias("y1"), side(F.array_max, "x").alias("x2"), side(F.array_max, "y").alias("y2")))


def shifted(keypoints: Column, dx: Column, dy: Column) -> Column:
    """From a crop's coordinates to the whole image's."""
    return F.transform(keypoints, lambda k: F.struct(k["name"].alias("name"), (k["x"] + dx).alias("x"), (k["y"] + dy).alias("y"), k["visible"].alias("visible")))


def _question_rows(most: int, seed: int) -> Column:
    """What ``pose_questions`` explodes: array<struct<question,answer>>, of the columns pose_id, v (the visible joints), w, h."""
    key = [F.lit(seed), F.col("pose_id")]
    token = lambda k: joint_tag(k["x"], k["y"], F.col("w"), F.col("h"), shown(k["name"]))
    row = lambda q, a: F.struct(q.alias("question"), a.alias("answer"))
    single = F.transform(F.slice("v", 1, most), lambda k, i: row(fill(pick(ONE_Q, *key, i, "q"), A=shown(k["name"])), fill(pick(ONE_A, *key, i, "a"), A=shown(k["name"]), X=token(k))))
    every = F.array(row(pick(ALL_Q, *key), F.array_join(F.transform("v", token), " ")))
    words = lambda r, part, *k: F.coalesce(*[F.when(r == n, pick(TEMPLATES[f"{n}_predicate"][part], *k)) for n in ("left", "right", "above", "below")])
    # pairs of joints by their places in v, those in the same place left out; their texts are made for the first ones in drawn order only
    nth = F.sequence(F.lit(0), F.size("v") - 1)
    at = lambda i: F.get(F.col("v"), i)
    relation = lambda i, j: joint_relation(at(j)["x"] - at(i)["x"], at(j)["y"] - at(i)["y"])
    two = F.flatten(F.transform(nth, lambda i: F.transform(F.filter(nth, lambda j: (j > i) & (relation(i, j) != "same")), lambda j: F.struct(order_of(*key, i, j).alias("o"), i.alias("i"), j.alias("j")))))

    def pair(x: Column) -> Column:
        own, r = [*key, x["i"], x["j"]], relation(x["i"], x["j"])
        names = {"A": shown(at(x["i"])["name"]), "B": shown(at(x["j"])["name"])}
        return row(fill(words(r, 0, *own, "q"), **names), fill(words(r, 1, *own, "a"), **names))

    left = F.greatest(F.lit(most) - F.size("v") - 1, F.lit(0))
    related = F.transform(F.when(left > 0, F.slice(F.array_sort(two), F.lit(1), left)).otherwise(F.slice(two, 1, 0)), pair)
    return F.slice(F.concat(single, every, related), 1, most)


def pose_questions(poses: DataFrame, most: int = 12, seed: int = 0) -> DataFrame:
    """pose_id, nth, question, answer from pose_id, keypoints, w, h: first one row for each visible joint, then one for all,
    then relations of joint pairs in drawn order, only true ones, and none for joints in the same place; ``most`` in all."""
    p = poses.withColumn("v", visible(F.col("keypoints"))).where(F.size("v") > 0)
    return p.select("pose_id", F.posexplode(_question_rows(most, seed)).alias("nth", "r")).select("pose_id", F.col("nth").cast("long").alias("nth"), "r.question", "r.answer")


def sample_of(question: Column, answer: Column) -> Column:
    """One chat sample: an image and a question, and the answer."""
    part = lambda text, kind, i: F.struct(F.lit(i).cast("long").alias("index"), text.cast("string").alias("text"), F.lit(kind).alias("type"))
    turn = lambda role, *c: F.struct(F.lit(role).alias("role"), F.array(*c).alias("content"))
    return F.array(turn("user", part(F.lit(None), "image", 0), part(question, "text", None)), turn("assistant", part(answer, "text", None)))


def pose_samples(poses: DataFrame, most: int = 12, seed: int = 0) -> DataFrame:
    """``poses`` with ``pose_messages``: an array of chat samples; null where a pose gives none."""
    own = poses.columns
    p = poses.withColumn("v", visible(F.col("keypoints")))
    samples = F.transform(_question_rows(most, seed), lambda r: sample_of(r["question"], r["answer"]))
    return p.select(*own, F.when((F.size("v") > 0) & F.col("pose_id").isNotNull() & (F.lit(most) > 0), samples).alias("pose_messages"))

"""Matched points of two views: question rows and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fill, point_tag

MATCH = "array<struct<ax:double,ay:double,bx:double,by:double,caption:string,distance:double>>"
QUESTIONS = ["[SRC] marks the [ALT] in the first view. Where in the second view is the same [ALT]?", "View 1 has the [ALT] at [SRC]. Point to it in view 2.", "The first view shows the [ALT] at [SRC]; find the matching [ALT] in the second."]
ANSWERS = ["[DST]", "In the second view the same [ALT] is at [DST].", "The matching place is [DST]."]


def as_matches(df: DataFrame) -> DataFrame:
    """(pair_id, nth, ax, ay, bx, by, caption) to pair_id, matches in the order of nth; a missing caption is "feature"."""
    m = F.struct("nth", *[F.col(c).cast("double").alias(c) for c in ("ax", "ay", "bx", "by")], F.coalesce("caption", F.lit("feature")).alias("caption"))
    return df.groupBy("pair_id").agg(F.array_sort(F.collect_list(m)).alias("matches"))


def question_of(m: Column, question: str = QUESTIONS[0], answer: str = ANSWERS[0], alt: str | None = None) -> Column:
    """struct<question,answer> of a match; view sizes are columns a_w, a_h, b_w, b_h."""
    caption = m["caption"] if alt is None else F.lit(alt)
    slots = {
        "SRC": point_tag(m["ax"], m["ay"], F.col("a_w"), F.col("a_h"), caption),
        "DST": point_tag(m["bx"], m["by"], F.col("b_w"), F.col("b_h"), caption),
        "ALT": caption,
    }
    return F.struct(fill(F.lit(question), **slots).alias("question"), fill(F.lit(answer), **slots).alias("answer"))


def _turns(q: Column, with_images: Column) -> Column:
    part = lambda text, kind, i: F.struct(F.lit(i).cast("long").alias("index"), text.cast("string").alias("text"), F.lit(kind).alias("type"))
    turn = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    none = F.lit(None)
    text = part(q["question"], "text", None)
    user = F.when(with_images, F.array(part(none, "image", 0), part(none, "image", 1), text)).otherwise(F.array(text))
    return F.array(turn("user", user), turn("assistant", F.array(part(q["answer"], "text", None))))


def _some(most: int | None) -> Column:
    return F.col("matches") if most is None else F.slice("matches", 1, most)


def conversation(pairs: DataFrame, most: int | None = None, **how: str) -> DataFrame:
    """``pairs`` (pair_id, matches, sizes) with ``messages``: one conversation, both images in its first turn only."""
    return pairs.withColumn("messages", F.flatten(F.transform(_some(most), lambda m, i: _turns(question_of(m, **how), i == 0))))


def single_questions(pairs: DataFrame, most: int | None = None, **how: str) -> DataFrame:
    """pair_id, nth, messages: a conversation of one turn, with both images, for each match."""
    rows = pairs.select("*", F.posexplode(_some(most)).alias("nth", "m"))
    return rows.select("pair_id", F.col("nth").cast("long").alias("nth"), _turns(question_of(F.col("m"), **how), F.lit(True)).alias("messages"))


def inlier_ratio(kept: Column, raw: Column) -> Column:
    """In [0, 1]; 0 if there was nothing to keep."""
    return F.coalesce(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.try_divide(kept, raw))), F.lit(0.0))


def backend_label(matcher: Column) -> Column:
    """"sift-bf" to "sift:bf": the matcher's name as a tool reports it."""
    return F.replace(F.lower(matcher), F.lit("-"), F.lit(":"))


def views_of(images: Column) -> Column:
    """Nested lists of views to one list, without nulls."""
    return F.filter(F.flatten(images), lambda x: x.isNotNull())

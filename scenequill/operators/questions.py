"""Question and answer texts about pairs of objects: one pass over a pairs table, whatever the number of kinds.

A kind's truth or value is a column of the pair's statistics, its wording one of several templates, drawn by a hash of scene,
pair and kind. Ties are false, or go to B. Labels are lower-cased."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.draws import order_of, pick, sample
from ..functions.text import fill, first_distance
from .dialogue import messages_of

#: Predicates: what A is to B, and what it is if not.
RELATIONS = {
    "left": ("to the left of", "to the right of"), "right": ("to the right of", "to the left of"), "above": ("above", "below"), "below": ("below", "above"),
    "wide": ("wider than", "narrower than"), "thin": ("thinner than", "wider than"), "big": ("bigger than", "smaller than"), "small": ("smaller than", "bigger than"),
    "tall": ("taller than", "shorter than"), "short": ("shorter than", "taller than"), "behind": ("behind", "in front of"), "front": ("in front of", "behind"),
}
#: Choices: which of the two it is.
COMPARED = {"left": "further to the left", "right": "further to the right", "above": "higher up", "below": "lower down", "tall": "taller", "short": "shorter"}
MEASURES = {"vertical": "vertical distance", "horizontal": "horizontal distance", "width": "width", "height": "height", "distance": "distance"}

OPEN = [f"{x}_predicate" for x in ("left", "right", "wide", "big", "thin", "small", "behind", "front")] + ["left_choice", "right_choice"]
UPRIGHT = [f"{x}_predicate" for x in ("above", "below", "tall", "short")] + [f"{x}_choice" for x in ("tall", "above", "short", "below")]
LENGTHS = ["vertical", "horizontal", "width", "height"]


def _templates() -> dict[str, tuple[list[str], list[str], list[str]]]:
    """kind: questions, answers if it holds, answers if not (for choices and lengths the same)."""
    out = {}
    for k, (is_, not_) in RELATIONS.items():
        out[f"{k}_predicate"] = (
            [f"Is the [A] {is_} the [B]?", f"Does the [A] look {is_} the [B] here?", f"Can you confirm that the [A] is {is_} the [B]?"],
            [f"Yes, the [A] is {is_} the [B].", f"Indeed, the [A] is {is_} the [B].", f"Correct, you will find the [A] {is_} the [B]."],
            [f"No, the [A] is not {is_} the [B].", f"Incorrect, the [A] is not {is_} the [B].", f"Actually, the [A] is {not_} the [B]."],
        )
    for k, more in COMPARED.items():
        answers = [f"The [X] is {more}.", f"Of the two, the [X] is {more}.", f"It is the [X] that is {more}."]
        out[f"{k}_choice"] = ([f"Which is {more}, the [A] or the [B]?", f"Of these two, which one appears {more}: the [A] or the [B]?", f"Tell me what is {more}, the [A] or the [B]?"], answers, answers)
    for k in ("vertical", "horizontal"):
        answers = [f"The {k} distance of the [A] and the [B] is [X].", f"Measured {k}ly, the [A] and the [B] are [X] apart.", "[X]."]
        out[k] = ([f"What is the {k} distance between the [A] and the [B]?", f"How far is the [A] from the [B] {k}ly?", f"Can you give the {k} gap that parts the [A] and the [B], as a distance measurement?"], answers, answers)
    for k, many in (("width", "wide"), ("height", "tall")):
        answers = [f"The {k} of the [A] is [X].", f"The [A] is [X] {many}.", f"It has a {k} of [X]."]
        out[k] = ([f"What is the {k} of the [A]?", f"How {many} is the [A]?", f"Please measure the {k} that the [A] has."], answers, answers)
    answers = ["The [A] and the [B] are [X] apart.", "The distance between the [A] and the [B] is [X].", "The [A] is [X] from the [B].", "About [X]."]
    out["distance"] = (["How far apart are the [A] and the [B]?", "What is the distance between the [A] and the [B]?", "How close is the [A] to the [B]?", "Can you measure the distance from the [A] to the [B]?"], answers, answers)
    return out


TEMPLATES = _templates()


def templates(spark: SparkSession) -> DataFrame:
    """kind, q, yes, no: a row for each kind."""
    return spark.createDataFrame([(k, *v) for k, v in TEMPLATES.items()], "kind string, _q array<string>, _yes array<string>, _no array<string>")


def rendered(rows: DataFrame, compat: bool = False) -> DataFrame:
    """``rows`` with ``question`` and ``answer``. They have a_* and b_* statistics, ``a_label``, ``b_label``, ``kind``, ``nth_text``
    (tells paraphrases of one kind apart) and, for "distance", the mean nearest-point ``distance``. With ``compat`` a height is
    the extent along x. Built in steps of columns, so that no expression is repeated."""
    own, kind = rows.columns, F.col("kind")
    key = [F.col("scene_id"), F.col("a_object_id"), F.col("b_object_id"), kind]
    holds = F.coalesce(*[F.when(kind.isin(f"{k}_predicate", f"{k}_choice"), G.predicate(k)) for k in RELATIONS], F.lit(True))
    length = F.coalesce(
        F.when(kind == "vertical", G.vertical_distance()), F.when(kind == "horizontal", G.horizontal_distance()), F.when(kind == "width", F.col("a_ex")),
        F.when(kind == "height", F.col("a_ex" if compat else "a_ey")), F.when(kind == "distance", F.col("distance")),
    )
    t = rows.withColumns({"_a": F.lower("a_label"), "_b": F.lower("b_label"), "_holds": holds, "_length": length})
    # all paraphrases of a pair's distance say the same length
    t = G.with_human_distance(t, "_said", F.col("_length"), *key)
    x = F.when(F.endswith(kind, F.lit("_choice")), F.when(F.col("_holds"), F.col("_a")).otherwise(F.col("_b"))).otherwise(F.coalesce("_said", F.lit("")))
    t = t.join(F.broadcast(templates(rows.sparkSession)), "kind")
    t = t.withColumns({"_x": x, "_w": F.when(F.col("_holds"), F.col("_yes")).otherwise(F.col("_no"))})
    t = t.withColumns({"_q": pick(F.col("_q"), *key, F.col("nth_text"), "q"), "_w": pick(F.col("_w"), *key, F.col("nth_text"), "a")})
    a, b = F.col("_a"), F.col("_b")
    return t.select(*own, fill(F.col("_q"), A=a, B=b).alias("question"), fill(F.col("_w"), A=a, B=b, X=F.col("_x")).alias("answer"))


def pair_questions(pairs: DataFrame, kinds: list[str] | None = None) -> DataFrame:
    """scene_id, a_object_id, b_object_id, kind, question, answer: every kind for every pair, one explode of one table."""
    kinds = kinds or [*OPEN, *UPRIGHT, *LENGTHS]
    if "distance" not in pairs.columns:
        pairs = pairs.withColumn("distance", F.lit(None).cast("double"))
    rows = pairs.withColumns({"kind": F.explode(F.array(*[F.lit(k) for k in kinds])), "nth_text": F.lit(0)})
    return rendered(rows).select("scene_id", "a_object_id", "b_object_id", "kind", "question", "answer")


def valid(answer: Column) -> Column:
    """The answer has a number, and it is not zero. ``answer``: "question Answer: answer"."""
    d = first_distance(answer)
    return d.isNotNull() & ~F.isnan(d) & (d != 0)


def drawn_pairs(pairs: DataFrame, k: int = 5) -> DataFrame:
    """Up to ``k`` ordered pairs of each scene, in drawn order (``nth`` from 1)."""
    w = Window.partitionBy("scene_id").orderBy(order_of("pairs", F.col("scene_id"), F.col("a_object_id"), F.col("b_object_id")), "a_object_id", "b_object_id")
    return pairs.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)


def scene_prompts(pairs: DataFrame, points: DataFrame, canonical: Column | bool = True, compat: bool = False, shown: int = 5) -> DataFrame:
    """scene_id, prompts, truncated, messages: the whole stage. Up to five drawn pairs of a scene each give the four lengths,
    the two kinds drawn for the scene, and five paraphrases of the distance between their points; rows whose length is
    missing or zero are replaced, for every pair, by as many rows of the two drawn kinds. Repeated texts go; what is left is
    shuffled, and the first ``shown`` make the messages. ``canonical``: whether kinds that need an upright scene take part.
    ``compat``: validity is asked of all rows, so that those without a number go as well."""
    canonical = F.lit(canonical) if isinstance(canonical, bool) else canonical
    some = drawn_pairs(pairs.withColumn("canonical", canonical))
    near = G.nearest_distances(points, some.select("scene_id", "a_object_id", "b_object_id"))
    some = some.join(near.select("scene_id", "a_object_id", "b_object_id", F.col("mean").alias("distance")), ["scene_id", "a_object_id", "b_object_id"], "left")
    names = lambda x: F.array(*[F.lit(k) for k in x])
    all_kinds = F.when(F.col("canonical"), names([*OPEN, *UPRIGHT, *LENGTHS])).otherwise(names(OPEN))
    some = some.withColumn("others", sample(all_kinds, 2, "kinds", F.col("scene_id")))
    one = lambda k: F.transform(k, lambda x: F.struct(x.alias("kind"), F.lit(0).alias("i")))
    asked = F.concat(one(names(LENGTHS)), one(F.col("others")), F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.struct(F.lit("distance").alias("kind"), i.alias("i"))))

    def said(rows: DataFrame) -> DataFrame:
        r = rendered(rows.withColumns({"kind": F.col("k.kind"), "nth_text": F.col("k.i")}), compat)
        return r.withColumn("text", F.concat("question", F.lit(" Answer: "), "answer"))

    first = said(some.withColumn("k", F.explode(asked)))
    asked_of = F.lit(True) if compat else F.col("kind").isin(*LENGTHS, "distance")
    first = first.withColumn("ok", ~asked_of | valid(F.col("text")))
    dropped = first.groupBy("scene_id").agg(F.count_if(~F.col("ok")).cast("int").alias("dropped")).where("dropped > 0")
    again = some.join(dropped, "scene_id")
    kinds = F.transform(F.sequence(F.lit(1), F.col("dropped")), lambda i: F.struct(pick(F.col("others"), "again", F.col("scene_id"), F.col("nth"), i).alias("kind"), i.alias("i")))
    again = said(again.withColumn("k", F.explode(kinds)))
    texts = first.select("scene_id", "text", "ok").union(again.select("scene_id", "text", F.lit(True)))
    texts = texts.groupBy("scene_id", "text").agg(F.max("ok").alias("ok")).where("ok")
    key = order_of("shuffle", F.col("scene_id"), F.col("text"))
    each = texts.groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct(key.alias("o"), "text"))).alias("p"))
    out = each.select("scene_id", F.transform("p", lambda x: x["text"]).alias("prompts"))
    return out.withColumn("truncated", F.slice("prompts", 1, shown)).withColumn("messages", messages_of(F.col("truncated")))


def cross_questions(objects: DataFrame, questions: list[str]) -> DataFrame:
    """Every question for every object (scene_id, object_id, label): a product with a fixed list, by explode."""
    q = F.explode(F.array(*[F.lit(x) for x in questions])).alias("question")
    return objects.select("scene_id", "object_id", "label", q).withColumn("question", fill(F.col("question"), A=F.col("label")))


def named_in(prompts: Column, captions: Column) -> Column:
    """The first of the captions that the prompt's text has in it, both lower-cased; null if none."""
    return F.get(F.filter(captions, lambda c: F.contains(F.lower(prompts), F.lower(c))), F.lit(0))

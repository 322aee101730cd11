"""Benchmarks: scores of predictions by each one's own rules, roll-ups, and the report.

Items have the columns of ``sources.tables.ITEM`` and a prediction joined to them; a scorer is one column expression, so all
benchmarks are scored in one pass. The columns ``p`` and ``g`` (see ``functions.text.with_lengths``) hold the two lengths."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .reports import rollup, with_predictions

# A text with one of these in it is taken to give a length.
UNIT_MARKS = ("meter", "meters", "cm", "feet", "inch", "inches", "ft", "m ")


def same_text(a: Column, b: Column) -> Column:
    return (T.strip(F.upper(a)) == T.strip(F.upper(b))).cast("double")


def _letters(prediction: Column, answer: Column, otherwise: Column) -> Column:
    said = T.option(prediction)
    return F.when(said.isNotNull(), (said == T.strip(F.upper(answer))).cast("double")).otherwise(otherwise)


def score_by_type(question_type: Column, prediction: Column, answer: Column) -> Column:
    """Multiple choice by letters if both texts have one, judgment by yes or no (null if unclear), anything else as an open
    answer: by ratio if the truth names a unit, else by mean relative accuracy, else by equality."""
    said, true = T.option(prediction), T.option(answer)
    choice = F.when(said.isNotNull() & true.isNotNull(), (said == true).cast("double")).otherwise(same_text(prediction, answer))
    return F.when(question_type == "multi-choice", choice).when(question_type == "judgment", T.score_yes_no(prediction, answer)).otherwise(score_open(prediction, answer))


def score_open(prediction: Column, answer: Column) -> Column:
    low = F.lower(answer)
    unit = F.lit(False)
    for mark in UNIT_MARKS:
        unit = unit | F.contains(low, F.lit(mark))
    return F.coalesce(F.when(unit, T.score_distance()), T.score_mra(), same_text(prediction, answer))


def score_with_text(prediction: Column, answer: Column, answer_text: Column) -> Column:
    """The letter, or else whether the prediction has the right option's text in it."""
    said = T.option(prediction)
    has = F.when(F.coalesce(answer_text, F.lit("")) != "", F.contains(F.lower(prediction), F.lower(answer_text)).cast("double")).otherwise(0.0)
    return F.when(said.isNotNull(), (said == F.upper(answer)).cast("double")).otherwise(has)


def score_with_options(prediction: Column, answer: Column, options: Column) -> Column:
    """The letter, or else whether the prediction has the text of the option with the right letter in it."""
    nth = F.ascii(T.strip(F.upper(answer))) - 65
    single = F.char_length(T.strip(answer)) == 1
    right = F.when(single & (nth >= 0), F.get(options, nth))
    return _letters(prediction, answer, F.coalesce(F.contains(F.lower(prediction), F.lower(right)).cast("double"), F.lit(0.0)))


def score_letter(prediction: Column, answer: Column) -> Column:
    """The letter, or else the whole text."""
    return _letters(prediction, answer, same_text(prediction, answer))


#: benchmark: score of columns question_type, prediction, answer, answer_text, options.
SCORERS: dict[str, Callable[[], Column]] = {
    "spatialscore": lambda: score_by_type(F.col("question_type"), F.col("prediction"), F.col("answer")),
    "omnispatial": lambda: score_with_text(F.col("prediction"), F.col("answer"), F.col("answer_text")),
    "space10": lambda: score_with_options(F.col("prediction"), F.col("answer"), F.col("options")),
    "mindcube": lambda: score_letter(F.col("prediction"), F.col("answer")),
}

# How a taxonomy of question classes is scored, and which classes make a category, by benchmark.
_RATIO = {k: "ratio_tolerance" for k in ("distance", "vertical_distance", "horizontal_distance", "measurement")} | {"comparison_yn": "yes_no", "comparison_choice": "choice", "unknown": "llm_judge"}
TAXONOMY = {
    "spatialscore": {"scorer": _RATIO, "categories": {"Object Distance": ["distance", "vertical_distance", "horizontal_distance"], "Object Properties": ["measurement"], "Spatial Relations": ["comparison_yn", "comparison_choice"]}},
    "omnispatial": {"scorer": dict.fromkeys(_RATIO, "llm_judge"), "categories": {"Spatial Interaction": ["distance", "vertical_distance", "horizontal_distance"], "Complex Logic": ["measurement"], "Perspective Taking": ["comparison_yn", "comparison_choice"]}},
    "space10": {"scorer": _RATIO, "categories": {"Size Assessment": ["measurement"], "Object-Object Spatial Relationship": ["comparison_yn", "comparison_choice"], "Spatial Planning": ["distance", "vertical_distance", "horizontal_distance"]}},
    "mindcube": {"scorer": {k: "mra" if v == "ratio_tolerance" else v for k, v in _RATIO.items()}, "categories": {"Rotation": ["vertical_distance", "horizontal_distance"], "Among": ["comparison_yn", "comparison_choice"], "Around": ["distance", "measurement"]}},
}


def taxonomy(name: str) -> dict:
    if name.lower() not in TAXONOMY:
        raise ValueError(f"unknown benchmark {name!r}; there are {', '.join(TAXONOMY)}")
    return TAXONOMY[name.lower()]


def score_taxonomy(df: DataFrame, name: str, judge: Column | None = None) -> DataFrame:
    """``df`` (question, pred, truth) with ``kind``, ``category`` and ``score`` by the question's class; what only a judge can
    score gets ``judge``, null without one."""
    plan = taxonomy(name)
    by = {"ratio_tolerance": T.score_distance(), "mra": T.score_mra(), "yes_no": T.score_yes_no(F.col("pred"), F.col("truth")), "choice": T.score_choice(F.col("pred"), F.col("truth"), F.col("question")), "llm_judge": F.lit(None).cast("double") if judge is None else judge}
    out = T.with_lengths(df).withColumn("kind", T.question_class(F.col("question")))
    category, score = F.lit("Other"), F.lit(None).cast("double")
    for label, kinds in plan["categories"].items():
        category = F.when(F.col("kind").isin(kinds), label).otherwise(category)
    for kind, how in plan["scorer"].items():
        score = F.when(F.col("kind") == kind, by[how]).otherwise(score)
    return out.withColumns({"category": category, "score": score})


class Runner:
    """Scores benchmarks given as tables. ``judge``: a column expression or UDF column that scores what a scorer leaves null."""

    def __init__(self, benchmarks: str | Iterable[str] | None = None, judge: Column | None = None):
        names = list(SCORERS) if benchmarks in (None, "all") else [benchmarks] if isinstance(benchmarks, str) else list(benchmarks)
        self.benchmarks, self.judge = [n.lower() for n in names], judge

    def score(self, name: str, items: DataFrame, predictions: DataFrame | list[str]) -> DataFrame:
        """benchmark, id, score, unscored, category, subcategory, question_type: one row for each item. ``predictions``: (id,
        prediction), a missing one being empty, or a list in the order of the items' ``nth``; what the list lacks is empty."""
        if name.lower() not in SCORERS:
            raise ValueError(f"no scorer for benchmark {name!r}")
        if isinstance(predictions, list):
            said = items.sparkSession.createDataFrame(list(enumerate(predictions)), "nth long, prediction string")
            joined = items.join(said, "nth", "left").withColumn("prediction", F.coalesce("prediction", F.lit("")))
        else:
            seq = predictions if "seq" in predictions.columns else predictions.withColumn("seq", F.lit(0))
            joined = with_predictions(items, seq)
        read = T.with_lengths(joined, "prediction", "answer").withColumn("raw", SCORERS[name.lower()]())
        score = F.coalesce("raw", self.judge if self.judge is not None else F.lit(None).cast("double"), F.lit(0.0))
        return read.select(F.lit(name).alias("benchmark"), "id", score.alias("score"), F.col("raw").isNull().alias("unscored"), "category", "subcategory", "question_type")

    def run(self, items: dict[str, DataFrame], predictions: dict[str, DataFrame | list[str]]) -> DataFrame:
        """Item scores of all configured benchmarks that have predictions, one below the other."""
        out = None
        for name in self.benchmarks:
            if name in predictions:
                one = self.score(name, items[name], predictions[name])
                out = one if out is None else out.unionByName(one)
        if out is None:
            raise ValueError("no benchmark has predictions")
        return out

    @staticmethod
    def items_for_inference(items: DataFrame) -> DataFrame:
        """What a model may see: no truth."""
        return items.select("id", "question", "options", "images", "category", "subcategory")


def summary(scores: DataFrame) -> DataFrame:
    """benchmark, level (overall, category, subcategory), key, accuracy, n: one pass of grouping sets over all benchmarks."""
    g = scores.groupingSets([[F.col("benchmark")], [F.col("benchmark"), F.col("category")], [F.col("benchmark"), F.col("subcategory")]], "benchmark", "category", "subcategory")
    out = g.agg(F.round(F.avg("score"), 6).alias("accuracy"), F.count("*").alias("n"), F.grouping("category").alias("gc"), F.grouping("subcategory").alias("gs"))
    level = F.when(F.col("gc") == 0, "category").when(F.col("gs") == 0, "subcategory").otherwise("overall")
    return out.select("benchmark", level.alias("level"), F.when(level == "category", F.col("category")).when(level == "subcategory", F.col("subcategory")).otherwise("all").alias("key"), "accuracy", "n")


def differing_subcategories(summary_rows: DataFrame) -> DataFrame:
    """benchmark, differs: whether its subcategories are others than its categories (a set comparison)."""
    keys = lambda level: F.array_sort(F.collect_set(F.when(F.col("level") == level, F.col("key"))))
    return summary_rows.groupBy("benchmark").agg((keys("category") != keys("subcategory")).alias("differs"))


def report_text(summary_rows: DataFrame) -> str:
    """The report as text, from a summary: a row for each category, so small."""
    rows = summary_rows.orderBy("benchmark", "level", "key").collect()
    by: dict[str, dict[str, list]] = {}
    for r in rows:
        by.setdefault(r["benchmark"], {}).setdefault(r["level"], []).append(r)
    rule, thin = "=" * 70, "-" * 60
    out = ["", rule, "SPATIAL REASONING BENCHMARK REPORT", rule]
    if by:
        out += ["", f"{'Benchmark':<25} {'Overall Accuracy':>18} {'Samples':>10}", "-" * 55]
        out += [f"{name:<25} {v['overall'][0]['accuracy']:>17.1%} {v['overall'][0]['n']:>10}" for name, v in by.items()]
    for name, v in by.items():
        whole = v["overall"][0]
        out += ["", f"--- {name} ---", f"  Overall: {whole['accuracy']:.1%} ({whole['n']} samples)"]
        for level, title in (("category", "Category"), ("subcategory", "Subcategory")):
            part = v.get(level, [])
            if part and (level == "category" or {r["key"] for r in part} != {r["key"] for r in v.get("category", [])}):
                out += ["", f"  {title:<40} {'Accuracy':>10} {'Count':>8}", f"  {thin}"]
                out += [f"  {r['key']:<40} {r['accuracy']:>9.1%} {r['n']:>8}" for r in part]
    return "\n".join([*out, "", rule, ""])


def report_json(summary_rows: DataFrame) -> DataFrame:
    """benchmark, report: the same as JSON, a row for each benchmark."""
    entry = F.struct("level", "key", F.struct("accuracy", F.col("n").alias("count")).alias("v"))
    pick = lambda level: F.map_from_entries(F.transform(F.filter(F.array_sort(F.collect_list(entry)), lambda x: x["level"] == level), lambda x: F.struct(x["key"], x["v"])))
    g = summary_rows.groupBy("benchmark").agg(F.max(F.when(F.col("level") == "overall", F.col("accuracy"))).alias("overall_accuracy"), F.max(F.when(F.col("level") == "overall", F.col("n"))).alias("total"), pick("category").alias("by_category"), pick("subcategory").alias("by_subcategory"))
    return g.select("benchmark", F.to_json(F.struct("overall_accuracy", "total", "by_category", "by_subcategory")).alias("report"))


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``nth`` from 0 in the order of the columns, without a window over all rows: rows are range-partitioned, each part is
    numbered for itself, and the parts' counts, a row for each, are summed up."""
    spark = df.sparkSession
    parts = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    parts = parts.withColumn("_part", F.spark_partition_id()).withColumn("_in", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    parts = parts.persist()  # read twice, and both times it must be parted at the same places
    sizes = parts.groupBy("_part").agg((F.max("_in") + 1).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sizes.select("_part", before.alias("_base"))  # a row for each partition
    return parts.join(F.broadcast(base), "_part").withColumn("nth", (F.col("_base") + F.col("_in")).cast("long")).drop("_part", "_in", "_base")


__all__ = ["SCORERS", "TAXONOMY", "Runner", "differing_subcategories", "numbered", "report_json", "report_text", "rollup", "score_taxonomy", "summary", "taxonomy"]

"""Domain views over the test tables. ``text_items`` uses expressions that read the same in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry

NOUN = "CASE object_id WHEN 'AF' THEN 'wooden crate' WHEN 'AO' THEN 'steel plank' WHEN 'NF' THEN 'red chair' WHEN 'NO' THEN 'lamp' WHEN 'RF' THEN 'door' ELSE 'table' END"
N = "(CAST(floor(o_totalprice / 1000) AS BIGINT) % 50 + 1)"


def _cases(key: str, texts: list[str]) -> str:
    return f"CASE {key} % {len(texts)} " + " ".join(f"WHEN {i} THEN {t}" for i, t in enumerate(texts)) + " END"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_n, _q = f"CAST({N} AS STRING)", quoted
#: Predictions, truths and questions that reach every branch of the readers and scorers.
PRED = _cases("o_orderkey", [
    f"{_n} || ' meters'", f"CAST({N} * 100 AS STRING) || ' cm'", f"'about ' || {_n} || '.5 feet away'", f"{_n} || ' metres or so'", f"{_n} || ' centimetres'", f"{_n} || ' inches'", _n, f"'1,' || CAST(100 + {N} AS STRING) || ' mm'",
    f"'<conclusion> ' || {_n} || '.25 </conclusion>'", _q("twenty or three of them"), _q("Yes, it is."), _q("No"), _q("Actually, it is not."), _q("<conclusion>no</conclusion> yes"), _q("It is correct that it is wrong."), _q("Indeed it is true."),
    _q("Answer: B left"), _q("The answer is c"), _q("<conclusion> (D) </conclusion>"), _q("I take [a] here"), _q("b. the door"), _q("E."), _q("Answer: Bold"), _q("the crate is left"), _q("The lamp"), _q("It has three parts, actually."), _q("the table"), f"'left ' || {_n} || ' ft'",
])
TRUTH = _cases("o_custkey", [f"CAST({N} + o_custkey % 3 AS STRING) || ' meters'", _q("yes"), _q("(B)"), _q("the crate is left"), f"{_n} || ' feet'", f"{_n}", _q("A"), _q("the lamp, not the crate"), _q("No, it is not."), f"CAST({N} AS STRING) || ' metres'", _q("0"), _q("The lamp")])
QUESTION = _cases("o_custkey", [
    _q("How far is the lamp from the door?"), _q("What is the vertical distance between them?"), _q("What is the horizontal distance between them?"), _q("How wide is the crate?"), _q("Who is taller, the crate or the lamp?"), _q("Is the lamp left of the door?"), _q("Describe the scene."),
    _q("What is the radius of the ball?"), _q("Which is above the floor: the crate or the lamp?"), _q("Can you confirm that it is red?"), _q("How tall is the door?"), _q("Which one appears bigger, the crate  or the lamp."), _q("Does the lamp touch it?"),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "lineitem")
    return t.select(F.col("l_suppkey").alias("scene_id"), F.concat("l_returnflag", "l_linestatus").alias("object_id"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / F.lit(1000.0)).alias("y"), (F.col("l_discount") * 100).alias("z"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.objects(points(spark, sf_dir))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.pairs(objects(spark, sf_dir))


def text_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "orders")
    return t.select(F.col("o_orderkey").alias("id"), F.expr(PRED).alias("pred"), F.expr(TRUTH).alias("truth"), F.expr(QUESTION).alias("question"), F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("subcategory"))


_stats = ", ".join([f"round(avg({a}), 6) AS m{a}, (min({a}) + max({a})) / 2 AS c{a}, max({a}) - min({a}) AS e{a}" for a in "xyz"])
SQL_POINTS = "points AS (SELECT l_suppkey AS scene_id, l_returnflag || l_linestatus AS object_id, l_quantity AS x, l_extendedprice / 1000.0::DOUBLE AS y, l_discount * 100 AS z FROM lineitem)"
SQL_OBJECTS = f"{SQL_POINTS}, o0 AS (SELECT scene_id, object_id, {_stats}, count(*) AS n_points FROM points GROUP BY scene_id, object_id), objects AS (SELECT *, ex * ey * ez AS volume FROM o0)"
_cols = ["object_id", *[f"{s}{a}" for s in "mce" for a in "xyz"], "volume"]
SQL_PAIRS = f"{SQL_OBJECTS}, pairs AS (SELECT a.scene_id, {', '.join(f'a.{c} AS a_{c}, b.{c} AS b_{c}' for c in _cols)} FROM objects a JOIN objects b ON a.scene_id = b.scene_id AND a.object_id <> b.object_id)"
SQL_ITEMS = f"items AS (SELECT o_orderkey AS id, {PRED} AS pred, {TRUTH} AS truth, {QUESTION} AS question, o_orderpriority AS category, o_orderstatus AS subcategory FROM orders)"

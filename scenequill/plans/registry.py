"""Registered queries over the test tables, each with its SQL for the side-by-side check where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import imaging
from ..functions import text as T
from ..functions.draws import sql_draw, sql_half_up
from ..operators import benchmarks, boxes, correspondences, curate, dialogue, meshes, poses, questions, reports, traces
from ..sources import tables
from . import views as V

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def flagship(spark, sf_dir):
    return QUERIES["scene_questions"](spark, sf_dir)


# --- geometry ---

_BOX = "scene_id, object_id, mx, my, mz, cx, cy, cz, ex, ey, ez, volume, n_points"


@query("object_boxes", f"WITH {V.SQL_OBJECTS} SELECT {_BOX} FROM objects")
def object_boxes(spark, sf):
    return V.objects(spark, sf).select(*_BOX.split(", "))


@query("ordered_pairs", f"WITH {V.SQL_PAIRS} SELECT scene_id, a_object_id, b_object_id FROM pairs")
def ordered_pairs(spark, sf):
    return V.pairs(spark, sf).select("scene_id", "a_object_id", "b_object_id")


@query("unordered_pair_offsets", f"WITH {V.SQL_PAIRS} SELECT scene_id, a_object_id, b_object_id, round(b_mx - a_mx, 6) AS dx, round(b_my - a_my, 6) AS dy, round(b_mz - a_mz, 6) AS dz FROM pairs WHERE a_object_id < b_object_id")
def unordered_pair_offsets(spark, sf):
    p = G.pairs(V.objects(spark, sf), ordered=False)
    return p.select("scene_id", "a_object_id", "b_object_id", *[F.round(F.col(f"b_m{a}") - F.col(f"a_m{a}"), 6).alias(f"d{a}") for a in "xyz"])


def _predicate(name):
    stat, greater = G.PREDICATES[name]
    sql = f"WITH {V.SQL_PAIRS} SELECT scene_id, a_object_id, b_object_id, a_{stat} {'>' if greater else '<'} b_{stat} AS holds FROM pairs"
    query(f"pred_{name}", sql)(lambda spark, sf: V.pairs(spark, sf).select("scene_id", "a_object_id", "b_object_id", G.predicate(name).alias("holds")))
    if name in G.CHOICES:
        sql = f"WITH {V.SQL_PAIRS} SELECT scene_id, a_object_id, b_object_id, CASE WHEN a_{stat} {'>' if greater else '<'} b_{stat} THEN a_object_id ELSE b_object_id END AS chosen FROM pairs"
        query(f"choice_{name}", sql)(lambda spark, sf: V.pairs(spark, sf).select("scene_id", "a_object_id", "b_object_id", G.choice(name).alias("chosen")))


for _name in G.PREDICATES:
    _predicate(_name)


@query("measures", f"WITH {V.SQL_PAIRS} SELECT scene_id, a_object_id, b_object_id, abs(a_cy - b_cy) AS vertical, round(sqrt((a_cx - b_cx) * (a_cx - b_cx) + (a_cz - b_cz) * (a_cz - b_cz)), 6) AS horizontal, a_ex AS width, a_ey AS height FROM pairs")
def measures(spark, sf):
    return V.pairs(spark, sf).select("scene_id", "a_object_id", "b_object_id", G.vertical_distance().alias("vertical"), F.round(G.horizontal_distance(), 6).alias("horizontal"), F.col("a_ex").alias("width"), F.col("a_ey").alias("height"))


_NOUN_A, _NOUN_B = (V.NOUN.replace("object_id", f"{x}_object_id") for x in "ab")
_KEY = "CAST(scene_id AS STRING), a_object_id, b_object_id, kind, '0'"


def _chosen(by: dict, key: str) -> str:
    """SQL: one of a kind's templates."""
    lists = " ".join(f"WHEN '{k}' THEN [{', '.join(V.quoted(t) for t in v)}]" for k, v in by.items())
    n = {len(v) for v in by.values()}
    assert len(n) == 1
    return f"(CASE kind {lists} END)[1 + {sql_draw(n.pop(), _KEY, key)}]"


_ALL_KINDS = [*questions.OPEN, *questions.UPRIGHT, *questions.LENGTHS]
_HOLDS = "CASE " + " ".join(f"WHEN kind IN ('{k}_predicate', '{k}_choice') THEN a_{stat} {'>' if more else '<'} b_{stat}" for k, (stat, more) in G.PREDICATES.items()) + " ELSE TRUE END"
_LENGTH = "CASE kind WHEN 'vertical' THEN abs(a_cy - b_cy) WHEN 'horizontal' THEN sqrt((a_cx - b_cx) * (a_cx - b_cx) + (a_cz - b_cz) * (a_cz - b_cz)) WHEN 'width' THEN a_ex WHEN 'height' THEN a_ey END"


def _said(length: str, key: str) -> str:
    """SQL: a length in words."""
    m = f"({length}) * 10"
    first = f"({sql_draw(10, key, V.quoted('unit'))} < CASE WHEN {m} < 3 THEN 6 ELSE 7 END)"
    v = sql_half_up(f"{m} * CASE WHEN {first} THEN CASE WHEN {m} < 1 THEN 100.0::DOUBLE ELSE 1.0::DOUBLE END ELSE CASE WHEN {m} < 1 THEN 39.37::DOUBLE ELSE 3.281::DOUBLE END END", 2)
    unit = f"CASE WHEN {first} THEN CASE WHEN {m} < 1 THEN 'centimeters' ELSE 'meters' END ELSE CASE WHEN {m} < 1 THEN 'inches' ELSE 'feet' END END"
    places = sql_draw(3, key, V.quoted("places"))
    return f"CAST(CASE WHEN {v} = 0 THEN {v} WHEN {places} = 0 THEN {sql_half_up(v)} WHEN {places} = 1 THEN {sql_half_up(v, 1)} ELSE {v} END AS VARCHAR) || ' ' || {unit}"


_NOUN_A, _NOUN_B = (V.NOUN.replace("object_id", f"{x}_object_id") for x in "ab")
_T = questions.TEMPLATES
_QA_SQL = (
    f"WITH {V.SQL_PAIRS}, k AS (SELECT *, unnest([{', '.join(V.quoted(k) for k in _ALL_KINDS)}]) AS kind FROM pairs), "
    f"h AS (SELECT *, {_HOLDS} AS holds, lower({_NOUN_A}) AS a, lower({_NOUN_B}) AS b, {_LENGTH} AS length FROM k), "
    f"t AS (SELECT *, CASE WHEN ends_with(kind, '_choice') THEN CASE WHEN holds THEN a ELSE b END ELSE coalesce({_said('length', 'CAST(scene_id AS STRING), a_object_id, b_object_id, kind')}, '') END AS x, "
    f"{_chosen({k: _T[k][0] for k in _ALL_KINDS}, V.quoted('q'))} AS q, CASE WHEN holds THEN {_chosen({k: _T[k][1] for k in _ALL_KINDS}, V.quoted('a'))} ELSE {_chosen({k: _T[k][2] for k in _ALL_KINDS}, V.quoted('a'))} END AS w FROM h) "
    "SELECT scene_id, a_object_id, b_object_id, kind, replace(replace(q, '[A]', a), '[B]', b) AS question, replace(replace(replace(w, '[A]', a), '[B]', b), '[X]', x) AS answer FROM t"
)


def labelled_pairs(spark, sf):
    return V.pairs(spark, sf).withColumns({"a_label": F.expr(_NOUN_A), "b_label": F.expr(_NOUN_B)})


@query("scene_questions", _QA_SQL)
def scene_questions(spark, sf):
    return questions.pair_questions(labelled_pairs(spark, sf))


@query("scene_messages")
def scene_messages(spark, sf):
    return questions.scene_prompts(labelled_pairs(spark, sf), V.points(spark, sf))


@query("human_distance", f"WITH {V.SQL_PAIRS}, d AS (SELECT scene_id, a_object_id, b_object_id, abs(a_cz - b_cz) / 10 AS m FROM pairs) SELECT scene_id, a_object_id, b_object_id, {_said('m', 'CAST(scene_id AS STRING), a_object_id')} AS said FROM d")
def human_distance(spark, sf):
    p = G.with_human_distance(V.pairs(spark, sf), "said", F.abs(F.col("a_cz") - F.col("b_cz")) / 10, F.col("scene_id"), F.col("a_object_id"))
    return p.select("scene_id", "a_object_id", "b_object_id", "said")


@query("nearest_cloud_distance", f"WITH {V.SQL_POINTS}, n AS (SELECT a.scene_id, a.object_id AS a_object_id, b.object_id AS b_object_id, a.rid, min(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z))) AS d FROM (SELECT *, row_number() OVER () AS rid FROM points) a JOIN points b ON a.scene_id = b.scene_id AND a.object_id = 'AF' AND b.object_id = 'NO' GROUP BY ALL) SELECT scene_id, a_object_id, b_object_id, round(avg(d), 6) AS mean, round(min(d), 6) AS least, round(max(d), 6) AS greatest FROM n GROUP BY ALL")
def nearest_cloud_distance(spark, sf):
    p = V.points(spark, sf)
    chosen = p.select("scene_id").distinct().select("scene_id", F.lit("AF").alias("a_object_id"), F.lit("NO").alias("b_object_id"))
    return G.nearest_distances(p, chosen).select("scene_id", "a_object_id", "b_object_id", *[F.round(c, 6).alias(c) for c in ("mean", "least", "greatest")])


@query("nearest_cloud_distances")
def nearest_cloud_distances(spark, sf):
    chosen = V.pairs(spark, sf).select("scene_id", "a_object_id", "b_object_id")
    return G.nearest_distances(V.points(spark, sf), chosen).select("scene_id", "a_object_id", "b_object_id", *[F.round(c, 6).alias(c) for c in ("mean", "least", "greatest")])


@query("oriented_saving")
def oriented_saving(spark, sf):
    return G.oriented_volume(V.points(spark, sf)).select("scene_id", "object_id", *[F.round(c, 4).alias(c) for c in ("oriented_volume", "aligned_volume", "saving")])


@query("box_corners", f"WITH {V.SQL_OBJECTS}, s AS (SELECT unnest([-1, 1]) AS v) SELECT scene_id, object_id, cx + i.v * ex / 2 AS x, cy + j.v * ey / 2 AS y, cz + k.v * ez / 2 AS z FROM objects, s i, s j, s k")
def box_corners(spark, sf):
    signs = F.array(*[F.array(*[F.lit(v) for v in (i, j, k)]) for i in (-1, 1) for j in (-1, 1) for k in (-1, 1)])
    o = V.objects(spark, sf).withColumn("s", F.explode(signs))
    return o.select("scene_id", "object_id", *[(F.col(f"c{a}") + F.col("s")[i] * F.col(f"e{a}") / 2).alias(a) for i, a in enumerate("xyz")])


@query("unprojected", "SELECT l_orderkey, l_linenumber, l_partkey, round((l_quantity - 25) * l_discount / 500, 9) + 0.0::DOUBLE AS x, round((l_tax - 0.04::DOUBLE) * l_discount / 500, 9) + 0.0::DOUBLE AS y, l_discount AS z FROM lineitem")
def unprojected(spark, sf):
    t = V.table(spark, sf, "lineitem")
    x, y, z = G.unproject(F.col("l_quantity"), F.col("l_tax"), F.col("l_discount"), 500, 500, 25, 0.04)
    return t.select("l_orderkey", "l_linenumber", "l_partkey", (F.round(x, 9) + 0.0).alias("x"), (F.round(y, 9) + 0.0).alias("y"), z)


@query("relation_2d", "WITH d AS (SELECT o_orderkey, o_custkey % 61 - 30 AS dx, o_orderkey % 61 - 30 AS dy FROM orders) SELECT o_orderkey, CASE WHEN dx < -10 THEN 'left of' WHEN dx > 10 THEN 'right of' ELSE 'horizontally aligned with' END || ' and ' || CASE WHEN dy < -10 THEN 'above' WHEN dy > 10 THEN 'below' ELSE 'vertically aligned with' END || ' a' AS relation, round(sqrt((dx * dx + dy * dy)::DOUBLE), 1) AS pixels FROM d")
def relation_2d(spark, sf):
    dx, dy = F.col("o_custkey") % 61 - 30, F.col("o_orderkey") % 61 - 30
    return V.table(spark, sf, "orders").select("o_orderkey", G.relation_2d(dx, dy).alias("relation"), F.round(F.sqrt((dx * dx + dy * dy).cast("double")), 1).alias("pixels"))


_WRAP = "((({d} + 180) % 360 + 360) % 360 - 180)"


@query("orientation", f"SELECT o_orderkey, {_WRAP.format(d='(o_custkey % 720 - o_orderkey % 360)')} AS delta, ['north','northeast','east','southeast','south','southwest','west','northwest'][CAST(round_even((o_custkey % 360) / 45.0::DOUBLE, 0) AS BIGINT) % 8 + 1] AS facing FROM orders")
def orientation(spark, sf):
    az = F.col("o_custkey") % 360
    return V.table(spark, sf, "orders").select("o_orderkey", T.wrap_degrees(F.col("o_custkey") % 720 - F.col("o_orderkey") % 360).alias("delta"), T.compass(az).alias("facing"))


@query("decode_argmax", "WITH e AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id, i <= 32 ORDER BY v DESC, i) AS n FROM e) SELECT vec_id, CAST(max(i - 1) FILTER (WHERE i <= 32 AND n = 1) AS BIGINT) AS first_bin, CAST(max(i - 33) FILTER (WHERE i > 32 AND n = 1) AS BIGINT) AS second_bin FROM r GROUP BY vec_id")
def decode_argmax(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return e.select("vec_id", meshes.decode_bins(F.col("embedding"), 0, 32).alias("first_bin"), meshes.decode_bins(F.col("embedding"), 32, 32).alias("second_bin"))


@query("joint_relations", "WITH j AS (SELECT c_custkey AS pose_id, unnest(range(0, 17)) AS i FROM customer), k AS (SELECT pose_id, i, (pose_id * 7 + i * 13) % 100 AS x, (pose_id * 3 + i * 29) % 100 AS y FROM j WHERE (pose_id + i) % 5 <> 0) SELECT a.pose_id, a.i AS a, b.i AS b, CASE WHEN b.x = a.x AND b.y = a.y THEN 'same' WHEN abs(b.x - a.x) >= abs(b.y - a.y) THEN CASE WHEN b.x > a.x THEN 'left' ELSE 'right' END WHEN b.y > a.y THEN 'above' ELSE 'below' END AS relation FROM k a JOIN k b ON a.pose_id = b.pose_id AND a.i < b.i")
def joint_relations(spark, sf):
    j = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("pose_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(16).cast("long"))).alias("i"))
    k = j.where((F.col("pose_id") + F.col("i")) % 5 != 0).select("pose_id", "i", ((F.col("pose_id") * 7 + F.col("i") * 13) % 100).alias("x"), ((F.col("pose_id") * 3 + F.col("i") * 29) % 100).alias("y"))
    # a join of joints would be planned by the size of customer, which says nothing of 17 rows for each: the pairs are made of each pose's list
    each = k.groupBy("pose_id").agg(F.collect_list(F.struct("i", "x", "y")).alias("j"))
    two = each.select("pose_id", "j", F.explode("j").alias("a")).select("pose_id", "a", F.explode("j").alias("b")).where("a.i < b.i")
    return two.select("pose_id", F.col("a.i").alias("a"), F.col("b.i").alias("b"), meshes.joint_relation(F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y")).alias("relation"))


# --- text and scores: the SQL states its own words, units, patterns and thresholds ---

_W = r"(^|[^\p{L}\p{N}_])"
_E = r"([^\p{L}\p{N}_]|$)"
_YES, _NO = "yes|yeah|yep|correct|true|right|indeed|affirmative", "no|nope|false|incorrect|wrong|negative"


def _yn(t: str) -> str:
    s = f"lower(trim({t}))"
    head = f"trim(split_part(split_part({s}, ',', 1), '.', 1))"
    y, n = (f"regexp_matches({s}, '{_W}({w}){_E}')" for w in (_YES, _NO))
    tag = rf"nullif(regexp_extract({s}, '<conclusion>\s*(yes|no)\s*</conclusion>', 1), '')"
    return (
        f"CASE WHEN {tag} IS NOT NULL THEN {tag} = 'yes' WHEN regexp_matches({head}, '^({_YES}){_E}') THEN TRUE WHEN regexp_matches({head}, '^({_NO}){_E}') THEN FALSE WHEN {head} = 'actually' THEN FALSE "
        f"WHEN {y} AND NOT {n} THEN TRUE WHEN {n} AND NOT {y} THEN FALSE END"
    )


_SPELLED = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty".split()


def _num(t: str) -> str:
    words = ", ".join(f"CASE WHEN regexp_matches(lower({t}), '{_W}{w}{_E}') THEN {i}.0::DOUBLE END" for i, w in enumerate(_SPELLED))
    tag = rf"TRY_CAST(nullif(regexp_extract(lower({t}), '<conclusion>\s*([0-9.]+)\s*</conclusion>', 1), '') AS DOUBLE)"
    return rf"coalesce({tag}, TRY_CAST(replace(nullif(regexp_extract({t}, '([0-9]+(?:,[0-9]{{3}})*(?:\.[0-9]+)?)', 1), ''), ',', '') AS DOUBLE), {words})"


_M = rf"([0-9]+(?:\.[0-9]+)?)\s*(centimeters|centimetres|millimeters|centimeter|centimetre|millimeter|meters|metres|inches|meter|metre|foot|feet|inch|cm|mm|ft|in|m){_E}"
_val = lambda t: f"TRY_CAST(nullif(regexp_extract(lower({t}), '{_M}', 1), '') AS DOUBLE)"
_unit = lambda t: f"nullif(regexp_extract(lower({t}), '{_M}', 2), '')"
_cm = lambda t: (
    f"{_val(t)} * CASE WHEN {_unit(t)} IN ('m', 'meter', 'meters', 'metre', 'metres') THEN 100.0::DOUBLE WHEN {_unit(t)} IN ('cm', 'centimeter', 'centimeters', 'centimetre', 'centimetres') THEN 1.0::DOUBLE "
    f"WHEN {_unit(t)} IN ('mm', 'millimeter', 'millimeters') THEN 0.1::DOUBLE WHEN {_unit(t)} IN ('ft', 'foot', 'feet') THEN 30.48::DOUBLE WHEN {_unit(t)} IN ('in', 'inch', 'inches') THEN 2.54::DOUBLE END"
)
_I = f"WITH {V.SQL_ITEMS}"


@query("extract_yes_no", f"{_I} SELECT id, {_yn('pred')} AS said FROM items")
def extract_yes_no(spark, sf):
    return V.text_items(spark, sf).select("id", T.yes_no(F.col("pred")).alias("said"))


@query("yes_no_documents", f"SELECT doc_id, {_yn('text')} AS said FROM documents")
def yes_no_documents(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", T.yes_no(F.col("text")).alias("said"))


@query("extract_number", f"{_I} SELECT id, {_num('pred')} AS value FROM items")
def extract_number(spark, sf):
    return V.text_items(spark, sf).select("id", T.number(F.col("pred")).alias("value"))


@query("extract_unit", f"{_I} SELECT id, {_val('pred')} AS value, {_unit('pred')} AS unit, round({_cm('pred')}, 6) AS cm FROM items")
def extract_unit(spark, sf):
    read = T.with_readings(V.text_items(spark, sf), "pred")
    return read.select("id", F.col("pred_value").alias("value"), F.col("pred_unit").alias("unit"), F.round(T.to_cm(F.col("pred_value"), F.col("pred_unit")), 6).alias("cm"))


def _opt(t: str) -> str:
    forms = [(rf"[Aa]nswer\s*:\s*([A-Fa-f]){_E}", 1), (rf"(?i)answer\s+is\s+([A-F]){_E}", 1), (r"<conclusion>\s*\(?([A-Fa-f])\)?\s*</conclusion>", 1), (r"[\(\[]([A-Fa-f])[\)\]]", 1), (rf"{_W}([A-Fa-f])[.,;:]\s", 2), (r"^([A-Fa-f])\.?$", 1)]
    return "coalesce(" + ", ".join(f"nullif(upper(regexp_extract(trim({t}), '{f}', {g})), '')" for f, g in forms) + ")"


@query("extract_option", f"{_I} SELECT id, {_opt('pred')} AS pred_option, {_opt('truth')} AS truth_option FROM items")
def extract_option(spark, sf):
    return V.text_items(spark, sf).select("id", T.option(F.col("pred")).alias("pred_option"), T.option(F.col("truth")).alias("truth_option"))


_far = "regexp_matches(lower(trim(question)), '(distance between|how far|how close|how distant|measure the distance|distance of the|distance from|distance measurement)')"
_KIND = (
    f"CASE WHEN {_far} AND lower(question) LIKE '%vertic%' THEN 'vertical_distance' WHEN {_far} AND lower(question) LIKE '%horizont%' THEN 'horizontal_distance' WHEN {_far} THEN 'distance' "
    "WHEN regexp_matches(lower(question), '(width of|height of|how wide|how tall|measure the width|measure the height|horizontal dimensions|vertical dimensions|radius of)') THEN 'measurement' "
    "WHEN regexp_matches(lower(question), '(which is more to the|which one appears|who is positioned more|which is above|which is below|which one is positioned|who is taller|who is shorter|who is higher|who is lower)') THEN 'comparison_choice' "
    "WHEN regexp_matches(lower(trim(question)), '^(is the |does the |can you confirm)') THEN 'comparison_yn' ELSE 'unknown' END"
)


@query("classify_question", f"{_I} SELECT id, {_KIND} AS kind FROM items")
def classify_question(spark, sf):
    return V.text_items(spark, sf).select("id", T.question_class(F.col("question")).alias("kind"))


_PG = f"{_I}, r AS MATERIALIZED (SELECT *, {_val('pred')} AS pv, {_val('truth')} AS tv FROM items), pg AS MATERIALIZED (SELECT *, CASE WHEN pv IS NOT NULL AND tv IS NOT NULL THEN {_cm('pred')} ELSE {_num('pred')} END AS p, CASE WHEN pv IS NOT NULL AND tv IS NOT NULL THEN {_cm('truth')} ELSE {_num('truth')} END AS g FROM r)"
_DIST = "CASE WHEN p = 0 AND g = 0 THEN 1.0::DOUBLE WHEN p = 0 OR g = 0 THEN 0.0::DOUBLE WHEN p IS NOT NULL AND g IS NOT NULL THEN CAST(greatest(p / nullif(g, 0), g / nullif(p, 0)) < 2.0::DOUBLE AS DOUBLE) END"
_within = ["0.5", "0.44999999999999996", "0.4", "0.35", "0.30000000000000004", "0.25", "0.19999999999999996", "0.15000000000000002", "0.10000000000000009", "0.050000000000000044"]
_MRA = "CASE WHEN p IS NULL OR g IS NULL THEN NULL WHEN g = 0 THEN CAST(p = 0 AS DOUBLE) ELSE (0.0::DOUBLE + " + " + ".join(f"CASE WHEN abs(p - g) / nullif(abs(g), 0) <= {x}::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END" for x in _within) + ") / 10.0::DOUBLE END"
_SAME = "CAST(upper(trim(pred)) = upper(trim(truth)) AS DOUBLE)"


def lengths(spark, sf):
    return T.with_lengths(V.text_items(spark, sf))


@query("score_distance", f"{_PG} SELECT id, {_DIST} AS score FROM pg")
def score_distance(spark, sf):
    return lengths(spark, sf).select("id", T.score_distance().alias("score"))


@query("score_mra", f"{_PG} SELECT id, round({_MRA}, 6) AS score FROM pg")
def score_mra(spark, sf):
    return lengths(spark, sf).select("id", F.round(T.score_mra(), 6).alias("score"))


@query("score_yes_no", f"{_I} SELECT id, CAST(({_yn('pred')}) = ({_yn('truth')}) AS DOUBLE) AS score FROM items")
def score_yes_no(spark, sf):
    return V.text_items(spark, sf).select("id", T.score_yes_no(F.col("pred"), F.col("truth")).alias("score"))


_CHOICE = r"""CASE WHEN contains(lower(truth), a) AND NOT contains(lower(truth), b) THEN CAST(contains(lower(pred), a) AS DOUBLE) WHEN contains(lower(truth), b) AND NOT contains(lower(truth), a) THEN CAST(contains(lower(pred), b) AS DOUBLE)
  ELSE CAST(lower(trim(pred)) = lower(trim(truth)) AS DOUBLE) END"""
_AB = r"""trim(nullif(regexp_extract(lower(question), 'the\s+(.+?)\s+or\s+the\s+(.+?)[?.]', 1), '')) AS a, trim(nullif(regexp_extract(lower(question), 'the\s+(.+?)\s+or\s+the\s+(.+?)[?.]', 2), '')) AS b"""


@query("score_choice", f"{_I}, n AS (SELECT *, {_AB} FROM items) SELECT id, {_CHOICE} AS score FROM n")
def score_choice(spark, sf):
    return V.text_items(spark, sf).select("id", T.score_choice(F.col("pred"), F.col("truth"), F.col("question")).alias("score"))


# items of the four benchmarks: three options each, the right one by the item's key
_BI = f"""{_PG}, i AS (SELECT *, pred AS prediction, truth AS answer, CASE id % 3 WHEN 0 THEN 'multi-choice' WHEN 1 THEN 'judgment' ELSE 'open-ended' END AS question_type, CASE WHEN id % 4 = 0 THEN NULL ELSE 'the crate' END AS answer_text,
  ['the crate', 'the lamp', 'the table'] AS options, ['A', 'b', ' C ', 'D', 'crate'][CAST(id % 5 AS INTEGER) + 1] AS letter FROM pg)"""
_SAID = _opt("pred")
_BY_TYPE = f"CASE question_type WHEN 'multi-choice' THEN CASE WHEN {_SAID} IS NOT NULL AND {_opt('truth')} IS NOT NULL THEN CAST({_SAID} = {_opt('truth')} AS DOUBLE) ELSE {_SAME} END WHEN 'judgment' THEN CAST(({_yn('pred')}) = ({_yn('truth')}) AS DOUBLE) ELSE coalesce(CASE WHEN regexp_matches(lower(truth), '(meter|cm|feet|inch|ft|m )') THEN {_DIST} END, {_MRA}, {_SAME}) END"
_WITH_TEXT = f"CASE WHEN {_SAID} IS NOT NULL THEN CAST({_SAID} = upper(letter) AS DOUBLE) WHEN answer_text IS NOT NULL THEN CAST(contains(lower(pred), answer_text) AS DOUBLE) ELSE 0.0::DOUBLE END"
_WITH_OPTIONS = f"CASE WHEN {_SAID} IS NOT NULL THEN CAST({_SAID} = upper(trim(letter)) AS DOUBLE) WHEN upper(trim(letter)) = 'A' THEN CAST(contains(lower(pred), 'the crate') AS DOUBLE) WHEN upper(trim(letter)) = 'B' THEN CAST(contains(lower(pred), 'the lamp') AS DOUBLE) WHEN upper(trim(letter)) = 'C' THEN CAST(contains(lower(pred), 'the table') AS DOUBLE) ELSE 0.0::DOUBLE END"
_LETTER = f"CASE WHEN {_SAID} IS NOT NULL THEN CAST({_SAID} = upper(trim(letter)) AS DOUBLE) ELSE CAST(upper(trim(pred)) = upper(trim(letter)) AS DOUBLE) END"


def benchmark_items(spark, sf, name):
    """(items, predictions) of a benchmark: the text items, with letters as truths but for the first."""
    t = V.text_items(spark, sf)
    kind = F.element_at(F.array(*[F.lit(x) for x in ("multi-choice", "judgment", "open-ended")]), (F.col("id") % 3 + 1).cast("int"))
    letter = F.element_at(F.array(*[F.lit(x) for x in ("A", "b", " C ", "D", "crate")]), (F.col("id") % 5 + 1).cast("int"))
    items = t.select("id", "category", "subcategory", "question", (F.col("truth") if name == "spatialscore" else letter).alias("answer"), kind.alias("question_type"), F.when(F.col("id") % 4 != 0, "the crate").alias("answer_text"), F.array(F.lit("the crate"), F.lit("the lamp"), F.lit("the table")).alias("options"))
    return items, t.select("id", F.col("pred").alias("prediction"))


def _scores(name):
    def run(spark, sf):
        return benchmarks.Runner(name).score(name, *benchmark_items(spark, sf, name)).select("id", F.round("score", 6).alias("score"), "unscored")

    return run


for _name, _sql in (("spatialscore", _BY_TYPE), ("omnispatial", _WITH_TEXT), ("space10", _WITH_OPTIONS), ("mindcube", _LETTER)):
    query(f"benchmark_{_name}", f"{_BI} SELECT id, round(coalesce({_sql}, 0), 6) AS score, ({_sql}) IS NULL AS unscored FROM i")(_scores(_name))

query("score_option_items", f"{_BI} SELECT id, coalesce({_LETTER}, 0) AS score FROM i")(lambda spark, sf: benchmarks.Runner("mindcube").score("mindcube", *benchmark_items(spark, sf, "mindcube")).select("id", "score"))
query("score_answer_in_text", f"{_BI} SELECT id, coalesce({_WITH_TEXT}, 0) AS score FROM i")(lambda spark, sf: benchmarks.Runner("omnispatial").score("omnispatial", *benchmark_items(spark, sf, "omnispatial")).select("id", "score"))


@query("score_open_ended", f"{_PG} SELECT id, round(coalesce(CASE WHEN regexp_matches(lower(truth), '(meter|cm|feet|inch|ft|m )') THEN {_DIST} END, {_MRA}, {_SAME}), 6) AS score FROM pg")
def score_open_ended(spark, sf):
    return lengths(spark, sf).select("id", F.round(benchmarks.score_open(F.col("pred"), F.col("truth")), 6).alias("score"))


@query(
    "benchmark_summary",
    f"{_BI}, s AS (SELECT 'spatialscore' AS benchmark, category, subcategory, coalesce({_BY_TYPE}, 0) AS score FROM i UNION ALL SELECT 'mindcube', category, subcategory, coalesce({_LETTER}, 0) FROM i) "
    + " UNION ALL ".join(f"SELECT benchmark, '{level}' AS level, {key} AS key, round(avg(score), 6) AS accuracy, count(*) AS n FROM s GROUP BY ALL" for level, key in (("overall", "'all'"), ("category", "category"), ("subcategory", "subcategory"))),
)
def benchmark_summary(spark, sf):
    both = {n: benchmark_items(spark, sf, n) for n in ("spatialscore", "mindcube")}
    return benchmarks.summary(benchmarks.Runner("all").run({n: v[0] for n, v in both.items()}, {n: v[1] for n, v in both.items()}))


_TAX = f"{_PG}, k AS (SELECT *, {_KIND} AS kind, {_AB} FROM pg)"


@query(
    "taxonomy_scores",
    f"{_TAX} SELECT id, kind, CASE WHEN kind IN ('vertical_distance', 'horizontal_distance') THEN 'Rotation' WHEN kind IN ('comparison_yn', 'comparison_choice') THEN 'Among' WHEN kind IN ('distance', 'measurement') THEN 'Around' ELSE 'Other' END AS category, "
    f"round(CASE WHEN kind IN ('distance', 'vertical_distance', 'horizontal_distance', 'measurement') THEN {_MRA} WHEN kind = 'comparison_yn' THEN CAST(({_yn('pred')}) = ({_yn('truth')}) AS DOUBLE) WHEN kind = 'comparison_choice' THEN {_CHOICE} END, 6) AS score FROM k",
)
def taxonomy_scores(spark, sf):
    return benchmarks.score_taxonomy(V.text_items(spark, sf), "mindcube").select("id", "kind", "category", F.round("score", 6).alias("score"))


_SC = f"{_PG}, s AS (SELECT id, category, subcategory, {_DIST} AS score FROM pg)"
_ACC = "round(avg(coalesce(score, 0)), 6) AS accuracy, count(*) AS n, count(*) FILTER (WHERE score IS NULL) AS n_unscored"


@query("report_rollup", f"{_SC} SELECT 'overall' AS level, 'all' AS key, {_ACC} FROM s UNION ALL SELECT 'category', category, {_ACC} FROM s GROUP BY category UNION ALL SELECT 'subcategory', subcategory, {_ACC} FROM s GROUP BY subcategory")
def report_rollup(spark, sf):
    return reports.rollup(lengths(spark, sf).withColumn("score", T.score_distance()))


@query("left_join_missing", f"{_I} SELECT i.id, CASE WHEN i.id % 3 = 0 THEN '' ELSE i.pred END AS prediction FROM items i")
def left_join_missing(spark, sf):
    items = V.text_items(spark, sf)
    preds = items.where("id % 3 <> 0").select("id", F.col("pred").alias("prediction"), F.lit(1).alias("seq"))
    return reports.with_predictions(items.select("id"), preds.union(preds.select("id", F.lit("older"), F.lit(0))))


_JS = "js AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 'no score' ELSE '[' || CAST(1 + o_orderkey % 5 AS STRING) || '] ok' END AS t FROM orders)"


@query("parse_score", f"WITH {_JS} SELECT id, TRY_CAST(nullif(regexp_extract(t, '\\[([0-9]+(?:\\.[0-9]+)?)\\]', 1), '') AS DOUBLE) AS score FROM js")
def parse_score(spark, sf):
    o = F.col("o_orderkey")
    return V.table(spark, sf, "orders").select(o.alias("id"), T.judge_score(F.when(o % 7 == 0, "no score").otherwise(F.concat(F.lit("["), (1 + o % 5).cast("string"), F.lit("] ok")))).alias("score"))


@query("score_histogram", f"WITH {_JS}, p AS (SELECT TRY_CAST(nullif(regexp_extract(t, '\\[([0-9]+)\\]', 1), '') AS DOUBLE) AS s FROM js), c AS (SELECT CAST(greatest(1, least(5, round_even(s, 0))) AS BIGINT) AS bucket, count(*) AS n FROM p WHERE s IS NOT NULL GROUP BY 1) SELECT CAST(r.i AS BIGINT) AS bucket, coalesce(n, 0) AS n, round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (), 6) AS share FROM range(1, 6) r(i) LEFT JOIN c ON c.bucket = r.i")
def score_histogram(spark, sf):
    return reports.score_histogram(parse_score(spark, sf))


@query("setting_of_id", "SELECT doc_id, CASE WHEN contains(lower(text), 'around') THEN 'around' WHEN contains(lower(text), 'rotation') THEN 'rotation' WHEN contains(lower(text), 'translation') THEN 'translation' WHEN contains(lower(text), 'among') THEN 'among' ELSE 'other' END AS setting FROM documents")
def setting_of_id(spark, sf):
    return V.table(spark, sf, "documents").select("doc_id", tables.setting_of(F.col("text")).alias("setting"))


@query("options_text", "SELECT p_partkey, '(A) ' || p_name || chr(10) || '(B) ' || p_brand || chr(10) || '(C) ' || p_type || chr(10) || 'Answer with the letter only.' AS prompt, chr(CAST(65 + p_size % 3 AS INTEGER)) AS letter FROM part")
def options_text(spark, sf):
    return V.table(spark, sf, "part").select("p_partkey", reports.options_text(F.array("p_name", "p_brand", "p_type")).alias("prompt"), tables.answer_letter((F.col("p_size") % 3).cast("string")).alias("letter"))


@query("point_tags", "SELECT o_orderkey, CAST(o_custkey % 640 AS DOUBLE) / 640 * 100 / 100 * 640 AS x, 'item ' || CAST(o_custkey % 7 AS STRING) AS alt FROM orders")
def point_tags(spark, sf):
    o = V.table(spark, sf, "orders")
    tag = F.concat(F.lit('a <point x="'), (F.col("o_custkey") % 640).cast("double") / 640 * 100, F.lit('" y="50.0" alt="Item '), (F.col("o_custkey") % 7).cast("string"), F.lit('"/> and <point x="150" y="1" alt="out">'))
    p = o.select("o_orderkey", F.explode(T.parse_points(tag, F.lit(640), F.lit(480))).alias("p"))
    return p.select("o_orderkey", F.col("p.x").alias("x"), F.col("p.alt").alias("alt"))


# --- dialogue ---


@query("judge_pairs", "WITH t AS (SELECT *, lag(role) OVER w AS r, lag(coalesce(text, '')) OVER w AS q FROM conversations WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, q AS question, coalesce(text, '') AS answer FROM t WHERE role = 'assistant' AND r = 'user' AND q <> ''")
def judge_pairs(spark, sf):
    return dialogue.pending_pairs(V.table(spark, sf, "conversations"))


@query("adjacent_qa_pairs", "WITH t AS (SELECT *, lead(role) OVER w AS r, lead(text) OVER w AS a FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn, text AS question, a AS answer FROM t WHERE role = 'user' AND r = 'assistant'")
def adjacent_qa_pairs(spark, sf):
    return dialogue.adjacent_pairs(V.table(spark, sf, "conversations"))


_PREAMBLE = (
    "###Task Description:\nAn instruction (might include an Input inside it), a response to evaluate, a reference answer that gets a score of 5, and a score rubric representing an evaluation criterion is given.\n"
    "1. Write a detailed feedback that assesses the quality of the response strictly based on the given score rubric, not evaluating in general.\n"
    "2. After writing a feedback, write a score that is an integer between 1 and 5. You should refer to the score rubric.\n"
    "3. The output format should look as follows: Feedback: (write a feedback for criteria) [RESULT] (an integer number between 1 and 5)\n"
    "4. Please do not generate any other opening, closing, and explanations.\n###The instruction to evaluate: "
)
_JUDGED = f"{ORACLES['judge_pairs'].replace('SELECT conv_id, turn, q AS question', 'SELECT conv_id AS row_idx, turn, q AS question')}"


@query("judge_requests", f"WITH j AS ({_JUDGED}) SELECT row_idx, turn, 'images/' || CAST(row_idx AS VARCHAR) || '.png' AS image, {V.quoted(_PREAMBLE)} || question AS instruction, answer AS \"response to evaluate\", answer AS original_response FROM j")
def judge_requests(spark, sf):
    e = dialogue.judge_entries(judge_pairs(spark, sf).withColumnRenamed("conv_id", "row_idx"))
    return e.select("row_idx", "turn", "image", "instruction", "response to evaluate", "original_response")


@query(
    "judge_scored",
    f"WITH j AS ({_JUDGED}), e AS (SELECT *, row_number() OVER (ORDER BY row_idx, turn) - 1 AS nth FROM j), s AS (SELECT *, CASE WHEN nth % 7 = 0 THEN 'no score' WHEN nth % 2 = 0 THEN '[4.5] good' ELSE '[' || CAST(1 + nth % 5 AS VARCHAR) || '] ok' END AS t FROM e WHERE nth < 30) "
    "SELECT nth, 'images/' || CAST(row_idx AS VARCHAR) || '.png' AS image, '###Request: ' || question || chr(10) || chr(10) || '###Response: ' || answer AS asked, '[' || CASE WHEN nth % 2 = 0 THEN '4.5' ELSE CAST(1 + nth % 5 AS VARCHAR) END || '] ' || t AS said FROM s WHERE nth % 7 <> 0",
)
def judge_scored(spark, sf):
    e = benchmarks.numbered(dialogue.judge_entries(judge_pairs(spark, sf).withColumnRenamed("conv_id", "row_idx")), "row_idx", "turn")
    n = F.col("id")
    text = F.when(n % 7 == 0, "no score").when(n % 2 == 0, "[4.5] good").otherwise(F.concat(F.lit("["), (1 + n % 5).cast("string"), F.lit("] ok")))
    out = dialogue.scored_dataset(dialogue.matched(e, spark.range(30).select(n.alias("nth"), text.alias("text"))))
    return out.select("nth", F.col("images").alias("image"), F.col("messages")[0]["content"].alias("asked"), F.col("messages")[1]["content"].alias("said"))


@query("positional_match", "WITH a AS (SELECT o_orderkey AS id, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM orders), b AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS row_idx FROM customer) SELECT a.row_idx, a.id, b.c_custkey, '[' || CAST(1 + c_custkey % 5 AS STRING) || '] ok' AS scored FROM a JOIN b USING (row_idx)")
def positional_match(spark, sf):
    nth = lambda t, key, name: benchmarks.numbered(V.table(spark, sf, t).select(F.col(key).alias(name)), name)
    j = nth("orders", "o_orderkey", "id").join(nth("customer", "c_custkey", "c_custkey"), "nth")
    return j.select(F.col("nth").alias("row_idx"), "id", "c_custkey", dialogue.scored_text((1 + F.col("c_custkey") % 5).cast("double"), F.lit("ok")).alias("scored"))


_EVENT = """SELECT user_id AS trace_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, ['Task', 'ToolCallEvent', 'PythonOutput', 'Message', 'Reasoning', 'ToolCallEvent'][1 + CAST(event_id % 6 AS INTEGER)] AS event_type,
  CASE event_id % 11 WHEN 0 THEN 'prefill_1' WHEN 1 THEN '' ELSE 'id_' || CAST(event_id % 4 AS VARCHAR) END AS tool_call_id, CASE WHEN event_id % 3 = 1 THEN 'execute_python' ELSE 'measure' END AS name, '{"k": 1}' AS arguments,
  CASE WHEN event_id % 5 <> 0 THEN 'got ' || event_type END AS result, 'out' AS stdout, CASE WHEN event_id % 2 = 0 THEN 'bad' ELSE '' END AS stderr, CASE WHEN event_id % 4 = 2 THEN 'SyntaxError' ELSE 'complete' END AS execution_status, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS content FROM events"""


def trace_events(spark, sf):
    from pyspark.sql import Window

    i = F.col("event_id")
    kind = F.element_at(F.array(*[F.lit(x) for x in ("Task", "ToolCallEvent", "PythonOutput", "Message", "Reasoning", "ToolCallEvent")]), (i % 6 + 1).cast("int"))
    seq = (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("long")
    return V.table(spark, sf, "events").select(
        F.col("user_id").alias("trace_id"), seq.alias("seq"), kind.alias("event_type"), F.when(i % 11 == 0, "prefill_1").when(i % 11 == 1, "").otherwise(F.concat(F.lit("id_"), (i % 4).cast("string"))).alias("tool_call_id"),
        F.when(i % 3 == 1, "execute_python").otherwise("measure").alias("name"), F.lit('{"k": 1}').alias("arguments"), F.when(i % 5 != 0, F.concat(F.lit("got "), "event_type")).alias("result"), F.lit("out").alias("stdout"),
        F.when(i % 2 == 0, "bad").otherwise("").alias("stderr"), F.when(i % 4 == 2, "SyntaxError").otherwise("complete").alias("execution_status"), F.when(i % 7 == 0, "").otherwise(F.col("event_type")).alias("content"),
    )


def trace_heads(spark, sf):
    t = V.table(spark, sf, "events").select(F.col("user_id").alias("trace_id")).distinct()
    text = F.col("trace_id").cast("string")
    return t.select("trace_id", F.concat(F.lit("img/"), text).alias("image_ref"), F.concat(F.lit("what is "), text).alias("question"), F.when(F.col("trace_id") % 2 == 0, "be brief").alias("system_prompt"), F.when(F.col("trace_id") % 3 == 0, "[]").alias("tool_schema"), F.lit("high").alias("confidence"), F.lit(1).alias("tool_calls_used"), F.lit(1.0).alias("wall_clock_s"))


@query(
    "trace_messages",
    f"""WITH ev AS ({_EVENT}), e AS (SELECT * FROM ev WHERE NOT starts_with(tool_call_id, 'prefill_') AND event_type <> 'Reasoning'),
ids AS (SELECT trace_id, tool_call_id, row_number() OVER (PARTITION BY trace_id ORDER BY min(seq)) AS n FROM e WHERE event_type IN ('ToolCallEvent', 'PythonOutput') AND tool_call_id <> '' GROUP BY trace_id, tool_call_id),
c AS (SELECT e.*, coalesce('call_' || CAST(n AS VARCHAR), 'call_at_' || CAST(seq AS VARCHAR)) AS call_id, min(CASE WHEN event_type = 'Task' THEN seq END) OVER (PARTITION BY e.trace_id) AS first_task FROM e LEFT JOIN ids ON e.trace_id = ids.trace_id AND e.tool_call_id = ids.tool_call_id)
SELECT trace_id, -1 AS seq, 0 AS part, 'system' AS role, CASE WHEN trace_id % 2 = 0 THEN 'be brief' ELSE '' END || CASE WHEN trace_id % 3 = 0 THEN chr(10) || chr(10) || '# Tools' || chr(10) || '[]' ELSE '' END AS content, NULL AS image, NULL AS call_id FROM (SELECT DISTINCT trace_id FROM ev) WHERE trace_id % 2 = 0 OR trace_id % 3 = 0
UNION ALL SELECT trace_id, seq, 0, 'user', 'what is ' || CAST(trace_id AS VARCHAR), 'img/' || CAST(trace_id AS VARCHAR), NULL FROM c WHERE event_type = 'Task' AND seq = first_task
UNION ALL SELECT trace_id, seq, 0, 'assistant', NULL, NULL, call_id FROM c WHERE event_type = 'ToolCallEvent'
UNION ALL SELECT trace_id, seq, 1, 'tool', result, NULL, call_id FROM c WHERE event_type = 'ToolCallEvent' AND name = 'measure' AND result IS NOT NULL
UNION ALL SELECT trace_id, seq, 0, 'tool', CASE WHEN execution_status = 'SyntaxError' AND stderr <> '' THEN stderr ELSE stdout END, NULL, call_id FROM c WHERE event_type = 'PythonOutput'
UNION ALL SELECT trace_id, seq, 0, 'assistant', content, NULL, NULL FROM c WHERE event_type = 'Message' AND content <> ''""",
)
def trace_messages(spark, sf):
    return traces.trace_turns(trace_heads(spark, sf), trace_events(spark, sf)).select("trace_id", "seq", "part", "role", "content", "image", "call_id")


# --- choosing ---

_TAGS = "m AS (SELECT label, i, round(avg(v), 6) AS v FROM (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i), g AS (SELECT label, list(v ORDER BY i) AS t FROM m GROUP BY label), tags AS (SELECT label, list_transform(t, lambda x: x / sqrt(list_sum(list_transform(t, lambda y: y * y)))) AS t FROM g), sims AS (SELECT vec_id, e.label AS own, tags.label, round(list_sum(list_transform(list_zip(embedding, t), lambda z: z[1]::DOUBLE * z[2])), 6) AS s FROM embeddings e, tags), best AS (SELECT * FROM sims QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) = 1)"


@query("tag_assign", f"WITH {_TAGS} SELECT vec_id, 'tag_' || CAST(label AS STRING) AS tag, s AS similarity FROM best")
def tag_assign(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return curate.nearest_tag(e, curate.label_tags(e))


@query("tag_filter", f"WITH {_TAGS} SELECT vec_id, 'tag_' || CAST(label AS STRING) AS tag FROM best WHERE label IN (1, 2, 3) AND label <> 3")
def tag_filter(spark, sf):
    return tag_assign(spark, sf).where(curate.tag_passes(F.col("tag"), "tag_1, tag_2,tag_3", "tag_3")).select("vec_id", "tag")


@query("null_filter", "SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL AND text IS NOT NULL")
def null_filter(spark, sf):
    d = V.table(spark, sf, "documents").select("doc_id", "text").join(V.table(spark, sf, "labels"), "doc_id", "left")
    return d.where(curate.not_null(d)).select("doc_id", "quality", "toxic")


@query("curate_random", "SELECT vec_id FROM embeddings ORDER BY md5('0:' || CAST(vec_id AS STRING)) LIMIT 50")
def curate_random(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return curate.random_subset(F.col("vec_id"), e.select("vec_id"), 50).select("vec_id")


def _fps_sql(k: int) -> str:
    d = "sqrt(list_sum(list_transform(list_zip(e.embedding, c.v), lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2]))))"
    out = ["c0 AS MATERIALIZED (SELECT 0 AS rank, vec_id, embedding AS v FROM embeddings WHERE vec_id = 0)", "s0 AS MATERIALIZED (SELECT * FROM c0)"]
    for i in range(1, k):
        out.append(f"c{i} AS MATERIALIZED (SELECT {i} AS rank, e.vec_id, any_value(e.embedding) AS v FROM embeddings e, s{i - 1} c WHERE e.vec_id NOT IN (SELECT vec_id FROM s{i - 1}) GROUP BY e.vec_id ORDER BY min({d}) DESC, e.vec_id LIMIT 1)")
        out.append(f"s{i} AS MATERIALIZED (SELECT * FROM s{i - 1} UNION ALL SELECT * FROM c{i})")
    return f"WITH {', '.join(out)} SELECT CAST(rank AS BIGINT) AS rank, vec_id FROM s{k - 1}"


@query("curate_farthest", _fps_sql(8))
def curate_farthest(spark, sf):
    return curate.farthest_points(V.table(spark, sf, "embeddings"), 8, 0)


@query("manifest_counts", "WITH s AS (SELECT vec_id, md5('0:' || CAST(vec_id AS STRING)) AS d FROM embeddings ORDER BY d LIMIT 25) SELECT (SELECT count(*) FROM embeddings) AS source_count, count(*) AS selected_count, array_to_string(list(vec_id ORDER BY d), ',') AS ids, 'random' AS strategy, 'euclidean' AS metric, 'precomputed:embedding' AS embedding_source FROM s")
def manifest_counts(spark, sf):
    _, m = curate.Curator().curate(V.table(spark, sf, "embeddings"), count=25, strategy="random", source_repo_id="some/data", split="train")
    return m.select("source_count", "selected_count", F.array_join(F.transform("selected_ids", lambda x: x.cast("string")), ",").alias("ids"), "strategy", "metric", "embedding_source")


@query("ratio_matches", "WITH d AS (SELECT a.label, a.vec_id, b.vec_id AS id, round(sqrt(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1]::DOUBLE - z[2]) * (z[1]::DOUBLE - z[2])))), 6) AS d FROM embeddings a JOIN embeddings b USING (label) WHERE a.vec_id % 2 = 0 AND b.vec_id % 2 = 1), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, id) AS n FROM d) SELECT x.label, x.vec_id, x.id AS match_id, x.d AS d1, y.d AS d2 FROM r x JOIN r y ON x.vec_id = y.vec_id AND x.n = 1 AND y.n = 2 WHERE x.d < 0.97::DOUBLE * y.d")
def ratio_matches(spark, sf):
    e = V.table(spark, sf, "embeddings")
    return curate.ratio_matches(e.where("vec_id % 2 = 0"), e.where("vec_id % 2 = 1"), 0.97, ["label"])


@query("percentile_stretch", "WITH b AS (SELECT quantile_cont(value, 0.02) AS lo, quantile_cont(value, 0.85) AS hi FROM events) SELECT event_id, round(least(1.0, greatest(0.0, (value - lo) / nullif(hi - lo, 0))), 6) AS stretched FROM events, b")
def percentile_stretch(spark, sf):
    return reports.stretch(V.table(spark, sf, "events"), "value").select("event_id", "stretched")


@query("median_fill", "WITH m AS (SELECT user_id, quantile_cont(value, 0.5) AS med FROM events WHERE event_id % 5 <> 0 GROUP BY user_id) SELECT event_id, CASE WHEN event_id % 5 = 0 THEN coalesce(med, 0) ELSE value END AS value FROM events LEFT JOIN m USING (user_id)")
def median_fill(spark, sf):
    e = V.table(spark, sf, "events").select("event_id", "user_id", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"))
    return reports.median_fill(e, "user_id", "value").select("event_id", "value")


# --- meshes, frames, subsets ---

_V = "v AS (SELECT p_partkey % 20 AS mesh_id, row_number() OVER (PARTITION BY p_partkey % 20 ORDER BY p_partkey) - 1 AS vid, CAST(p_size AS DOUBLE) AS x, CAST(p_partkey % 37 AS DOUBLE) AS y, CAST(p_partkey % 11 AS DOUBLE) AS z FROM part), r AS (SELECT mesh_id, min(x) lx, max(x) hx, min(y) ly, max(y) hy, min(z) lz, max(z) hz FROM v GROUP BY mesh_id)"
_Q = ", ".join(f"CAST(CASE WHEN h{a} > l{a} THEN floor(({a} - l{a}) / (h{a} - l{a}) * 63) ELSE 0 END AS BIGINT) AS {a}" for a in "xyz")


def _mesh(spark, sf):
    from pyspark.sql import Window

    p = V.table(spark, sf, "part").withColumn("mesh_id", F.col("p_partkey") % 20)
    nth = (F.row_number().over(Window.partitionBy("mesh_id").orderBy("p_partkey")) - 1).cast("long")
    v = p.select("mesh_id", nth.alias("vid"), F.col("p_size").cast("double").alias("x"), (F.col("p_partkey") % 37).cast("double").alias("y"), (F.col("p_partkey") % 11).cast("double").alias("z"))
    n = F.count("*").over(Window.partitionBy("mesh_id"))
    f = v.withColumn("n", n).where("vid < n - 2").select("mesh_id", F.col("vid").alias("fid"), F.explode(F.sequence(F.lit(0), F.lit(2))).alias("pos"))
    return v, f.select("mesh_id", "fid", F.col("pos").cast("long").alias("pos"), (F.col("fid") + F.col("pos")).alias("vid"))


@query("mesh_quantize", f"WITH {_V} SELECT mesh_id, vid, {_Q} FROM v JOIN r USING (mesh_id)")
def mesh_quantize(spark, sf):
    return meshes.quantize(_mesh(spark, sf)[0])


@query("mesh_tokens", f"WITH {_V}, q AS (SELECT mesh_id, vid, {_Q} FROM v JOIN r USING (mesh_id)), s AS (SELECT *, row_number() OVER (PARTITION BY mesh_id ORDER BY z, vid) - 1 AS nv, count(*) OVER (PARTITION BY mesh_id) AS n FROM q), f AS (SELECT a.mesh_id, a.vid AS fid, [a.nv, b.nv, c.nv] AS c FROM s a JOIN s b ON a.mesh_id = b.mesh_id AND b.vid = a.vid + 1 JOIN s c ON a.mesh_id = c.mesh_id AND c.vid = a.vid + 2), fs AS (SELECT *, row_number() OVER (PARTITION BY mesh_id ORDER BY list_sort(c), fid) AS i FROM f), l AS (SELECT mesh_id, 0 AS k, nv AS i, 'v ' || x || ' ' || y || ' ' || z AS t FROM s UNION ALL SELECT mesh_id, 1, i, 'f ' || (c[1] + 1) || ' ' || (c[2] + 1) || ' ' || (c[3] + 1) FROM fs) SELECT mesh_id, string_agg(t, chr(10) ORDER BY k, i) || chr(10) AS text FROM l GROUP BY mesh_id")
def mesh_tokens(spark, sf):
    v, f = _mesh(spark, sf)
    few = meshes.small_meshes(f)
    return meshes.mesh_text(*meshes.sort_mesh(meshes.quantize(v.join(few, "mesh_id", "left_semi")), f.join(few, "mesh_id", "left_semi")))


ORACLES["mesh_tokens"] = ORACLES["mesh_tokens"].replace("FROM l GROUP BY mesh_id", "FROM l WHERE mesh_id IN (SELECT mesh_id FROM fs GROUP BY mesh_id HAVING count(*) <= 500) GROUP BY mesh_id")


@query("clip_adjacent_views", "WITH t AS (SELECT page_id % 10 AS clip, page_id, lead(page_id) OVER (PARTITION BY page_id % 10 ORDER BY page_id) AS next_id FROM pages) SELECT * FROM t WHERE next_id IS NOT NULL")
def clip_adjacent_views(spark, sf):
    from pyspark.sql import Window

    t = V.table(spark, sf, "pages").select((F.col("page_id") % 10).alias("clip"), "page_id")
    return t.withColumn("next_id", F.lead("page_id").over(Window.partitionBy("clip").orderBy("page_id"))).where("next_id IS NOT NULL")


@query("stride_sample", "SELECT event_id, event_id / 30.0::DOUBLE AS t_seconds FROM events WHERE (event_id - 3) % 25 = 0 AND event_id >= 3")
def stride_sample(spark, sf):
    return V.table(spark, sf, "events").where("event_id >= 3 AND pmod(event_id - 3, 25) = 0").select("event_id", (F.col("event_id") / F.lit(30.0)).alias("t_seconds"))


@query("subset_union", "SELECT 'nations' AS subset, n_name AS name, 'Nations' AS category FROM nation UNION ALL SELECT 'regions', r_name, 'regions' FROM region")
def subset_union(spark, sf):
    n, r = V.table(spark, sf, "nation").select(F.col("n_name").alias("name")), V.table(spark, sf, "region").select(F.col("r_name").alias("name"))
    return tables.union_subsets({"nations": n, "regions": r}, {"nations": "Nations"}).select("subset", "name", "category")

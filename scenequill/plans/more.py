"""Registered queries of boxes, views, poses, masks, captions and model seams, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import imaging as I
from ..functions import text as T
from ..functions.draws import sql_draw, sql_half_up
from ..operators import boxes, correspondences, dialogue, models, poses, questions, traces, verbs
from . import views as V
from .registry import query

# --- boxes ---

_B_Q = ", ".join(V.quoted(q) for q in boxes.QUESTIONS[:3])
_B_A = ", ".join(V.quoted(a) for a in boxes.ANSWERS)
_f = lambda c: f"printf('%.2f', {sql_half_up(c, 2)})"
_POINT3D = f"""'<point3d x="' || {_f("cx")} || '" y="' || {_f("cy")} || '" z="' || {_f("cz")} || '" extent="' || {_f("ex")} || ',' || {_f("ey")} || ',' || {_f("ez")} || '" alt="' || l || '"/>'"""
_BRACKET = f"'[[' || {_f('cx')} || ',' || {_f('cy')} || ',' || {_f('cz')} || '],[' || {_f('ex')} || ',' || {_f('ey')} || ',' || {_f('ez')} || ']]'"


def labelled_boxes(spark, sf, threshold=None):
    return boxes.boxes(V.points(spark, sf), threshold).withColumn("label", F.expr(V.NOUN))


def _box_sql(value: str) -> str:
    draw = sql_draw(len(boxes.ANSWERS), "'box'", "CAST(scene_id AS VARCHAR)", "object_id", "CAST(nth AS VARCHAR)")
    return (
        f"WITH {V.SQL_OBJECTS}, b AS (SELECT *, {V.NOUN} AS l FROM objects), q AS (SELECT *, unnest([{_B_Q}]) AS q, unnest([0, 1, 2]) AS nth FROM b), a AS (SELECT *, [{_B_A}][1 + {draw}] AS w, {value} AS v FROM q) "
        "SELECT scene_id, object_id, CAST(nth AS BIGINT) AS nth, replace(q, '[A]', l) || ' Answer: ' || replace(replace(w, '[A]', l), '[X]', v) AS text FROM a"
    )


@query("box_prompts", _box_sql(_POINT3D))
def box_prompts(spark, sf):
    return boxes.box_prompts(labelled_boxes(spark, sf))


@query("box_prompts_bracket", _box_sql(_BRACKET))
def box_prompts_bracket(spark, sf):
    return boxes.box_prompts(labelled_boxes(spark, sf), 3, "bracket")


@query("box_detections")
def box_detections(spark, sf):
    o = V.points(spark, sf).select("scene_id", "object_id").distinct().withColumn("label", F.expr(V.NOUN))
    scenes = o.groupBy("scene_id").agg(F.array_sort(F.collect_list(F.struct("object_id", "label"))).alias("objects"))
    return boxes.detections(scenes, V.points(spark, sf))


@query("box_bounds", f"WITH {V.SQL_OBJECTS} SELECT scene_id, object_id, " + ", ".join(f"c{a} - e{a} / 2 AS low_{a}, c{a} + e{a} / 2 AS high_{a}" for a in "xyz") + " FROM objects")
def box_bounds(spark, sf):
    b = labelled_boxes(spark, sf).withColumn("b", G.box_bounds(F.col("centre"), F.col("extent")))
    return b.select("scene_id", "object_id", *[F.col(f"b.{side}")[i].alias(f"{side}_{a}") for i, a in enumerate("xyz") for side in ("low", "high")])


@query("box_comparisons", f"WITH {V.SQL_PAIRS} SELECT scene_id, a_object_id, b_object_id, a_ey > b_ey AS taller, a_volume > b_volume AS larger FROM pairs")
def box_comparisons(spark, sf):
    p = V.pairs(spark, sf)
    e = lambda s: F.array(f"{s}_ex", f"{s}_ey", f"{s}_ez")
    return p.select("scene_id", "a_object_id", "b_object_id", G.taller(e("a"), e("b")).alias("taller"), G.larger(e("a"), e("b")).alias("larger"))


_NEAR = "min(sqrt((a.x-b.x)*(a.x-b.x)+(a.y-b.y)*(a.y-b.y)+(a.z-b.z)*(a.z-b.z)))"


@query(
    "cloud_distances",
    f"WITH {V.SQL_POINTS}, p AS (SELECT *, row_number() OVER () AS rid FROM points), n AS (SELECT a.scene_id, a.rid, {_NEAR} AS d FROM p a JOIN p b ON a.scene_id = b.scene_id AND ((a.object_id = 'AF' AND b.object_id = 'NO') OR (a.object_id = 'NO' AND b.object_id = 'AF')) GROUP BY a.scene_id, a.rid) "
    "SELECT scene_id, 'AF' AS a_object_id, 'NO' AS b_object_id, round(min(d), 6) AS least, round(avg(d), 6) AS mean, round(max(d), 6) AS greatest FROM n GROUP BY scene_id",
)
def cloud_distances(spark, sf):
    p = V.points(spark, sf)
    chosen = p.select("scene_id").distinct().select("scene_id", F.lit("AF").alias("a_object_id"), F.lit("NO").alias("b_object_id"))
    d = G.cloud_distances(p, chosen)
    return d.select("scene_id", "a_object_id", "b_object_id", *[F.round(c, 6).alias(c) for c in ("least", "mean", "greatest")])


# --- questions ---


@query("drawn_pairs", f"WITH {V.SQL_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY scene_id ORDER BY md5('pairs:' || CAST(scene_id AS VARCHAR) || ':' || a_object_id || ':' || b_object_id)) AS nth FROM pairs) SELECT scene_id, a_object_id, b_object_id, nth FROM r WHERE nth <= 5")
def drawn_pairs(spark, sf):
    return questions.drawn_pairs(V.pairs(spark, sf)).select("scene_id", "a_object_id", "b_object_id", "nth")


@query("cross_questions", f"WITH {V.SQL_OBJECTS} SELECT scene_id, object_id, replace(q, '[A]', {V.NOUN}) AS question FROM objects, (SELECT unnest(['What is the [A]?', 'Describe the [A].']) AS q)")
def cross_questions(spark, sf):
    o = V.objects(spark, sf).withColumn("label", F.expr(V.NOUN))
    return questions.cross_questions(o, ["What is the [A]?", "Describe the [A]."]).select("scene_id", "object_id", "question")


@query("valid_answers", "SELECT o_orderkey, coalesce(TRY_CAST(nullif(regexp_extract(split_part(t, ' Answer: ', 2), '([0-9]+\\.[0-9]+|[0-9]+)', 1), '') AS DOUBLE), 0) <> 0 AS ok FROM (SELECT o_orderkey, 'how far 9? Answer: ' || ['3.5 feet', '0.0 meters', 'no', '0 feet or 2'][1 + CAST(o_orderkey % 4 AS INTEGER)] AS t FROM orders)")
def valid_answers(spark, sf):
    said = F.element_at(F.array(*[F.lit(x) for x in ("3.5 feet", "0.0 meters", "no", "0 feet or 2")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return V.table(spark, sf, "orders").select("o_orderkey", questions.valid(F.concat(F.lit("how far 9? Answer: "), said)).alias("ok"))


@query("named_captions", "SELECT o_orderkey, CASE WHEN contains(q, 'lamp') THEN 'Lamp' WHEN contains(q, 'door') THEN 'door' WHEN contains(q, 'crate') THEN 'crate' END AS named FROM (SELECT o_orderkey, ['the LAMP and the door', 'one door', 'nothing', 'a crate, a door'][1 + CAST(o_orderkey % 4 AS INTEGER)] AS t, lower(t) AS q FROM orders)")
def named_captions(spark, sf):
    text = F.element_at(F.array(*[F.lit(x) for x in ("the LAMP and the door", "one door", "nothing", "a crate, a door")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return V.table(spark, sf, "orders").select("o_orderkey", questions.named_in(text, F.array(F.lit("Lamp"), F.lit("door"), F.lit("crate"))).alias("named"))


# --- views, poses ---

_COR = "SELECT o_orderkey AS pair_id, (o_orderkey % 640)::DOUBLE AS ax, (o_custkey % 500)::DOUBLE AS ay, (o_custkey % 800)::DOUBLE AS bx, (o_orderkey % 300)::DOUBLE AS by_, CASE WHEN o_orderkey % 5 = 0 THEN '' WHEN o_orderkey % 5 = 1 THEN 'feature' ELSE 'item ' || CAST(o_orderkey % 5 AS VARCHAR) END AS c FROM orders"
_pct = lambda v, n: f"CAST(round(greatest(0.0::DOUBLE, least(100.0::DOUBLE, {v} / {n} * 100)), 2) AS VARCHAR)"
_tag = lambda x, w, y, h: f"""'<point x="' || {_pct(x, w)} || '" y="' || {_pct(y, h)} || '" alt="' || CASE WHEN c = '' THEN 'point' ELSE c END || '">'"""


def views(spark, sf):
    o, k, c = V.table(spark, sf, "orders"), F.col("o_orderkey"), F.col("o_custkey")
    caption = F.when(k % 5 == 0, "").when(k % 5 != 1, F.concat(F.lit("item "), (k % 5).cast("string")))
    m = o.select(k.alias("pair_id"), F.lit(0).alias("nth"), (k % 640).alias("ax"), (c % 500).alias("ay"), (c % 800).alias("bx"), (k % 300).alias("by"), caption.alias("caption"))
    return correspondences.as_matches(m).withColumns({"a_w": F.lit(640), "a_h": F.lit(480), "b_w": F.lit(800), "b_h": F.lit(300)})


_SLOTS = lambda t, c: f"replace(replace(replace({V.quoted(t)}, '[SRC]', src), '[DST]', dst), '[ALT]', {c})"


@query("correspondence_questions", f"WITH m AS ({_COR}), t AS (SELECT *, {_tag('ax', 640, 'ay', 480)} AS src, {_tag('bx', 800, 'by_', 300)} AS dst FROM m) SELECT pair_id, {_SLOTS(correspondences.QUESTIONS[0], 'c')} AS question, {_SLOTS(correspondences.ANSWERS[1], 'c')} AS answer FROM t")
def correspondence_questions(spark, sf):
    m = correspondences.conversation(views(spark, sf), answer=correspondences.ANSWERS[1])
    text = lambda turn, at: F.col("messages")[turn]["content"][at]["text"]
    return m.select("pair_id", text(0, 2).alias("question"), text(1, 0).alias("answer"))


def pose_table(spark, sf):
    j = V.table(spark, sf, "customer").select(F.col("c_custkey").alias("pose_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(16).cast("long"))).alias("i"))
    k = j.where((F.col("pose_id") + F.col("i")) % 5 != 0).select("pose_id", F.col("i").alias("joint"), ((F.col("pose_id") * 7 + F.col("i") * 13) % 100).alias("x"), ((F.col("pose_id") * 3 + F.col("i") * 29) % 100).alias("y"))
    return poses.keypoints(k).withColumns({"w": F.lit(100.0), "h": F.lit(100.0)})


_KP = "k AS (SELECT pose_id, i, (pose_id * 7 + i * 13) % 100 AS x, (pose_id * 3 + i * 29) % 100 AS y FROM (SELECT c_custkey AS pose_id, unnest(range(0, 17)) AS i FROM customer) WHERE (pose_id + i) % 5 <> 0)"


@query("pose_boxes", f"WITH {_KP} SELECT pose_id, CAST(min(x) AS INTEGER) AS x1, CAST(min(y) AS INTEGER) AS y1, CAST(max(x) AS INTEGER) AS x2, CAST(max(y) AS INTEGER) AS y2, count(*) AS visible FROM k GROUP BY pose_id")
def pose_boxes(spark, sf):
    p = pose_table(spark, sf).withColumn("b", poses.person_box(F.col("keypoints")))
    return p.select("pose_id", "b.*", F.size(poses.visible(F.col("keypoints"))).cast("long").alias("visible"))


_JN = ", ".join(V.quoted(n.replace("_", " ")) for n in poses.JOINTS)


@query(
    "pose_all_joints",
    f"""WITH {_KP} SELECT pose_id, string_agg('<point x="' || CAST(round(x / 100.0::DOUBLE * 100, 1) AS VARCHAR) || '" y="' || CAST(round(y / 100.0::DOUBLE * 100, 1) AS VARCHAR) || '" alt="' || [{_JN}][i + 1] || '"/>', ' ' ORDER BY i) AS answer FROM k GROUP BY pose_id""",
)
def pose_all_joints(spark, sf):
    q = poses.pose_questions(pose_table(spark, sf), 1000)
    return q.where(F.col("question").isin(*poses.ALL_Q)).select("pose_id", "answer")


@query("pose_samples")
def pose_samples(spark, sf):
    return poses.pose_samples(pose_table(spark, sf)).select("pose_id", "pose_messages")


# --- masks and images ---

_MASK = "SELECT l_suppkey AS scene_id, l_linenumber AS mask_id, CAST(l_quantity AS BIGINT) AS y, l_partkey % 60 AS x FROM lineitem"


def mask_pixels(spark, sf):
    return V.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("scene_id"), F.col("l_linenumber").alias("mask_id"), F.col("l_quantity").cast("long").alias("y"), (F.col("l_partkey") % 60).alias("x"))


_CROP = ", ".join(f"CAST(greatest(0, least(64, floor(({lo} + {hi}) / 2.0::DOUBLE {sign} floor(greatest(x2 - x1, y2 - y1) * 1.1::DOUBLE) / 2))) AS BIGINT) AS c{name}" for name, lo, hi, sign in (("x1", "x1", "x2", "-"), ("y1", "y1", "y2", "-"), ("x2", "x1", "x2", "+"), ("y2", "y1", "y2", "+")))


@query("mask_boxes", f"WITH m AS ({_MASK}), s AS (SELECT DISTINCT scene_id, unnest(range(1, 10)) AS mask_id FROM m), b AS (SELECT s.scene_id, s.mask_id, coalesce(min(x), 0) AS x1, coalesce(min(y), 0) AS y1, coalesce(max(x) + 1, 0) AS x2, coalesce(max(y) + 1, 0) AS y2, count(x) AS n FROM s LEFT JOIN m USING (scene_id, mask_id) GROUP BY ALL) SELECT *, {_CROP} FROM b")
def mask_boxes(spark, sf):
    px = mask_pixels(spark, sf)
    every = px.select("scene_id").distinct().withColumn("mask_id", F.explode(F.sequence(F.lit(1), F.lit(9))))
    b = I.mask_boxes(every, px).withColumn("c", I.crop_square(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], F.lit(64), F.lit(64)))
    return b.select("scene_id", "mask_id", "x1", "y1", "x2", "y2", "n", *[F.col(f"c.{c}").alias(f"c{c}") for c in ("x1", "y1", "x2", "y2")])


_DEPTH = "d AS (SELECT DISTINCT p_partkey % 10 AS scene_id, p_partkey % 8 AS y, p_size % 12 AS x, (p_partkey % 8 * 12 + p_size % 12)::DOUBLE * 150 AS z FROM part)"


def depth_map(spark, sf):
    t = V.table(spark, sf, "part").select((F.col("p_partkey") % 10).alias("scene_id"), (F.col("p_partkey") % 8).alias("y"), (F.col("p_size") % 12).alias("x"))
    return t.distinct().withColumn("z", (F.col("y") * 12 + F.col("x")).cast("double") * 150)


@query("depth_cloud", f"WITH {_DEPTH}, m AS (SELECT *, z / 1000 AS m FROM d) SELECT scene_id, round((x - 6) * m / 18, 9) + 0.0::DOUBLE AS x, round((y - 4) * m / 18, 9) + 0.0::DOUBLE AS y, m AS z FROM m WHERE m > 0 AND m < 10")
def depth_cloud(spark, sf):
    c = I.cloud_of(depth_map(spark, sf), 12, 8)
    return c.select("scene_id", (F.round("x", 9) + 0.0).alias("x"), (F.round("y", 9) + 0.0).alias("y"), "z")


@query("depth_at_point", f"WITH {_DEPTH}, a AS (SELECT c_custkey, c_custkey % 10 AS scene_id, (c_custkey % 31) / 2.0::DOUBLE - 1 AS u, (c_custkey % 23) / 2.0::DOUBLE - 1 AS v FROM customer) SELECT c_custkey, z FROM a LEFT JOIN d ON a.scene_id = d.scene_id AND d.x = greatest(0, least(11, round_even(u, 0))) AND d.y = greatest(0, least(7, round_even(v, 0)))")
def depth_at_point(spark, sf):
    k = F.col("c_custkey")
    asked = V.table(spark, sf, "customer").select(k, (k % 10).alias("scene_id"), (k % 31 / F.lit(2.0) - 1).alias("u"), (k % 23 / F.lit(2.0) - 1).alias("v"))
    return I.depth_at(asked, depth_map(spark, sf), 12, 8).select("c_custkey", "z")


@query("masked_points", f"WITH {_DEPTH}, m AS (SELECT DISTINCT scene_id % 10 AS scene_id, mask_id, y % 8 AS y, x % 12 AS x FROM ({_MASK})) SELECT m.scene_id, m.mask_id, count(*) AS n, round(sum((m.x - 6) * z / 500), 6) AS sx, round(sum(z), 6) AS sz FROM m JOIN d ON m.scene_id = d.scene_id AND m.x = d.x AND m.y = d.y WHERE z > 0 GROUP BY ALL")
def masked_points(spark, sf):
    px = mask_pixels(spark, sf).select((F.col("scene_id") % 10).alias("scene_id"), "mask_id", (F.col("y") % 8).alias("y"), (F.col("x") % 12).alias("x")).distinct()
    p = I.masked_points(px, depth_map(spark, sf), 500, 500, 6, 4)
    return p.groupBy("scene_id", "mask_id").agg(F.count("*").alias("n"), F.round(F.sum("x"), 6).alias("sx"), F.round(F.sum("z"), 6).alias("sz"))


@query(
    "image_numbers",
    "SELECT o_orderkey, 518 AS width, CAST(least(round_even((o_custkey % 900 + 100) * 518.0::DOUBLE / 640 / 14, 0) * 14, 518) AS BIGINT) AS height, '<loc_' || CAST(CAST(floor((o_orderkey % 640) * 999 / 640.0::DOUBLE) AS BIGINT) AS VARCHAR) || '>' AS token, "
    "(o_orderkey % 640 + 1) * (o_custkey % 480 + 1) / (640 * 480)::DOUBLE > 0.6::DOUBLE AS degenerate, greatest(0.0::DOUBLE, least(1.0::DOUBLE, coalesce((o_custkey % 9) / nullif(o_orderkey % 7, 0)::DOUBLE, 0))) AS inliers FROM orders",
)
def image_numbers(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    size = I.model_size(F.lit(640), c % 900 + 100)
    box = F.array(F.struct(F.lit(0).alias("x1"), F.lit(0).alias("y1"), (k % 640 + 1).alias("x2"), (c % 480 + 1).alias("y2")))
    token = F.regexp_extract(I.region_tokens(k % 640, F.lit(0), F.lit(0), F.lit(0), F.lit(640), F.lit(480)), "^(<loc_[0-9]+>)", 1)
    return V.table(spark, sf, "orders").select("o_orderkey", size["width"].cast("int").alias("width"), size["height"].alias("height"), token.alias("token"), I.degenerate(box, F.lit(640), F.lit(480)).alias("degenerate"), correspondences.inlier_ratio(c % 9, k % 7).alias("inliers"))


@query("polygon_boxes", "SELECT o_orderkey, round(least(o_orderkey % 50, o_custkey % 60, 30)::DOUBLE, 1) AS x1, round(least(o_custkey % 70, 20, o_orderkey % 40)::DOUBLE, 1) AS y1, round(greatest(o_orderkey % 50, o_custkey % 60, 30)::DOUBLE, 1) AS x2, round(greatest(o_custkey % 70, 20, o_orderkey % 40)::DOUBLE, 1) AS y2 FROM orders")
def polygon_boxes(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    flat = F.array(*[x.cast("double") for x in (k % 50, c % 70, c % 60, F.lit(20), F.lit(30), k % 40)])
    return V.table(spark, sf, "orders").select("o_orderkey", I.polygon_box(flat).alias("b")).select("o_orderkey", "b.*")


_BAND = lambda v, n: f"CASE WHEN {v} <= -60 THEN '{n[0]}' WHEN {v} < -15 THEN '{n[1]}' WHEN {v} <= 15 THEN '{n[2]}' WHEN {v} < 60 THEN '{n[3]}' ELSE '{n[4]}' END"


@query(
    "orientation_texts",
    "WITH a AS (SELECT o_orderkey, o_custkey % 360 AS az, o_orderkey % 181 - 90 AS po, ((o_custkey % 720 - 360 + 180) % 360 + 360) % 360 - 180 AS ro, (o_orderkey % 11) / 10.0::DOUBLE AS c FROM orders) SELECT o_orderkey, 'facing ' || ['north','northeast','east','southeast','south','southwest','west','northwest'][CAST(round_even(az / 45.0::DOUBLE, 0) AS BIGINT) % 8 + 1] || ', ' || "
    + _BAND("po", ("steeply downward", "slightly downward", "level", "slightly upward", "steeply upward"))
    + " || ', ' || "
    + _BAND("ro", ("rolled hard left", "slight roll left", "upright", "slight roll right", "rolled hard right"))
    + " || ', ' || CASE WHEN c >= 0.75 THEN 'high' WHEN c >= 0.4 THEN 'moderate' ELSE 'low' END || ' confidence' AS said FROM a",
)
def orientation_texts(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    return V.table(spark, sf, "orders").select("o_orderkey", T.orientation_text(c % 360, k % 181 - 90, c % 720 - 360, k % 11 / F.lit(10.0)).alias("said"))


# --- texts, dialogue, models ---


@query("caption_texts", "SELECT doc_id, CAST(len(list_filter(list_transform(string_split(coalesce(text, ''), '.'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')) AS BIGINT) AS sentences, CASE WHEN length(text) > 48 THEN rtrim(left(text, 48)) || chr(8230) ELSE text END AS short FROM documents")
def caption_texts(spark, sf):
    t = V.table(spark, sf, "documents")
    return t.select("doc_id", F.size(T.sentences(F.coalesce("text", F.lit("")))).cast("long").alias("sentences"), T.short_text(F.col("text")).alias("short"))


@query("tag_captions", "SELECT o_orderkey, 'item ' || CAST(o_custkey % 7 AS VARCHAR) || '|lamp' AS captions FROM orders")
def tag_captions(spark, sf):
    tag = F.concat(F.lit('a <point x="1.0" y="50.0" alt=" Item '), (F.col("o_custkey") % 7).cast("string"), F.lit('"/> and <point x="150" y="1" alt="LAMP">'))
    return V.table(spark, sf, "orders").select("o_orderkey", F.array_join(T.captions(tag), "|").alias("captions"))


@query("judged_by_stub", f"WITH {V.SQL_ITEMS} SELECT id, CAST(contains(lower(pred), lower(truth)) AS DOUBLE) AS score FROM items")
def judged_by_stub(spark, sf):
    r = models.run_model(V.text_items(spark, sf), "judge", "stub", "reply", "question", "pred", "truth")
    return r.select("id", models.judged(F.col("reply")).alias("score"))


@query("chosen_pairs", "WITH t AS (SELECT *, lag(role) OVER w AS r, lag(coalesce(text, '')) OVER w AS q FROM conversations WHERE role IN ('user', 'assistant') WINDOW w AS (PARTITION BY conv_id ORDER BY turn)), p AS (SELECT conv_id, turn, q AS question, coalesce(text, '') AS answer, row_number() OVER (PARTITION BY conv_id ORDER BY md5('0:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR))) AS n FROM t WHERE role = 'assistant' AND r = 'user' AND q <> '') SELECT conv_id, turn, question, answer FROM p WHERE n = 1")
def chosen_pairs(spark, sf):
    return dialogue.chosen_pair(dialogue.pending_pairs(V.table(spark, sf, "conversations")))


@query("last_user_turns", "SELECT conv_id, arg_max(coalesce(text, ''), turn) AS text FROM conversations WHERE role = 'user' GROUP BY conv_id")
def last_user_turns(spark, sf):
    m = V.table(spark, sf, "conversations").select("conv_id", F.col("turn").alias("seq"), "role", F.lit(0).alias("at"), F.lit("text").alias("kind"), F.coalesce("text", F.lit("")).alias("text"))
    return traces.last_user(m).select("conv_id", "text")


@query("rows_by_number", "SELECT CAST(r.i AS BIGINT) AS rank, n_name FROM (SELECT unnest([7, 3, 7, 99]) AS nth, unnest([0, 1, 2, 3]) AS i) r JOIN nation ON n_nationkey = nth")
def rows_by_number(spark, sf):
    return verbs.rows_by_number(V.table(spark, sf, "nation").withColumn("nth", F.col("n_nationkey").cast("long")), [7, 3, 7, 99]).select("rank", "n_name")


@query("distinct_first", "SELECT lang, arg_min(doc_id, doc_id) AS doc_id FROM documents WHERE coalesce(lang, '') <> '' GROUP BY lang")
def distinct_first(spark, sf):
    return verbs.distinct_first(V.table(spark, sf, "documents").select("lang", "doc_id"), "lang", "doc_id").select("lang", "doc_id")

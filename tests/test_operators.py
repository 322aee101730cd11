import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenequill.functions import geometry as G
from scenequill.functions import text as T
from scenequill.operators import curate, dialogue, meshes, reports
from scenequill.plans import registry
from scenequill.plans import views as V
from scenequill.sources import tables
from scenequill.streaming import traces


def one(spark, text, f):
    return spark.createDataFrame([(text,)], "t string").select(f(F.col("t"))).first()[0]


@pytest.mark.parametrize(("text", "want"), [("[RESULT] 4", None), ("[4]", 4.0), ("[4.5] fine", 4.5), ("", None), ("[2] or [5]", 2.0), (None, None)])
def test_judge_score(spark, text, want):
    assert one(spark, text, T.judge_score) == want


@pytest.mark.parametrize(("text", "want"), [("Yes, it is", True), ("No.", False), ("<conclusion>no</conclusion> yes", False), ("Actually, it may be", False), ("that is correct", True), ("yes or no", True), ("maybe", None)])
def test_yes_no(spark, text, want):
    assert one(spark, text, T.yes_no) == want


def test_numbers_units_options(spark):
    assert one(spark, "about 1,234.5 m", T.number) == 1234.5
    assert one(spark, "three or so", T.number) == 3.0
    assert one(spark, "3 in total", T.measure_unit) == "in"
    assert one(spark, "Answer: (c)", T.option) == "C"
    assert one(spark, "I pick [B]", T.option) == "B"
    assert one(spark, "d.", T.option) == "D"


def test_relative_accuracy_of_a_fifth_off(spark):
    d = T.with_lengths(spark.createDataFrame([("8 m", "10 m"), ("4", "3"), ("0 m", "0 cm"), ("none", "1 m")], "pred string, truth string"))
    assert [r[0] for r in d.select(T.score_mra()).collect()] == [0.6, 0.4, 1.0, None]
    assert [r[0] for r in d.select(T.score_distance()).collect()] == [1.0, 1.0, 1.0, None]


@pytest.mark.parametrize(("text", "want"), [('```json\n{"a": 1}\n```', '{"a": 1}'), ('<think>{x}</think>so {"a": {"b": 2}} ok', '{"a": {"b": 2}}'), ("{oops", None), ('first {"a": "}"} then {"b": 2}', '{"a": "}"}'), ("<think>x</think>\n```\n[1, 2]\n```", "[1, 2]")])
def test_json(spark, text, want):
    assert one(spark, text, T.json_of) == want


def corners(size, turn=0.0):
    c, s = math.cos(turn), math.sin(turn)
    for x in (0, size[0]):
        for y in (0, size[1]):
            for z in (0, size[2]):
                yield float(c * x - s * y), float(s * x + c * y), float(z)


def test_boxes(spark):
    rows = [(1, "box", *p) for p in corners((2, 3, 4))] + [(1, "slab", *p) for p in corners((10, 1, 1), math.pi / 4)]
    pts = spark.createDataFrame(rows, "scene_id long, object_id string, x double, y double, z double")
    r = {x["object_id"]: x for x in G.objects(pts).collect()}["box"]
    assert (r["cx"], r["cy"], r["cz"], r["ex"], r["ey"], r["ez"], r["volume"]) == (1.0, 1.5, 2.0, 2.0, 3.0, 4.0, 24.0)
    o = {x["object_id"]: x for x in G.oriented_volume(pts).collect()}
    assert o["slab"]["oriented_volume"] < 0.25 * o["slab"]["aligned_volume"]
    assert o["box"]["saving"] == pytest.approx(0, abs=1e-6)


def test_nearest_distances(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=(20, 3)), rng.normal(size=(30, 3))
    rows = [(1, "a", *map(float, p)) for p in a] + [(1, "b", *map(float, p)) for p in b]
    pts = spark.createDataFrame(rows, "scene_id long, object_id string, x double, y double, z double")
    chosen = spark.createDataFrame([(1, "a", "b")], "scene_id long, a_object_id string, b_object_id string")
    d = np.sqrt(((a[:, None] - b[None]) ** 2).sum(2)).min(1)
    r = G.nearest_distances(pts, chosen).first()
    assert (r["mean"], r["least"], r["greatest"]) == pytest.approx((d.mean(), d.min(), d.max()))


def test_nearest_distances_of_all_pairs(spark, sf_dir):
    p = V.points(spark, sf_dir).toPandas()
    clouds = {k: g[["x", "y", "z"]].to_numpy(float) for k, g in p.groupby(["scene_id", "object_id"])}
    want = {}
    for (s, a), x in clouds.items():
        for (t, b), y in clouds.items():
            if s == t and a != b:
                d = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2)).min(1)
                want[s, a, b] = d.mean(), d.min(), d.max()
    got = {(r["scene_id"], r["a_object_id"], r["b_object_id"]): (r["mean"], r["least"], r["greatest"]) for r in registry.QUERIES["nearest_cloud_distances"](spark, sf_dir).collect()}
    assert got.keys() == want.keys() and len(got) > len(clouds)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_farthest_points(spark):
    e = spark.createDataFrame([(0, [0.0]), (1, [1.0]), (2, [2.0]), (3, [10.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in curate.farthest_points(e, 3).orderBy("rank").collect()] == [0, 3, 2]
    c = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in curate.farthest_points(c, 2, metric="cosine").orderBy("rank").collect()] == [0, 1]
    assert curate.farthest_points(e, 0).count() == 0
    for bad in ({"metric": "taxi"}, {"start": 9}):
        with pytest.raises(ValueError):
            curate.farthest_points(e, 2, **bad)


def test_choice_of_k_and_tags(spark):
    assert curate.resolve_k(5, fraction=0.5) == 2
    for bad in ({}, {"fraction": 0.5, "count": 1}, {"count": 9}):
        with pytest.raises(ValueError):
            curate.resolve_k(5, **bad)
    t = spark.createDataFrame([("a",), ("b",)], "t string")
    assert t.where(curate.tag_passes(F.col("t"), "", None)).count() == 2
    assert t.where(curate.tag_passes(F.col("t"), "a, b", "b")).count() == 1


def test_null_filter_keeps_nan(spark):
    d = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert d.where(curate.not_null(d)).count() == 2


def test_histogram(spark):
    s = spark.createDataFrame([(x,) for x in (1.0, 3.0, 3.0, 5.0, 4.0)], "score double")
    assert {r["bucket"]: r["n"] for r in reports.score_histogram(s).collect()} == {1: 1, 2: 0, 3: 2, 4: 1, 5: 1}


def test_messages(spark):
    d = spark.createDataFrame([(["Q1? Answer: A1", "no answer", "Q2? Answer: A2"],)], "p array<string>")
    m = d.select(dialogue.messages_of(F.col("p")).alias("m")).first()["m"]
    assert [x["role"] for x in m] == ["user", "assistant"] * 2
    assert [c["type"] for c in m[0]["content"]] == ["image", "text"]
    assert m[3]["content"][0]["text"] == "A2"


def test_mesh(spark):
    text = "v 0 0 5\nv 1 0 1\nv 0 1 9\nv 1 1 3\nf 1/1 2/2 3/3\n# end"
    v, f = meshes.parse_obj(spark.createDataFrame([("m", text)], "mesh_id string, text string"))
    assert v.count() == 4
    assert [r["vid"] for r in f.orderBy("pos").collect()] == [0, 1, 2]
    v2, f2 = meshes.sort_mesh(v, f)
    z = {r["vid"]: r["z"] for r in v2.collect()}
    assert [z[i] for i in range(4)] == [1, 3, 5, 9]
    assert sorted(z[i] for i in f2.first()["c"]) == [1, 5, 9]
    assert {r["x"] for r in meshes.quantize(v).collect()} == {0, 63}


def test_joint_relation(spark):
    d = spark.createDataFrame([(60, 0), (0, 60), (0, 0)], "dx int, dy int")
    assert [r[0] for r in d.select(meshes.joint_relation(F.col("dx"), F.col("dy"))).collect()] == ["left", "above", "same"]


def test_non_maximum(spark):
    b = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0, 0.9), (1, 2, 1.0, 1.0, 10.0, 10.0, 0.8), (1, 3, 50.0, 50.0, 60.0, 60.0, 0.1)], "image_id long, box_id long, x1 double, y1 double, x2 double, y2 double, score double")
    assert sorted(r["box_id"] for r in meshes.non_maximum(b).collect()) == [1, 3]


def test_backends(spark):
    d = spark.createDataFrame([(1, bytearray(b"\x01")), (2, None)], "image_id long, content binary")
    got = {r["image_id"]: r["embedding"] for r in meshes.embed(d).collect()}
    assert got == {1: [0.0, 1.0, 0.0, 0.0], 2: None}
    with pytest.raises(ValueError):
        meshes.embed(d, "nothing")
    with pytest.raises(TypeError):
        meshes.register_backend("x", 3)


def test_sources(spark, tmp_path):
    d = spark.createDataFrame([(1, None), (2, "b")], "id long, t string")
    assert tables.read_table(spark, tables.write_table(d, str(tmp_path / "t"))).count() == 2
    tables.write_jsonl(d, str(tmp_path / "j"))
    assert sorted(r["id"] for r in tables.read_jsonl(spark, str(tmp_path / "j"), "id long, t string").collect()) == [1, 2]
    (tmp_path / "a.obj").write_text("v 1 2 3\n")
    assert tables.read_meshes(spark, str(tmp_path)).first()["mesh_id"] == "a"


def test_trace_stream(spark, tmp_path):
    spark.createDataFrame([(1, 1, "task", "go")], "trace_id long, seq long, kind string, content string").write.json(str(tmp_path / "in"))
    q = traces.append_trace(traces.read_trace(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert q.awaitTermination(60)
    assert spark.read.json(str(tmp_path / "out")).count() == 1

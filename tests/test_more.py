"""Benchmarks, questions, boxes, poses, views, traces, masks, models and dataset verbs, case by case."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scenequill.functions import draws
from scenequill.functions import geometry as G
from scenequill.functions import imaging as I
from scenequill.functions import text as T
from scenequill.operators import benchmarks, boxes, correspondences, curate, dialogue, models, poses, questions, reports, traces, verbs
from scenequill.plans import registry
from scenequill.plans import views as V
from scenequill.sources import benchmarks as files
from scenequill.sources import tables


def col(spark, rows, schema, f):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(f).collect()]


def test_options_units_and_classes(spark):
    texts = ["Answer: b", "the answer is C, surely", "<conclusion>(d)</conclusion>", "so [E] it is", "a. the cat", "F", "f.", "Answer: Bold", "no letter", "é.a. x"]
    assert col(spark, [(t,) for t in texts], "t string", T.option(F.col("t"))) == ["B", "C", "D", "E", "A", "F", "F", None, None, "A"]
    read = T.with_readings(spark.createDataFrame([("3 metres",), ("2 centimetres off",), ("1,234 meters",), ("3 in total",), ("seven or three",)], "t string"), "t")
    assert [(r["t_value"], r["t_unit"], r["t_number"]) for r in read.collect()] == [(3.0, "metres", 3.0), (2.0, "centimetres", 2.0), (234.0, "meters", 1234.0), (3.0, "in", 3.0), (None, None, 3.0)]
    asked = {"What is the radius of the ball?": "measurement", "Who is taller?": "comparison_choice", "How far vertically?": "vertical_distance", "the horizontal distance between": "horizontal_distance", "How close?": "distance", " Is the A red?": "comparison_yn", "Why?": "unknown"}
    assert col(spark, [(q,) for q in asked], "q string", T.question_class(F.col("q"))) == list(asked.values())


def test_choice_needs_one_name_in_the_truth(spark):
    rows = [("the crate", "crate and lamp", "Which, the crate or the lamp?"), ("I say lamp", "the lamp", "Which, the crate or the lamp?"), ("x", " X", "Why?"), ("crate", "lamp.", "Which, the crate or the lamp?")]
    assert col(spark, rows, "p string, g string, q string", T.score_choice(F.col("p"), F.col("g"), F.col("q"))) == [0.0, 1.0, 1.0, 0.0]


def test_runner_summary_and_report(spark):
    items = spark.createDataFrame(
        [(0, "1", "q", "(A)", None, "multi-choice", "c1", "s1", ["x"]), (1, "2", "q", "yes", None, "judgment", "c1", "s2", ["x"]), (2, "3", "q", "4 meters", None, "open-ended", "c2", "s2", ["x"]), (3, "4", "q", "left", None, "open-ended", "c2", "s3", ["x"]), (4, "5", "q", "3", None, "open-ended", "c2", "s3", ["x"])],
        "nth long, id string, question string, answer string, answer_text string, question_type string, category string, subcategory string, options array<string>",
    )
    r = benchmarks.Runner("all")
    said = ["answer is a", "maybe", "700 cm", "Left"]
    scores = r.run({"spatialscore": items}, {"spatialscore": said})
    assert {x["id"]: (x["score"], x["unscored"]) for x in scores.collect()} == {"1": (1.0, False), "2": (0.0, True), "3": (1.0, False), "4": (1.0, False), "5": (0.0, False)}
    judged = benchmarks.Runner("spatialscore", judge=F.lit(1.0)).score("spatialscore", items, said)
    assert {x["id"]: x["score"] for x in judged.collect()}["2"] == 1.0
    rows = benchmarks.summary(scores)
    got = {(x["level"], x["key"]): (x["accuracy"], x["n"]) for x in rows.collect()}
    assert got["overall", "all"] == (0.6, 5) and got["category", "c1"] == (0.5, 2) and got["subcategory", "s3"] == (0.5, 2)
    text = benchmarks.report_text(rows)
    assert f"spatialscore{' ' * 13} {'60.0%':>17} {5:>10}" in text and "Subcategory" in text
    assert json.loads(benchmarks.report_json(rows).first()["report"])["by_category"]["c2"]["count"] == 3
    assert benchmarks.differing_subcategories(rows).first()["differs"]
    with pytest.raises(ValueError):
        benchmarks.taxonomy("none")


def test_benchmark_files(spark, tmp_path):
    root = tmp_path / "b"
    (root / "OmniSpatial-test").mkdir(parents=True)
    (root / "data/raw").mkdir(parents=True)
    (root / "SpatialScore.json").write_text(json.dumps([{"id": 7, "question": "Where? (A) left (B) right", "answer": "A", "question_type": "multi-choice", "img_paths": ["i/1.png", "/abs.png"]}, {"question": "how far"}]))
    (root / "OmniSpatial-test/data.json").write_text(json.dumps([{"id": "3_1", "question": "q", "options": ["up", "down"], "answer": 1, "task_type": "t", "sub_task_type": "s"}, {"id": "4", "options": ["a"], "answer": "b text"}]))
    (root / "data/raw/MindCube_tinybench.jsonl").write_text(json.dumps({"id": "among_1", "question": "q", "gt_answer": "C", "images": ["x.png"]}) + "\n")
    a = files.read_benchmark(spark, "SpatialScore", str(root)).orderBy("nth").collect()
    assert (a[0]["id"], a[0]["options"], a[0]["images"]) == ("7", ["left", "right"], [f"{root}/i/1.png", "/abs.png"])
    assert (a[1]["id"], a[1]["question_type"], a[1]["category"], a[1]["options"]) == ("1", "open-ended", "unknown", [])
    b = files.read_benchmark(spark, "omnispatial", str(root)).orderBy("nth").collect()
    assert (b[0]["answer"], b[0]["answer_text"], b[0]["images"]) == ("B", "down", [f"{root}/OmniSpatial-test/t/3.png"]) and b[1]["answer"] == "B"
    c = files.read_benchmark(spark, "mindcube", str(root)).first()
    assert (c["category"], c["answer"], c["images"]) == ("among", "C", [f"{root}/data/x.png"])
    spark.createDataFrame([(5, "q", "A", "one", "", "three")], "index int, question string, answer string, A string, B string, C string").write.parquet(f"{root}/single-choice/ep")
    d = files.read_space10(spark, str(root), ["ep"]).first()
    assert (d["id"], d["options"], d["subcategory"], d["images"]) == ("ep_5", ["one", "three"], "Entity Presence", [])


def test_prompts_of_scenes(spark, sf_dir):
    out = {r["scene_id"]: r for r in questions.scene_prompts(registry.labelled_pairs(spark, sf_dir), V.points(spark, sf_dir)).collect()}
    again = {r["scene_id"]: r for r in questions.scene_prompts(registry.labelled_pairs(spark, sf_dir).repartition(3), V.points(spark, sf_dir)).collect()}
    assert out == again
    for r in out.values():
        assert len(set(r["prompts"])) == len(r["prompts"]) >= 5 and r["truncated"] == r["prompts"][:5]
        assert [m["role"] for m in r["messages"]] == ["user", "assistant"] * 5
        assert [c["type"] for c in r["messages"][0]["content"]] == ["image", "text"] and all(len(m["content"]) == 1 for m in r["messages"][1:])
        question, answer = r["truncated"][0].split(" Answer: ", 1)
        assert (r["messages"][0]["content"][1]["text"], r["messages"][1]["content"][0]["text"]) == (question, answer)


def test_every_kind_tells_the_truth(spark):
    stats = {"mx": (1.0, 2.0), "my": (5.0, 2.0), "cx": (0.0, 3.0), "cy": (1.0, 1.0), "cz": (0.0, 4.0), "ex": (2.0, 2.0), "ey": (3.0, 1.0), "volume": (6.0, 2.0)}
    cols = [f"{s}_{k}" for k in stats for s in "ab"]
    row = [x for k in stats for x in stats[k]]
    p = spark.createDataFrame([(1, "A", "B", "Red Box", "LAMP", 0.05, *row)], "scene_id long, a_object_id string, b_object_id string, a_label string, b_label string, distance double, " + ", ".join(f"{c} double" for c in cols))
    said = {r["kind"]: r["answer"] for r in questions.pair_questions(p, [*questions.OPEN, *questions.UPRIGHT, *questions.LENGTHS, "distance"]).collect()}
    yes = {"left", "above", "big", "tall", "front"}
    for k in questions.RELATIONS:
        text = said[f"{k}_predicate"]
        assert (text in {t.replace("[A]", "red box").replace("[B]", "lamp") for t in questions.TEMPLATES[f"{k}_predicate"][1]}) == (k in yes), k
    assert "red box" in said["left_choice"] and "lamp" in said["right_choice"] and "lamp" in said["below_choice"] and "red box" in said["tall_choice"]
    number = lambda t: float(t.split("is ")[-1].split(" ")[0]) if "is " in t else None  # noqa: E731, F841
    length = col(spark, [(said["horizontal"],), (said["vertical"],), (said["distance"],)], "t string", F.regexp_extract("t", r"([0-9.]+) (meters|feet|centimeters|inches)", 1).cast("double"))
    assert any(abs(length[0] - f * 50) <= 0.5 for f in (1.0, 3.281)) and length[1] == 0.0
    assert any(abs(length[2] - f * 0.5) <= 0.5 for f in (100.0, 39.37))


def test_draws_are_fixed_and_even(spark):
    n = spark.range(3000).select(draws.draw(3, "k", F.col("id")).alias("d")).groupBy("d").count().collect()
    assert sorted(r["d"] for r in n) == [0, 1, 2] and all(900 < r["count"] < 1100 for r in n)
    s = spark.range(1).select(draws.sample(F.array(*[F.lit(c) for c in "abcde"]), 3, "k").alias("s"), draws.choices(F.array(F.lit("x"), F.lit("y")), 4, "k").alias("c")).first()
    assert len(set(s["s"])) == 3 and len(s["c"]) == 4


def test_judge_records(spark):
    rows = [(0, 1, "user", "Where is it?"), (0, 2, "assistant", "2 meters away"), (1, 1, "system", "s"), (1, 2, "user", ""), (1, 3, "assistant", "skip"), (1, 4, "user", "How far?"), (1, 5, "assistant", "near")]
    pairs = dialogue.pending_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumnRenamed("conv_id", "row_idx")
    e = dialogue.judge_entries(pairs, image_dir="openspaces")
    assert len(e.columns) == 16
    first = e.orderBy("row_idx", "turn").first()
    assert first["image"] == "openspaces/0.png" and first["instruction"].startswith("###Task Description:\n") and first["instruction"].endswith("###The instruction to evaluate: Where is it?")
    assert first["score rubrics"].count("\nScore ") == 5 and first["orig_score5_description"].startswith("The response demonstrates excellent")
    results = spark.createDataFrame([(0, "[4] great"), (1, "no score"), (2, "[5]")], "nth long, text string")
    out = dialogue.scored_dataset(dialogue.matched(benchmarks.numbered(e, "row_idx", "turn"), results)).collect()
    assert len(out) == 1 and out[0]["images"] == "openspaces/0.png"
    assert [m["content"] for m in out[0]["messages"]] == ["###Request: Where is it?\n\n###Response: 2 meters away", "[4] [4] great"]
    content = "array<struct<text:string>>"
    assert col(spark, [([(None,), ("",), ("b",), ("c",)],), ([],), (None,)], f"c {content}", dialogue.text_of(F.col("c"))) == ["b", "", ""]


def test_boxes_attach_orientation_where_it_saves(spark):
    a = math.pi / 4
    slab = [(x * math.cos(a) - y * math.sin(a), x * math.sin(a) + y * math.cos(a), z) for x in (-5, 5) for y in (-0.5, 0.5) for z in (-0.5, 0.5)]
    cube = [(x, y, z) for x in (0, 2) for y in (0, 3) for z in (0, 4)]
    points = spark.createDataFrame([(1, "slab", *p) for p in slab] + [(1, "cube", *map(float, p)) for p in cube] + [(1, "dot", 1.0, 1.0, 1.0)], "scene_id long, object_id string, x double, y double, z double")
    b = {r["object_id"]: r for r in boxes.boxes(points).collect()}
    assert b["cube"]["oriented"] is None and list(b["cube"]["extent"]) == [2, 3, 4] and list(b["cube"]["centre"]) == [1, 1.5, 2] and b["dot"]["oriented"] is None
    o = b["slab"]["oriented"]
    assert np.allclose(sorted(o["extent"]), [1, 1, 10]) and np.allclose(o["centre"], [0, 0, 0], atol=1e-9) and np.allclose(np.abs(np.linalg.det(o["rotation"])), 1)
    assert all(r["oriented"] is None for r in boxes.boxes(points, 0).collect())
    scenes = spark.createDataFrame([(1, [("cube", "wooden crate"), ("gone", "x")]), (2, [("cube", "y")])], "scene_id long, objects array<struct<object_id:string,label:string>>")
    d = {r["scene_id"]: r for r in boxes.detections(scenes, points).collect()}
    assert len(d[1]["prompts"]) == 3 and 'x="1.00" y="1.50" z="2.00" extent="2.00,3.00,4.00" alt="wooden crate"/>' in d[1]["prompts"][0]
    assert d[2]["boxes"] == [] and d[2]["prompts"] == [] and d[2]["messages"] == []
    assert boxes.box_prompts(boxes.boxes(points, None).withColumn("label", F.lit("")), None, "bracket").where("object_id = 'cube' AND text LIKE '%[[1.00,1.50,2.00],[2.00,3.00,4.00]]%' AND text LIKE '%object%'").count() == 6
    with pytest.raises(ValueError):
        boxes.box_prompts(boxes.boxes(points, None).withColumn("label", F.lit("")), 1, "other")


def test_pose_questions(spark):
    seen = {"nose": (50, 12), "left_shoulder": (30, 25), "right_shoulder": (70, 25), "left_wrist": (20, 50), "right_ankle": (75, 90)}
    rows = [(1, n, float(x), float(y)) for n, (x, y) in seen.items()] + [(1, "left_hip", None, None), (2, "3", 1.0, 1.0)]
    p = poses.keypoints(spark.createDataFrame(rows, "pose_id long, joint string, x double, y double")).withColumns({"w": F.lit(100.0), "h": F.lit(100.0)})
    k = {r["pose_id"]: r["keypoints"] for r in p.collect()}
    assert [j["name"] for j in k[1]] == poses.JOINTS and sum(j["visible"] for j in k[1]) == 5 and k[2][3]["visible"]
    q = [r for r in poses.pose_questions(p, 12).orderBy("nth").collect() if r["pose_id"] == 1]
    assert len(q) == 12 and 'alt="nose"/>' in q[0]["answer"] and '<point x="50.0" y="12.0"' in q[0]["answer"] and q[5]["answer"].count("<point") == 5
    side = {True: ("Yes", "Indeed", "Correct")}
    assert all(r["answer"].startswith(side[True]) for r in q[6:])
    assert len([r for r in poses.pose_questions(p, 3).collect() if r["pose_id"] == 1]) == 3
    s = {r["pose_id"]: r["pose_messages"] for r in poses.pose_samples(p).collect()}
    assert len(s[1]) == 12 and s[1][0][0]["content"][0]["type"] == "image"
    box = p.select("pose_id", poses.person_box(F.col("keypoints")).alias("b")).where("pose_id = 1").first()["b"]
    assert tuple(box) == (20, 12, 75, 90)


def test_correspondences(spark):
    m = spark.createDataFrame([(1, 0, 320.0, 120.0, 50.0, 60.0, "door"), (1, 1, -5.0, 500.0, 10.0, 10.0, ""), (2, 0, 1.0, 1.0, 1.0, 1.0, None)], "pair_id long, nth int, ax double, ay double, bx double, by double, caption string")
    pairs = correspondences.as_matches(m).withColumns({"a_w": F.lit(640), "a_h": F.lit(480), "b_w": F.lit(100), "b_h": F.lit(100)})
    c = {r["pair_id"]: r["messages"] for r in correspondences.conversation(pairs).collect()}
    assert [len(x["content"]) for x in c[1]] == [3, 1, 1, 1]
    assert '<point x="50.0" y="25.0" alt="door">' in c[1][0]["content"][2]["text"] and c[1][1]["content"][0]["text"] == '<point x="50.0" y="60.0" alt="door">'
    assert '<point x="0.0" y="100.0" alt="point">' in c[1][2]["content"][0]["text"] and "feature" in c[2][0]["content"][2]["text"]
    s = correspondences.single_questions(pairs, 1)
    assert s.count() == 2 and all(len(r["messages"][0]["content"]) == 3 for r in s.collect())
    with pytest.raises(Exception, match="positive"):
        correspondences.conversation(pairs.withColumn("a_w", F.lit(0))).collect()


def test_traces(spark):
    events = [
        (1, 0, "Task", None, None, None, None, None, None, None, "template"), (1, 1, "ToolCallEvent", "prefill_a", "look", None, "x", None, None, None, None), (1, 2, "ToolCallEvent", "long_b", "measure", '{"a": 1}', "3 m", None, None, None, None),
        (1, 3, "ToolCallEvent", "long_a", "execute_python", None, "status", None, None, None, None), (1, 4, "PythonOutput", "long_a", None, None, None, "out", "err", "ExecutionStatus.ERROR", None), (1, 5, "Message", None, None, None, None, None, None, None, "done"),
        (1, 6, "Task", None, None, None, None, None, None, None, "again"), (1, 7, "ToolCallEvent", "long_b", "return_result", None, "ok", None, None, None, None), (1, 8, "DebugTrace", None, None, None, None, None, None, None, "x"), (1, 9, "LLMOutput", None, None, None, None, None, None, None, ""),
    ]
    ev = spark.createDataFrame(events, "trace_id long, seq long, event_type string, tool_call_id string, name string, arguments string, result string, stdout string, stderr string, execution_status string, content string")
    tr = spark.createDataFrame([(1, "i.png", "what?", "sys", "[]", "high", 2, 1.0), (2, "j.png", "q", None, None, "low", 0, 1.0)], "trace_id long, image_ref string, question string, system_prompt string, tool_schema string, confidence string, tool_calls_used int, wall_clock_s double")
    out = {r["trace_id"]: r for r in traces.conversations(tr, ev).collect()}
    got = [(m["role"], m["content"], m["call_id"]) for m in out[1]["messages"]]
    assert got == [("system", "sys\n\n# Tools\n[]", None), ("user", "what?", None), ("assistant", None, "call_1"), ("tool", "3 m", "call_1"), ("assistant", None, "call_2"), ("tool", "err", "call_2"), ("assistant", "done", None), ("assistant", None, "call_1")]
    assert out[2]["messages"] == [] and out[1]["meta"]["confidence"] == "high"
    assert traces.since(ev, 8).count() == 2


def test_curator(spark):
    line = spark.createDataFrame([(i, [float(x)]) for i, x in enumerate((0, 1, 2, 10))], "vec_id long, embedding array<double>")
    assert [r["vec_id"] for r in curate.farthest_points(line, 3, 0).orderBy("rank").collect()] == [0, 3, 2]
    many = spark.createDataFrame([(i, [math.cos(i), math.sin(i)]) for i in range(60)], "vec_id long, embedding array<double>")
    chosen = [r["vec_id"] for r in curate.farthest_points(many, 40, 0).orderBy("rank").collect()]
    v = np.array([[math.cos(i), math.sin(i)] for i in range(60)])
    near, want = np.full(60, np.inf), [0]
    while len(want) < 40:
        near = np.minimum(near, np.sqrt(((v - v[want[-1]]) ** 2).sum(1)))
        near[want] = -1
        want.append(int(near.argmax()))
    assert chosen == want
    sub, m = curate.Curator(seed=3).curate(line, fraction=0.5, source_repo_id="r/d", split="train")
    row = m.first()
    assert sub.count() == 2 == row["selected_count"] and row["source_count"] == 4 and row["fraction"] == 0.5 and row["embedding_source"] == "precomputed:embedding"
    assert row["selected_ids"] == [r["vec_id"] for r in sub.orderBy("rank").collect()]
    for bad in ({"fraction": 1.5}, {"count": 0}, {"count": 9}, {}, {"count": 1, "fraction": 0.5}, {"count": 1, "strategy": "best"}):
        with pytest.raises(ValueError):
            curate.Curator().curate(line, **bad)
    with pytest.raises(ValueError):
        curate.Curator(metric="other")
    with pytest.raises(ValueError):
        curate.Curator().curate(line.withColumn("embedding", F.when(F.col("vec_id") > 0, F.col("embedding"))), count=1)
    with pytest.raises(KeyError):
        curate.Curator().curate(line.withColumn("split", F.lit("train")), count=1, split="test")


def test_ratio_matches_in_blocks(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(90, 4)).round(2)
    d = spark.createDataFrame([(i, [float(a) for a in r], i % 2) for i, r in enumerate(x)], "vec_id long, embedding array<double>, side int")
    got = {r["vec_id"]: (r["match_id"], r["d1"], r["d2"]) for r in curate.ratio_matches(d.where("side = 0"), d.where("side = 1"), 0.9, block=7).collect()}
    want = {}
    for i in range(0, 90, 2):
        near = sorted((round(float(np.sqrt(((x[i] - x[j]) ** 2).sum())), 6), j) for j in range(1, 90, 2))[:2]
        if near[0][0] < 0.9 * near[1][0]:
            want[i] = (near[0][1], near[0][0], near[1][0])
    assert got == want


def test_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(size=5000), np.full(3000, 7.0), [1e9, -1e9]])
    d = spark.createDataFrame([(float(x),) for x in v] + [(None,)], "v double").repartition(4)
    assert np.allclose(reports.quantiles(d, "v", [0.02, 0.5, 0.85, 1.0], few=100), np.quantile(v, [0.02, 0.5, 0.85, 1.0]))
    assert reports.quantiles(d.where("v IS NULL"), "v", [0.5]) == [None]


def test_masks_and_clouds(spark):
    assert col(spark, [(255,), (0,), (128,)], "v int", I.on(F.col("v"))) == [True, False, True]
    p = spark.createDataFrame([(1, i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (1, 0), (0, 1), (9, 9)])], "scene_id long, point_id long, x double, y double")
    assert [r["point_id"] for r in I.medoid(p, 2).orderBy("rank").collect()] == [1, 0, 2]
    cloud = [(1, "a", float(i % 5), float(i // 5), 0.0) for i in range(25)] + [(1, "a", 90.0, 90.0, 90.0)]
    c = spark.createDataFrame(cloud, "scene_id long, object_id string, x double, y double, z double")
    assert I.without_outliers(c, 4).count() == 25
    a = math.radians(30)
    plane = [(1, i, x, z * math.sin(a), z * math.cos(a)) for i, (x, z) in enumerate((x / 3, z / 3) for x in range(10) for z in range(10))]
    up = I.upright(spark.createDataFrame(plane, "scene_id long, point_id long, x double, y double, z double")).collect()
    assert all(r["canonical"] for r in up) and max(abs(r["y"]) for r in up) < 0.02
    heat = spark.createDataFrame([(1, y, x, float(x == 3)) for y in range(5) for x in range(5)], "scene_id long, y int, x int, heat double")
    assert {r["x"] for r in I.heat_samples(heat, 3, 0.9).collect()} == {3}
    logits = [0.0] * 902
    logits[90], logits[360 + 120], logits[540 + 180], logits[900] = 5.0, 5.0, 5.0, 2.0
    r = spark.createDataFrame([(logits,)], "l array<double>").select(I.angles(F.col("l")).alias("a")).first()["a"]
    assert (r["azimuth"], r["polar"], r["rotation"]) == (90.0, 30.0, 0.0) and abs(r["confidence"] - 1 / (1 + math.exp(-2))) < 1e-9
    sym = G.cloud_distances(c.unionByName(c.limit(1).withColumns({"object_id": F.lit("b"), "x": F.lit(-1.0), "y": F.lit(0.0)})), spark.createDataFrame([(1, "a", "b")], "scene_id long, a_object_id string, b_object_id string")).first()
    assert sym["least"] == 1.0 and sym["greatest"] > 150


def test_models(spark):
    class Failing:
        def predict(self, inputs):
            if any(x == "bad" for x in inputs):
                raise RuntimeError("bad")
            return [x.upper() for x in inputs]

    d = spark.createDataFrame([("a",), ("bad",), (None,), ("c",)], "t string").coalesce(1)
    assert [r["out"] for r in models.run_model(d, "caption", Failing, "out", "t").collect()] == ["A", None, None, "C"]
    e = models.embeddings(spark.createDataFrame([(bytes([3, 2]),)], "i binary"), "i").first()["embedding"]
    assert list(e) == [0.0, 1.0, 0.0, 0.0]
    items = spark.createDataFrame([("1", "q", ["x", "y"], ["img"]), ("2", "q", [], [])], "id string, question string, options array<string>, images array<string>")
    said = {r["id"]: r["prediction"] for r in models.answers(items).collect()}
    assert said["2"] == "" and said["1"] != ""
    for wrong in (lambda: models.register("none", "x", Failing), lambda: models.backend("pose", "none")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(TypeError):
        models.register("caption", "x", "not a class")


def test_verbs_and_tables(spark, tmp_path):
    d = spark.createDataFrame([(0, "b", 1), (1, "", 2), (2, "b", 3), (3, "a", 4)], "nth long, k string, v int")
    assert [r["v"] for r in verbs.rows_by_number(d, [2, 0, 2, 9]).orderBy("rank").collect()] == [3, 1, 3]
    assert verbs.capped(d, 2).count() == 2 and verbs.capped(d, None).count() == 4
    assert verbs.only(d, "v").columns == ["v"] and verbs.without(d, "v").columns == ["nth", "k"] and dict(verbs.cast(d, v="string").dtypes)["v"] == "string"
    with pytest.raises(KeyError):
        verbs.only(d, "none")
    assert {(r["k"], r["nth"]) for r in verbs.distinct_first(d, "k", "nth").collect()} == {("b", 0), ("a", 3)}
    assert verbs.mapped(d, lambda x, by: x[["v"]] * by, "v int", by=2).agg(F.sum("v")).first()[0] == 20
    assert [r["nth"] for r in verbs.shuffled(d, "nth", 1).collect()] == [r["nth"] for r in verbs.shuffled(d.repartition(3), "nth", 1).collect()]
    messages = "array<struct<role:string,content:array<struct<index:long,text:string,type:string>>>>"
    t = spark.createDataFrame([([("user", [(None, "q", "text")])], None, None), (None, "in", "out"), ([], None, None)], f"messages {messages}, input string, output string")
    m = [r["messages"] for r in dialogue.training_messages(t).collect()]
    assert [c["type"] for c in m[0][0]["content"]] == ["image", "text"] and [x["role"] for x in m[1]] == ["user", "assistant"] and m[2] is None
    r = spark.createDataFrame([(1, ["a cat", " "], ["r1", "r2"])], "scene_id long, captions array<string>, regions array<string>")
    assert dialogue.caption_questions(r, ["What?", "Which?"], 5).count() == 2
    (tmp_path / "c.yaml").write_text("a: 1\nb:\n  c: 'x' # note\n  d: true\ne: 0.5\n")
    assert tables.load_config(str(tmp_path / "c.yaml")) == {"a": 1, "b": {"c": "x", "d": True}, "e": 0.5}
    d.write.parquet(str(tmp_path / "t"))
    assert tables.cached_table(spark, str(tmp_path / "t"), str(tmp_path / "copy")).count() == 4 and tables.cached_table(spark, "nowhere", str(tmp_path / "copy")).count() == 4
    tables.write_clouds(spark.createDataFrame([(1, "a", 1.0, 2.0, 3.0)], "scene_id long, object_id string, x double, y double, z double"), str(tmp_path / "clouds"))
    assert (tmp_path / "clouds/scene_id=1/object_id=a").exists()
    (tmp_path / "xyz").mkdir()
    (tmp_path / "xyz/7_box.xyz").write_text("1 2 3\n4 5 6\n")
    assert {(r["scene_id"], r["object_id"], r["z"]) for r in tables.read_clouds(spark, str(tmp_path / "xyz")).collect()} == {("7", "box", 3.0), ("7", "box", 6.0)}
    assert col(spark, [('{"a": {"description": "A. red box"}, "b": {"description": "x"}}',), ('{"object1": {"description": "one."},"object2": {"descr',)], "t string", T.described(F.col("t"))) == [["A red box", "x"], ["one"]]

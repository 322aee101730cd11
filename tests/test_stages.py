"""Stages behind model seams, with stubs."""

import math

from pyspark.sql import functions as F

from scenequill.operators import models, stages


def test_tags_and_places(spark):
    class Pointer:
        def predict(self, inputs):
            return ['<point x="50.0" y="25.0" alt=" Lamp ">' for _ in inputs]

    images = spark.createDataFrame([(0, bytes([0])), (1, bytes([1])), (2, None)], "vec_id long, image binary")
    tags = spark.createDataFrame([(0, [1.0, 0.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0, 0.0])], "label int, tag_vec array<double>")
    assert {(r["vec_id"], r["tag"]) for r in stages.tagged(images, tags).collect()} == {(0, "tag_0"), (1, "tag_1")}
    assert [r["vec_id"] for r in stages.tagged(images, tags, exclude="tag_0").collect()] == [1]
    r = stages.localized(images.where("vec_id = 0"), F.lit(640), F.lit(480), Pointer).first()
    assert (r["points"][0]["x"], r["points"][0]["y"], r["captions"]) == (320.0, 120.0, ["lamp"])
    t = spark.createDataFrame([(["a"],), (["vqa"],), (None,)], "t array<string>").select(stages.merged_tags(F.col("t"), ["vqa", "b"]))
    assert [x[0] for x in t.collect()] == [["a", "vqa", "b"], ["vqa"], ["vqa", "b"]]


def test_depth_to_scene(spark):
    class Flat:
        def predict(self, inputs):
            return [[4.0] + [2.0, 2.0, float("nan"), 2.0] * 4 for _ in inputs]

    px = stages.depths(spark.createDataFrame([(1, "i"), (2, None)], "scene_id long, image string"), Flat)
    assert px.count() == 16 and px.where("z <> 2.0").count() == 0
    masks = px.select("scene_id", F.lit(5).cast("long").alias("mask_id"), "y", "x")
    s = stages.scenes(px, masks, (2.0, 2.0, 2.0, 2.0))
    assert s.count() == 16 and s.select("canonical").distinct().first()[0] is True
    b = stages.lifted_boxes(spark.createDataFrame([(1, 5, "")], "scene_id long, object_id long, label string"), s).first()
    assert b["label"] == "object_5"


def test_angles_descriptions_and_replies(spark):
    class Logits:
        def predict(self, inputs):
            return [None if x == "bad" else [0.0] * 90 + [9.0] + [0.0] * 811 for x in inputs]

    o = stages.oriented(spark.createDataFrame([("a",), ("bad",)], "image string"), Logits).collect()
    assert o[0]["angles"]["azimuth"] == 90.0 and o[0]["description"].startswith("facing east") and o[1]["description"] is None
    one = spark.createDataFrame([(1, (170.0, 0.0, 0.0))], "k int, angles struct<azimuth:double,polar:double,rotation:double>")
    two = spark.createDataFrame([(1, (-170.0, 1.0, 0.0))], "k int, angles struct<azimuth:double,polar:double,rotation:double>")
    assert math.isclose(stages.turned_by(one, two, "k").first()["azimuth"], 20.0)
    d = stages.described(spark.createDataFrame([(1, ["r1", "r2"])], "scene_id long, regions array<string>"), ["What?", "Which?"], 2).first()
    assert len(d["prompts"]) == 4 and len(d["messages"]) == 8 and d["captions"] == ["seen: r1", "seen: r2"]
    p = stages.posed(spark.createDataFrame([(1, "i", 1.0, 1.0)], "pose_id long, image string, w double, h double")).first()
    assert len(p["pose_messages"]) == 2
    conv = spark.createDataFrame([(1, 1, "user", "far?"), (1, 2, "assistant", "2 m")], "conv_id long, turn long, role string, text string")
    r = stages.reasoned(conv).first()
    assert r["input"].endswith("far?<|eot_id|><|start_header_id|>assistant<|end_header_id|>") and r["output"].startswith("seen: ")

    class Json:
        def predict(self, inputs):
            return ['so {"a": 1} it is' for _ in inputs]

    assert stages.generated_json(spark.createDataFrame([("x",)], "prompt string"), Json).first()["json"] == '{"a": 1}'


def test_detection_and_matches(spark):
    class Whole:
        def predict(self, inputs):
            return [[{"x1": 0.0, "y1": 0.0, "x2": 100.0, "y2": 100.0, "score": 0.9, "label": p}] for _, p in inputs]

    class Fine:
        def predict(self, inputs):
            return [[{"x1": 1.0, "y1": 1.0, "x2": 9.0, "y2": 9.0, "score": 0.5, "label": p}] for _, p in inputs]

    i = spark.createDataFrame([("a", "lamp", 100.0, 100.0)], "image string, phrase string, w double, h double")
    assert stages.detected(i, Whole).first()["boxes"][0]["x2"] == 100.0 and stages.detected(i, Whole, Fine).first()["boxes"][0]["x2"] == 9.0
    assert stages.detected(i, Whole, Fine, 0.6).first()["boxes"] == []
    pairs = spark.createDataFrame([(1, "a", "b", 10, 10, 10, 10)], "pair_id long, a string, b string, a_w int, a_h int, b_w int, b_h int")
    assert stages.matched_views(pairs).first()["messages"] is None
    assert models.device(None) == "cpu" and models.device(8) == "small" and models.device(24) == "large"

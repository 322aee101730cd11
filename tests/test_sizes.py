"""What must hold for tables of any size: nothing that grows with them is sent to the driver, held by a Python worker or built twice."""

from scenequill.operators import poses
from scenequill.plans import more, registry  # more adds its queries to those of registry


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joints_are_paired_without_a_join(spark, sf_dir, same, tmp_path):
    assert "Join" not in plan(registry.QUERIES["joint_relations"](spark, sf_dir))  # the planner took 17 rows for each customer as one, and broadcast them
    for name in ("customer",):  # keys that come twice, and none
        spark.createDataFrame([(1,), (1,), (2,), (None,)], "c_custkey long").coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    same(registry.QUERIES["joint_relations"](spark, str(tmp_path)), registry.ORACLES["joint_relations"], str(tmp_path))


def test_nearest_distances_hold_no_pairs_of_clouds(spark):
    """Points go through one shuffle by scene: packed clouds joined to each of their pairs made a Python batch of 10,000 of them."""
    import numpy as np

    from scenequill.functions import geometry as G

    rng = np.random.default_rng(5)
    sizes = {(s, o): int(n) for (s, o), n in zip(((s, o) for s in "pq" for o in "abc"), [1, 3000, 40, 7, 2, 90], strict=True)}
    clouds = {k: rng.normal(size=(n, 3)).round(3) for k, n in sizes.items()}
    points = spark.createDataFrame([(s, o, *map(float, x)) for (s, o), c in clouds.items() for x in c], "scene_id string, object_id string, x double, y double, z double")
    asked = [("p", "a", "b"), ("p", "b", "a"), ("p", "b", "c"), ("p", "b", "c"), ("q", "c", "c"), ("q", "a", "no"), ("r", "a", "b"), (None, "a", "b")]
    chosen = spark.createDataFrame(asked, "scene_id string, a_object_id string, b_object_id string")
    df = G.nearest_distances(points, chosen)
    text = plan(df)
    assert "Join" not in text and "collect_list" not in text and text.count("Exchange hashpartitioning") == 1
    got = sorted(tuple(r) for r in df.collect())
    want = []
    for s, a, b in asked[:5]:
        d = np.sqrt(((clouds[s, a][:, None] - clouds[s, b][None]) ** 2).sum(2)).min(1)
        want.append((s, a, b, d.mean(), d.min(), d.max(), len(d)))
    assert [g[:3] + g[6:] for g in got] == [w[:3] + w[6:] for w in sorted(want)]
    assert np.allclose([g[3:6] for g in got], [w[3:6] for w in sorted(want)], atol=1e-9)


def test_pose_samples_are_made_in_their_row(spark, sf_dir):
    """Questions were exploded, gathered again and joined to the poses, and every pair of joints had its texts made to be cut off."""
    df = registry.QUERIES["pose_samples"](spark, sf_dir)
    text = plan(df)
    assert "Join" not in text and "explode" not in text.split("collect_list")[0] and text.count("Exchange hashpartitioning") == 1
    p = more.pose_table(spark, sf_dir).limit(3)
    for most in (1, 5, 14, 1000):
        asked = {}
        for r in poses.pose_questions(p, most).orderBy("pose_id", "nth").collect():
            asked.setdefault(r["pose_id"], []).append((r["question"], r["answer"]))
        got = {r["pose_id"]: [(m[0]["content"][1]["text"], m[1]["content"][0]["text"]) for m in r["pose_messages"]] for r in poses.pose_samples(p, most).collect()}
        assert got == asked and len(got) == 3 and all(len(v) <= most for v in got.values())

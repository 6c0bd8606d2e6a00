import hashlib
import random

import pytest
from pyspark.sql import functions as F

from imagelab.operators import classes, sketches
from imagelab.sources import images as src


def exact_rates(rows, class_id, threshold):
    """(fpr, tpr) of scores above a threshold."""
    own = [s[class_id] for label, s in rows if label == class_id and s[class_id] is not None]
    rest = [s[class_id] for label, s in rows if label != class_id and s[class_id] is not None]
    return [sum(x > threshold for x in side) / len(side) for side in (rest, own)]


@pytest.mark.parametrize("ties", [False, True])
def test_curve_is_within_its_bound(spark, ties):
    pick = random.Random(ties)
    rows = []
    for i in range(6000):
        label = i % 3
        scores = [pick.gauss(0.8 if c == label else 0.0, 1.0) for c in range(3)]
        rows.append((label, [round(s) * 1.0 if ties else s for s in scores]))
    rows.append((0, [None, float("nan"), 1.0]))
    df = spark.createDataFrame(rows, "label int, scores array<double>").repartition(5)
    curve = sketches.roc_curve(sketches.score_sketches(df), 20).collect()
    rows = rows[:-1]
    for r in curve:
        fpr, tpr = exact_rates(rows, r["class_id"], r["threshold"])
        assert abs(r["fpr"] - fpr) <= sketches.RANK_ERROR and abs(r["tpr"] - tpr) <= sketches.RANK_ERROR
    assert {r["class_id"] for r in curve} == {0, 1, 2}
    for c in range(3):
        mine = sorted((r["threshold"], r["fpr"], r["tpr"]) for r in curve if r["class_id"] == c)
        assert mine[0][1:] == (1.0, 1.0) and mine[-1][1:] == (0.0, 0.0) and len(mine) <= 22


def test_sketches_merge_and_stay_small(spark):
    df = spark.range(200_000).select((F.col("id") % 2).cast("int").alias("label"), F.array(F.rand(1), F.rand(2)).alias("scores"))
    parts = [sketches.score_sketches(df.filter(F.col("scores")[0] < 0.3)), sketches.score_sketches(df.filter(F.col("scores")[0] >= 0.3))]
    merged = sketches.merged_score_sketches(parts[0].unionByName(parts[1])).collect()
    assert sum(r["n"] for r in merged) == 400_000 and all(len(r["sketch"]) < 40_000 for r in merged)
    one_class = sketches.score_sketches(spark.createDataFrame([(0, [0.5])], "label int, scores array<double>"))
    assert sketches.roc_curve(one_class).count() == 0  # no rows of the other kind
    assert sketches.score_sketches(df.limit(0)).count() == 0


def test_profile_of_image_sizes(spark, tree, tmp_path):
    names, path = ["alpha", "beta", "gamma"], str(tmp_path / "profile")
    images = src.read_labelled_images(spark, str(tree), names, drop_invalid=False, extensions=["png"])
    for name in names[:2]:
        sketches.append_profile(sketches.image_size_sketches(images.filter(F.col("class_name") == name)), path, name)
    sketches.append_profile(sketches.image_size_sketches(images.filter("class_name = 'beta'")), path, "beta")  # replaced, not doubled
    found = {(r["class_name"], r["share"]): r for r in sketches.size_quantiles(sketches.read_profile(spark, path), [0.0, 0.5, 1.0]).collect()}
    sizes = images.filter("image.height > 0").select("class_name", "image.height", "image.width", F.octet_length("image.data").alias("bytes")).collect()
    for name in names[:2]:
        mine = [r for r in sizes if r["class_name"] == name]
        for size in ("height", "width", "bytes"):
            values = sorted(r[size] for r in mine)
            assert found[name, 0.0][size] == values[0] and found[name, 1.0][size] == values[-1]
            assert found[name, 0.5][size] in values[len(values) // 2 - 1 : len(values) // 2 + 1]
        assert found[name, 0.5]["n"] == len(mine)
    assert len(found) == 6


@pytest.mark.parametrize("percent", [0, 1, 50, 70, 100])
def test_exact_shares(spark, monkeypatch, percent):
    monkeypatch.setattr(classes, "DIGIT", 1)  # several rounds
    rows = [(i, ["a", "b", None, "lone"][min(i % 40, 3)] if i else "lone") for i in range(1500)]
    df = spark.createDataFrame(rows, "key int, class string").repartition(3)
    train, test = classes.exact_split(df, "class", F.col("key"), percent, "salt")
    expected = set()
    for name in {c for _, c in rows}:
        keys = sorted((k for k, c in rows if c == name), key=lambda k: hashlib.md5(f"salt{k}".encode()).hexdigest())
        expected |= set(keys[: len(keys) * percent // 100])
    got = [r["key"] for r in train.collect()]
    assert set(got) == expected and len(got) == len(expected)
    assert sorted(got + [r["key"] for r in test.collect()]) == list(range(1500))


def test_rows_of_one_key_are_not_parted(spark):
    df = spark.createDataFrame([("same", "a")] * 10 + [(None, "b")] * 4 + [("x", "b")], "key string, class string")
    train, test = classes.exact_split(df, "class", F.col("key"), 50)
    assert train.filter("class = 'a'").count() == 0 and test.count() + train.count() == 15
    assert train.filter("class = 'b'").count() in (0, 1)
    assert classes.exact_split(df.limit(0), "class", F.col("key"))[0].count() == 0

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from imagelab.functions import columns as fx
from imagelab.operators import classes
from imagelab.operators.encoding import one_hot_column
from imagelab.operators.indexing import with_global_index, with_running_total
from imagelab.plans import training


def test_dictionary_labels_and_names(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "name string")
    dictionary = classes.class_dictionary(df, "name")
    assert sorted(map(tuple, dictionary.collect())) == [(0, "a"), (1, "b"), (2, "c")]
    labelled = classes.with_label(df, dictionary, "name")
    assert sorted(map(tuple, labelled.collect()), key=str) == sorted(
        [("b", 1), ("a", 0), (None, None), ("c", 2), ("a", 0)], key=str
    )
    scored = spark.createDataFrame([(2.0,), (0.0,), (9.0,)], "prediction double")
    named = classes.with_class_name(scored, dictionary, "prediction")
    assert {tuple(r) for r in named.collect()} == {(2.0, "c"), (0.0, "a"), (9.0, None)}


def test_small_dictionaries_are_broadcast_by_size_and_large_ones_are_not(spark):
    df = spark.range(200).select(F.concat(F.lit("c"), F.col("id") % 5).alias("name"))
    dictionary = classes.class_dictionary(df, "name")
    plan = lambda: classes.with_label(df, dictionary, "name")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10)
    try:
        assert "BroadcastHashJoin" not in plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_literal_class_lists(spark):
    df = spark.createDataFrame([("x",), ("y",), ("z",), (None,)], "n string")
    ids = df.select(fx.class_id(F.col("n"), ["x", "y"]).alias("i")).collect()
    assert [r.i for r in ids] == [0, 1, None, None]
    numbers = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (-1.0,), (None,)], "p double")
    names = numbers.select(fx.class_name(F.col("p"), ["x", "y"]).alias("n")).collect()
    assert [r.n for r in names] == ["x", "y", None, None, None]


@pytest.mark.parametrize(
    "name,allowed",
    [("a.png", 1), ("a.PNG", 1), ("a.tar.gif", 1), ("a", 0), ("a.", 0), (".jpg", 1), ("a.png.exe", 0), ("d.png/x", 0)],
)
def test_extension_list(spark, name, allowed):
    df = spark.createDataFrame([(name,)], "n string")
    assert df.select(fx.allowed_extension(F.col("n")).alias("ok")).first().ok == bool(allowed)


def test_label_from_path(spark):
    df = spark.createDataFrame([("file:///x/y/cls/a.png",), ("a.png",), ("cls/a",)], "p string")
    assert [r.l for r in df.select(fx.label_from_path(F.col("p")).alias("l")).collect()] == ["cls", None, "cls"]


def test_top_k_breaks_ties_by_id(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.5, 0.1],), ([1.0, 1.0],), ([],)], "s array<double>")
    rows = df.select(fx.top_k(F.col("s"), 3).alias("t"), fx.best_class(F.col("s")).alias("b")).collect()
    assert [[c.class_id for c in r.t] for r in rows] == [[1, 2, 0], [0, 1], []]
    assert [r.b for r in rows] == [1, 0, None]
    named = df.select(fx.named_top_k(F.col("s"), list("wxyz"), 2).alias("t")).collect()
    assert [(c.class_name, c.score) for c in named[0].t] == [("x", 0.5), ("y", 0.5)]


def test_one_hot_forms_agree(spark):
    df = spark.createDataFrame([("b", 1), ("a", 0), ("c", 2)], "n string, i int")
    coded = one_hot_column(df, "n", "v").select(
        vector_to_array("v").cast("array<int>").alias("v"), fx.one_hot(F.col("i"), 3).alias("w")
    )
    assert all(r.v == r.w and sum(r.v) == 1 for r in coded.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """5,000 rows; half of them are of one class."""
    name = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 7))
    return spark.range(0, 5000, 1, 12).select(
        name.alias("name"), F.concat(F.lit("k"), F.lpad(((F.col("id") * 7919) % 5000).cast("string"), 5, "0")).alias("key")
    )


@pytest.mark.parametrize("rows", [1, 150, 1500, 10_000])
def test_cap_equals_brute_force(skewed, rows):
    expected, seen = [], {}
    for name, key in sorted(map(tuple, skewed.collect())):
        seen[name] = seen.get(name, 0) + 1
        if seen[name] <= rows:
            expected.append((name, key))
    assert sorted(map(tuple, classes.cap_per_class(skewed, "name", "key", rows).collect())) == expected


def test_cap_of_rows_without_a_class(spark):
    df = spark.range(10).select(F.lit(None).cast("string").alias("name"), "id")
    assert {r.id for r in classes.cap_per_class(df, "name", "id", 3).collect()} == {0, 1, 2}


def test_running_total_equals_sums(spark, skewed):
    rows = skewed.withColumn("v", F.length("name").cast("long"))
    got = with_running_total(rows, ["name", "key"], "v", "upto").orderBy("name", "key").collect()
    total = 0
    for r in got:
        total += r.v
        assert r.upto == total


def test_global_index_equals_sorting(spark, skewed):
    numbered = with_global_index(skewed.repartition(9), ["name", "key"])
    expected = [(*row, i + 1) for i, row in enumerate(sorted(map(tuple, skewed.collect())))]
    assert sorted(map(tuple, numbered.collect())) == expected


def test_global_index_over_many_sort_partitions(spark, skewed):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = with_global_index(skewed, ["name", "key"])
        assert [r.idx for r in numbered.orderBy("name", "key").collect()] == list(range(1, 5001))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_global_index_of_nothing(spark):
    assert with_global_index(spark.range(0), ["id"]).count() == 0


def test_hash_split_does_not_depend_on_partitioning(spark):
    df = spark.range(4000).select(F.col("id"))
    sides = []
    for frame in (df, df.repartition(13).orderBy(F.desc("id"))):
        train, test = classes.hash_split(frame, F.col("id"), 80, "s")
        sides.append(({r.id for r in train.collect()}, {r.id for r in test.collect()}))
    assert sides[0] == sides[1]
    train, test = sides[0]
    assert len(train) + len(test) == 4000 and not train & test
    assert abs(len(train) - 3200) < 120


def test_random_split_is_there_too(spark):
    train, test = classes.random_split(spark.range(1000), 80, 42)
    assert train.count() + test.count() == 1000


def test_spread(spark):
    assert classes.spread(spark.range(1000), 5).rdd.getNumPartitions() == 5
    spread = classes.spread(spark.range(0, 1000, 1, 1), 6, ["id"])
    assert spread.rdd.getNumPartitions() == 6 and sorted(r.id for r in spread.collect()) == list(range(1000))


@pytest.mark.parametrize("cap,kept", [(3, 3), (10, 10), (12, 13), (20, 13)])
def test_cap_with_null_keys(spark, cap, kept):
    """10 keys and 3 rows without one, which come last and tie."""
    df = spark.createDataFrame([("a", i) for i in range(10)] + [("a", None)] * 3, "name string, id int")
    got = [r.id for r in classes.cap_per_class(df, "name", "id", cap).collect()]
    assert len(got) == kept and sorted(i for i in got if i is not None) == list(range(min(cap, 10)))


def test_split_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([(i if i % 4 else None,) for i in range(200)], "id int")
    train, test = classes.hash_split(df, F.col("id"))
    assert train.count() + test.count() == 200
    train, test = training.split_rows(df.withColumn("x", F.lit(1)), "id")
    assert train.count() + test.count() == 200


def test_first_rows(spark):
    assert [r.id for r in classes.first_rows(spark.range(100), [F.desc("id")], 3).collect()] == [99, 98, 97]

import numpy as np
from pyspark.sql import functions as F

from imagelab.functions.columns import file_name
from imagelab.operators import classes, filters
from imagelab.plans import training
from imagelab.schemas import CAR_CLASSES, IMAGE_STRUCT
from imagelab.sources import images as src
from tests.png import write_png

NAMES = ["alpha", "beta", "gamma"]


def test_one_scan_reads_all_class_folders(spark, tree):
    df = src.read_images(spark, str(tree))
    assert df.schema["image"].dataType.names == IMAGE_STRUCT.names
    assert df.count() == 3 * 9 + 1
    assert src.read_images(spark, f"{tree}/*", recursive=False).count() == 3 * 9 + 1


def test_one_scan_equals_the_union_of_class_frames(spark, tree):
    frames = [
        src.read_images(spark, f"{tree}/{name}").select("image.origin", F.lit(i).alias("label"))
        for i, name in enumerate(NAMES)
    ]
    union = classes.union_frames(frames)
    scan = src.read_labelled_images(spark, str(tree), NAMES).select("image.origin", "label")
    assert sorted(map(tuple, union.collect())) == sorted(map(tuple, scan.collect()))
    assert classes.union_frames([]) is None


def test_undecodable_files_stay_on_request(spark, tree):
    df = src.read_images(spark, str(tree), drop_invalid=False, extensions=["png"])
    assert df.count() == 3 * 10 + 1
    broken = df.filter("image.height = -1").select("image.mode", "image.nChannels").collect()
    assert [tuple(r) for r in broken] == [(-1, -1)] * 3
    assert filters.drop_invalid(df).count() == 3 * 9 + 1


def test_extensions_are_checked_while_listing(spark, tree):
    names = src.read_images(spark, str(tree), False, extensions=["png"]).select(
        file_name(F.col("image.origin")).alias("n")
    )
    found = {r.n for r in names.collect()}
    assert "rgba.PNG" in found and "notes.txt" not in found
    everything = src.read_images(spark, str(tree), drop_invalid=False)
    assert everything.count() - src.allowed_only(everything).count() == 3
    assert src.extension_glob(["mp4"]) == "*.{[mM][pP]4}"


def files_read(df):
    """Number of files that the scan of a plan opens, from its metrics after a run."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    scans = [plan]
    while scans:
        node = scans.pop()
        if node.nodeName().startswith("Scan image"):
            return node.metrics().apply("numFiles").value()
        children = node.children()
        scans += [children.apply(i) for i in range(children.size())]
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            scans.append(node.executedPlan())


def test_files_of_other_classes_are_not_opened(spark, tree):
    everything = src.read_labelled_images(spark, str(tree), NAMES, extensions=["png"])
    assert files_read(everything.select("image.height", "label")) == 31
    two = src.read_labelled_images(spark, str(tree), ["alpha", "gamma"], extensions=["png"])
    assert files_read(two.select("image.height", "label")) == 20
    one = everything.filter("class_name = 'beta'")
    assert files_read(one.select("image.height")) == 11
    assert files_read(everything.filter("label = 0 AND origin LIKE '%rgb3%'").select("image.height")) == 1


def test_files_behind_the_cap_are_not_opened(spark, tree):
    images = src.read_labelled_images(spark, str(tree), NAMES, drop_invalid=False, extensions=["png"])
    capped = training.capped(images, 4)
    assert files_read(capped.select("image.height", "class_name")) == 12
    names = sorted((r.class_name, r.origin) for r in images.select("class_name", "origin").collect())
    expected = [n for name in NAMES for n in [m for m in names if m[0] == name][:4]]
    assert sorted(map(tuple, capped.select("class_name", "origin").collect())) == expected
    assert training.capped(images, 100).count() == 31


def test_folders_with_odd_names(spark, tmp_path):
    for name in ("a b", "c+d", "e%20f", "ü"):
        (tmp_path / name).mkdir()
        write_png(tmp_path / name / "x.png", [[(1, 2, 3)] * 4] * 4)
    df = src.read_labelled_images(spark, str(tmp_path), ["a b", "c+d", "e%20f", "ü"])
    assert sorted(r.class_name for r in df.collect()) == sorted(["a b", "c+d", "e%20f", "ü"])


def test_modes_and_channel_order(spark, tree):
    df = src.read_images(spark, str(tree)).select(file_name(F.col("image.origin")).alias("n"), "image.*")
    rows = {r.n: r for r in df.filter("origin LIKE '%beta%'").collect()}
    assert (rows["gray.png"].mode, rows["rgb0.png"].mode, rows["rgba.PNG"].mode) == (0, 16, 24)
    pixel = np.frombuffer(rows["rgb0.png"].data, np.uint8).reshape(9, 8, 3)[0, 0]
    assert pixel.tolist() == [10, 250, 10]
    red = df.filter("origin LIKE '%alpha/rgb0%'").first()
    assert list(red.data[:3]) == [10, 10, 250]  # stored as B, G, R


def test_filters_on_nested_fields(spark, tree):
    df = src.read_images(spark, str(tree))
    assert filters.keep_dimensions(df).count() == 27
    assert filters.keep_dimensions(df, below_height=10).filter("image.height >= 10").count() == 0
    assert filters.drop_mode(df, 16).count() == 4
    assert filters.keep_modes(df, [0, 24]).count() == 4


def test_labels_from_folders_outside_the_list_are_left_out(spark, tree):
    df = src.read_labelled_images(spark, str(tree), ["gamma", "alpha"])
    counts = {(r.class_name, r.label): r["count"] for r in df.groupBy("class_name", "label").count().collect()}
    assert counts == {("gamma", 0): 9, ("alpha", 1): 9}


def test_vectors_from_memory(spark):
    assert src.from_vectors(spark, []).count() == 0
    df = src.from_vectors(spark, [[1, 2], [3, 4.5]])
    assert [r.features.toArray().tolist() for r in df.collect()] == [[1, 2], [3, 4.5]]


def test_class_list_is_alphabetical():
    assert len(CAR_CLASSES) == 38 and CAR_CLASSES == sorted(CAR_CLASSES)


def test_image_stream_equals_batch(spark, tree, tmp_path):
    stream = src.stream_images(spark, str(tree)).select("image.origin", "image.height")
    query = stream.writeStream.format("memory").queryName("uploads").trigger(availableNow=True).start()
    query.awaitTermination()
    batch = src.read_images(spark, str(tree)).select("image.origin", "image.height")
    assert sorted(map(tuple, spark.table("uploads").collect())) == sorted(map(tuple, batch.collect()))


def test_tables_round_trip(spark, tree, tmp_path):
    df = src.read_images(spark, str(tree)).select("image.*")
    path = str(tmp_path / "images")
    src.write_table(df, path)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, df.collect()))


def test_writer_makes_images_that_spark_decodes(spark, tmp_path):
    pixels = [[(r * 16, c * 16, 7) for c in range(5)] for r in range(4)]
    write_png(tmp_path / "x.png", pixels)
    row = src.read_images(spark, str(tmp_path)).select("image.*").first()
    rgb = np.frombuffer(row.data, np.uint8).reshape(4, 5, 3)[:, :, ::-1]
    assert rgb.tolist() == [[list(p) for p in line] for line in pixels]

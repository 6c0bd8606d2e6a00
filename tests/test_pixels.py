import math
import tracemalloc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from imagelab.functions import pixels as px
from imagelab.functions.predictors import GridColour
from imagelab.operators import images as ops
from imagelab.schemas import IMAGE_STRUCT, IMAGE_ROWS


def structs(rows):
    keys = ["height", "width", "nChannels", "data"]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    columns = [pa.array([None if r is None else r[i] for r in rows], k) for i, k in enumerate(kinds)]
    return pa.StructArray.from_arrays(columns, keys)


def brute_resize(image, height, width, method):
    """Pixel by pixel, in whole numbers."""

    def kernel(x):
        x = abs(x)
        if method == "bilinear":
            return max(0.0, 1.0 - x)
        if x < 1:
            return (1.5 * x - 2.5) * x * x + 1
        return ((-0.5 * x + 2.5) * x - 4) * x + 2 if x < 2 else 0.0

    def line(values, target):
        scale = len(values) / target
        stretch = max(scale, 1.0)
        reach = (1.0 if method == "bilinear" else 2.0) * stretch
        out = []
        for t in range(target):
            centre = (t + 0.5) * scale
            first, last = max(0, int(centre - reach + 0.5)), min(len(values), int(centre + reach + 0.5))
            weights = [kernel((s - centre + 0.5) / stretch) for s in range(first, last)]
            whole = [int(w / sum(weights) * (1 << 22) + math.copysign(0.5, w)) for w in weights]
            total = sum(w * int(v) for w, v in zip(whole, values[first:last]))
            out.append(min(255, max(0, (total + (1 << 21)) >> 22)))
        return out

    h, w, _ = image.shape
    across = np.array([[line(image[y, :, c], width) for c in range(3)] for y in range(h)])  # h, 3, width
    down = np.array([[line(across[:, c, x], height) for c in range(3)] for x in range(width)])
    return down.transpose(2, 0, 1)


@pytest.mark.parametrize("method", ["bilinear", "bicubic"])
@pytest.mark.parametrize("shape,target", [((7, 5), (3, 4)), ((4, 6), (9, 11)), ((12, 3), (5, 3)), ((1, 1), (2, 2))])
def test_resize_equals_brute_force(method, shape, target):
    image = np.random.default_rng(1).integers(0, 256, (*shape, 3), dtype=np.uint8)
    got = px.resize(image[None], *target, method)[0]
    assert got.tolist() == brute_resize(image, *target, method).tolist()


def test_resize_keeps_constant_images_and_equal_sizes():
    solid = np.full((2, 30, 17, 3), 201, np.uint8)
    for method in ("nearest", "bilinear", "bicubic"):
        assert (px.resize(solid, 224, 224, method) == 201).all()
    noise = np.random.default_rng(2).integers(0, 256, (1, 6, 6, 3), dtype=np.uint8)
    assert (px.resize(noise, 6, 6, "bicubic") == noise).all()


def test_nearest_takes_pixel_centres():
    ramp = np.arange(8, dtype=np.uint8).reshape(1, 1, 8, 1).repeat(3, axis=3)
    assert px.resize(ramp, 1, 4, "nearest")[0, 0, :, 0].tolist() == [1, 3, 5, 7]
    assert px.resize(ramp, 1, 16, "nearest")[0, 0, :, 0].tolist() == [i // 2 for i in range(16)]


def test_every_kind_of_failure_has_its_reason():
    good = bytes(range(12))
    rows = [
        (2, 2, 3, good),
        None,
        (-1, -1, -1, b""),
        (2, 2, 2, bytes(8)),
        (2, 2, 3, good[:-1]),
        (2, 2, 3, None),
        (1, 2, 1, b"\x05\x09"),
        (1, 1, 4, b"\x01\x02\x03\x04"),
        (2, 2, 3, good),
    ]
    reasons, pieces = px.decode_rgb(structs(rows))
    assert reasons.tolist() == [None, "missing", "undecodable", "channels", "length", "missing", None, None, None]
    decoded = {int(r): image for at, stack in pieces for r, image in zip(at, stack)}
    assert decoded[0].tolist() == [[[2, 1, 0], [5, 4, 3]], [[8, 7, 6], [11, 10, 9]]]
    assert decoded[6].tolist() == [[[5] * 3, [9] * 3]]
    assert decoded[7].tolist() == [[[3, 2, 1]]]
    assert (decoded[8] == decoded[0]).all()


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 4), st.integers(1, 4), st.sampled_from([1, 3, 4]), st.booleans()), max_size=12),
    st.integers(0, 3),
)
def test_batches_equal_single_rows(kinds, cut):
    rng = np.random.default_rng(len(kinds))
    rows = [
        None if lost else (h, w, c, rng.integers(0, 256, h * w * c, dtype=np.uint8).tobytes())
        for h, w, c, lost in kinds
    ]
    batch = structs(rows)[cut:]
    _, pieces = px.decode_rgb(batch)
    together = px.byte_strings(len(batch), list(pieces)).to_pylist()
    alone = []
    for row in rows[cut:]:
        if row is None:
            alone.append(None)
            continue
        h, w, c, data = row
        image = np.frombuffer(data, np.uint8).reshape(h, w, c)
        alone.append((image.repeat(3, axis=2) if c == 1 else image[:, :, 2::-1]).tobytes())
    assert together == alone


def test_scalings_follow_their_definition():
    pixels = np.array([[0, 127, 255]], np.uint8)
    assert np.allclose(px.scale(pixels, "inception"), [[-1, 127 / 127.5 - 1, 1]])
    assert np.allclose(px.scale(pixels, "resnet"), [[255 - 103.939, 127 - 116.779, 0 - 123.68]])
    assert px.scale(pixels, None) is pixels
    with pytest.raises(ValueError):
        px.scale(pixels, "other")


def test_grid_features_of_uneven_images():
    stack = np.random.default_rng(3).integers(0, 256, (3, 7, 5, 3), dtype=np.uint8)
    got = GridColour(2, 4)()(stack)
    assert got.shape == (3, 2 * 2 * 3 + 3 * 4)
    cells = [stack[1, a:b, c:d].reshape(-1, 3).mean(axis=0) for a, b in ((0, 3), (3, 7)) for c, d in ((0, 2), (2, 5))]
    assert np.allclose(got[1, :12], np.concatenate(cells))
    shares = [((stack[1, :, :, c] // 64) == b).mean() for c in range(3) for b in range(4)]
    assert np.allclose(got[1, 12:], shares)


IMAGES = [
    ("a", 1, 2, 3, 16, bytes([1, 2, 3, 4, 5, 6])),
    ("b", 2, 1, 4, 24, bytes([1, 2, 3, 9, 4, 5, 6, 9])),
    ("c", -1, -1, -1, -1, b""),
    ("d", 1, 1, 1, 0, bytes([7])),
]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(row,) for row in IMAGES] + [(None,)], IMAGE_ROWS)


def test_operators_on_mixed_rows(spark, frame):
    rows = frame.select("image.origin", ops.rgb_pixels("image").alias("p")).select("origin", "p.*").collect()
    got = {r.origin: (None if r.pixels is None else list(r.pixels), r.reason) for r in rows}
    assert got == {
        "a": ([3, 2, 1, 6, 5, 4], None),
        "b": ([3, 2, 1, 6, 5, 4], None),
        "c": (None, "undecodable"),
        "d": ([7, 7, 7], None),
        None: (None, "missing"),
    }


def test_raw_floats_keep_the_stored_bytes(frame):
    rows = frame.select("image.origin", ops.raw_floats("image.data").alias("f")).collect()
    got = {r.origin: r.f for r in rows}
    assert got["b"] == [1, 2, 3, 9, 4, 5, 6, 9] and got["c"] == [] and got[None] is None


def test_resized_table_schema(frame):
    table = ops.resized_table(frame.withColumn("label", F.lit(1)), 4, 5)
    assert table.columns == ["label", *IMAGE_STRUCT.names, "pixels", "reason"]
    sizes = {r.origin: r.n for r in table.select("origin", F.length("pixels").alias("n")).collect()}
    assert sizes == {"a": 60, "b": 60, "c": None, "d": 60, None: None}


def test_means_and_scores_say_what_is_wrong(spark):
    df = spark.createDataFrame([(bytes([1, 2, 3, 3, 4, 5]),), (b"\x01",), (None,), (b"",)], "p binary")
    reasons = [None, "length", "missing", "length"]
    means = df.select(ops.opened(ops.channel_means("p"))).collect()
    assert tuple(means[0]) == (2, 3, 4, None) and [r.reason for r in means] == reasons
    assert [r.r for r in means[1:]] == [None] * 3
    factory = lambda: lambda stack: stack.reshape(len(stack), -1)[:, :2]
    scores = df.select(ops.opened(ops.predict_pixels("p", factory, 1, 2))).collect()
    assert [r.scores for r in scores] == [[1, 2], None, None, None] and [r.reason for r in scores] == reasons
    scaled = df.select(ops.opened(ops.scaled_floats("p", "inception"))).collect()
    assert len(scaled[0]["values"]) == 6 and [r.reason for r in scaled] == reasons


def test_large_results_come_in_several_arrays(spark, frame, monkeypatch):
    """With room for two images in an array every row still has its own result."""
    batch = pa.array([b"abc", b"", b"xyz", b"12"], pa.binary())
    monkeypatch.setattr(px, "ARRAY_VALUES", 6)
    slices = list(px.bounded(iter([batch]), px.longest_line))
    assert [len(s) for s in slices] == [2, 2] and pa.concat_arrays(slices).equals(batch)
    assert [len(s) for s in px.bounded(iter([batch.slice(0, 0)]), px.longest_line)] == [0]

    def halves(batches):
        for column in batches:
            yield from (px.float_lists(len(s), list(px.equal_lines(s))) for s in px.bounded(iter([column]), lambda _: 1 << 27))

    udf = F.arrow_udf("array<float>")(_as_iterator(halves))
    df = spark.createDataFrame([(bytes([i]),) for i in range(7)], "p binary").coalesce(1)
    assert [r.f for r in df.select(udf("p").alias("f")).collect()] == [[i] for i in range(7)]


def _as_iterator(run):
    def spread(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from run(batches)

    return spread


def test_results_too_large_for_an_array_are_an_error(monkeypatch):
    monkeypatch.setattr(px, "MOST_VALUES", 5)
    with pytest.raises(OverflowError):
        px.byte_strings(2, [(np.array([0, 1]), np.zeros((2, 3), np.uint8))])


def test_scattered_rows_are_put_in_their_places():
    rows, block = np.array([3, 0, 2]), np.arange(6, dtype=np.float32).reshape(3, 2)
    for short in (px.SHORT_LINE, 1):
        old, px.SHORT_LINE = px.SHORT_LINE, short
        assert px.float_lists(4, [(rows, block)]).to_pylist() == [[2, 3], None, [4, 5], [0, 1]]
        data = px.ByteColumn(pa.array([b"ab", b"cde", b"fg"], pa.binary()))
        assert data.lines(np.array([2, 0]), 2).tobytes() == b"fgab"
        px.SHORT_LINE = old


def test_a_worker_holds_little_of_a_batch_that_grows():
    """8 x 8 to 224 x 224: a batch of 10,000 small images would be 1.5 GB."""
    count, side = 2000, 224
    data = pa.array([bytes(192)] * count, pa.binary())
    fields = [pa.array([v] * count, pa.int32()) for v in (8, 8, 3)]
    images = pa.StructArray.from_arrays([*fields, data], ["height", "width", "nChannels", "data"])
    tracemalloc.start()
    made = 0
    for batch in px.bounded(iter([images]), lambda _: 3 * side * side):
        reasons, resized = px.resized_stacks(batch, side, side, "nearest")
        made += len(px.byte_strings(len(batch), list(resized)))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert made == count and peak < 100 << 20

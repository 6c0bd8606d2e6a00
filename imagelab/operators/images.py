"""Image columns: decode, resize, scale, and run a batch predictor, in Arrow batches.

Every operator here is a column expression over an Arrow UDF: only the image column travels to
the Python workers, whole batches at a time, and everything else in the row stays in the JVM.
Filters on other columns are planned below the UDF. The table operators open its result with a
generator, which filters on the result do not pass, so it is never computed twice.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.functions import pixels as px
from imagelab.functions.predictors import PredictFn, RowsRefused, grid_colour
from imagelab.session import ship_package

Batches = Iterator[pa.Array]
Sizes = Callable[[pa.Array], int]


def _image_udf(run: Callable[[Batches], Batches], returns: str, values_per_row: Sizes):
    ship_package(SparkSession.active())

    @F.arrow_udf(returns)
    def image_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return run(px.bounded(batches, values_per_row))

    return image_udf


def _each(transform: Callable[[pa.Array], pa.Array], returns: str, values_per_row: Sizes):
    return _image_udf(lambda batches: map(transform, batches), returns, values_per_row)


def opened(struct: Column) -> Column:
    """The fields of a computed struct as columns of a select, computed once whatever is filtered."""
    return F.inline(F.array(struct))


def _with_reasons(column: pa.Array, name: str, reasons: np.ndarray) -> pa.StructArray:
    return pa.StructArray.from_arrays([column, pa.array(reasons, pa.string())], [name, "reason"])


def rgb_pixels(image: str | Column = "image") -> Column:
    """struct<pixels:binary, reason:string>: R,G,B bytes at the stored size.

    Gray is repeated over the channels and alpha is dropped. `reason` says why `pixels` is null.
    """

    def run(images: pa.StructArray) -> pa.StructArray:
        reasons, decoded = px.decode_rgb(images)
        return _with_reasons(px.byte_strings(len(images), list(decoded)), "pixels", reasons)

    return _each(run, "pixels binary, reason string", px.largest_image)(image)


def resized_pixels(
    image: str | Column = "image", height: int = 224, width: int = 224, method: str = "bicubic"
) -> Column:
    """struct<pixels:binary, reason:string>: R,G,B bytes of the image at a fixed size."""

    def run(images: pa.StructArray) -> pa.StructArray:
        reasons, resized = px.resized_stacks(images, height, width, method)
        return _with_reasons(px.byte_strings(len(images), list(resized)), "pixels", reasons)

    return _each(run, "pixels binary, reason string", lambda _: 3 * height * width)(image)


def raw_floats(data: str | Column = "image.data") -> Column:
    """array<float> of the bytes as they are stored."""

    def run(column: pa.Array) -> pa.Array:
        return px.float_lists(len(column), list(px.equal_lines(column)))

    return _each(run, "array<float>", px.longest_line)(data)


def _line_reasons(column: pa.Array, fits: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Why a row of bytes cannot be used: it is missing, or has a length that does not fit."""
    data = px.ByteColumn(column)
    reasons = np.full(len(column), None, object)
    reasons[~fits(data.lengths)] = "length"
    reasons[~data.valid] = "missing"
    return reasons


def _whole_pixels(lengths: np.ndarray | int) -> np.ndarray | bool:
    return (lengths > 0) & (lengths % 3 == 0)


def scaled_floats(pixels: str | Column, scaling: str) -> Column:
    """struct<values:array<float>, reason:string>: R,G,B bytes in the input scaling of a network.

    The scaling is 'inception' or 'resnet'.
    """

    def run(column: pa.Array) -> pa.Array:
        pieces = [
            (rows, px.scale(lines.reshape(len(rows), -1, 3), scaling))
            for rows, lines in px.equal_lines(column)
            if _whole_pixels(lines.shape[1])
        ]
        return _with_reasons(px.float_lists(len(column), pieces), "values", _line_reasons(column, _whole_pixels))

    return _each(run, "values array<float>, reason string", px.longest_line)(pixels)


def channel_means(pixels: str | Column) -> Column:
    """struct<r,g,b: double, reason:string>: mean of every channel of R,G,B bytes."""

    def run(column: pa.Array) -> pa.Array:
        means = np.full((len(column), 3), np.nan)
        for rows, lines in px.equal_lines(column):
            if _whole_pixels(lines.shape[1]):
                means[rows] = lines.reshape(len(rows), -1, 3).mean(axis=1)
        channels = [pa.array(c, from_pandas=True) for c in means.T.copy()]
        reasons = pa.array(_line_reasons(column, _whole_pixels), pa.string())
        return pa.StructArray.from_arrays([*channels, reasons], ["r", "g", "b", "reason"])

    return _each(run, "r double, g double, b double, reason string", px.longest_line)(pixels)


def _predicted(predict: PredictFn, rows: np.ndarray, stack: np.ndarray, reasons: np.ndarray) -> Iterator[px.Piece]:
    """Predict a stack; rows that the predictor refuses get its message as their reason."""
    try:
        yield rows, np.asarray(predict(stack), np.float32)
    except RowsRefused as refusal:
        if len(rows) == 1:
            reasons[rows] = f"predictor: {refusal}"
        else:
            for at in range(len(rows)):
                yield from _predicted(predict, rows[at : at + 1], stack[at : at + 1], reasons)


def embed(
    image: str | Column = "image",
    make_predict_fn: Callable[[], PredictFn] = grid_colour,
    height: int = 224,
    width: int = 224,
    method: str = "bicubic",
    scaling: str | None = None,
) -> Column:
    """struct<features:array<float>, reason:string>: image struct to features in one pass.

    Decoding, resizing, scaling and the predictor are fused: pixels enter the worker once and
    only features leave it. The predictor is built once per task.
    """

    def run(batches: Batches) -> Batches:
        predict = make_predict_fn()
        for images in batches:
            reasons, resized = px.resized_stacks(images, height, width, method)
            pieces = []
            for rows, stack in resized:
                pieces += _predicted(predict, rows, px.scale(stack, scaling), reasons)
            yield _with_reasons(px.float_lists(len(images), pieces), "features", reasons)

    return _image_udf(run, "features array<float>, reason string", lambda _: 3 * height * width)(image)


def predict_pixels(
    pixels: str | Column,
    make_predict_fn: Callable[[], PredictFn],
    height: int = 224,
    width: int = 224,
    scaling: str | None = None,
) -> Column:
    """struct<scores:array<float>, reason:string> of already resized R,G,B bytes."""
    size = height * width * 3

    def run(batches: Batches) -> Batches:
        predict = make_predict_fn()
        for column in batches:
            reasons = _line_reasons(column, lambda lengths: lengths == size)
            pieces = []
            for rows, lines in px.equal_lines(column):
                if lines.shape[1] == size:
                    stack = lines.reshape(len(rows), height, width, 3)
                    pieces += _predicted(predict, rows, px.scale(stack, scaling), reasons)
            yield _with_reasons(px.float_lists(len(column), pieces), "scores", reasons)

    return _image_udf(run, "scores array<float>, reason string", lambda _: size)(pixels)


def resized_table(
    df: DataFrame, height: int = 224, width: int = 224, method: str = "bicubic", image: str = "image"
) -> DataFrame:
    """All image fields, the resized bytes and the reject reason, in place of the image struct."""
    resized = resized_pixels(image, height, width, method)
    rest = [c for c in df.columns if c != image]
    fields = [f"{image}.{f.name}" for f in df.schema[image].dataType]
    return df.select(*rest, *fields, opened(resized))


def feature_table(df: DataFrame, keep: list[str], image: str = "image", **embed_options) -> DataFrame:
    """`keep` columns, features and reject reason; pixels are gone from here on."""
    return df.select(*keep, opened(embed(image, **embed_options)))


def pixel_feature_table(
    df: DataFrame, keep: list[str], make_predict_fn: Callable[[], PredictFn], height: int, width: int,
    method: str = "bicubic", scaling: str | None = None,
) -> DataFrame:
    """The same from the `pixels` of a table of resized images; `method` is how they were resized."""
    scores = predict_pixels("pixels", make_predict_fn, height, width, scaling)
    return df.select(*keep, opened(scores)).withColumnRenamed("scores", "features")

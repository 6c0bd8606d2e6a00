"""Per-batch pixel helpers on Arrow arrays and numpy. They run inside Spark tasks only.

A decoded image is a uint8 array (height, width, 3) in R,G,B order.
"""

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Public definitions of the two network input scalings.
INCEPTION_HALF_RANGE = 127.5
RESNET_BGR_MEANS = (103.939, 116.779, 123.68)

# Kernel half widths, and the fraction bits of the 8-bit resampling weights.
KERNEL_SUPPORT = {"bilinear": 1.0, "bicubic": 2.0}
WEIGHT_ONE = float(1 << 22)

BAND_LINES = 16  # target lines per product of resampling
CHUNK_VALUES = 2_000_000  # pixel values in work at a time
ARRAY_VALUES = 1 << 24  # values of one result array, which a Python worker holds twice; 32-bit offsets end at 2^31
MOST_VALUES = (1 << 31) - 1
SHORT_LINE = 4096  # rows up to this length are moved by index, longer ones one by one


Piece = tuple[np.ndarray, np.ndarray]  # row numbers of a batch, and one line of values for each


class ByteColumn:
    """A binary Arrow column as one flat uint8 array with row starts; nothing is copied."""

    def __init__(self, column: pa.Array):
        width = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        _, offsets, values = column.buffers()
        count = len(column)
        ends = np.frombuffer(offsets, width)[column.offset : column.offset + count + 1]
        self.values = np.frombuffer(values, np.uint8) if values else np.empty(0, np.uint8)
        self.starts, self.lengths = ends[:-1], np.diff(ends)
        self.valid = column.is_valid().to_numpy(zero_copy_only=False)

    def lines(self, rows: np.ndarray, size: int) -> np.ndarray:
        """(rows, size) matrix of equally long rows; a view where the rows lie side by side."""
        starts = self.starts[rows]
        if np.all(np.diff(starts) == size):
            return self.values[starts[0] : starts[0] + len(rows) * size].reshape(len(rows), size)
        if size <= SHORT_LINE:
            return self.values[starts[:, None].astype(np.int64) + np.arange(size)]
        return np.stack([self.values[s : s + size] for s in starts])


def bounded(batches: Iterator[pa.Array], values_per_row: Callable[[pa.Array], int]) -> Iterator[pa.Array]:
    """The batches in slices, each of which makes at most ARRAY_VALUES values or has one row."""
    for batch in batches:
        step = max(1, ARRAY_VALUES // max(1, values_per_row(batch)))
        for start in range(0, max(1, len(batch)), step):
            yield batch.slice(start, step)


def largest_image(images: pa.StructArray) -> int:
    """R,G,B values of the largest image of a batch, going by its stated size."""
    fields = dict(zip([f.name for f in images.type], images.flatten(), strict=True))
    height, width = (fields[n].fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("height", "width"))
    return 3 * int((height * width).max(initial=0))


def longest_line(column: pa.Array) -> int:
    return int(ByteColumn(column).lengths.max(initial=0))


def pieces_of(rows: np.ndarray, values_per_row: int) -> Iterator[np.ndarray]:
    """Row numbers in chunks whose values stay within CHUNK_VALUES."""
    step = max(1, CHUNK_VALUES // values_per_row)
    return (rows[start : start + step] for start in range(0, len(rows), step))


def equal_lines(column: pa.Array) -> Iterator[Piece]:
    """Binary rows in pieces of equal length."""
    data = ByteColumn(column)
    for size in np.unique(data.lengths[data.valid]).tolist():
        for rows in pieces_of(np.flatnonzero(data.valid & (data.lengths == size)), max(size, 1)):
            yield rows, data.lines(rows, size)


def decode_rgb(images: pa.StructArray, work: int = 0) -> tuple[np.ndarray, Iterator[Piece]]:
    """Image structs to (rows, R,G,B stack) pieces of equal shape, and a reason for every other row.

    `work` is the number of values per image that the caller makes of it, to bound the pieces.
    """
    fields = dict(zip([f.name for f in images.type], images.flatten(), strict=True))
    data = ByteColumn(fields["data"])
    shape = [fields[n].fill_null(0).to_numpy(zero_copy_only=False) for n in ("height", "width", "nChannels")]
    height, width, channels = (s.astype(np.int64) for s in shape)
    known = data.valid.copy()
    for name in ("height", "width", "nChannels"):
        known &= fields[name].is_valid().to_numpy(zero_copy_only=False)
    tests = [
        ("missing", ~known),
        ("undecodable", (height <= 0) | (width <= 0)),
        ("channels", ~np.isin(channels, (1, 3, 4))),
        ("length", data.lengths != height * width * channels),
    ]
    reasons = np.full(len(images), None, object)
    for reason, failed in reversed(tests):  # the first reason that applies wins
        reasons[failed] = reason
    good = np.flatnonzero(reasons == None)  # noqa: E711

    def pieces() -> Iterator[Piece]:
        shapes, group = np.unique(
            np.stack([height[good], width[good], channels[good]], axis=1), axis=0, return_inverse=True
        )
        for number, (h, w, c) in enumerate(shapes.tolist()):
            for rows in pieces_of(good[group == number], max(work, 3 * h * w)):
                yield rows, _rgb(data.lines(rows, h * w * c).reshape(len(rows), h, w, c))

    return reasons, pieces()


def _rgb(stored: np.ndarray) -> np.ndarray:
    if stored.shape[3] == 1:
        return np.repeat(stored, 3, axis=3)
    return stored[..., 2::-1]  # B,G,R(,A) to R,G,B


def _weights(lines: np.ndarray, source: int, target: int, method: str) -> tuple[slice, np.ndarray]:
    """Source lines that the target lines need, and their integer weights, which sum to about WEIGHT_ONE."""
    scale = source / target
    stretch = max(scale, 1.0)
    reach = KERNEL_SUPPORT[method] * stretch
    centre = (lines[:, None] + 0.5) * scale
    first = np.maximum((centre - reach + 0.5).astype(int), 0)
    last = np.minimum((centre + reach + 0.5).astype(int), source)
    used = slice(int(first.min()), int(last.max()))
    pixel = np.arange(used.start, used.stop)[None, :]
    x = np.abs((pixel - centre + 0.5) / stretch)
    if method == "bilinear":
        kernel = np.clip(1.0 - x, 0.0, None)
    else:  # cubic convolution, a = -1/2
        near = (1.5 * x - 2.5) * x * x + 1.0
        far = ((-0.5 * x + 2.5) * x - 4.0) * x + 2.0
        kernel = np.where(x < 1.0, near, np.where(x < 2.0, far, 0.0))
    kernel = np.where((pixel >= first) & (pixel < last), kernel, 0.0)
    kernel /= kernel.sum(axis=1, keepdims=True)
    return used, np.trunc(kernel * WEIGHT_ONE + np.copysign(0.5, kernel))


def _to_bytes(weighted: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(weighted / WEIGHT_ONE + 0.5), 0, 255)


@lru_cache(maxsize=256)
def _bands(source: int, target: int, method: str) -> list[tuple[slice, slice, np.ndarray]]:
    """(target lines, source lines, weights), a few target lines at a time.

    Each target line needs few source lines, and only their weights are ever computed.
    """
    bands = []
    for start in range(0, target, BAND_LINES):
        lines = np.arange(start, min(start + BAND_LINES, target))
        bands.append((slice(start, start + len(lines)), *_weights(lines, source, target, method)))
    return bands


def _resample(stack: np.ndarray, target: int, method: str) -> np.ndarray:
    """Resample axis 1 of a (n, source, k, 3) stack."""
    n, source, k, _ = stack.shape
    lines = np.ascontiguousarray(stack).reshape(n, source, k * 3)
    out = np.empty((n, target, k * 3), np.uint8)
    for targets, sources, weights in _bands(source, target, method):
        out[:, targets] = _to_bytes(weights @ lines[:, sources].astype(np.float64))
    return out.reshape(n, target, k, 3)


def resize(stack: np.ndarray, height: int, width: int, method: str) -> np.ndarray:
    """Resize a (n, h, w, 3) stack of equal images; columns first, then rows, 8 bits between."""
    _, h, w, _ = stack.shape
    if (h, w) == (height, width):
        return np.ascontiguousarray(stack)
    if method == "nearest":
        rows = ((np.arange(height) + 0.5) * h / height).astype(int)
        cols = ((np.arange(width) + 0.5) * w / width).astype(int)
        return stack[:, rows[:, None], cols[None, :]]
    across = _resample(stack.transpose(0, 2, 1, 3), width, method).transpose(0, 2, 1, 3)
    return _resample(across, height, method)


def resized_stacks(
    images: pa.StructArray, height: int, width: int, method: str
) -> tuple[np.ndarray, Iterator[Piece]]:
    """Image structs to (rows, resized stack) pieces, and a reason for every other row."""
    reasons, decoded = decode_rgb(images, 3 * height * width)
    return reasons, ((rows, resize(stack, height, width, method)) for rows, stack in decoded)


def scale(pixels: np.ndarray, scaling: str | None) -> np.ndarray:
    """Network input scaling of RGB bytes whose last axis is the channel."""
    if scaling is None:
        return pixels
    values = pixels.astype(np.float32)
    if scaling == "inception":
        return values / np.float32(INCEPTION_HALF_RANGE) - np.float32(1.0)
    if scaling == "resnet":
        return values[..., ::-1] - np.array(RESNET_BGR_MEANS, np.float32)
    raise ValueError(f"unknown scaling {scaling!r}")


def _assemble(count: int, pieces: list[Piece], dtype) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets, flat values and null mask of a column whose rows come in pieces."""
    sizes = np.zeros(count, np.int64)
    missing = np.ones(count, bool)
    blocks = [(rows, block.reshape(len(rows), -1)) for rows, block in pieces if len(rows)]
    for rows, block in blocks:
        sizes[rows], missing[rows] = block.shape[1], False
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if offsets[-1] > MOST_VALUES:
        raise OverflowError(f"{offsets[-1]} values do not fit in one array; use smaller batches")
    values = np.empty(offsets[-1], dtype)
    for rows, block in blocks:
        if rows[-1] - rows[0] == len(rows) - 1:
            values[offsets[rows[0]] : offsets[rows[-1] + 1]] = block.ravel()
        elif block.shape[1] <= SHORT_LINE:
            values[offsets[rows][:, None] + np.arange(block.shape[1])] = block
        else:
            for row, line in zip(rows, block, strict=True):
                values[offsets[row] : offsets[row + 1]] = line
    return offsets.astype(np.int32), values, pa.array(missing)


def float_lists(count: int, pieces: list[Piece]) -> pa.ListArray:
    """array<float> column of `count` rows, null where no piece has the row."""
    offsets, values, missing = _assemble(count, pieces, np.float32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), mask=missing)


def byte_strings(count: int, pieces: list[Piece]) -> pa.Array:
    """binary column of `count` rows, null where no piece has the row."""
    offsets, values, missing = _assemble(count, pieces, np.uint8)
    present = pc.invert(missing)
    return pa.Array.from_buffers(
        pa.binary(), count, [present.buffers()[1], pa.py_buffer(offsets), pa.py_buffer(values)]
    )

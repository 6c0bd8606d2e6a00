"""Best-fit packing of tokenised documents into fixed-length sequences by exact-complement hashing.

A document is its token ids and an end id. Longer ones than a sequence are cut into full pieces,
of which the first may be shorter. Only the histogram of piece lengths, at most one number for
each length up to the capacity, reaches the driver. The plan is made on it: for the largest length
left, the single lengths, pairs and triples that exactly fill the gap are looked up by their sum
among the lengths still available, and a combination is consumed as often as the counts allow.
What finds no exact complement goes through best fit, again by count. The plan is a list of
patterns with repetition counts, bounded by the number of lengths and not by the number of pieces.

Each piece finds its place by its length and its number among the pieces of that length. The
number is local count + start of the partition, both over a written table, so that a retried task
places its pieces as before.

Defined results: null text is an empty document of one end id; repeated rows are documents of
their own; an empty table gives no rows.
"""

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from imagelab.llm.common import col
from imagelab.session import materialise, ship_package

CAPACITY = 2048
END_ID = 0
LAST_PLAIN = 0x24F  # the last code point of the Latin blocks
SPACE_RUN = 10_000  # white space in a row from which on a text goes to the reference tokenizer

Pattern = tuple[int, tuple[int, ...]]  # how many sequences, lengths of their pieces in order


@lru_cache(maxsize=4)
def text_encoder(vocabulary: str, ranks: str | None, added_tokens: bool = False):
    """text -> array of ids; with `added_tokens`, the added tokens of the file are found in texts, as it does by default.

    `ranks` is the same vocabulary for a faster library; texts in Latin script go through it and all
    others through the reference tokenizer, as do texts with long runs of white space, in which the
    pattern search of the faster one overflows its stack.
    """
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(vocabulary)
    reference.encode_special_tokens = not added_tokens  # else control strings in texts are ordinary text
    # the faster library knows no added tokens
    added = [t.content for t in reference.get_added_tokens_decoder().values() if added_tokens or not t.special]

    def slow(text: str) -> np.ndarray:
        return np.array(reference.encode(text, add_special_tokens=False).ids, dtype="<u4")

    if ranks is None:
        return slow
    import base64

    import tiktoken

    with open(ranks, "rb") as lines:
        pairs = [line.split() for line in lines]
    merges = {base64.b64decode(token): int(rank) for token, rank in pairs}
    fast = tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={})
    long_run = re.compile(rf"\s{{{SPACE_RUN}}}")

    def encode(text: str) -> np.ndarray:
        latin = text.isascii() or ord(max(text)) <= LAST_PLAIN
        if latin and not any(token in text for token in added) and (len(text) < SPACE_RUN or not long_run.search(text)):
            return np.array(fast.encode_ordinary(text), dtype="<u4")
        return slow(text)

    return encode


def piece_bounds(tokens: int, capacity: int) -> list[int]:
    """Where the pieces of a document begin, and its end."""
    return [0, *range(tokens % capacity or min(tokens, capacity), tokens, capacity), tokens]


def token_pieces(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str | None = None,
    ranks: str | None = None,
    with_ids: bool = False,
    added_tokens: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, nth), written; with `with_ids` also `ids`.

    `added_tokens`: texts that contain an added token of the file, such as <|endoftext|>, get its id
    there, as from an untouched tokenizer; otherwise it is ordinary text.

    `nth` counts the pieces of one length inside the task `part`.
    """
    ship_package(df.sparkSession)
    if vocabulary is None:
        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
        ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    id_type = df.schema[id_col].dataType
    fields = [
        ("id", id_type), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
        ("ids_crc32", T.LongType()), ("part", T.IntegerType()), ("nth", T.LongType()),
    ]
    if with_ids:
        fields.append(("ids", T.ArrayType(T.LongType())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_encoder(vocabulary, ranks, added_tokens)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            owners, rows, ids_of = [], [], []
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(end_id)).astype("<u4")
                bounds = piece_bounds(len(ids), capacity)
                for piece, (low, high) in enumerate(zip(bounds, bounds[1:])):
                    owners.append(at)
                    rows.append((piece, low, high - low, zlib.crc32(ids[low:high]), part, seen[high - low]))
                    seen[high - low] += 1
                    if with_ids:
                        ids_of.append(ids[low:high])
            numbers = np.array(rows, np.int64).reshape(len(rows), 6).T
            columns = [batch.column(0).take(pa.array(owners, pa.int64()))]
            columns += [pa.array(numbers[0].astype(np.int32)), *(pa.array(n) for n in numbers[1:4])]
            columns += [pa.array(numbers[4].astype(np.int32)), pa.array(numbers[5])]
            if with_ids:
                columns.append(pa.array(ids_of, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])

    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
    texts = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return materialise(texts.mapInArrow(cut, schema), "pieces")


def _complement(counts: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One to three available lengths, largest first, whose sum is `gap`."""

    def pair(total: int, most: int) -> tuple[int, int] | None:
        low = np.arange(1, total // 2 + 1)
        high = total - low
        fits = (counts[low] > 0) & (counts[high] > (low == high)) & (high <= most)
        found = np.flatnonzero(fits)
        return (int(high[found[0]]), int(low[found[0]])) if len(found) else None

    if counts[gap]:
        return (gap,)
    two = pair(gap, gap)
    if two:
        return two
    for first in np.flatnonzero(counts[: gap - 1])[::-1]:
        counts[first] -= 1
        two = pair(gap - int(first), int(first))
        counts[first] += 1
        if two:
            return (int(first), *two)
        if 3 * first < gap:
            break
    return None


def packing_plan(lengths: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use every piece of the histogram {length: count} once."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in lengths.items():
        counts[length] = count
    plan: list[Pattern] = []
    rest = np.zeros_like(counts)
    for length in range(capacity, 0, -1):
        while counts[length]:
            counts[length] -= 1
            others = _complement(counts, capacity - length) if length < capacity else ()
            counts[length] += 1
            if others is None:
                break
            pattern = (length, *others)
            times = min(int(counts[x]) // k for x, k in Counter(pattern).items())
            for x in pattern:
                counts[x] -= times
            plan.append((times, pattern))
        rest[length], counts[length] = counts[length], 0
    return plan + _best_fit(rest, capacity)


def _best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit by decreasing length; sequences with the same pieces are one entry with a count."""
    open_: dict[int, list[list]] = {}  # gap: [how many, pattern] entries
    holds = np.zeros(capacity + 1, bool)  # gaps that have an entry

    def put(many: int, pattern: tuple[int, ...], gap: int) -> None:
        if many:
            open_.setdefault(gap, []).append([many, pattern])
            holds[gap] = True

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            gaps = np.flatnonzero(holds[length:])
            if len(gaps):
                gap = int(gaps[0]) + length
                many, pattern = open_[gap].pop()
                holds[gap] = bool(open_[gap])
            else:
                gap, many, pattern = capacity, left, ()
            each = gap // length  # a piece more makes the gap smaller, so the same one is best again
            full = min(many, left // each)
            put(full, pattern + (length,) * each, gap - each * length)
            left -= full * each
            many -= full
            if many and left:
                put(1, pattern + (length,) * left, gap - left * length)
                left, many = 0, many - 1
            if pattern:
                put(many, pattern, gap)
    return [(many, pattern) for entries in open_.values() for many, pattern in entries]


def _places(plan: list[Pattern]) -> np.ndarray:
    """(length, first number, first sequence, offset) of each run of pieces, sorted."""
    used, runs, sequence = Counter(), [], 0
    for times, pattern in plan:
        offset = 0
        for length in pattern:
            runs.append((length, used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    return np.array(sorted(runs), np.int64).reshape(-1, 4)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add (sequence_id, offset) to a written table of `token_pieces`."""
    ship_package(pieces.sparkSession)
    sums = pieces.groupBy("part", "length").agg(F.count("*").alias("many"))
    histogram = sums.groupBy("length").agg(F.sum("many").alias("many"))
    plan = packing_plan({r["length"]: r["many"] for r in histogram.collect()}, capacity)  # at most `capacity` rows
    runs = _places(plan)
    numbers = runs[:, 0] << 48 | runs[:, 1]

    @F.arrow_udf("sequence_id bigint, offset bigint")
    def place(length: pa.Array, number: pa.Array) -> pa.Array:
        length, number = length.to_numpy(), number.to_numpy()
        at = np.searchsorted(numbers, length << 48 | number, side="right") - 1
        _, first, sequence, offset = runs[at].T
        return pa.StructArray.from_arrays(
            [pa.array(sequence + number - first), pa.array(offset)], ["sequence_id", "offset"]
        )

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("part").alias("_part"),
        F.col("length").alias("_length"),
        F.coalesce(F.sum("many").over(earlier), F.lit(0)).alias("first"),
    )
    numbered = pieces.join(starts, (F.col("part") == F.col("_part")) & (F.col("length") == F.col("_length")))
    placed = numbered.withColumn("place", place("length", F.col("first") + F.col("nth")))
    return placed.select(*[c for c in pieces.columns if c not in ("part", "nth")], "place.sequence_id", "place.offset")


def pack_documents(df: DataFrame, capacity: int = CAPACITY, **options) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset), a row for each piece."""
    return place_pieces(token_pieces(df, capacity=capacity, **options), capacity)

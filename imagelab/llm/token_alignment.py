"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

A document is encoded by both; every token covers a range of bytes. Between two ends that both share,
a common end near the middle is located by bisection: the end of the middle token of one side is
looked up in the other side's ends, the next end there in the first side's, and so on until both
agree or the interval is over; first to the right, then to the left. Both halves go on in the
same way, and an interval without a common end is a group. Searched regions halve with each level, so
work is n log n for any text; all intervals of many documents take each step together.

Two tokens are linked where their ranges overlap. The count of a pair of ids is the number of documents
that hold it linked. A task writes its documents in bundles of about `BUNDLE` links: the links of a
document as numbers into the bundle's list of distinct pairs, and that list once, with how many
documents hold each. Counts are sums over these lists, and go back to each bundle as one list, where
the documents of the bundle meet them: no row for each link is ever shuffled, and a frequent pair has
one row in a bundle, not one for each document. A task holds one bundle, and one document's links at least.

Defined results: texts that are null or empty, or that a tokenizer does not give back byte by byte with a
space in front, have no tokens, no groups and no links; control strings are ordinary text; repeated
rows are documents of their own and count as such; an empty table gives no rows.
"""

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from imagelab.llm.common import col
from imagelab.llm.packing import text_encoder
from imagelab.session import materialise, ship_package

BUNDLE = 1 << 21  # links after which a bundle ends
CHUNK = 1 << 19  # characters encoded and aligned together, unless a document is longer
PAIR_BITS = 32
SPACE = "▁"  # how pieces write a space


@lru_cache(maxsize=2)
def _byte_tokens(vocabulary: str) -> list[bytes]:
    """Bytes of each id of a byte-level vocabulary."""
    from tokenizers import Tokenizer

    # fixed rule of byte-level vocabularies: printable Latin-1 bytes stand for themselves, all others for 256, 257, ...
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    entries = Tokenizer.from_file(vocabulary).get_vocab(with_added_tokens=True)
    tokens = [b""] * (max(entries.values()) + 1)
    for entry, number in entries.items():
        tokens[number] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
    return tokens


@lru_cache(maxsize=2)
def _pieces(model: str):
    """(encoder of many texts, bytes of each id) of a piece model."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=model)
    tokens = []
    for number in range(pieces.get_piece_size()):
        piece = pieces.id_to_piece(number)
        tokens.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(number) else piece.replace(SPACE, " ").encode())
    return (lambda texts: pieces.encode(texts, num_threads=1)), tokens


class Side:
    """The tokens of many documents by one tokenizer, one after another: ids, byte ends, first token of each document."""

    def __init__(self, documents: list[list[int]], sizes: np.ndarray):
        self.starts = np.cumsum([0, *map(len, documents)])
        self.ids = np.concatenate([np.asarray(d, np.int64) for d in documents] or [np.zeros(0, np.int64)])
        self.ends = np.cumsum(sizes[self.ids])


def shared_cuts(a: np.ndarray, b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which ends of `a` are ends of `b` too, found by divide and conquer.

    `a` and `b` ascend. Each region first[i]..last[i] of `a` ends in a known common end, at last[i].
    """
    cut = np.zeros(len(a), bool)
    cut[last] = True
    low, high = first, last  # ends low..high-1 are to be searched
    while True:
        open_ = low < high
        low, high = low[open_], high[open_]
        if not len(low):
            return cut
        middle = (low + high) // 2
        found = np.full(len(low), -1)
        at, rest = middle.copy(), np.arange(len(low))
        while len(rest):  # to the right of the middle
            other = np.searchsorted(b, a[at])
            equal = b[other] == a[at]
            found[rest[equal]] = at[equal]
            rest, at = rest[~equal], np.searchsorted(a, b[other[~equal]])
            inside = at < high[rest]
            rest, at = rest[inside], at[inside]
        right = found >= 0
        rest = np.flatnonzero(~right & (middle > low))
        at = middle[rest] - 1
        while len(rest):  # and to its left
            other = np.searchsorted(b, a[at], side="right") - 1
            before = other < 0
            rest, at, other = rest[~before], at[~before], other[~before]
            equal = b[other] == a[at]
            found[rest[equal]] = at[equal]
            rest, at = rest[~equal], np.searchsorted(a, b[other[~equal]], side="right") - 1
            inside = at >= low[rest]
            rest, at = rest[inside], at[inside]
        cut[found[found >= 0]] = True
        left = ~right & (found >= 0)
        # nothing common lies between the middle and the end that was found
        low, high = (
            np.concatenate([low[right], found[right] + 1, low[left]]),
            np.concatenate([middle[right], high[right], found[left]]),
        )


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0..most - 1, left-aligned, and how many each has."""
    text = np.arange(most).astype("S")
    return text.view(np.uint8).reshape(most, -1), np.char.str_len(text)


def _group_digests(a: Side, b: Side, cut: np.ndarray, cut_b: np.ndarray) -> list[str]:
    """Digest of `a1,a2|b1;a3|b2,b3` for each document; `cut` and `cut_b` mark the last tokens of groups."""
    group_a, group_b = np.cumsum(cut) - cut, np.cumsum(cut_b) - cut_b
    ends_a, ends_b = np.flatnonzero(cut) + 1, np.flatnonzero(cut_b) + 1  # tokens up to the end of each group
    tokens = len(a.ids) + len(b.ids)
    place_a = np.arange(len(a.ids)) + np.concatenate([[0], ends_b])[group_a]
    place_b = np.arange(len(b.ids)) + ends_a[group_b]
    written, lengths = _digits(int(max(a.ids.max(), b.ids.max())) + 1)
    width = written.shape[1] + 1
    cells, size = np.zeros((tokens, width), np.uint8), np.zeros(tokens, np.int64)
    for place, ids, ends, last in ((place_a, a.ids, cut, b"|"), (place_b, b.ids, cut_b, b";")):
        cells[place, : width - 1] = written[ids]
        size[place] = lengths[ids]
        cells[place, lengths[ids]] = np.where(ends, last[0], ord(","))
    text = cells[np.arange(width) <= size[:, None]].tobytes()
    offsets = np.concatenate([[0], np.cumsum(size + 1)])[a.starts + b.starts].tolist()
    return [hashlib.sha256(text[low : high - 1]).hexdigest() for low, high in zip(offsets, offsets[1:])]


def align(a: Side, b: Side) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """(groups of each document, their digests, pair of each link, document of each link).

    Both sides hold the same documents, each of which has tokens, and cover the same bytes.
    """
    cut = shared_cuts(a.ends, b.ends, a.starts[:-1], a.starts[1:] - 1)
    cut_b = np.zeros(len(b.ends), bool)
    cut_b[np.searchsorted(b.ends, a.ends[cut])] = True
    groups = np.add.reduceat(cut.astype(np.int64), a.starts[:-1])
    # between two neighbouring ends of any side lies one stretch of bytes, and so one link
    ends = np.sort(np.concatenate([a.ends, b.ends[~cut_b]]))
    at_a, at_b = np.searchsorted(a.ends, ends), np.searchsorted(b.ends, ends)
    owner = np.searchsorted(a.starts, at_a, side="right") - 1
    return groups, _group_digests(a, b, cut, cut_b), a.ids[at_a] << PAIR_BITS | b.ids[at_b], owner


def _packed(numbers: np.ndarray) -> bytes:
    """Ascending numbers as compressed differences."""
    steps = np.diff(numbers, prepend=0).astype("<u4")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


class Bundle:
    """Documents of a task with their links, until there are enough to be written."""

    def __init__(self):
        self.rows: list[tuple] = []  # id, n_a, n_b, n_groups, digest
        self.pairs: list[np.ndarray] = []
        self.owners: list[np.ndarray] = []  # index into `rows`
        self.links = 0

    def batch(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        pairs = np.concatenate([np.zeros(0, np.int64), *self.pairs])
        owners = np.concatenate([np.zeros(0, np.int64), *self.owners])
        distinct, inverse = np.unique(pairs, return_inverse=True)
        many = len(self.rows)
        held = np.unique(owners * max(len(distinct), 1) + inverse) % max(len(distinct), 1)
        documents = np.bincount(held.astype(np.int64), minlength=len(distinct))
        order = np.argsort(-documents, kind="stable")  # frequent pairs get small numbers, so steps are small
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        numbers = rank[inverse]
        numbers = numbers[np.lexsort((numbers, owners))]
        bounds = np.searchsorted(np.sort(owners), np.arange(many + 1))
        links = [_packed(numbers[low:high]) for low, high in zip(bounds, bounds[1:])]
        ids, n_a, n_b, groups, digests = zip(*self.rows) if many else ((),) * 5
        # one row more: the list of pairs
        columns = [
            pa.array([*ids, None], id_type),
            pa.array([number] * (many + 1), pa.int64()),
            *[pa.array([*values, None], pa.int64()) for values in (n_a, n_b, groups, np.diff(bounds).tolist())],
            pa.array([*digests, None], pa.string()),
            pa.array([*links, None], pa.binary()),
            pa.array([None] * many + [distinct[order]], pa.list_(pa.int64())),
            pa.array([None] * many + [documents[order]], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays(columns, _FIELDS)


_FIELDS = ["id", "bundle", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "pairs", "documents"]


def _chunks(texts: list[str | None]) -> Iterator[range]:
    low = size = 0
    for at, text in enumerate(texts):
        size += len(text or "")
        if size >= CHUNK:
            yield range(low, at + 1)
            low, size = at + 1, 0
    if low < len(texts):
        yield range(low, len(texts))


def aligned_bundles(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, ranks: str | None = None, model: str | None = None
) -> DataFrame:
    """The written table of bundles: a row for each document with its numbers and links, one for each list of pairs."""
    ship_package(df.sparkSession)
    if vocabulary is None:
        vocabulary, ranks = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    longs = [T.StructField(name, T.LongType()) for name in _FIELDS[1:6]]
    lists = [T.StructField(name, T.ArrayType(T.LongType())) for name in _FIELDS[8:]]
    schema = T.StructType(
        [T.StructField("id", df.schema[id_col].dataType), *longs, T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType()), *lists]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_a, tokens_a = text_encoder(vocabulary, ranks), _byte_tokens(vocabulary)
        encode_b, tokens_b = _pieces(model)
        sizes_a, sizes_b = (np.array([len(t) for t in tokens], np.int64) for tokens in (tokens_a, tokens_b))
        number = TaskContext.get().partitionId() << PAIR_BITS
        bundle, id_type = Bundle(), pa.null()
        for batch in batches:
            id_type = batch.column(0).type
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for chunk in _chunks(texts):
                used, side_a, side_b = [], [], []
                kept = [i for i in chunk if texts[i]]
                for i, of_b in zip(kept, encode_b([texts[i] for i in kept])):
                    whole, of_a = (" " + texts[i]).encode(), encode_a(" " + texts[i]).tolist()
                    if b"".join([tokens_a[t] for t in of_a]) == whole == b"".join([tokens_b[t] for t in of_b]):
                        used.append(i)
                        side_a.append(of_a)
                        side_b.append(of_b)
                first = len(bundle.rows)
                if used:
                    groups, digests, pairs, owners = align(Side(side_a, sizes_a), Side(side_b, sizes_b))
                    bundle.rows += [
                        (ids[i], len(x), len(y), g, d) for i, x, y, g, d in zip(used, side_a, side_b, groups.tolist(), digests)
                    ]
                    bundle.pairs.append(pairs)
                    bundle.owners.append(owners + first)
                    bundle.links += len(pairs)
                bundle.rows += [(ids[i], 0, 0, 0, "") for i in sorted(set(chunk) - set(used))]
                if bundle.links >= BUNDLE:
                    yield bundle.batch(number, id_type)
                    bundle, number = Bundle(), number + 1
        if bundle.rows:
            yield bundle.batch(number, id_type)

    texts = df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return materialise(texts.mapInArrow(encode, schema), "bundles")


def pair_counts(bundles: DataFrame) -> DataFrame:
    """(pair, count, best), written: documents that hold each pair of ids linked; whether no other pair of its first id has more."""
    held = bundles.select(F.inline_outer(F.arrays_zip("pairs", "documents"))).filter("pairs IS NOT NULL")
    counts = materialise(held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("documents").alias("count")), "counts")
    first = F.shiftright("pair", PAIR_BITS)
    highest = counts.groupBy(first.alias("_first")).agg(F.max("count").alias("_most"))
    best = counts.join(highest, first == F.col("_first"))
    return materialise(best.select("pair", "count", (F.col("count") == F.col("_most")).alias("best")), "pair_counts")


def align_tokenizers(df: DataFrame, **options) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row for each document."""
    bundles = aligned_bundles(df, **options)
    counts = pair_counts(bundles)
    listed = bundles.filter("pairs IS NOT NULL").select("bundle", F.posexplode_outer("pairs").alias("number", "pair")).filter("pair IS NOT NULL")
    lists = listed.join(counts, "pair").select(F.col("bundle").alias("of_bundle"), "number", "count", "best")
    documents = bundles.filter("links IS NOT NULL").select(*_FIELDS[:8])
    id_type = df.schema[options.get("id_col", "doc_id")].dataType
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType(
        [T.StructField("id", id_type), *[T.StructField(n, T.LongType()) for n in names], T.StructField("groups_sha256", T.StringType())]
    )

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        most = right.num_rows
        count, best = np.zeros(most, np.int64), np.zeros(most, np.int64)
        number = right.column("number").to_numpy()
        count[number] = right.column("count").to_numpy()
        best[number] = right.column("best").to_numpy()
        n_best, sums = [], []
        for packed in left.column("links").to_pylist():
            numbers = _unpacked(packed)
            n_best.append(int(best[numbers].sum()))
            sums.append(int(count[numbers].sum()))
        columns = [left.column("id"), *[left.column(n) for n in names[:4]], pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), left.column("groups_sha256")]
        return pa.Table.from_arrays(columns, ["id", *names, "groups_sha256"])

    return documents.groupBy("bundle").cogroup(lists.groupBy("of_bundle")).applyInArrow(score, schema)

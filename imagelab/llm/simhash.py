"""SimHash near-duplicates within 4 bits, found by Golay-code fuzzy hashing.

Of 4 differing bits at most 2 lie in one of the two 32-bit halves of a fingerprint. Of the three
disjoint 9-bit blocks of that half 2 bits can touch only two, so one block is equal, and the other
23 bits differ in at most 2. The Golay code gives these 23 bits one or six keys such that words
within 2 bits share one (see `golay`). A fingerprint's keys are half, block, block value and
codeword: 32 on average, and every pair within 4 bits meets under one of them. Candidates are
verified on all 64 bits.

Only distinct fingerprints are searched, so copies cost nothing. A key with many fingerprints is
dealt out in pairs of blocks of bounded size, all of them compared. Within a group the links are
reduced to a spanning forest: never all pairs of a group are emitted, and no connection is lost.

Defined results: null text has no words and fingerprint zero, which links like any other; null ids
never name a component unless it has no other; repeated rows are in the same component; an empty
table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.llm import golay
from imagelab.llm.common import address, col, keep_listed, without_rows
from imagelab.llm.components import connected_components
from imagelab.session import materialise, ship_package

SHINGLE = 4
SEED = 42
DISTANCE = 4
GROUP = 2048  # fingerprints of a key above which it is dealt out in blocks
SHORT_RUN = 16
CHUNK = 1 << 15

HALVES, HALF_BITS = 2, 32
BLOCKS, BLOCK_BITS = 3, 9


def fingerprint_of(text: str | None, words_each: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    joined = b" ".join(words)
    width = min(words_each, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK])
        digests = b"".join([xxhash.xxh64_digest(joined[s:e], SEED) for s, e in spans])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts)).view(">i8")[0])


def fingerprint(text: str | Column) -> Column:
    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_py()) for t in texts], pa.int64())

    return simhash(text)


def search_keys(fingerprints: np.ndarray) -> np.ndarray:
    """(n, 36) keys of each fingerprint, -1 where there are fewer."""
    whole = fingerprints.view(np.uint64)
    columns = []
    for half in range(HALVES):
        bits = (whole >> np.uint64(half * HALF_BITS) & np.uint64((1 << HALF_BITS) - 1)).astype(np.int64)
        for block in range(BLOCKS):
            low = block * BLOCK_BITS
            value = bits >> low & (1 << BLOCK_BITS) - 1
            rest = bits & (1 << low) - 1 | bits >> low + BLOCK_BITS << low
            prefix = (half * BLOCKS + block) << BLOCK_BITS | value
            codewords = golay.keys(rest)
            columns.append(np.where(codewords < 0, -1, prefix[:, None] << golay.DATA_BITS | codewords))
    return np.concatenate(columns, axis=1)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fingerprints = batch.column(0).to_numpy()
        keys = search_keys(fingerprints)
        row, column = np.nonzero(keys >= 0)
        yield pa.RecordBatch.from_arrays([pa.array(keys[row, column]), pa.array(fingerprints[row])], ["key", "fp"])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _forest(members: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges of a spanning forest of the links between members: from each node to those it reached first."""
    edges, unseen = [], members
    while len(unseen):
        frontier, unseen = unseen[:1], unseen[1:]
        while len(frontier) and len(unseen):
            node, frontier = frontier[0], frontier[1:]
            near = _distances(unseen, node) <= DISTANCE
            if near.any():
                reached, unseen = unseen[near], unseen[~near]
                edges.append((np.full(len(reached), node), reached))
                frontier = np.concatenate((frontier, reached))
    return edges


def _linked(groups: np.ndarray, fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links inside the groups of rows sorted by group."""
    edges = []
    bounds = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1, append=groups[-1] + 1))
    lengths = np.diff(bounds)
    for start, length in zip(bounds[:-1][lengths > SHORT_RUN], lengths[lengths > SHORT_RUN]):
        edges += _forest(np.unique(fps[start : start + length]))
    short = np.repeat(lengths <= SHORT_RUN, lengths)
    groups, fps = groups[short], fps[short]
    at = np.arange(len(fps))
    for step in range(1, SHORT_RUN):
        at = at[at + step < len(fps)]
        at = at[groups[at] == groups[at + step]]
        near = at[_distances(fps[at], fps[at + step]) <= DISTANCE]
        edges.append((fps[near], fps[near + step]))
    return edges


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted (group, fp) rows; the last group of a batch waits for its rest in the next."""
    groups, fps = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def found(groups: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        edges = _linked(groups, fps) if len(groups) else []
        if edges:
            a, b = (np.concatenate(side) for side in zip(*edges))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    for batch in batches:
        groups = np.concatenate((groups, batch.column(0).to_numpy()))
        fps = np.concatenate((fps, batch.column(1).to_numpy()))
        cut = np.searchsorted(groups, groups[-1]) if len(groups) else 0
        yield from found(groups[:cut], fps[:cut])
        groups, fps = groups[cut:], fps[cut:]
    yield from found(groups, fps)


def links(fingerprints: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b) pairs of distinct fingerprints within the distance; they connect all that are linked.

    `fingerprints` is one bigint column without repeats.
    """
    ship_package(fingerprints.sparkSession)
    keyed = fingerprints.mapInArrow(_keyed, "key bigint, fp bigint")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("many")).filter(F.col("many") > group)
    blocks = F.ceil(F.col("many") / F.lit(group)).cast("int").alias("blocks")
    hot = materialise(sizes.select(F.col("key").alias("_key"), blocks), "hot_keys")
    dealt = keyed.join(hot, F.col("key") == F.col("_key"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    paired = dealt.select("key", "fp", "blocks", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    rows = paired.select(F.when(F.col("blocks") == 1, F.col("key")).otherwise(pair).alias("group"), "fp")
    return rows.repartition("group").sortWithinPartitions("group").mapInArrow(_link, "a bigint, b bigint")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """(id, fingerprint, component_id, keeper, row, kept), one row for each row of `df`.

    `keeper` is the fingerprint of the row that stands for the component, whose id is `component_id`.
    Of the rows with that id and fingerprint the one with the least `row`, which tells rows apart, is kept.
    """
    ship_package(df.sparkSession)
    text = col(text_col).cast("string")
    own = (F.monotonically_increasing_id() if row is None else row).alias("row")
    rows = materialise(df.select(col(id_col).alias("id"), fingerprint(text).alias("fp"), own), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "fp", "row"))
    classes = materialise(rows.groupBy("fp").agg(first.alias("first")), "classes")
    labels = connected_components(links(classes.select("fp")))
    rooted = classes.join(labels, F.col("fp") == F.col("node"), "left")
    rooted = materialise(rooted.select("fp", "first", F.coalesce("label", "fp").alias("root")), "rooted")
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    firsts = materialise(firsts.select(F.col("root").alias("_root"), "first"), "firsts")
    of_class = rooted.drop("first").join(firsts, F.col("root") == F.col("_root"))
    of_class = materialise(of_class.select(F.col("fp").alias("_fp"), "first"), "of_class")
    return rows.join(of_class, F.col("fp") == F.col("_fp")).select(
        "id",
        F.col("fp").alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        F.col("first.fp").alias("keeper"),
        "row",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `df` for each component, with all its columns.

    Rows of files are told apart by their place in them, so fingerprints are computed once and no row
    is shuffled but those near a dropped one; other frames are joined with the list of what stays.
    """
    at = address(df)
    if at is not None:
        near = near_duplicates(df, id_col, text_col, at)
        return without_rows(df, at, materialise(near.filter("NOT kept").select("row"), "dropped"))
    near = near_duplicates(df, id_col, text_col)
    kept = near.select(F.col("component_id").alias("id"), F.col("keeper").alias("fp")).distinct()
    keys = {"id": col(id_col), "fp": fingerprint(col(text_col).cast("string"))}
    return keep_listed(df, keys, kept)

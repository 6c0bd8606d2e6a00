"""Exact top-k inner-product search by MaxScore over sharded postings.

Vectors are term weights: a dimension is a term, and a shard of the table holds one posting column
per term with the smallest and largest weight in it. What a term can add to a query's score is at
most its bound, so a query's terms are split by those bounds: the essential ones, without which no
vector can reach the query's current k-th best score, are scored for the whole shard; the others
are probed in order of falling bound, and only for vectors whose score so far plus all remaining
bounds still competes. The k-th best score carries over from one block of a shard to the next.

Shards and blocks of queries meet on a grid of bounded cells, so no task holds all vectors or all
queries. Every cell returns its best k for each query, and a window with a group limit before its
shuffle merges the shards.

Defined results: vectors that are null, hold null or non-finite components, or have a null id take
no part; missing trailing components count as zero; ties go to the smaller id; rows that repeat an
id are candidates of their own and never answer a query of that id, and as queries share one
answer; scores beyond 64 bits are clipped to that range; an empty table gives no rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from imagelab.llm.common import col
from imagelab.session import materialise, ship_package

TOP = 20
SHARD_ROWS = 16384
QUERY_ROWS = 16384  # of 64 terms are 8 MB; each vector is copied once for as many queries
BLOCK_ROWS = 4096
PROBE = 8  # non-essential terms between two checks of who still competes
EXACT = float(1 << 53)
LIMIT = (1 << 63) - 1


def quantised(vector: str, factor: int = 64):
    """array<double> of floor(factor * component)."""
    return F.transform(col(vector), lambda x: F.floor(x.cast("double") * factor).cast("double"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of the list column, padded with zeros at the end."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(vectors.offsets.to_numpy())
    width = int(lengths.max(initial=0))
    if len(flat) == len(lengths) * width:
        return flat.reshape(len(lengths), width)
    rows = np.zeros((len(lengths), width))
    rows[np.arange(width) < lengths[:, None]] = flat
    return rows


def _exactly(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in doubles if every sum of products is exact in them, else in Python integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if width == 0 or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * width < EXACT:
        return a, b
    whole = np.vectorize(int, otypes=[object])
    return whole(a), whole(b)


def max_score(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, top: int, block: int = BLOCK_ROWS
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query position, ids, scores) of each query's best `top` vectors, in no order."""
    queries, vectors = _exactly(queries, vectors)
    best = [(np.zeros(0, np.int64), np.zeros(0, queries.dtype)) for _ in query_ids]
    for start in range(0, len(ids), block):
        own = ids[start : start + block]
        postings = np.ascontiguousarray(vectors[start : start + block].T)
        lowest, highest = postings.min(axis=1, initial=0), postings.max(axis=1, initial=0)
        for at, query in enumerate(queries):
            held_ids, held = best[at]
            bounds = np.maximum(query * lowest, query * highest)
            order = np.argsort(-bounds, kind="stable")
            least = held.min() if len(held) >= top else None
            # rest[i]: what the terms from the i-th on can add together at most
            rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
            essential = len(order) if least is None else int(np.count_nonzero(rest[:-1] >= least))
            if least is not None and essential == 0:
                continue  # nothing here can reach the k-th best score
            terms = order[:essential]
            scores = query[terms] @ postings[terms] if essential else np.zeros(len(own), query.dtype)
            alive = np.arange(len(own))
            for low in range(essential, len(order) + 1, PROBE):
                if least is not None:
                    competes = scores + rest[low] >= least
                    alive, scores = alive[competes], scores[competes]
                terms = order[low : low + PROBE]
                if len(terms) and len(alive):
                    scores = scores + query[terms] @ postings[np.ix_(terms, alive)]
            if least is not None:
                competes = scores >= least
                alive, scores = alive[competes], scores[competes]
            other = own[alive] != query_ids[at]
            best[at] = _best(
                np.concatenate((held_ids, own[alive][other])), np.concatenate((held, scores[other])), top
            )
    for at, (found, scores) in enumerate(best):
        yield at, found, scores


def _best(ids: np.ndarray, scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    if len(ids) > top:
        if scores.dtype != object:  # all that reach the k-th best score, ties included
            reach = scores >= np.partition(scores, len(scores) - top)[len(scores) - top]
            ids, scores = ids[reach], scores[reach]
        keep = np.lexsort((ids, -scores))[:top] if scores.dtype != object else sorted(
            range(len(ids)), key=lambda i: (-scores[i], ids[i])
        )[:top]
        ids, scores = ids[keep], scores[keep]
    return ids, scores


def _dealt(vectors: DataFrame, shards: int, blocks: int) -> DataFrame:
    """(id, vector, shard, block): by the written row number, so that rows of one id spread too."""
    number = F.xxhash64("row")
    shard, block = F.pmod(number, F.lit(shards)), F.pmod(F.shiftright(number, 20), F.lit(blocks))
    return vectors.select("id", "vector", shard.cast("int").alias("shard"), block.cast("int").alias("block"))


def top_k(
    df: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    top: int = TOP,
    factor: int = 64,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """(query_id, rank, id, score) of the best `top` rows for every row under the condition `is_query`.

    `is_query` is a condition on a column named `id`.
    """
    ship_package(df.sparkSession)
    usable = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vectors = df.select(col(id_col).cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    vectors = vectors.filter(F.col("id").isNotNull() & F.coalesce(usable, F.lit(False)))
    vectors = vectors.select("id", quantised("vector", factor).alias("vector"), F.monotonically_increasing_id().alias("row"))
    vectors = materialise(vectors, "vectors")
    counts = vectors.agg(F.count("*"), F.count(F.when(is_query, 1))).first()
    shards, blocks = -(-counts[0] // shard_rows) or 1, -(-counts[1] // query_rows) or 1
    # small tables: more and smaller shards, so that every core has a cell
    shards = max(shards, min(-(-counts[0] // 512) or 1, -(-2 * df.sparkSession.sparkContext.defaultParallelism // blocks)))
    placed = _dealt(vectors, shards, blocks)
    all_blocks = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    all_shards = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    candidates = placed.select("id", "vector", "shard").withColumn("block", all_blocks)
    asked = placed.filter(is_query).select("id", "vector", "block").withColumn("shard", all_shards)

    def cell(questions: pa.Table, rows: pa.Table) -> pa.Table:
        out = {"query_id": [], "id": [], "score": []}
        if len(questions) and len(rows):
            query_ids = questions["id"].to_numpy()
            found = max_score(
                _matrix(questions["vector"].combine_chunks()), query_ids,
                _matrix(rows["vector"].combine_chunks()), rows["id"].to_numpy(), top,
            )
            for at, ids, scores in found:
                out["query_id"] += [query_ids[at]] * len(ids)
                out["id"] += ids.tolist()
                out["score"] += [max(-LIMIT - 1, min(LIMIT, int(x))) for x in scores]
        return pa.table({k: pa.array(v, pa.int64()) for k, v in out.items()})

    grid = ["shard", "block"]
    partial = asked.groupBy(*grid).cogroup(candidates.groupBy(*grid)).applyInArrow(
        cell, "query_id bigint, id bigint, score bigint"
    )
    best_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = partial.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "id", "score")

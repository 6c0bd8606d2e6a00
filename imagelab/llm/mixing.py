"""Mixing sources to target weights by weighted fair queueing.

Every source gets a target number of words. Its documents are shuffled by a seeded hash and served
in that order, up to `most` times; a document's virtual finish time is its source's words so far
divided by the source's target. All services are range-sorted by that time, with running totals of
their words. All sources being served at once, words in proportion to the targets have been served at
any virtual time, and the whole budget at time 1: the queue is truncated behind the last service that
is finished by then. What the budget leaves there goes to the documents next in line, one of each
source, which are cut, so each source ends within one word of its target.

No task sees a whole source: documents fall into about sqrt(rows) hash buckets of each source, the
buckets are summed up and put in line (one narrow row each), and running totals are taken inside
a bucket only.

Defined results: null text has size 0; null sources are one source, the last; a null id is
shuffled like an empty one; repeated rows are documents of their own; with no words at all every
target is 0; an empty table gives no rows.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from imagelab.llm.common import WORD, col, fresh
from imagelab.operators.indexing import with_global_index, with_running_total
from imagelab.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # budget as a multiple of all words
MOST = 2  # times that a document may be taken


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target): the budget shared by weight, no target over `most` times the source.

    Sources are numbered in code point order with null last, and take the weights in turn. What a
    full source cannot take is shared again by weight among the others until none is above; each
    round is one aggregate over the sources table that returns four numbers.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = with_global_index(totals, [F.col("source").asc_nulls_last()])
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weight = F.element_at(cycle, (F.pmod(F.col("idx") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = materialise(numbered.select("source", "source_size", weight.alias("weight")), "sources")
    cap = F.col("source_size") * most
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, full = -1.0, F.lit(False)
    free, spread = budget, 1
    while True:
        found = sources.agg(
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weights"),
        ).first()
        if not found["weights"]:
            break
        free, spread = budget - found["taken"], found["weights"]
        if free / spread <= level:
            break
        level = free / spread
        full = cap < level * F.col("weight")
    target = F.when(full, cap.cast("double")).otherwise(F.lit(free) * F.col("weight") / F.lit(spread))
    return sources.select("source", "source_size", target.alias("target"))


def _in_line(sizes: DataFrame, seed: str) -> DataFrame:
    """Add `before`: the words of the source's documents that come earlier in its shuffled order."""
    buckets = max(1, math.ceil(math.sqrt(sizes.count())))
    order = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    at = F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(1 << 32))
    placed = sizes.withColumn("order", order).withColumn("bucket", at)
    earlier = Window.partitionBy("source", "bucket").orderBy("order", "id", "row")
    inside = F.sum("size").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    line = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("_source"),
        F.col("bucket").alias("_bucket"),
        F.coalesce(F.sum("words").over(line), F.lit(0)).alias("start"),
    )
    joined = placed.withColumn("inside", inside).join(
        starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))
    )
    return joined.withColumn("before", F.col("start") + F.col("inside")).drop(
        "_source", "_bucket", "start", "inside", "bucket", "order"
    )


def fair_queue(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights=WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = "",
) -> DataFrame:
    """(id, row, print, size, source_size, target, turn, finish, served, taken), a row for each document and turn.

    `served` is the running total of words in order of virtual finish time. `taken` words of the
    document belong to the mix in this turn: all, the part before the end of the budget, or none.
    """
    sizes = materialise(
        df.select(
            col(id_col).alias("id"),
            col(source_col).alias("source"),
            word_count(col(text_col)).alias("size"),
            F.xxhash64(col(text_col)).alias("print"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    targets = source_targets(sizes, weights, share, most).withColumnRenamed("source", "_source")
    lined = _in_line(sizes, seed).join(targets, F.col("source").eqNullSafe(F.col("_source")))
    turns = lined.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    start = F.col("before") + F.col("turn") * F.col("source_size")
    finish = F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target")).otherwise(F.lit(0.0))
    queue = turns.select("id", "row", "print", "source", "size", "source_size", "target", "turn", finish.alias("finish"))
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("row"), F.col("turn")]
    return truncated(materialise(with_running_total(queue, order, "size", "served"), "queue"))


def truncated(queue: DataFrame) -> DataFrame:
    """Add `taken` to a written queue with running totals `served`, cut at the end of the budget."""
    cut = queue.filter("finish <= 1.0").agg(F.max("served")).first()[0] or 0
    before = F.col("served") <= cut
    left = queue.groupBy(F.col("source").alias("_source")).agg(
        F.coalesce(F.sum(F.when(before, F.col("size"))), F.lit(0)).alias("_done"),
        F.min(F.when(~before & (F.col("size") > 0), F.struct("served", "row", "turn"))).alias("_next"),
    )
    joined = queue.join(materialise(left, "in_service"), F.col("source").eqNullSafe(F.col("_source")))
    in_service = (F.col("row") == F.col("_next.row")) & (F.col("turn") == F.col("_next.turn"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.floor("target") - F.col("_done")))
    taken = F.when(before, F.col("size")).when(in_service, part).otherwise(0).cast("long")
    return joined.withColumn("taken", taken).drop("source", "_source", "_done", "_next")


def mixed_sizes(df: DataFrame, **options) -> DataFrame:
    """(id, row, size, source_size, target, taken), one row for each row of `df`, taken or not."""
    queue = fair_queue(df, **options)
    return queue.groupBy("row").agg(
        *[F.first(c).alias(c) for c in ("id", "size", "source_size", "target")], F.sum("taken").alias("taken")
    )


def mix_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = MOST, **options) -> DataFrame:
    """The mixed documents themselves: a row as often as the mix takes it, the last time when at least half is taken.

    Documents without words cost nothing and stay once. Of rows that repeat an id and a text, the
    takes are added up and each of them returns as often as their mean says.
    """
    queue = fair_queue(df, id_col=id_col, text_col=text_col, most=most, **options)
    # each row of a document is in the queue `most` times
    taken = queue.groupBy("id", "print", "size").agg((F.sum("taken") * most / F.count("*")).alias("words"))
    times = F.when(F.col("size") == 0, 1).otherwise(F.round(F.col("words") / F.col("size"))).cast("int")
    key, key_print, repeats, n, own = (fresh(df, name) for name in ("_key", "_key_print", "_repeats", "_n", "_print"))
    wanted = taken.select(F.col("id").alias(key), F.col("print").alias(key_print), times.alias(repeats))
    keyed = df.withColumn(own, F.xxhash64(col(text_col)))
    on = col(id_col).eqNullSafe(col(key)) & (col(own) == col(key_print))
    joined = keyed.join(wanted.filter(col(repeats) > 0).hint("shuffle_hash"), on)
    repeated = joined.withColumn(n, F.explode(F.sequence(F.lit(1), col(repeats))))
    return repeated.select(*[col(c) for c in df.columns])

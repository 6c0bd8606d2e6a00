"""Repair of the turn structure of conversations by weighted interval (CYK) parsing.

A conversation is well formed when the initials of its roles read (s?(ua)+)?. Its rows are repaired by
edits: Keep costs 0, Rerole to user or assistant 2, Delete 3 (the only edit of a blank or repeated
row), Insert of an empty user or assistant turn 2, and a truncated row that is not deleted 1 more.
The repair grammar is in Chomsky normal form. Its non-terminals are pairs of places in the role
grammar: X[p,q] derives every edited span that leads from p to q, by X[p,q] -> X[p,r] X[r,q] over two
shorter spans or by one edited row. A cell of the chart holds, for each non-terminal, the least
(cost, audit) of its span, where the audit is the initials of the edits; insertions, which cover no
row, are closed over on both sides of every row. Two audits of one span and cost never begin with
one another, so the least audit of a whole is made of least parts.

Rows are numbered by one distributed sort and cut into blocks of `BLOCK` rows. Inside a block the chart
is filled for all spans by increasing length, over all their splits. Above, cells of neighbouring
blocks are combined `FAN` at a time, again bottom-up; any split of a span gives the same cell here,
as both halves keep all places, so one is enough and work stays linear in the length of a conversation.
A task sees codes of two characters a row, never the texts of a conversation at once. Repaired turns
are made in one pass over the texts, sorted by conversation, behind the row with its audit; this
pass holds one batch. Only there a conversation is one task's work, as its turns follow each other.

Defined results: a null role or text is one space; null conversations are one conversation; null turns
come first; rows of equal turn go by role and then digest of the text; of rows that repeat role and
text the first one stays; a role whose initial is none of s, u, a must be reroled or deleted; texts are
kept whole; no rows give no conversations.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.llm.common import col
from imagelab.operators.indexing import with_global_index
from imagelab.session import materialise, ship_package

BLOCK = 16  # rows of a chart
FAN = 64  # blocks combined in one go

# places in the role grammar: at the start, after the system turn, after a user turn, after an answer
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
PLACES, START, ENDS = range(4), 0, (0, 3)
MADE = {"u": "user", "a": "assistant"}  # the roles that edits give
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1  # costs
LEGAL = {"su", "ua", "au"}

Cell = dict[tuple[int, int], tuple[int, str]]
CELL_TYPE = "array<struct<p:int,q:int,cost:bigint,audit:string>>"
SPAN_TYPE = f"struct<cells:{CELL_TYPE},first:string,last:string,illegal:bigint>"


def _least(options: Iterable[tuple[tuple[int, int], tuple[int, str]]]) -> Cell:
    cell: Cell = {}
    for symbol, value in options:
        if symbol not in cell or value < cell[symbol]:
            cell[symbol] = value
    return cell


def _binary(left: Cell, right: Cell) -> Iterator[tuple[tuple[int, int], tuple[int, str]]]:
    """What X[p,q] -> X[p,r] X[r,q] derives from two neighbouring cells."""
    for (p, r), (cost, audit) in left.items():
        for q in PLACES:
            if (r, q) in right:
                more, rest = right[r, q]
                yield (p, q), (cost + more, audit + rest)


def _insertions() -> Cell:
    """The cell of an empty span: nothing, or the least insertions that lead from p to q."""
    once = {(p, q): (INSERT, "I") for (p, initial), q in STEPS.items() if initial in MADE}
    closed: Cell = {(p, p): (0, "") for p in PLACES}
    for _ in PLACES:
        closed = _least([*closed.items(), *_binary(closed, once)])
    return closed


EMPTY = _insertions()


@lru_cache(maxsize=64)
def row_cell(code: str) -> Cell:
    """The cell of one row; its code is the initial and the fault (b and d must go, t is truncated)."""
    initial, fault = code
    options = [((p, p), (DELETE, "D")) for p in PLACES]
    if fault not in "bd":
        extra = TRUNCATED if fault == "t" else 0
        options += [((p, q), (extra, "K")) for (p, c), q in STEPS.items() if c == initial]
        options += [((p, q), (REROLE + extra, "R")) for (p, c), q in STEPS.items() if c in MADE]
    return _least(_binary(_least(_binary(EMPTY, _least(options))), EMPTY))


@lru_cache(maxsize=4096)
def block_cell(codes: str) -> Cell:
    """The cell of a whole block, from the cells of all its spans by increasing length."""
    rows = len(codes) // 2
    chart = {(at, 1): row_cell(codes[2 * at : 2 * at + 2]) for at in range(rows)}
    for length in range(2, rows + 1):
        for at in range(rows - length + 1):
            splits = ((chart[at, left], chart[at + left, length - left]) for left in range(1, length))
            chart[at, length] = _least(found for pair in splits for found in _binary(*pair))
    return chart[0, rows]


def _block_span(codes: str) -> dict:
    initials = codes[::2]
    return {
        "cells": [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in block_cell(codes).items()],
        "first": initials[0],
        "last": initials[-1],
        "illegal": sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1)),
    }


def _joined_span(spans: list[dict]) -> dict:
    cells = [{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in s["cells"]} for s in spans]
    while len(cells) > 1:  # neighbours first, so that an audit is copied once a level
        pairs = [cells[i : i + 2] for i in range(0, len(cells), 2)]
        cells = [_least(_binary(*pair)) if len(pair) == 2 else pair[0] for pair in pairs]
    seams = sum(a["last"] + b["first"] not in LEGAL for a, b in zip(spans, spans[1:]))
    return {
        "cells": [{"p": p, "q": q, "cost": c, "audit": a} for (p, q), (c, a) in cells[0].items()],
        "first": spans[0]["first"],
        "last": spans[-1]["last"],
        "illegal": seams + sum(s["illegal"] for s in spans),
    }


_ARROW_CELL = pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_ARROW_SPAN = pa.struct(
    [("cells", pa.list_(_ARROW_CELL)), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64())]
)


def _in_arrow(function: Callable, values: str) -> Column:
    """`function` on every value of a column, to a span."""

    @F.arrow_udf(SPAN_TYPE)
    def spans(column: pa.Array) -> pa.Array:
        return pa.array([function(value) for value in column.to_pylist()], _ARROW_SPAN)

    return spans(values)


def _or_space(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(" "))


def _order() -> list[Column]:
    """The order of rows inside a conversation."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    texts = df.select(
        col(conv_col).alias("conv"), col(turn_col).alias("turn"), _or_space(role_col).alias("role"), _or_space(text_col).alias("text")
    )
    return texts.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _faults(turns: DataFrame) -> DataFrame:
    """(conv, turn, at, code): every row without its text, numbered in order, with its first fault."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*+\z", 1)
    own = F.when(last == "", "b").when(~last.isin(".", "!", "?"), "t").otherwise("-")
    narrow = turns.select("conv", "turn", "role", "digest", own.alias("own"))
    rows = with_global_index(narrow, [F.col("conv").asc_nulls_first(), *_order()], "at")
    rows = materialise(rows, "turns")
    copies = rows.groupBy("conv", "role", "digest").agg(F.min("at").alias("first"), F.count("*").alias("many"))
    copies = copies.filter("many > 1").select(F.col("conv").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "first")
    same_row = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    fault = F.when(F.col("own") == "b", "b").when(F.col("first") < F.col("at"), "d").otherwise(F.col("own"))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    return rows.join(copies, same_row, "left").select("conv", "turn", "at", F.concat(known, fault).alias("code"))


def _spans(rows: DataFrame) -> DataFrame:
    """(conv, span): the parsed cell of every whole conversation."""
    block = F.floor(F.col("at") / BLOCK)
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "code"))), lambda r: r["code"])
    blocks = rows.groupBy("conv", block.alias("block")).agg(F.array_join(in_order, "").alias("codes"))
    spans = materialise(blocks.select("conv", "block", _in_arrow(_block_span, "codes").alias("span")), "blocks")

    def joined(*keys: Column) -> DataFrame:
        sorted_spans = F.transform(F.array_sort(F.collect_list(F.struct("block", "span"))), lambda r: r["span"])
        groups = spans.groupBy("conv", *keys).agg(sorted_spans.alias("spans"))
        return groups.withColumn("span", _in_arrow(_joined_span, "spans")).drop("spans")

    while (spans.groupBy("conv").count().agg(F.max("count")).first()[0] or 0) > FAN:
        spans = materialise(joined(F.floor(F.col("block") / FAN).alias("block")), "blocks")
    return joined()


def repair_plans(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit), one row for each conversation."""
    ship_package(df.sparkSession)
    rows = materialise(_faults(_turns(df, conv_col, turn_col, role_col, text_col)), "faults")

    def faults(code: str) -> Column:
        return F.sum(F.col("code").endswith(code).cast("long"))

    by_turn = rows.groupBy("conv", "turn").agg(faults("b").alias("blank"), faults("d").alias("duplicate"), faults("t").alias("truncated"))
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")  # one row for each turn here
    counts = by_turn.groupBy(F.col("conv").alias("_conv")).agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    whole = F.filter("span.cells", lambda c: (c["p"] == START) & c["q"].isin(*ENDS))
    best = F.array_min(F.transform(whole, lambda c: F.struct(c["cost"].alias("cost"), c["audit"].alias("audit"))))
    parsed = _spans(rows).select("conv", F.col("span.illegal").alias("illegal"), best.alias("best"))
    plans = parsed.join(counts, F.col("conv").eqNullSafe(F.col("_conv")))
    return plans.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "best.cost", "best.audit")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repaired turns of rows that come sorted, each conversation behind the row with its audit."""
    at = place = odd = 0
    audit, conv = "", None

    def made() -> str:
        return MADE["ua"[(place - odd) % 2]]

    for batch in batches:
        owners, places, turns, roles, texts, edits = [], [], [], [], [], []

        def put(row: dict, turn: int | None, role: str, text: str, edit: str) -> None:
            for values, value in zip((owners, places, turns, roles, texts, edits), (row["conv"], place, turn, role, text, edit)):
                values.append(value)

        def insert(row: dict) -> None:
            nonlocal at, place
            while audit[at : at + 1] == "I":
                put(row, None, made(), "", "I")
                at, place = at + 1, place + 1

        for row in batch.to_pylist():
            if row["audit"] is not None:
                audit, at, place, odd = row["audit"], 0, 0, (len(row["audit"]) - row["audit"].count("D")) % 2
            else:
                edit, at = audit[at], at + 1
                if edit != "D":
                    put(row, row["turn"], row["role"] if edit == "K" else made(), row["text"], edit)
                    place += 1
            insert(row)
        columns = [pa.array(owners, batch.column("conv").type), pa.array(places, pa.int64()), pa.array(turns, batch.column("turn").type)]
        columns += [pa.array(values, pa.string()) for values in (roles, texts, edits)]
        yield pa.RecordBatch.from_arrays(columns, ["conv", "position", "turn", "role", "text", "edit"])


def repaired_turns(
    df: DataFrame, plans: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, position, turn, role, text, edit): the turns of every repaired conversation.

    `plans` is the result of `repair_plans` over the same rows. Turns come sorted by conversation and
    position inside each partition, all of a conversation in one; inserted turns have no turn number.
    """
    ship_package(df.sparkSession)
    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    heads = plans.select("conv", "audit")
    rows = turns.unionByName(heads, allowMissingColumns=True)
    dealt = rows.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), F.col("audit").asc_nulls_last(), *_order())
    kinds = dict(turns.dtypes)
    schema = f"conv {kinds['conv']}, position bigint, turn {kinds['turn']}, role string, text string, edit string"
    return dealt.select("conv", "turn", "role", "text", "audit").mapInArrow(_edited, schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    owner, sha, kind = None, None, pa.null()
    for batch in batches:
        done, digests, kind = [], [], batch.column("conv").type
        for row in batch.to_pylist():
            line = f"{row['role']}:{row['text']}".encode()
            if row["position"]:
                sha.update(b"\n" + line)
                continue
            if sha:
                done.append(owner)
                digests.append(sha.hexdigest())
            owner, sha = row["conv"], hashlib.sha256(line)
        yield pa.RecordBatch.from_arrays([pa.array(done, kind), pa.array(digests, pa.string())], ["conv", "sha256"])
    if sha:
        yield pa.RecordBatch.from_arrays([pa.array([owner], kind), pa.array([sha.hexdigest()])], ["conv", "sha256"])


def turn_digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256): hex digest of `role:text` lines of every conversation that `repaired_turns` gave turns.

    Reads its input in the order of its partitions, so it must be that very frame.
    """
    kind = dict(repaired.dtypes)["conv"]
    return repaired.select("conv", "position", "role", "text").mapInArrow(_hashed, f"conv {kind}, sha256 string")


def damaged(df: DataFrame) -> DataFrame:
    """`conversations` with the faults of the registered query, chosen by a checksum of each row's place."""
    place = F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn"))
    fault = F.pmod(F.crc32(F.encode(place, "UTF-8")), F.lit(20))
    role, text = _or_space("role"), _or_space("text")
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    rows = df.filter(fault != 0).select("conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), text.alias("text"), copies)
    return rows.drop("col")


def repair_damaged(df: DataFrame) -> DataFrame:
    """One row for each conversation of `df`: what its damaged rows lack, the cheapest repair and its digest."""
    ship_package(df.sparkSession)
    broken = damaged(df)
    plans = materialise(repair_plans(broken).withColumnRenamed("conv", "_conv"), "plans")
    digests = turn_digests(repaired_turns(broken, plans.withColumnRenamed("_conv", "conv")))
    every = df.select("conv_id").distinct()
    found = every.join(plans, every["conv_id"].eqNullSafe(plans["_conv"]), "left")
    found = found.join(digests, found["conv_id"].eqNullSafe(digests["conv"]), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256().hexdigest()
    return found.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(empty)).alias("repaired_sha256")
    )

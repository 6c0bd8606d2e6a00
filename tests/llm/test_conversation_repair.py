import hashlib
import itertools
import random
import re
import zlib

import pytest

from imagelab.llm import conversation_repair as repair
from imagelab.llm.queries import QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WELL_FORMED = re.compile(r"(s?(ua)+)?")


def faults_of(rows):
    """First fault of each row of a conversation that is in order."""
    seen, found = set(), []
    for _, role, text in rows:
        if not re.search(r"[^\x20\x09-\x0D]", text):
            fault = "b"
        elif (role, text) in seen:
            fault = "d"
        else:
            fault = "-" if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "t"
        seen.add((role, text))
        found.append(fault)
    return found


def cheapest(rows, most_inserts=2):
    """(cost, audit, repaired text) by trying every edit of every row and every number of insertions between."""
    options = []
    for (_, role, text), fault in zip(rows, faults_of(rows)):
        late = fault == "t"
        edits = [(3, "D", None)]
        if fault not in "bd":
            edits += [(late, "K", (role, text)), (2 + late, "R", ("user", text)), (2 + late, "R", ("assistant", text))]
        options.append(edits)
    added = [[(2, "I", (r, "")) for r in roles] for n in range(most_inserts + 1) for roles in itertools.product(["user", "assistant"], repeat=n)]
    gaps = [added] * (len(rows) + 1)
    best = None
    for edits in itertools.product(*options):
        for between in itertools.product(*gaps):
            chain = [*between[0]]
            for edit, more in zip(edits, between[1:]):
                chain += [edit, *more]
            turns = [turn for _, _, turn in chain if turn]
            if WELL_FORMED.fullmatch("".join(role[:1] if role else "?" for role, _ in turns)):
                found = (sum(c for c, _, _ in chain), "".join(e for _, e, _ in chain), "\n".join(f"{r}:{t}" for r, t in turns))
                best = min(best or found, found)
    return best


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def expected(rows, most_inserts=1):
    conversations = {conv: [] for conv, *_ in rows}
    for conv, turn, role, text in damage(rows):
        conversations[conv].append((turn, role, text))
    out = []
    for conv, turns in conversations.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        numbers = {t for t, _, _ in turns if t is not None}
        faults = faults_of(turns)
        initials = [role[:1] for _, role, _ in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, text = cheapest(turns, most_inserts)
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        counts = [faults.count(f) for f in "bdt"]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def query(spark, tmp_path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in QUERIES["op11_cyk_repair"](spark, str(tmp_path)).collect()), key=str)


def cell_of(codes):
    spans = [repair._block_span(codes[i : i + 2 * repair.BLOCK]) for i in range(0, len(codes), 2 * repair.BLOCK)]
    whole = repair._joined_span(spans)
    return min((c["cost"], c["audit"]) for c in whole["cells"] if c["p"] == 0 and c["q"] in repair.ENDS), whole["illegal"]


@pytest.mark.parametrize("block", [1, 2, 16])
def test_chart_equals_all_edits(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    roles = ["system", "user", "assistant", "tool", " "]
    pick = random.Random(block)
    for _ in range(40):
        rows = [(0, pick.choice(roles), pick.choice(["", "Yes.", "No", f"w{i}."])) for i in range(pick.randint(1, 4))]
        codes = "".join((r[0] if r[0] in "sua" else "x") + f for (_, r, _), f in zip(rows, faults_of(rows)))
        (cost, audit), _ = cell_of(codes)
        assert (cost, audit) == cheapest(rows, 2 if len(rows) < 3 else 1)[:2]


def test_edge_rows(spark, tmp_path):
    rows = [
        (1, 0, "user", "Hello."), (1, 1, "assistant", "Fine."), (1, 1, "assistant", "Fine."), (1, None, "system", "Be kind."),
        (2, 5, "user", "One two"), (2, 9, "user", "  \n"), (2, 9, "assistant", "x?"),
        (3, None, None, None), (3, None, "user", "a.") , (None, 1, "user", "No id!"), (None, None, "assistant", "None."),
        (4, 3, "", "no role."), (4, 4, "usher", "odd role."), (5, 0, "assistant", "long " * 50_000 + ". \n"), (6, 0, "Ünal", "ü"),
        (7, -3, "user", "a\nb."), (7, 4, "assistant", "tie."), (7, 4, "assistant", "eit."), (7, 4, "user", "tie."),
    ]
    rows += [(100 + i, 0, "user", f"alone {i}.") for i in range(40)]  # some lose their only row
    assert query(spark, tmp_path, rows) == expected(rows)


def test_random_conversations(spark, tmp_path):
    pick = random.Random(5)
    roles = ["system", "user", "assistant", "assistant", "user", "tool", None]
    texts = ["Yes.", "No", "", " \t", "Why?", "Go!  \n", None]
    rows = [
        (conv, pick.choice([None, turn, turn, turn + 1]), pick.choice(roles), pick.choice(texts))
        for conv in range(60) for turn in range(pick.randint(1, 4))
    ]
    assert query(spark, tmp_path, rows) == expected(rows)


def test_blocks_of_long_conversations(spark, monkeypatch):
    """Several levels of blocks against one chart step after the other; turns come back in order."""
    monkeypatch.setattr(repair, "FAN", 3)
    pick = random.Random(1)
    rows = [(c, t, pick.choice(["user", "assistant", "tool"]), f"w {pick.randint(0, 300)}{pick.choice('.?x')}") for c in (1, 2) for t in range(900)]
    rows += [(3, t, ["user", "assistant"][t % 2], f"fine {t}.") for t in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    plans = repair.repair_plans(df)
    found = {r["conv"]: r for r in plans.collect()}
    for conv in (1, 2, 3):
        turns = [(t, role, text) for c, t, role, text in rows if c == conv]
        cell = repair.EMPTY
        for (_, role, _), fault in zip(turns, faults_of(turns)):
            cell = repair._least(repair._binary(cell, repair.row_cell((role[0] if role[0] in "sua" else "x") + fault)))
        assert (found[conv]["cost"], found[conv]["audit"]) == min(cell[0, q] for q in repair.ENDS)
        initials = [role[0] for _, role, _ in turns]
        assert found[conv]["illegal"] == sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    assert found[3]["audit"] == "K" * 40
    turns = repair.repaired_turns(df, plans).collect()
    for conv in (1, 2, 3):
        mine = sorted((r for r in turns if r["conv"] == conv), key=lambda r: r["position"])
        assert [r["position"] for r in mine] == list(range(len(mine)))
        assert WELL_FORMED.fullmatch("".join(r["role"][0] for r in mine))
        assert "".join(r["edit"] for r in mine) == found[conv]["audit"].replace("D", "")


def test_empty_table_and_clashing_columns(spark, tmp_path):
    assert query(spark, tmp_path, []) == []
    rows = [(1, 1, "user", "a.", "x", 1, "y"), (1, 2, "assistant", "b.", "x", 2, "y")]
    names = SCHEMA + ", audit string, at int, Digest string"
    got = query(spark, tmp_path / "more", rows, names)
    assert got == expected([r[:4] for r in rows])


def test_query_against_brute_force_of_small_conversations(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r) for r in QUERIES["op11_cyk_repair"](spark, sf_dir).collect()}
    assert set(got) == {r[0] for r in rows}
    small = [c for c in got if sum(r[0] == c for r in damage(rows)) <= 3]
    for want in expected([r for r in rows if r[0] in small]):
        assert got[want[0]] == want

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from imagelab.llm import token_alignment
from imagelab.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"
ODD = [
    None, "", " ", "  two  spaces ", "a\tb\r\n\n c", "plain words, and more.", "naïve café ÀÉ", "да нет", "中文 和 \U0001f600\U0001f468‍\U0001f469",
    "<|endoftext|> </s> <s>[INST]", "a▁b", "▁", "a\x00b", "ﬁ x ½", "x" * 3000, "tie", "tie", "﻿bom", "line\x85sep ",
]


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_decoder():
    """The public table of byte-level entries, as a dictionary."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in keep}
    for number, b in enumerate(b for b in range(256) if b not in keep):
        table[chr(256 + number)] = b
    return table


def tokens(sides, text):
    """[(id, start, end)] of both sides, or two empty lists."""
    a, b = sides
    if not text:
        return [], []
    whole, table = (" " + text).encode(), byte_decoder()
    entries = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    pieces = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        is_byte = len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">")
        pieces.append((i, bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()))
    out = []
    for side in (entries, pieces):
        if b"".join(x for _, x in side) != whole:
            return [], []
        at, ranges = 0, []
        for i, x in side:
            ranges.append((i, at, at + len(x)))
            at += len(x)
        out.append(ranges)
    return out


def expected(sides, rows):
    documents, counts = [], Counter()
    for doc, text in rows:
        a, b = tokens(sides, text)
        links = [(x, y) for x, s, e in a for y, s2, e2 in b if s < e2 and s2 < e]
        counts.update(set(links))
        documents.append((doc, a, b, links))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc, a, b, links in documents:
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in cuts:
            sides_of = (",".join(str(i) for i, s, e in side if low < e <= high) for side in (a, b))
            groups.append("|".join(sides_of))
            low = high
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(counts[p] == highest[p[0]] for p in links)
        out.append((doc, len(a), len(b), len(groups), len(links), best, sum(counts[p] for p in links), digest))
    return sorted(out, key=str)


def query(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    found = QUERIES["op12_shared_cuts"](spark, str(path))
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_edge_rows(spark, tmp_path, sides):
    rows = [*enumerate(ODD), (None, "no id"), (3, "  two  spaces "), (3, "other text of the id")]
    assert query(spark, tmp_path, rows) == expected(sides, rows)


@pytest.mark.parametrize("bundle", [1, 300, 1 << 21])
def test_bundles_do_not_matter(spark, tmp_path, sides, monkeypatch, bundle):
    monkeypatch.setattr(token_alignment, "BUNDLE", bundle)
    monkeypatch.setattr(token_alignment, "CHUNK", 400)
    pick = random.Random(bundle)
    words = ["the", "tokenizer", "über", "straße", "\n", "quaternion", "1234567", "...", "été", "Xyzzy"]
    rows = [(i, " ".join(pick.choices(words, k=pick.randint(0, 40)))) for i in range(60)]
    assert query(spark, tmp_path, rows) == expected(sides, rows)


def test_empty_table_and_clashing_columns(spark, tmp_path, sides):
    assert query(spark, tmp_path / "none", []) == []
    rows = [(1, "some words", 1, "x"), (2, "more words", 2, "y")]
    got = query(spark, tmp_path / "more", rows, SCHEMA + ", bundle int, Pairs string")
    assert got == expected(sides, [r[:2] for r in rows])


def test_query_on_given_documents(spark, sides):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op12_shared_cuts"](spark, sf_dir).collect()), key=str)
    few = sorted(rows, key=lambda r: len(r[1] or ""))  # the brute force compares all tokens of a document
    assert len(got) == len(rows)
    assert {r[0]: r[1:4] + r[7:] for r in got} == {r[0]: r[1:4] + r[7:] for r in expected_without_links(sides, few)}


def expected_without_links(sides, rows):
    for doc, text in rows:
        a, b = tokens(sides, text)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        at_a, at_b, groups = 0, 0, []
        for high in cuts:
            pair = []
            for side, at in ((a, at_a), (b, at_b)):
                end = at
                while side[end][2] < high:
                    end += 1
                pair.append(side[at : end + 1])
            at_a, at_b = at_a + len(pair[0]), at_b + len(pair[1])
            groups.append("|".join(",".join(str(t[0]) for t in part) for part in pair))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        yield (doc, len(a), len(b), len(groups), None, None, None, digest)


@pytest.mark.parametrize("seed", range(30))
def test_cuts_equal_common_ends(seed):
    pick, a, b, first, last, base = random.Random(seed), [], [], [], [], 0
    for _ in range(pick.randint(1, 6)):
        n, dense_a, dense_b = pick.randint(1, 300), pick.random(), pick.random()
        first.append(len(a))
        a += [*(base + x for x in range(1, n) if pick.random() < dense_a), base + n]
        b += [*(base + x for x in range(1, n) if pick.random() < dense_b), base + n]
        last.append(len(a) - 1)
        base += n
    cut = token_alignment.shared_cuts(*map(np.array, (a, b, first, last)))
    assert (cut == np.isin(a, b)).all()


def test_cuts_of_a_long_interval_take_few_steps(monkeypatch):
    """A common end far from the middle, and none at all, among 200,000 tokens."""
    steps, search = [], np.searchsorted
    monkeypatch.setattr(token_alignment.np, "searchsorted", lambda a, v, **k: steps.append(len(v)) or search(a, v, **k))
    n = 200_000
    a = np.arange(2, 2 * n + 2, 2)
    b = np.append(a[:-1] + 1, a[-1])
    b[5] = a[5]
    cut = token_alignment.shared_cuts(a, np.unique(b), np.array([0]), np.array([n - 1]))
    assert np.flatnonzero(cut).tolist() == [5, n - 1]
    assert sum(steps) < 3 * n * 18

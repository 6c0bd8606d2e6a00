import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from imagelab.llm import packing
from imagelab.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check(rows, texts, tokenizer, capacity):
    """Pieces against the tokenizer itself, one document id per text; places against the rules."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine, at = sorted(pieces[doc_id], key=lambda r: r["piece"]), 0
        assert [r["piece"] for r in mine] == list(range(math.ceil(len(ids) / capacity)))
        for r in mine:
            assert r["start"] == at
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            assert r["length"] == capacity or r["piece"] == 0
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_edge_rows(spark, tokenizer):
    odd = [None, "", " ", "word " * 5000, "<|endoftext|>", "中文да \U0001f600", "a b\x85c\x1cd", "\t\n  x", "üß"]
    texts = dict(enumerate(odd)) | {100: "tie", 101: "tie", 102: "tie", None: "no id"}
    rows = [(i, t, "x", 1) for i, t in texts.items()]
    df = spark.createDataFrame(rows, SCHEMA + ", length string, part int").repartition(3)
    packed = packing.pack_documents(df, capacity=64).withColumnRenamed("id", "doc_id").collect()
    check(packed, texts, tokenizer, 64)


def test_ids_are_those_of_the_tokenizer(spark, tokenizer):
    df = spark.createDataFrame([(1, "The idea, a <|endoftext|> test"), (2, "да")], SCHEMA)
    got = {r["id"]: r["ids"] for r in packing.token_pieces(df, with_ids=True).collect()}
    assert got == {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0] for r in df.collect()}


def test_added_tokens_get_their_id_in_query_and_pipeline(spark, tmp_path):
    """Against a tokenizer with no setting touched."""
    import corpus_pipeline

    texts = {1: "a <|endoftext|> b", 2: "<|endoftext|>", 3: "да <|endoftext|><|endoftext|>", 4: "<|endoftext |>", 5: "plain é", 6: None}
    untouched = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert untouched.encode(texts[1], add_special_tokens=False).ids == [64, 220, 50256, 275]
    df = spark.createDataFrame(list(texts.items()), SCHEMA)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    check(QUERIES["op8_best_fit_packing"](spark, str(tmp_path)).collect(), texts, untouched, 2048)
    check(corpus_pipeline.packing(spark, df, str(tmp_path)).collect(), texts, untouched, 2048)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "same text here")] * 5, SCHEMA)
    packed = packing.pack_documents(df, capacity=8).collect()
    assert len(packed) == 5 and len({(r["sequence_id"], r["offset"]) for r in packed}) == 5
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_brute_force(spark, tokenizer):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = QUERIES["op8_best_fit_packing"](spark, sf_dir).collect()
    used = check(rows, texts, tokenizer, 2048)
    least = max(math.ceil(sum(r["length"] for r in rows) / 2048), sum(r["length"] > 1024 for r in rows))
    assert used <= least + 2


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    pick = random.Random(seed)
    lengths = Counter(pick.choice([pick.randint(1, 64), pick.randint(30, 40), 64, 21]) for _ in range(pick.randint(1, 3000)))
    plan = packing.packing_plan(lengths, 64)
    used = Counter()
    for times, pattern in plan:
        assert times > 0 and sum(pattern) <= 64
        for length in pattern:
            used[length] += times
    assert used == lengths
    sequences = sum(times for times, _ in plan)
    total = sum(k * n for k, n in lengths.items())
    assert sequences <= max(math.ceil(total / 64), sum(n for k, n in lengths.items() if k > 32)) * 1.1 + 1
    runs = packing._places(plan)
    for length, count in lengths.items():
        mine = runs[runs[:, 0] == length]
        assert mine[0, 1] == 0 and (np.diff(np.append(mine[:, 1], count)) > 0).all()


def test_exact_complements():
    counts = np.zeros(33, np.int64)
    counts[[5, 7, 20]] = 1
    assert packing._complement(counts, 20) == (20,)
    assert packing._complement(counts, 12) == (7, 5)
    assert packing._complement(counts, 32) == (20, 7, 5)
    assert packing._complement(counts, 10) is None  # there is one 5 only
    counts[5] = 3
    assert packing._complement(counts, 15) == (5, 5, 5)
    assert counts[5] == 3


def test_long_white_space(spark, tmp_path):
    """Runs on which the faster library's pattern search overflows; ids of an untouched tokenizer, in query and pipeline."""
    import corpus_pipeline

    untouched = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    mixed = ("a word \t" + " " * 12_000 + "é\n" * 300) * 150
    texts = dict(enumerate([" " * 1_000_000, "x" + " " * 1_000_000 + "y", "\n " * 500_000, " " * 300_000 + "z", mixed, " " * 9_999, "b"]))
    df = spark.createDataFrame(list(texts.items()), SCHEMA).repartition(4)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    check(packing.pack_documents(df).withColumnRenamed("id", "doc_id").collect(), texts, untouched, 2048)
    check(corpus_pipeline.packing(spark, df, str(tmp_path)).collect(), texts, untouched, 2048)

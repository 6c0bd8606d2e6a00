import itertools
import random
import zlib

import numpy as np
import pytest

from imagelab.llm import crf, toxicity
from imagelab.llm.queries import QUERIES

DOCS = "doc_id bigint, text string"
LABELS = "doc_id bigint, toxic int"


def brute_marginals(scores, a):
    total, p, counts = 0.0, np.zeros(len(scores)), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=len(scores)):
        path = list(zip((0, *tags), tags))
        weight = np.exp(sum(a[pair] for pair in path) + sum(s for s, y in zip(scores, tags) if y))
        total, p = total + weight, p + weight * np.array(tags)
        for pair in path:
            counts[pair] += weight
    return p / total, counts / total


def test_marginals_equal_enumeration(monkeypatch):
    monkeypatch.setattr(crf, "WIDTH", 3)
    pick = np.random.default_rng(1)
    a = pick.normal(size=(2, 2))
    sequences = [pick.normal(size=n) * 3 for n in (1, 2, 3, 4, 6, 7, 11)]
    p, counts = crf.marginals(np.concatenate(sequences), np.array([len(s) for s in sequences]), a, with_counts=True)
    exact = [brute_marginals(s, a) for s in sequences]
    assert p == pytest.approx(np.concatenate([e[0] for e in exact]))
    assert counts == pytest.approx(sum(e[1] for e in exact))


def test_long_sequences_do_not_depend_on_the_chunks(monkeypatch):
    pick = np.random.default_rng(2)
    a, scores = pick.normal(size=(2, 2)), pick.normal(size=5000) * 4
    lengths = np.array([1, 4999])
    found = crf.marginals(scores, lengths, a)[0]
    monkeypatch.setattr(crf, "WIDTH", 7)
    assert found == pytest.approx(crf.marginals(scores, lengths, a)[0])


def corpus(n=400, seed=0):
    pick = random.Random(seed)
    plain = ["the", "river", "runs", "over", "green", "hills", "and", "slow", "days", "pass"]
    for i in range(n):
        words = [pick.choice(plain) + pick.choice(["", "", "ly", "er"]) for _ in range(pick.randint(5, 60))]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(pick.randint(2, 6)):
                words.insert(pick.randrange(len(words)), pick.choice(["grumbwort", "Grumbleth", "zonkard,", "zonkarden"]))
        yield i, " ".join(words), toxic


@pytest.fixture(scope="module")
def fitted(spark):
    rows = list(corpus())
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], LABELS)
    return docs, labels, toxicity.fit_scorer(docs, labels), {i: y for i, _, y in rows}


def test_held_out_documents(fitted):
    docs, _, scorer, truth = fitted
    rows = toxicity.scored(docs, scorer).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and all(r["predicted"] == truth[r["id"]] == int(r["score"] >= 0.7) for r in held)


def test_held_out_labels_are_not_learned_from(spark, fitted):
    docs, labels, scorer, truth = fitted
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in truth.items()]
    again = toxicity.fit_scorer(docs, spark.createDataFrame(flipped, LABELS))
    assert again.field.weights == scorer.field.weights and (again.weights == scorer.weights).all()


def test_spans_point_at_the_words(spark, fitted):
    scorer = fitted[2]
    text = "The İ river, zonkarden! and Grumbwort"
    df = spark.createDataFrame([(1, text), (2, None), (3, "the river")], DOCS)
    spans = {r[0]: r[1] for r in df.select("doc_id", toxicity.offending_spans(scorer, "text")).collect()}
    assert [text[s["start"] : s["end"]] for s in spans[1]] == ["zonkarden", "Grumbwort"]
    assert spans[2] == spans[3] == []


def test_edge_rows(spark, fitted):
    scorer = fitted[2]
    texts = [None, "", "...", "12 34", "river " * 50_000, "river " * 50_000 + "zonkard " * 30, "zonkard grumbwort", "da \U0001f600"]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "zonkard grumbwort zonkard", 0), (6, "zonkard grumbwort", 0)]
    df = spark.createDataFrame(rows, DOCS + ", _score int")
    got = toxicity.scored(df, scorer).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    by_id = {r["id"]: r["score"] for r in got}
    assert by_id[0] == by_id[1] == by_id[2] and by_id[6] > 0.7 > by_id[4]
    assert [r["held_out"] for r in got if r["id"] is None] == [False]
    kept = toxicity.drop_toxic(df, scorer)
    assert kept.columns == df.columns and {0, 1, 2, 3, 4, 7} <= {r["doc_id"] for r in kept.collect()}
    assert 6 not in {r["doc_id"] for r in kept.collect()}


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)], [(None, 1), (1, None), (2, 0), (2, 0)]])
def test_labels_of_one_kind(spark, labels):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], DOCS)
    scorer = toxicity.fit_scorer(docs, spark.createDataFrame(labels, LABELS))
    assert len({round(r["score"], 6) for r in toxicity.scored(docs, scorer).collect()}) == 1
    assert toxicity.scored(spark.createDataFrame([], DOCS), scorer).count() == 0


def test_query_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = QUERIES["op4_toxicity_crf"](spark, sf_dir)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"]
    found = rows.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").filter("held_out").collect()
    caught = sum(r["predicted"] and r["toxic"] for r in found)
    assert caught >= 0.9 * sum(r["toxic"] for r in found)
    assert caught >= 0.95 * sum(r["predicted"] for r in found)

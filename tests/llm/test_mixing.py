import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from imagelab.llm import mixing

SCHEMA = "doc_id bigint, source string, text string"


def targets(sizes, share=Fraction(3, 2), most=2, weights=(5, 2, 1)):
    """Water filling by exact fractions."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, budget = set(), share * sum(sizes.values())
    while True:
        free = budget - sum(most * sizes[s] for s in full)
        spread = sum(weight[s] for s in names if s not in full) or 1
        target = {s: Fraction(most * sizes[s]) if s in full else free * weight[s] / spread for s in names}
        above = {s for s in names if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.fixture(scope="module")
def rows():
    made = [(i, f"s{i % 7}" if i % 3 else "big", "w " * (i * 37 % 50)) for i in range(400)]
    made += [(900, None, "a b c"), (901, "s1", None), (None, "s2", "null id"), (902, "tiny", "one"), (903, "Z", "\x0b\x0c x")]
    return made + [(904, "s3", "w " * 5000), (3, "s3", "repeated row"), (3, "s3", "repeated row")]


def test_targets_and_takes(spark, rows):
    got = mixing.mixed_sizes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, source, text in rows:
        sizes[source] += words(text)
    exact = targets(sizes)
    source_of = {(i, words(t)): s for i, s, t in rows}
    taken = Counter()
    for r in got:
        source = source_of[r["id"], r["size"]]
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(float(exact[source]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert all(exact[s] - 1 <= taken[s] <= exact[s] for s in sizes)
    assert sum(exact.values()) == Fraction(3, 2) * sum(sizes.values())


def test_order_of_service(spark, rows):
    """The same takes as serving each source's documents in the order of their hashes."""
    unique = [r for r in rows if r[0] != 3 and r[0] is not None]
    got = {r["id"]: r["taken"] for r in mixing.mixed_sizes(spark.createDataFrame(unique, SCHEMA)).collect()}
    by_source = defaultdict(list)
    for i, source, text in unique:
        by_source[source].append((hashlib.md5(str(i).encode()).hexdigest(), i, words(text)))
    exact = targets({s: sum(n for *_, n in docs) for s, docs in by_source.items()})
    for source, docs in by_source.items():
        left, expected = int(exact[source]), Counter()
        for _, i, n in sorted(docs) * 2:
            expected[i] += min(n, left)
            left -= min(n, left)
        assert all(got[i] == expected[i] for _, i, _ in docs)


def test_queue_is_in_order_and_reruns_agree(spark, rows):
    df = spark.createDataFrame(rows[:200], SCHEMA)
    first = [tuple(r) for r in mixing.fair_queue(df).select("id", "turn", "finish", "taken").orderBy("finish", "id", "turn").collect()]
    second = mixing.fair_queue(df.repartition(5, "text")).select("id", "turn", "finish", "taken").orderBy("finish", "id", "turn")
    assert first == [tuple(r) for r in second.collect()]
    assert len(first) == 400
    other = mixing.fair_queue(df, seed="other").select("id", "turn", "finish", "taken").orderBy("finish", "id", "turn")
    assert first != [tuple(r) for r in other.collect()]


def test_mixed_documents_keep_columns(spark, rows):
    wide = [(*r, "a", "b", 1) for r in rows]
    df = spark.createDataFrame(wide, SCHEMA + ", _key string, id string, _n int")
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    times = Counter((r["doc_id"], r["text"]) for r in mixed.collect())
    assert all(n <= 2 for key, n in times.items() if key[0] != 3)
    assert times[901, None] == 1  # no words: stays
    assert set(times) <= {(i, t) for i, _, t in rows}


@pytest.mark.parametrize("texts", [[], [None, "", " "]])
def test_nothing_to_mix(spark, texts):
    df = spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], SCHEMA)
    got = mixing.mixed_sizes(df).collect()
    assert [(r["target"], r["taken"]) for r in got] == [(0.0, 0)] * len(texts)
    assert mixing.mix_documents(df).count() == len(texts)


def test_takes_come_from_the_order_of_the_queue(spark, rows):
    """The same services in another order give other takes; in theirs, the mix ends with the budget."""
    queue = mixing.fair_queue(spark.createDataFrame(rows, SCHEMA))
    budget = 1.5 * queue.filter("turn = 0").agg(F.sum("size")).first()[0]
    taken = queue.agg(F.sum("taken")).first()[0]
    assert budget - 20 < taken <= budget
    sources = {(r["id"], r["size"]): r["source"] for r in spark.createDataFrame(rows, SCHEMA).withColumn("size", mixing.word_count(F.col("text"))).withColumnRenamed("doc_id", "id").collect()}
    listed = [r.asDict() for r in queue.collect()]
    takes = {}
    for name, order in (("own", lambda r: r["served"]), ("other", lambda r: (-r["size"], r["row"]))):
        served, made = 0, []
        for r in sorted(listed, key=order):
            served += r["size"]
            own = dict(r, source=sources[r["id"], r["size"]], served=r["served"] if name == "own" else served)
            made.append({k: own[k] for k in own if k != "taken"})
        names = "row bigint, turn int, size bigint, target double, finish double, source string, served bigint"
        again = mixing.truncated(spark.createDataFrame([tuple(r[c.split()[0]] for c in names.split(", ")) for r in made], names))
        takes[name] = {(r["row"], r["turn"]): r["taken"] for r in again.collect()}
    assert takes["own"] == {(r["row"], r["turn"]): r["taken"] for r in listed} != takes["other"]


def test_mixed_documents_of_one_id_and_size(spark):
    """Two texts of one id and word count keep their own takes; names may hold dots."""
    rows = [(1, "s", "a b c"), (1, "s", "d e f")] * 2 + [(i, "t", "w " * i) for i in range(2, 40)]
    df = spark.createDataFrame(rows, "`doc.id` bigint, source string, text string")
    mixed = mixing.mix_documents(df, id_col="doc.id")
    assert mixed.columns == df.columns and mixed.count() > len(rows)
    per_text = {t: n for t, n in mixed.groupBy("text").count().collect()}
    sizes = mixing.mixed_sizes(df.withColumnRenamed("doc.id", "doc_id")).collect()
    assert sum(r["taken"] for r in sizes if r["id"] == 1) == pytest.approx(3 * (per_text.get("a b c", 0) + per_text.get("d e f", 0)), abs=3)

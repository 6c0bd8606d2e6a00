import random
import re

import numpy as np
import pytest
import xxhash

from imagelab.llm import golay, simhash
from imagelab.llm.components import connected_components
from imagelab.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string"


def brute_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fingerprints):
    """{fingerprint: representative} by comparing all pairs."""
    values = sorted(set(fingerprints))
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[find(a)] = find(b)
    return {v: find(v) for v in values}


def check(rows, texts):
    """Rows of (doc_id, fingerprint as int, component) against all pairs of {doc_id: text}."""
    fingerprints = {i: brute_fingerprint(t) for i, t in texts.items()}
    root = brute_components(fingerprints.values())
    smallest = {}
    for i, f in fingerprints.items():
        smallest[root[f]] = min(smallest.get(root[f], i), i)
    assert sorted(rows) == sorted((i, f, smallest[root[f]]) for i, f in fingerprints.items())


def test_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op9_simhash_golay"](spark, sf_dir)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    check([(r[0], int(r[1], 16), r[2]) for r in got.collect()], texts)


def test_edge_rows(spark):
    long = "word" * 10 + " many different words " * 20_000
    texts = [None, "", " \t", "one", "ONE", "a b c", "a b c d", "A  b\nc d", "É b c d", "é b c d", long, long + " x"]
    texts = dict(enumerate(texts, start=3)) | {1: "a b c d", 2: None}
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in texts.items()], SCHEMA + ", fp string, id int")
    got = simhash.near_duplicates(df).collect()
    check([(r["id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in got], texts)


def test_null_ids_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, "a b c d"), (7, "a b c d"), (7, "a b c d"), (None, "only null here")], SCHEMA)
    got = sorted((str(r["id"]), str(r["component_id"])) for r in simhash.near_duplicates(df).collect())
    assert got == [("7", "7"), ("7", "7"), ("None", "7"), ("None", "None")]
    kept = simhash.drop_near_duplicates(df)
    assert sorted(map(str, kept.collect())) == sorted(map(str, [df.collect()[1], df.collect()[3]]))


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("group", [8, 2048])  # hot keys dealt out in blocks, or not
def test_links_connect_like_all_pairs(spark, group):
    pick = random.Random(5)
    centres = [pick.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]
    values = set(centres)
    for _ in range(300):
        value = pick.choice(sorted(values))
        for _ in range(pick.randint(1, 5)):
            value ^= 1 << pick.randrange(64)
        values.add(value)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), group)
    assert all((r["a"] ^ r["b"]) % (1 << 64) and ((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= 4 for r in edges.collect())
    labels = {r["node"] % (1 << 64): r["label"] % (1 << 64) for r in connected_components(edges).collect()}
    mine = {v: labels.get(v, v) for v in values}
    root = brute_components(values)
    assert len(set(mine.values())) == len(set(root.values())) == len({(mine[v], root[v]) for v in values})


def test_golay_keys():
    pick = np.random.default_rng(3)
    words = pick.integers(0, 1 << 23, 3000)
    keys = golay.keys(words)
    counts = (keys >= 0).sum(axis=1)
    assert set(counts) == {1, 6}
    for errors in (0, 1, 2):
        flips = np.array([sum(1 << int(b) for b in pick.choice(23, errors, replace=False)) for _ in words])
        others = golay.keys(words ^ flips)
        assert all(set(a[a >= 0]) & set(b[b >= 0]) for a, b in zip(keys, others))


def test_fingerprints_within_four_bits_share_a_key():
    pick = random.Random(11)
    for errors in (0, 1, 2, 3, 4):
        a = [pick.getrandbits(64) for _ in range(500)]
        b = [v ^ sum(1 << bit for bit in pick.sample(range(64), errors)) for v in a]
        ka, kb = (simhash.search_keys(np.array(v, np.uint64).view(np.int64)) for v in (a, b))
        assert all(set(x[x >= 0]) & set(y[y >= 0]) for x, y in zip(ka, kb))


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    edges = spark.createDataFrame(chain + star + [(500, 500), (7, 6), (-3, 200)], "a bigint, b bigint")
    got = {r["node"]: r["label"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}, 200: -3}

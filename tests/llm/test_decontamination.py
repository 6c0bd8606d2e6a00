import hashlib
import random
import re

import pytest

from imagelab.llm import decontamination
from imagelab.llm.queries import QUERIES

DOCS, ITEMS = "doc_id bigint, text string", "item_id bigint, text string"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def expected(documents, items):
    windows = {}
    for item, text in items:
        w = words(text)
        length = min(len(w), 10)
        for at in range(len(w) - length + 1 if w else 0):
            windows.setdefault(tuple(w[at : at + length]), set()).add("" if item is None else str(item))
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in documents:
        w, hit, found = words(text), set(), set()
        for length in lengths:
            for at in range(len(w) - length + 1):
                owners = windows.get(tuple(w[at : at + length]))
                if owners:
                    hit |= set(range(at, at + length))
                    found |= owners
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def query(spark, path, documents, items, more=""):
    spark.createDataFrame(documents, DOCS + more).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, ITEMS + more).write.parquet(f"{path}/benchmark.parquet")
    return sorted((tuple(r) for r in QUERIES["op13_winnowing"](spark, str(path)).collect()), key=str)


def text(pick, n, vocabulary=40):
    return " ".join(f"w{pick.randint(0, vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("shortest", [1, 4, 6, 10])
def test_planted_passages(spark, tmp_path, shortest):
    pick = random.Random(shortest)
    items = [(i, text(pick, pick.randint(shortest, 25), 400)) for i in range(30)] + [(None, text(pick, 12, 400))]
    documents = []
    for i in range(150):
        w = text(pick, pick.randint(0, 80), 400).split()
        for _, item in pick.sample(items, pick.randint(0, 3)):
            item = item.split()
            low = pick.randint(0, len(item) - 1)
            at = pick.randint(0, len(w))
            w[at:at] = item[low : low + pick.randint(8, 14)]  # some long enough, some not
        documents.append((i, " ".join(w)))
    assert query(spark, tmp_path, documents, items) == expected(documents, items)


def test_repetitive_words(spark, tmp_path):
    """Equal k-grams tie everywhere; windows overlap themselves."""
    pick = random.Random(3)
    items = [(1, "a " * 30), (2, "a b " * 6), (3, "b a " * 6), (4, "a " * 3), (5, text(pick, 60, 1))]
    documents = [(i, text(pick, pick.randint(0, 200), 1).replace("w0", "a").replace("w1", "b")) for i in range(40)]
    assert query(spark, tmp_path, documents, items) == expected(documents, items)


def test_edge_rows(spark, tmp_path):
    passage = "One two three four five six seven eight nine ten eleven twelve"
    items = [(7, passage), (10, passage), (10, passage), (None, "Été Ünal ÀB"), (8, None), (9, " .,!"), (11, "中文 \U0001f600x y")]
    documents = [
        (1, None), (2, ""), (3, " \n.,"), (4, passage.upper()), (4, passage.upper()), (5, "x " * 200_000 + passage.replace(" ", "--\n")),
        (6, "ÉTÉ Ünal Àb"), (6, "Été ÜNAL Àb!"), (None, "été Ünal ÀB ... Été ünal Àb, Été Ünal ÀB?"), (8, "中文 \U0001f600x Y 中文\U0001f600x y"),
        (9, " ".join(passage.split()[:9])), (9, "one two THREE four five six seven eight nine ten. one two"), (12, "a\x00b\x7fc"),
        (13, "İstanbul ǅ Ⓐ K one"), (14, passage + " " + passage),
    ]
    assert query(spark, tmp_path, documents, items) == expected(documents, items)


def test_without_windows_or_rows(spark, tmp_path):
    documents = [(1, "a b c"), (2, None)]
    assert query(spark, tmp_path / "a", documents, []) == expected(documents, [])
    assert query(spark, tmp_path / "b", documents, [(1, None), (2, "--")]) == expected(documents, [])
    assert query(spark, tmp_path / "c", [], [(1, "a b c")]) == []


def test_clashing_columns_and_dropping(spark, tmp_path):
    documents = [(1, "a b c d", "x", 1), (2, "a b", "y", 2)]
    items = [(5, "b c", "x", 3)]
    assert query(spark, tmp_path, documents, items, ", digest string, Length int") == expected(
        [d[:2] for d in documents], [i[:2] for i in items]
    )
    df = spark.createDataFrame(documents, DOCS + ", digest string, Length int")
    kept = decontamination.drop_contaminated(df, spark.createDataFrame([i[:2] for i in items], ITEMS))
    assert kept.columns == df.columns and [r["doc_id"] for r in kept.collect()] == [2]


def test_no_python_in_the_plan(spark):
    sf_dir = "/root/testdata/sf0.001"
    plan = QUERIES["op13_winnowing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

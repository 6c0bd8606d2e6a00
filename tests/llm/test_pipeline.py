import shutil
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from imagelab.llm.common import WORD
from imagelab.llm.toxicity import THRESHOLD, fit_scorer, sums_of
from imagelab.session import materialise
from tests.llm.test_exact_dedup import body
from tests.llm.test_mixing import targets, words
from tests.llm.test_packing import check as check_packing
from tests.llm.test_packing import tokenizer  # noqa: F401
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The input and the written result of every stage, over the documents and some odd ones."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = [
        (9001, None, None, None, None), (9002, "", "en", None, 0), (9003, "A  copy of\nit", "en", "src1", 1), (9004, "A copy of it", "en", "src1", 1),
        (9005, "a COPY of it", None, "src2", 1), (9006, "w " * 30_000, "en", "src3", 1), (None, "null id here", "en", "src1", 1),
        (9007, "twice the same", "en", "src1", 1), (9007, "twice the same", "en", "src1", 1),
    ]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, docs, SF_DIR), name)
        steps[name] = (docs, out)
        docs = out
    return steps


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "exact_dedup", "simhash_dedup", "mixing", "packing"]
    for _, out in list(stages.values())[:-1]:
        assert out.columns == COLUMNS
    assert stages["packing"][1].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_toxicity_drops_what_is_predicted(spark, stages):
    before, after = stages["toxicity"]
    scorer = fit_scorer(before, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    rows = before.collect()
    scores = scorer.score(np.array([sums_of(m) for m in scorer.tagged([r["text"] for r in rows])]))
    expected = Counter(r for r, score in zip(rows, scores) if score < THRESHOLD)
    assert Counter(after.collect()) == expected
    assert 0 < sum(expected.values()) < len(rows)


def test_exact_dedup_keeps_the_smallest_id(stages):
    before, after = (df.collect() for df in stages["exact_dedup"])
    first = {}
    for r in sorted(before, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        first.setdefault(body(r["text"]), r)
    assert Counter(after) == Counter(first.values())


def test_simhash_keeps_one_of_each_component(stages):
    before, after = (df.collect() for df in stages["simhash_dedup"])
    prints = {r: brute_fingerprint(r["text"]) for r in before}
    root = brute_components(prints.values())
    first = {}
    for r in sorted(before, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
        first.setdefault(root[prints[r]], r)
    assert Counter(after) == Counter(first.values())
    assert len(after) < len(before)


def test_mixing_takes_near_targets(stages):
    before, after = (df.collect() for df in stages["mixing"])
    times = Counter(after)
    assert set(times) <= set(before) and max(times.values()) <= 2
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in before:
        n = words(r["text"])
        sizes[r["source"]] += n
        taken[r["source"]] += n * times[r]
        longest[r["source"]] = max(longest[r["source"]], n)
    exact = targets(sizes)
    for source in sizes:
        assert abs(taken[source] - exact[source]) <= longest[source]


def test_packing_equals_brute_force(stages, tokenizer):  # noqa: F811
    before, after = stages["packing"]
    rows, texts = after.collect(), {}
    counts = Counter()
    for r in before.collect():
        counts[r["doc_id"]] += 1
        texts[r["doc_id"]] = r["text"]
    pieces = Counter(r["doc_id"] for r in rows if r["piece"] == 0)
    assert pieces == counts
    once = {i for i, n in counts.items() if n == 1}
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    solo = [r.asDict() | {"sequence_id": at, "offset": 0} for at, r in enumerate(rows) if r["doc_id"] in once]
    check_packing(solo, {i: texts[i] for i in once}, tokenizer, 2048)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns[0] == "doc_id" and out.agg(F.max("length")).first()[0] <= 2048
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0


def test_word_pattern_is_that_of_the_other_stages():
    assert WORD == r"[^\x20\x09-\x0D]+"


def test_the_rest_works_without_this_subpackage(tmp_path):
    root = Path(__file__).resolve().parents[2]
    for part in ("catalog", "imagelab", "__spark_entry__.py"):
        source = root / part
        if source.is_dir():
            shutil.copytree(source, tmp_path / part, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / part)
    code = "import __spark_entry__ as e; assert e.queries() and not any(q.startswith('op') for q in e.queries()); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"})

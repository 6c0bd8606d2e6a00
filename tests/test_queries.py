import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SAME_TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", entry_points.oracle_sql())
def test_query_equals_its_sql(spark, database, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    expected = database.execute(entry_points.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in expected.description}
    assert {c: SAME_TYPES[t] for c, t in df.dtypes} == types
    rows = sorted((tuple(r) for r in df.select(*types).collect()), key=repr)
    assert rows == sorted(expected.fetchall(), key=repr)
    assert rows


def test_entry_runs(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["l_returnflag", "class_name", "n"]
    assert df.count() == 3


def test_every_oracle_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("blocked", ["xxhash", "imagelab.llm", "corpus_pipeline", "public_tokenizers"])
def test_the_rest_runs_without_the_text_operators(blocked):
    """In a process of its own that cannot import them, or a package they need."""
    script = f"""
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
from pyspark.sql import SparkSession
assert "pipeline" not in entry.queries() and not [q for q in entry.queries() if q.startswith("op")]
assert len(entry.queries()) > 70 and set(entry.oracle_sql()) <= set(entry.queries())
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
assert entry.queries()["label_ids"](spark, "/root/testdata/sf0.001").count() > 0
"""
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]

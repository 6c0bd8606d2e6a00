import hashlib
from collections import defaultdict

import pytest

from imagelab.llm import warc

SCHEMA = "page_id bigint, url string, html string"
SAME = "<p>" + "same " * 40
ROWS = [
    (1, "http://a/1", "short"), (2, "http://a/2", "short"), (5, "http://a/5", SAME), (3, "http://a/3", SAME),
    (9, "http://a/9", SAME), (4, None, None), (6, "http://a/6", ""), (7, "http://a/\r\n7", "x\r\n\r\nWARC/1.1\r\n\r\n\r\n"),
    (8, "http://a/8", "é中" * 50), (10, "http://a/10", "é中" * 50), (None, "http://a/n", SAME),
    (11, "http://a/11", "z" * 500_000), (12, "http://a/12", "a" * 99), (13, "http://a/13", "a" * 99), (14, "http://a/14", "b" * 100),
    (15, "http://a/15", "b" * 100), (16, "http://a/16", "twice" * 50), (16, "http://a/16b", "twice" * 50),
]


def expected(rows):
    groups = defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        first = min((p for p in groups[html or ""] if p is not None), default=None)
        again = len(payload) >= 100 and page_id != first
        kind = "revisit" if again else "response"
        yield str(page_id), len(payload), hashlib.sha256(payload).hexdigest(), kind, first if again else None


@pytest.mark.parametrize("with_payload", [False, True])
def test_round_trip(spark, with_payload):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA + ", digest string, id int").repartition(3)
    got = warc.archive_round_trip(df, with_payload).collect()
    found = sorted(
        (str(r["metadata"]["page_id"]), r["response"]["payload_bytes"], r["response"]["payload_digest"], r["response"]["type"],
         int(r["metadata"]["refers_to"]) if r["metadata"]["refers_to"] else None)
        for r in got
    )
    assert found == sorted(expected(ROWS))
    assert all(r["request"]["url"] == r["response"]["url"] for r in got)
    assert len({r["response"]["record_id"] for r in got}) == len(ROWS)
    if with_payload:
        for r in got:
            body = r["response"]["payload"]
            assert (body is None) == (r["response"]["type"] == "revisit")
            assert body is None or hashlib.sha256(body).hexdigest() == r["response"]["payload_digest"]


def test_incomplete_transaction(spark, tmp_path):
    record = "WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <urn:a>\r\nWARC-Concurrent-To: <urn:b>\r\nContent-Length: 2\r\n\r\nhi"
    df = spark.createDataFrame([(record,)], "value string")
    df.write.option("lineSep", warc.END).option("compression", "gzip").text(str(tmp_path / "one"))
    only = warc.read_captures(spark, str(tmp_path / "one")).collect()
    assert len(only) == 1 and only[0]["response"] is None and only[0]["request"]["record_id"] == "<urn:a>"


def test_broken_archive_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([("WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 50\r\n\r\nhi",)], "value string")
    df.write.option("lineSep", warc.END).option("compression", "gzip").text(str(tmp_path / "cut"))
    with pytest.raises(Exception, match="cut short"):
        warc.read_records(spark, str(tmp_path / "cut")).collect()


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0

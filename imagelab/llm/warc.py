r"""WARC archives of page captures: written by Spark's text writer, read back, assembled by transaction.

Each page is one transaction of three records: a request, a response (or a revisit of a response
with the same payload) and metadata. Request and metadata name the response in WARC-Concurrent-To.
A record ends with CRLF CRLF, so a transaction is one line of a text file whose line separator is
CRLF CRLF: archives go to any file system that Spark writes to, gzip-compressed, one per task.

Of pages with equal payloads of at least `least_bytes` the one with the smallest page id is the
response and the others are revisits of it. That is decided on narrow rows (id, digest); the wide
rows meet the decisions by id and digest, never by digest alone, so copies do not pile up.

Reading opens whole archives (files of one write task each) in the tasks, decompresses them as a
stream and frames records by Content-Length. The records of a transaction meet by the identifier
they are concurrent to, in one shuffle without payloads unless those are asked for.

Defined results: null html is an empty payload; null ids are written as such, are never the
smallest, and come back as null; rows that repeat id and payload are all what the first of them
is; line breaks inside URLs are percent-encoded; an empty table gives no rows.
"""

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from imagelab.llm.common import col
from imagelab.session import delete_on_exit, materialise, scratch_path, ship_package

END = "\r\n\r\n"
LEAST_BYTES = 100
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value of the format
FLUSH_BYTES = 16 << 20


def originals(df: DataFrame, id_col: str, payload: Column, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(id, digest, original): rows of equal payloads, with the smallest id among them."""
    digests = materialise(
        df.select(col(id_col).alias("id"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).alias("n"))
        .filter(F.col("n") >= least_bytes)
        .select("id", "digest"),
        "payloads",
    )
    groups = digests.groupBy("digest").agg(F.min("id").alias("original"), F.count("*").alias("rows"))
    repeated = materialise(groups.filter("rows > 1").select(F.col("digest").alias("_digest"), "original"), "repeated")
    members = digests.join(repeated, F.col("digest") == F.col("_digest"))
    return materialise(members.select("id", "digest", "original").distinct(), "originals")


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id]
    for name, value in headers:
        lines += [F.lit(f"\r\n{name}: "), value]
    lines += [F.lit(f"\r\nContent-Type: {content_type}\r\nContent-Length: "), F.octet_length(block).cast("string")]
    return F.concat(*lines, F.lit(END), block)


def write_archives(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = LEAST_BYTES,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write one request, response or revisit, and metadata record per row of `df` to the folder `path`."""
    payload = F.coalesce(col(html_col), F.lit(""))
    decided = originals(df, id_col, payload, least_bytes).withColumnsRenamed({"id": "_id", "digest": "_digest"})
    pages = df.select(
        col(id_col).alias("id"),
        F.regexp_replace(F.regexp_replace(F.coalesce(col(url_col), F.lit("")), "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"),
        F.sha2(payload, 256).alias("digest"),
        F.md5(F.concat_ws("|", col(id_col).cast("string"), F.monotonically_increasing_id(), F.lit("page"))).alias("key"),
    )
    on = pages["id"].eqNullSafe(decided["_id"]) & (pages["digest"] == decided["_digest"])
    joined = pages.join(decided, on, "left")

    def urn(part: str) -> Column:
        digits = F.md5(F.concat("key", F.lit(part)))
        parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
        return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))

    revisit = F.col("original").isNotNull() & ~F.col("original").eqNullSafe(F.col("id"))
    page_id = F.coalesce(F.col("id").cast("string"), F.lit(""))
    refers_to = F.when(revisit, F.col("original").cast("string")).otherwise("")
    uri, when = ("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest"))
    together = ("WARC-Concurrent-To", F.col("response_id"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("payload").cast("string"),
        F.lit(END),
    )
    request = _record(
        "request", urn("request"), [when, uri, together], "application/http;msgtype=request",
        F.concat(F.lit("GET "), "url", F.lit(" HTTP/1.1" + END)),
    )
    reply_type = "application/http;msgtype=response"
    full = _record("response", F.col("response_id"), [when, uri, digest], reply_type, F.concat(http, "payload"))
    profile = ("WARC-Profile", F.lit(IDENTICAL))
    again = _record("revisit", F.col("response_id"), [when, uri, digest, profile], reply_type, http)
    metadata = _record(
        "metadata", urn("metadata"), [when, uri, together], "application/warc-fields",
        F.concat(F.lit("page-id: "), page_id, F.lit("\r\nrefers-to-page: "), refers_to, F.lit("\r\n")),
    )
    response = F.when(revisit, again).otherwise(full)
    transaction = F.concat(request, F.lit(END), response, F.lit(END), metadata)
    rows = joined.withColumn("response_id", urn("response")).select(transaction.alias("value"))
    rows.write.option("lineSep", END).option("compression", "gzip").text(path)


def _records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record."""
    with gzip.GzipFile(fileobj=io.BytesIO(archive)) as stream:
        reader = io.BufferedReader(stream, 1 << 18)
        while first := reader.readline():
            if not first.startswith(b"WARC/"):
                raise ValueError(f"no record where one should begin: {first[:40]!r}")
            headers = {}
            while (line := reader.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode().rstrip("\r\n").partition(": ")
                headers[name.lower()] = value
            size = int(headers["content-length"])
            block = reader.read(size)
            if len(block) != size or reader.read(4) != b"\r\n\r\n":
                raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
            yield headers, block


def _fields(block: bytes) -> dict[str, str]:
    pairs = (line.partition(": ") for line in block.decode().split("\r\n") if line)
    return {name.lower(): value for name, _, value in pairs}


_SCHEMA = (
    "type string, record_id string, concurrent_to string, url string, "
    "payload_bytes bigint, payload_digest string, page_id string, refers_to string, payload binary"
)


def read_records(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives in a folder; digests are checked against the payloads."""
    ship_package(spark)
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    types = [pa.string()] * 4 + [pa.int64()] + [pa.string()] * 3 + [pa.binary()]

    def row(headers: dict[str, str], block: bytes) -> tuple:
        kind, found, digest, fields, payload = headers["warc-type"], None, None, {}, None
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            digest = headers["warc-payload-digest"].removeprefix("sha256:")
            found = int(_fields(head)["content-length"])
            if kind == "response":
                if len(body) != found or hashlib.sha256(body).hexdigest() != digest:
                    raise ValueError(f"record {headers['warc-record-id']} does not have the payload it states")
                payload = body if with_payload else None
        elif kind == "metadata":
            fields = _fields(block)
        return (
            kind, headers["warc-record-id"], headers.get("warc-concurrent-to"), headers.get("warc-target-uri"),
            found, digest, fields.get("page-id") or None, fields.get("refers-to-page") or None, payload,
        )

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for contents in batches:
            for content in contents.column(0):
                for headers, block in _records(content.as_py()):
                    rows.append(row(headers, block))
                    held += 500 + len(rows[-1][-1] or b"")
                    if held > FLUSH_BYTES:
                        yield batch(rows)
                        rows, held = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(parse, _SCHEMA)


def read_captures(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """(request, response, metadata) structs, one nested row per capture.

    A record without its counterparts gives a row with nulls in their place.
    """
    records = read_records(spark, path, with_payload)
    transaction = F.coalesce("concurrent_to", "record_id").alias("transaction")
    answer = ["record_id", "type", "url", "payload_bytes", "payload_digest"] + ["payload"] * with_payload
    kinds = {
        "request": (F.col("type") == "request", ["record_id", "url"]),
        "response": (F.col("type").isin("response", "revisit"), answer),
        "metadata": (F.col("type") == "metadata", ["record_id", "page_id", "refers_to"]),
    }
    structs = [F.when(is_kind, F.struct(*fields)).alias(name) for name, (is_kind, fields) in kinds.items()]
    parts = records.select(transaction, *structs)
    return parts.groupBy("transaction").agg(*[F.first(k, ignorenulls=True).alias(k) for k in kinds]).drop("transaction")


def archive_round_trip(df: DataFrame, with_payload: bool = False, **options) -> DataFrame:
    """Write `df` as archives in the shared folder and read the captures back."""
    spark = df.sparkSession
    path = scratch_path(spark, "archives")
    delete_on_exit(spark, path.rsplit("/", 1)[0])
    write_archives(df, path, **options)
    return read_captures(spark, path, with_payload)

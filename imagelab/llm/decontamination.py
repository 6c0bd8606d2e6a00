"""Benchmark decontamination by winnowing, in DataFrame functions only.

Texts are sequences of words. A document word is hit when it lies inside an occurrence of a window of a
benchmark item: `WINDOW` consecutive words, or all words of a shorter item. Both sides hash their k-grams
of words and keep, in each run of consecutive k-grams that a window spans, the least hash; so any
window that both have is kept at the same place in both. The kept hashes join, and each hit is extended
to all windows that contain its k-gram, which are compared word for word with the item windows. A
shared span of at least a window's length cannot be missed, and a chance hit of hashes marks nothing.

Windows of `GRAM` or more words share k = `GRAM`: what a short run keeps includes what a longer one
keeps, so documents keep the least hashes of the shortest run that some item needs. Items below `GRAM`
words are a single k-gram of their length.

Results depend on the text alone, so everything between the two scans goes by the digest of the text,
and copies of a document share it. In the second scan a bounded list of digest buckets keeps back the
texts without hits, so that only those with hits are shuffled, if Spark does not broadcast the hits.
The hashes and windows of the benchmark are written tables that Spark broadcasts by their size; beyond,
the kept hashes of the documents are shuffled (about two in seven words, 16 bytes and a digest each).

Defined results: null text has no words; null item ids are one item that is written as an empty
name; repeated items of one id are one item, repeated documents keep a row each; an item without
words has no window; an empty benchmark marks nothing.
"""

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.llm.common import col
from imagelab.session import materialise

# Fixed patterns: a word of lower-cased text is [^\x00-\x2F\x3A-\x60\x7B-\x7F]+, written here as what it
# may hold, which the pattern library matches faster
WORDS = r"[0-9a-z[^\x00-\x7F]]+"
WORDS_ANY_CASE = r"[0-9A-Za-z[^\x00-\x7F]]+"
OTHER_CAPITALS = r"[[\p{javaUpperCase}\p{javaTitleCase}]&&[^A-Z]]"
WINDOW = 10  # words
GRAM = 5  # words of a k-gram, unless the window is shorter
BUCKETS = 1 << 20  # of digests; which of them have hits is broadcast


def words_of(text: Column) -> Column:
    """The words of a text, with A-Z in lower case."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # the same, and faster, where no other letter has a lower case
    lower = F.when(text.rlike(OTHER_CAPITALS), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(F.lower(text))
    return F.regexp_extract_all(lower, F.lit(WORDS), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORDS_ANY_CASE)).cast("long")


def _steps(last: Column) -> Column:
    """0, 1, ... `last`; null when that is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last))


def _gram(window: int, gram: int) -> int:
    return min(window, gram)


def _over_run(df: DataFrame, name: str, run: int, choose: Callable, forward: bool) -> DataFrame:
    """Replace each value of the array `name` by the chosen one of `run` values, it and those after (or before) it.

    The run doubles from step to step. Values outside the array do not count; looking backward, the
    array grows by the places behind its end whose run still begins inside.
    """
    done = 1
    while done < run:
        step = min(done, run - done)
        if forward:
            shifted = F.slice(name, step + 1, F.greatest(F.size(name), F.lit(0)))
        else:
            shifted = F.concat(F.array_repeat(F.lit(None).cast("long"), step), F.col(name))
        df = df.withColumn(name, F.zip_with(name, shifted, choose))
        done += step
    return df


def _with_kept(df: DataFrame, size: int, run: int, alias: str) -> DataFrame:
    """Add array<struct<size, hash, at>>: the k-grams of `size` words that have the least hash of `run` in a row.

    `df` has the words' hashes in `_hashes`. Ties are all kept. Each array is a column of its own, so
    that Spark does not put one's expression into every use of another. For the same reason arrays
    are exploded as outer ones in this module: for others Spark puts a filter on their size below,
    and all these expressions into it. The rows without a value match nothing in the join that follows.
    """
    grams = F.transform(
        _steps(F.size("_hashes") - size), lambda at: F.xxhash64(*[F.get("_hashes", at + i) for i in range(size)])
    )
    df = df.withColumn("_grams", grams).withColumn("_chosen", F.col("_grams"))
    df = _over_run(df, "_chosen", run, lambda a, b: F.least(a, b), forward=True)
    whole_runs = F.greatest(F.size("_grams") - (run - 1), F.lit(0))
    df = df.withColumn("_chosen", F.slice("_chosen", 1, whole_runs))
    # a gram is the least of some run around it if the greatest of these runs' least ones is its own hash
    df = _over_run(df, "_chosen", run, lambda a, b: F.greatest(a, b), forward=False)
    # no array of another column inside a function of elements: Spark would make it anew for each one
    own = F.zip_with("_grams", "_chosen", lambda gram, least: F.when(gram == least, gram))
    kept = F.transform(own, lambda gram, at: F.when(gram.isNotNull(), F.struct(F.lit(size).alias("size"), gram.alias("hash"), at.alias("at"))))
    return df.withColumn(alias, F.filter(kept, lambda k: k.isNotNull())).drop("_grams", "_chosen")


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def benchmark_windows(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """(length, window, item), distinct: the windows of all items; an item is its id as text."""
    item = F.coalesce(col(id_col).cast("string"), F.lit("")).alias("item")
    items = benchmark.select(item, words_of(col(text_col)).alias("words"))
    items = items.withColumn("length", F.least(F.size("words"), F.lit(window))).filter("length > 0")
    rows = items.select("item", "length", "words", F.explode_outer(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("at"))
    words = F.slice("words", F.col("at") + 1, F.col("length"))
    return materialise(rows.select("length", F.array_join(words, " ").alias("window"), "item").distinct(), "item_windows")


def _benchmark_prints(windows: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """(size, hash), distinct: the k-gram of least hash of every window."""
    parts = []
    for length in lengths:
        size = _gram(length, gram)
        hashes = windows.filter(F.col("length") == length).select(_hashed(F.split("window", " ")).alias("_hashes"))
        kept = _with_kept(hashes, size, length - size + 1, "kept").select(F.explode_outer("kept").alias("kept"))
        parts.append(kept.select("kept.size", "kept.hash"))
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return materialise(union.distinct(), "item_prints")


def _candidates(hits: str, lengths: list[int], gram: int, n_words: Column) -> Column:
    """Packed (start, length) of all windows that contain one of the hits, distinct."""
    parts = []
    for length in lengths:
        size = _gram(length, gram)
        own = F.filter(hits, lambda h: h["size"] == size)
        around = F.transform(
            own,
            lambda h: F.when(
                F.least(h["at"], n_words - length) >= F.greatest(h["at"] - (length - size), F.lit(0)),
                F.sequence(F.greatest(h["at"] - (length - size), F.lit(0)), F.least(h["at"], n_words - length)),
            ).otherwise(F.array().cast("array<int>")),
        )
        parts.append(F.transform(F.flatten(around), lambda start: start.cast("long") * 64 + length))
    return F.array_distinct(F.concat(*parts))


def _covered(spans: Column) -> Column:
    """How many words lie in at least one of the (start, length) spans, which come sorted."""

    def add(seen: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        new = F.greatest(end - F.greatest(seen["end"], span["start"]), F.lit(0))
        return F.struct(F.greatest(seen["end"], end).alias("end"), (seen["n"] + new).alias("n"))

    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, add, lambda seen: seen["n"])


def contaminated_spans(
    df: DataFrame, windows: DataFrame, text_col: str = "text", gram: int = GRAM
) -> DataFrame | None:
    """(digest, start, length, window_id), distinct and written, and (window_id, item); None without any window.

    One row for each place of a text (by digest) where a window of `windows` occurs.
    """
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())  # at most WINDOW numbers
    if not lengths:
        return None
    prints = _benchmark_prints(windows, lengths, gram)
    runs: dict[int, int] = {}
    for length in reversed(lengths):
        runs[_gram(length, gram)] = length - _gram(length, gram) + 1  # the shortest length comes last
    texts = df.select(digest_of(col(text_col)).alias("digest"), col(text_col).alias("text"))
    kept = texts.select("digest", _hashed(words_of(F.col("text"))).alias("_hashes"))
    for size, run in runs.items():
        kept = _with_kept(kept, size, run, f"_kept{size}")
    none = F.array().cast("array<struct<size:int,hash:bigint,at:int>>")
    exploded = kept.select("digest", F.explode_outer(F.concat(*[F.coalesce(f"_kept{size}", none) for size in runs])).alias("kept"))
    found = exploded.select("digest", "kept.*").join(prints, ["size", "hash"], "left_semi")
    hits = materialise(found.groupBy("digest").agg(F.collect_set(F.struct("size", "at")).alias("hits")), "hits")

    # texts without hits stay where they are: only those in a bucket of some hit can meet one
    bucket = F.pmod(F.xxhash64("digest"), F.lit(BUCKETS)).alias("bucket")
    buckets = F.broadcast(materialise(hits.select(bucket).distinct(), "buckets"))  # at most BUCKETS numbers
    texts = texts.withColumn("bucket", bucket).join(buckets, "bucket", "left_semi")
    narrow = hits.select(F.col("digest").alias("_digest"), "hits")
    hit_texts = texts.join(narrow, texts["digest"] == narrow["_digest"]).select("digest", "hits", words_of(F.col("text")).alias("words"))
    listed = hit_texts.withColumn("windows", _candidates("hits", lengths, gram, F.size("words")))
    texts_of = F.transform(
        "windows",
        lambda w: F.struct(
            F.shiftright(w, 6).alias("start"),
            w.bitwiseAND(F.lit(63)).alias("length"),
            F.array_join(F.slice("words", F.shiftright(w, 6).cast("int") + 1, w.bitwiseAND(F.lit(63)).cast("int")), " ").alias("window"),
        ),
    )
    candidates = listed.select("digest", F.explode_outer(texts_of).alias("w")).select("digest", "w.*")
    known = windows.select("window").distinct().withColumn("window_id", F.monotonically_increasing_id())
    known = materialise(known, "windows")  # written, so that the numbers stay
    spans = candidates.join(known, "window").select("digest", "start", "length", "window_id")
    return materialise(spans.distinct(), "spans"), windows.join(known, "window").select("window_id", "item")


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def contamination(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """(id, n_words, n_hit, items), one row for each row of `df`; `items` are the sorted ids of items with hits."""
    narrow = df.select(
        col(id_col).alias("id"), digest_of(col(text_col)).alias("digest"), word_count(col(text_col)).alias("n_words")
    )
    rows = materialise(narrow, "rows")
    none = F.array().cast("array<string>")
    found = contaminated_spans(df, benchmark_windows(benchmark, item_col, item_text_col, window), text_col, gram)
    if found is None:
        return rows.select("id", "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    spans, owners = found
    marked = spans.groupBy("digest").agg(_covered(F.array_sort(F.collect_list(F.struct("start", "length")))).alias("n_hit"))
    pairs = spans.select("digest", "window_id").distinct().join(owners, "window_id").select("digest", "item").distinct()
    named = pairs.groupBy("digest").agg(F.array_sort(F.collect_list("item")).alias("items"))
    results = materialise(marked.join(named, "digest"), "contaminated").withColumnRenamed("digest", "_digest")
    joined = rows.join(results, rows["digest"] == results["_digest"], "left")
    return joined.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"))


def drop_contaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of `df` in which no window of the benchmark occurs, with all their columns."""
    found = contaminated_spans(df, benchmark_windows(benchmark, **options), text_col)
    if found is None:
        return df
    marked = materialise(found[0].select(F.col("digest").alias("_digest")).distinct(), "marked")
    return df.join(marked, digest_of(col(text_col)) == marked["_digest"], "left_anti")

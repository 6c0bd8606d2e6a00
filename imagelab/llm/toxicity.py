"""Toxicity by a linear-chain conditional random field over tokens.

Labels mark documents, the field tags tokens. On a bounded sample of labelled rows, words and word
beginnings that are strongly over-represented in toxic documents mark the offending tokens, and the
field is fitted to those labelled tokens (see `crf`). Forward-backward marginals of every token of
a whole text are then summed up to what a document score is calibrated on, with the same sample of
labelled rows, and give the offsets of the offending spans.

Only the text is ever an input of a score. The driver holds the sample's tokens, word statistics
and sums and the fitted weights, all bounded by `SAMPLE` and `SAMPLE_CHARS`.

Defined results: null and empty texts have no tokens and get the calibrated score of that; without
labels of both kinds every score is the share of toxic labels (0 without labels); null ids are not
held out; of several labels of one id the largest counts; repeated rows get equal scores; an empty
table gives no rows.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from imagelab.llm import crf
from imagelab.llm.common import col, fresh
from imagelab.session import materialise, ship_package

SAMPLE = 1000  # labelled documents of each class to learn from
SAMPLE_CHARS = 5000  # the tags are learned from documents up to this length, the scores from all
THRESHOLD = 0.7
LEAST_LIFT = 2.0  # log of how much more frequent an offending word is in toxic documents
LEAST_DEVIATIONS = 4.0
LEAST_DOCUMENTS = 3
BATCH_TOKENS = 1 << 18
CACHED_WORDS = 1 << 19

TOKEN = re.compile(r"[^\W\d_]+")


def tokens_of(text: str | None) -> list[str]:
    return TOKEN.findall((text or "").lower())


@dataclass
class Scorer:
    """The fitted field and the calibration of document sums."""

    field: crf.Model
    weights: np.ndarray  # of `sums`, the constant first

    def __post_init__(self) -> None:
        self._cache: dict[str, float] = {}

    def token_scores(self, words: Sequence[str]) -> list[float]:
        cache = self._cache
        if len(cache) > CACHED_WORDS:
            cache.clear()
        found = list(map(cache.get, words))
        if None in found:
            for at, score in enumerate(found):
                if score is None:
                    word = words[at]
                    found[at] = cache[word] = self.field.score(word)
        return found

    def tagged(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """Marginals of the offending tag for the tokens of each text, in bounded groups of texts."""
        lengths: list[int] = []
        scores: list[float] = []
        for text in texts:
            mine = self.token_scores(tokens_of(text))
            lengths.append(len(mine))
            scores += mine
            if len(scores) >= BATCH_TOKENS:
                yield from self._split(scores, lengths)
                lengths, scores = [], []
        yield from self._split(scores, lengths)

    def _split(self, scores: list[float], lengths: list[int]) -> list[np.ndarray]:
        sizes = np.array(lengths, np.int64)
        found, _ = crf.marginals(np.array(scores), sizes[sizes > 0], self.field.transitions)
        return np.split(found, np.cumsum(sizes)[:-1]) if lengths else []

    def score(self, sums: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_with_constant(sums) @ self.weights, -30, 30)))


def sums_of(marginals: np.ndarray) -> list[float]:
    """What a document's score depends on: its strongest token, expected offending tokens and their share."""
    if not len(marginals):
        return [0.0, 0.0, 0.0, 0.0]
    expected, n = float(marginals.sum()), len(marginals)
    return [float(marginals.max()), math.log1p(expected), math.log1p(100 * expected / (n + 10)), math.log1p(n) / 10]


def _with_constant(sums: np.ndarray) -> np.ndarray:
    return np.column_stack((np.ones(len(sums)), sums))


def offending_words(documents: Sequence[Sequence[str]], toxic: Sequence[int]) -> set[str]:
    """Word features (see `crf.features_of`) over-represented in the toxic documents."""
    counts = (Counter(), Counter())
    sizes = Counter(toxic)
    for words, label in zip(documents, toxic):
        counts[label].update({f for word in set(words) for f in crf.features_of(word)})
    found = set()
    for name, many in counts[1].items():
        if many >= LEAST_DOCUMENTS:
            rate, other = (many + 0.5) / (sizes[1] + 1), (counts[0][name] + 0.5) / (sizes[0] + 1)
            pooled = (many + counts[0][name] + 1) / (sizes[1] + sizes[0] + 2)
            spread = math.sqrt(pooled * (1 - pooled) * (1 / (sizes[1] + 1) + 1 / (sizes[0] + 1)))
            if math.log(rate / other) > LEAST_LIFT and (rate - other) / spread > LEAST_DEVIATIONS:
                found.add(name)
    return found


def token_tags(words: Sequence[str], toxic: int, offending: set[str]) -> np.ndarray:
    """1 for the offending tokens of a toxic document."""
    if not toxic:
        return np.zeros(len(words), np.int64)
    return np.array([int(any(f in offending for f in crf.features_of(w))) for w in words], np.int64)


def _calibrated(sums: np.ndarray, labels: np.ndarray, weight: np.ndarray, rounds: int = 30, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps; zero columns keep weight zero."""
    x = _with_constant(sums)
    theta = np.zeros(x.shape[1])
    penalty = ridge * np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (weight * (p - labels)) + penalty @ theta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        theta -= step / max(1.0, np.abs(step).max() / 5)
    return theta


def remainder(id_col: str) -> Column:
    return F.pmod(F.crc32(col(id_col).cast("string")), F.lit(3))


def _document_sums(scorer: Scorer):
    @F.arrow_udf("array<double>")
    def sums(texts: pa.Array) -> pa.Array:
        rows = [sums_of(m) for m in scorer.tagged(texts.to_pylist())]
        return pa.array(rows, pa.list_(pa.float64()))

    return sums


def fit_scorer(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE
) -> Scorer:
    """Field and calibration from a sample of the labelled rows that are not held out."""
    ship_package(documents.sparkSession)
    known = labels.filter((remainder(id_col) != 1) & col(label_col).isin(0, 1))
    known = known.groupBy(col(id_col).alias("_id")).agg(F.max(col(label_col)).cast("int").alias("label"))
    known = known.withColumn("order", F.xxhash64("_id", F.lit("sample")))
    known = materialise(known, "labels")
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}  # two rows at most
    # by id alone, so that a bounded list goes to the texts and no text is shuffled
    first = [known.filter(F.col("label") == label).orderBy("order", "_id").limit(2 * sample) for label in (0, 1)]
    candidates = F.broadcast(materialise(first[0].unionByName(first[1]), "candidates"))  # at most 4 * sample rows
    texts = documents.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    short = F.length(F.coalesce("text", F.lit(""))) <= SAMPLE_CHARS
    found = texts.join(candidates, F.col("id") == F.col("_id"))
    labelled = materialise(found.select("id", "label", "order", "text", short.alias("short")), "labelled")
    if labelled.select("label").distinct().count() < 2:
        share = sizes.get(1, 0) / max(1, sum(sizes.values()))
        share = min(max(share, 1e-9), 1 - 1e-9)
        return Scorer(crf.Model(), np.array([math.log(share / (1 - share)), 0, 0, 0, 0]))

    def chosen(condition: Column) -> list[DataFrame]:
        mine = labelled.filter(condition)
        return [mine.filter(F.col("label") == label).orderBy("order", "id").limit(sample) for label in (0, 1)]

    rows = [r for part in chosen(F.col("short")) for r in part.select("label", "text").collect()]  # at most 2 * sample
    words, toxic = [tokens_of(r["text"]) for r in rows], [r["label"] for r in rows]
    offending = offending_words(words, toxic)
    field = crf.fit(words, [token_tags(w, t, offending) for w, t in zip(words, toxic)])
    scorer = Scorer(field, np.zeros(5))
    sums = _document_sums(scorer)
    zero, one = chosen(F.lit(True))
    judged = zero.unionByName(one).select("label", sums("text").alias("sums")).collect()  # at most 2 * sample rows of 4 numbers
    y = np.array([r["label"] for r in judged])
    weight = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (1 - y).sum())  # classes as frequent as among all labels
    scorer.weights = _calibrated(np.array([r["sums"] for r in judged]), y, weight * len(y) / weight.sum())
    return scorer


def toxicity(scorer: Scorer, text: str | Column) -> Column:
    """double from 0 to 1 for a text column."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        sums = np.array([sums_of(m) for m in scorer.tagged(texts.to_pylist())]).reshape(-1, 4)
        return pa.array(scorer.score(sums))

    return score(text)


def offending_spans(scorer: Scorer, text: str | Column, least: float = 0.5) -> Column:
    """array<struct<start, end, probability>> of the tagged tokens, in code points of the text."""
    fields = [("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]

    def of(text: str | None, marginals: np.ndarray) -> list[dict]:
        hits = np.flatnonzero(marginals >= least)
        if not len(hits):
            return []
        text = text or ""
        lowered = text.lower()
        if len(lowered) != len(text):  # lower-casing some letters makes two of one
            origin = [at for at, c in enumerate(text) for _ in c.lower()] + [len(text)]
        else:
            origin = range(len(text) + 1)
        found = [m.span() for m in TOKEN.finditer(lowered)]
        return [
            {"start": origin[found[at][0]], "end": origin[found[at][1]], "probability": float(marginals[at])} for at in hits
        ]

    @F.arrow_udf("array<struct<start: bigint, end: bigint, probability: double>>")
    def spans(texts: pa.Array) -> pa.Array:
        values = texts.to_pylist()
        return pa.array([of(t, m) for t, m in zip(values, scorer.tagged(values))], pa.list_(pa.struct(fields)))

    return spans(text)


def scored(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted), one row for each row of `df`."""
    ship_package(df.sparkSession)
    rows = df.select(
        col(id_col).alias("id"),
        F.coalesce(remainder(id_col) == 1, F.lit(False)).alias("held_out"),
        toxicity(scorer, col(text_col).cast("string")).alias("score"),
    )
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(df: DataFrame, scorer: Scorer, text_col: str = "text") -> DataFrame:
    """The rows of `df` whose text is not predicted toxic."""
    ship_package(df.sparkSession)
    score = fresh(df, "_score")
    judged = df.withColumn(score, toxicity(scorer, col(text_col).cast("string")))
    return judged.filter(col(score) < THRESHOLD).select(*[col(c) for c in df.columns])

"""Quality classifier: a regularised quadratic discriminant.

Every whole text becomes a vector of transformed statistics (lengths, shares of
character kinds, repetition of words and lines). The labelled training rows give
each class a mean and a covariance, summed on Spark over all of them; the
covariances are shrunk towards the pooled one and towards a multiple of the
identity, and factored once by Cholesky. A text's score is the posterior of
label 1: the difference of the classes' log densities (Mahalanobis distances by
the cached factors) plus the log odds of the priors, through the logistic
function.

Labels, language, source and id never enter a score. Rows whose
crc32(doc_id as text) mod 5 is 0 are held out of the fit.

Defined cases: a null text counts as empty, which has a score too; an id that
is null is not held out and has no label; an id with contradicting labels, and a
label other than 0 or 1, is left out of the fit; with one class only, or no
labels, the score is that class's label, or 0.5; repeated ids are scored row by
row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log, log1p, sqrt
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import binary_rows, stage

HOLD_OUT = 5
THRESHOLD = 0.3
TO_POOLED = 0.05                # share of the pooled covariance in each class's
TO_IDENTITY = 0.01              # share of the scaled identity

_ASCII = bytes(range(128))
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"
_SPACES = b" \t\n\x0b\x0c\r"
_PROSE = b".,;:?'\"-()"
_SYMBOLS = bytes(b for b in range(33, 127)
                 if b not in _UPPER + _LOWER + _DIGITS + _PROSE)
FEATURES = ("words", "word_length", "line_words", "capitals", "digits", "symbols", "prose_marks",
            "bare_symbols", "marked_words", "repeats", "top_word", "variety", "same_lines")


def _share(part: float, whole: float) -> float:
    """A share on a log scale, flat below one in a thousand."""
    return log(part / whole + 1e-3) if whole else log(1e-3)


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of ``FEATURES``."""
    n = len(text)

    def count(kinds: bytes) -> int:
        return n - len(text.translate(None, kinds))

    words = text.split()
    n_words = len(words)
    lines = [line for line in text.split(b"\n") if line]
    spaces = count(_SPACES)
    beyond = text.translate(None, _ASCII).decode()
    upper = count(_UPPER) + sum(map(str.isupper, beyond))
    lower = count(_LOWER) + sum(map(str.islower, beyond))
    symbols = count(_SYMBOLS)
    tally = Counter(words)
    bare = sum(c for w, c in tally.items() if not w.strip(_SYMBOLS))
    marked = sum(c for w, c in tally.items() if w[-1] in _SYMBOLS)
    return [
        log1p(n_words),
        log1p((n - spaces) / n_words) if n_words else 0.0,
        log1p(n_words / len(lines)) if lines else 0.0,
        _share(upper, upper + lower),
        _share(count(_DIGITS), n),
        _share(symbols, n),
        _share(count(_PROSE), n),
        _share(bare, n_words),
        _share(marked, n_words),
        _share(sum(map(eq, words, words[1:])), n_words),
        _share(max(tally.values(), default=0), n_words),
        log(len(tally) / sqrt(n_words)) if n_words else 0.0,
        _share(len(lines) - len(set(lines)), len(lines)),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([statistics(t or b"") for t in binary_rows(batch, "text")], float)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(rows[:, i]) for i in range(len(FEATURES)))],
            names=["doc_id", *FEATURES])


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, one column per feature) of every whole text."""
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)
    return (docs.select(F.col("doc_id").cast("long"), F.col("text"))
            .mapInArrow(_measure, schema))


def held_out(doc_id: Column) -> Column:
    digest = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    return F.coalesce(digest % HOLD_OUT == 0, F.lit(False))


@dataclass(frozen=True)
class Discriminant:
    """The fitted classes: means, Cholesky factors, log normalisers with priors."""
    means: tuple
    factors: tuple
    offsets: tuple
    constant: float | None = None       # the score where no two classes were seen

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(offset - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(measured: DataFrame, labels: DataFrame, to_pooled: float = TO_POOLED,
        to_identity: float = TO_IDENTITY) -> Discriminant:
    """Fit on every labelled row that is not held out (sums on Spark, two rows back)."""
    agreed = (labels.where("quality in (0, 1) and doc_id is not null")
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
              .where("quality = other").drop("other"))
    d = len(FEATURES)
    upper = [(i, j) for i in range(d) for j in range(i, d)]
    sums = (measured.where(~held_out(F.col("doc_id")))
            .join(agreed, "doc_id").groupBy("quality")
            .agg(F.count(F.lit(1)).alias("n"), *[F.sum(f).alias(f"s{i}")
                                                 for i, f in enumerate(FEATURES)],
                 *[F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}")
                   for i, j in upper])
            .collect())
    by_class = {row.quality: row for row in sums}
    if len(by_class) < 2:
        return Discriminant((), (), (), float(next(iter(by_class), 0.5)))
    counts, means, scatters = [], [], []
    for label in (0, 1):
        row = by_class[label]
        mean = np.array([row[f"s{i}"] for i in range(d)]) / row.n
        scatter = np.zeros((d, d))
        for i, j in upper:
            scatter[i, j] = scatter[j, i] = row[f"p{i}_{j}"] - row.n * mean[i] * mean[j]
        counts.append(row.n)
        means.append(mean)
        scatters.append(scatter)
    pooled = sum(scatters) / sum(counts)
    factors, offsets = [], []
    for n, scatter in zip(counts, scatters):
        cov = (1 - to_pooled) * scatter / n + to_pooled * pooled
        cov = ((1 - to_identity) * cov
               + to_identity * max(np.trace(cov) / d, 1e-6) * np.eye(d))
        factor = np.linalg.cholesky(cov)
        factors.append(factor)
        offsets.append(log(n / sum(counts)) - np.log(np.diag(factor)).sum())
    return Discriminant(tuple(means), tuple(factors), tuple(offsets))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(i + 1).to_numpy() for i in range(len(FEATURES))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.score(x))], names=["doc_id", "score"])
    return run


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    measured = stage(text_statistics(docs), "quality-statistics")
    model = docs.sparkSession.sparkContext.broadcast(fit(measured, labels))
    return (measured.mapInArrow(_score(model), "doc_id long, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are predicted good: fitted on all documents'
    statistics, then judged text by text where they stand, without a shuffle."""
    measured = stage(text_statistics(docs), "quality-statistics")
    shared = docs.sparkSession.sparkContext.broadcast(fit(measured, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t or b"")
                              for t in binary_rows(batch, batch.schema.names[at])], float)
                yield batch.filter(pa.array(model.score(x) >= threshold))
    return docs.mapInArrow(run, docs.schema)

"""Substring dedup by sliding sentence spans.

A text is cut into sentences. Every run of ``SENTENCES`` and more consecutive
sentences with ``MIN_WORDS`` and more words counts: what any of them covers, the
shortest ones cover too, namely the shortest from each sentence on and the shortest up to
each sentence (the former reach every sentence of a repeated run but those of its
end, the latter those). These are hashed. The hashes of all texts meet in one aggregate
that finds each run's first document, and a join marks the runs that stand elsewhere
too. Sentences covered by any run that is not its first occurrence are removed: of the
documents by id, and within a document by position.

Runs are compared by the words of their sentences (runs of characters other than
ASCII punctuation and spaces, A-Z lower-cased) through 64-bit hashes. Sentences
end at ``.``, ``!`` or ``?`` before white space, at the full stops and question and
exclamation marks of other scripts, and at line breaks; those without words count
as none.

A sentence of more than ``LONG`` words counts as several: it is cut before the word
of the least hash of every ``WINDOW`` words in a row, the last one of equals. A cut
depends on fewer than ``WINDOW`` words on either side, and no piece has more than
``WINDOW`` words, so of 51 words in a row that two long sentences share, there is
always a run of whole pieces that both have.

Defined cases: null and empty texts have no sentences; rows are documents of their own,
whatever their doc_id: those that repeat one, or have none, come after all others
(``row_ids``); texts too short for a run lose nothing; other columns pass through
``remove_repeats`` as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import (
    ROW, WORD_BYTES, alnum_words, binary_rows, record_batches, row_ids, stage,
)

SENTENCES = 2
MIN_WORDS = 20
LONG = MIN_WORDS
WINDOW = 8
LENGTH_BITS = 24        # a run as one long: its first sentence above, its length below

_OTHER_ENDS = "|".join("\u3002 \uff01 \uff1f \uff0e \uff61 \u061f \u06d4 \u0964 \u0965 \u1362 \u1367".split())
_ENDS = re.compile(rb"(?:[.!?]+(?=[ \t\r\x0b\x0c\n]|\Z)|(?:" + _OTHER_ENDS.encode() + rb")+)"
                   rb"[ \t\r\x0b\x0c]*\n*|\n+")
_WORD = re.compile(rb"[^ ]+")

RUNS = pa.schema([("doc", pa.int64()), ("span", pa.int64()), ("hash", pa.int64()),
                  ("again", pa.bool_())])
_RUNS = "doc long, span long, hash long, again boolean"


def _picked(words: list[bytes]) -> Iterator[int]:
    """The place of the word of the least hash of every ``WINDOW`` words in a row."""
    hashes = [xxhash.xxh3_64_intdigest(w) for w in words]
    least = -1
    for start in range(len(words) - WINDOW + 1):
        last = start + WINDOW - 1
        if least < start:
            window = hashes[start:last + 1]
            least = last - window[::-1].index(min(window))
        elif hashes[last] <= hashes[least]:
            least = last
        else:
            continue
        yield least


def _pieces(text: bytes, start: int, end: int,
            words: list[bytes]) -> Iterator[tuple[int, int, list[bytes]]]:
    """The sentence from ``start`` to ``end``, cut if it is long."""
    if len(words) <= LONG:
        yield start, end, words
        return
    places = [start + m.start() for m in _WORD.finditer(text[start:end].translate(WORD_BYTES))]
    cuts = [0, *(i for i in _picked(words) if i), len(words)]
    for i, j in pairwise(cuts):
        yield (places[i] if i else start, places[j] if j < len(words) else end, words[i:j])


def sentences(text: bytes) -> list[tuple[int, int, list[bytes]]]:
    """(from, to, words) of the sentences that have words, long ones in pieces; ``to``
    includes the white space after a sentence."""
    out, at = [], 0
    for end in _ENDS.finditer(text):
        words = alnum_words(text[at:end.end()])
        if words:
            out += _pieces(text, at, end.end(), words)
            at = end.end()
    words = alnum_words(text[at:])
    if words:
        out += _pieces(text, at, len(text), words)
    return out


def _shortest(ends: list[int], least: int, min_words: int) -> Iterator[tuple[int, int]]:
    """(start, stop) of the shortest run from each sentence on; ``ends``: words so far."""
    stop = 0
    for start in range(len(ends) - 1):
        stop = max(stop, start + least)
        while stop < len(ends) and ends[stop] - ends[start] < min_words:
            stop += 1
        if stop >= len(ends):
            return
        yield start, stop


def runs(parts: list[list[bytes]], least: int = SENTENCES,
         min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, int]]:
    """(start, length, hash) of the shortest runs from each sentence on and up to each
    sentence, in order."""
    ends = list(accumulate((len(words) for words in parts), initial=0))
    n, total = len(parts), ends[-1]
    back = [total - e for e in reversed(ends)]
    spans = set(_shortest(ends, least, min_words))
    spans.update((n - stop, n - start) for start, stop in _shortest(back, least, min_words))
    joined = [b" ".join(words) for words in parts]
    for start, stop in sorted(spans):
        digest = xxhash.xxh3_64_intdigest(b"\n".join(joined[start:stop]))
        yield start, stop - start, digest - (1 << 63)


def _list_runs(least: int, min_words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), binary_rows(batch, "text")):
                parts = [words for _, _, words in sentences(text or b"")]
                yield doc, len(parts), None, False
                seen = set()
                for start, length, digest in runs(parts, least, min_words):
                    yield doc, start << LENGTH_BITS | length, digest, digest in seen
                    seen.add(digest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from record_batches(rows(batches), RUNS)
    return run


def list_runs(docs: DataFrame, least: int = SENTENCES, min_words: int = MIN_WORDS) -> DataFrame:
    """Every run of every text of ``row_ids``, written: ``doc`` is the row id. A row
    without a hash per text holds its number of sentences in ``span``."""
    return stage(docs.select(F.col(ROW).alias("doc"), F.col("text"))
                 .mapInArrow(_list_runs(least, min_words), _RUNS), "sentence-runs")


def repeated_runs(listed: DataFrame) -> DataFrame:
    """(doc, span) of the runs that are not their first occurrence."""
    found = listed.where("hash is not null")
    # written: the join's sides then come straight from a shuffle each, so that AQE can
    # split the rows of a hash that very many texts hold
    shared = stage(found.where("not again").groupBy("hash")
                   .agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
                   .where("first < last").select("hash", "first"), "shared-runs")
    elsewhere = found.select("doc", "span", "hash").join(shared, "hash").where("doc <> first")
    return (elsewhere.select("doc", "span")
            .union(found.where("again").select("doc", "span")))


def _covered(spans: DataFrame) -> DataFrame:
    """(doc, gone): the sentences that the spans cover, ascending."""
    start = F.shiftright("span", LENGTH_BITS).cast("int")
    length = F.col("span").bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)).cast("int")
    # a text has each of its runs once
    return (spans.select("doc", F.sequence(start, start + length - 1).alias("s"))
            .groupBy("doc").agg(F.collect_list("s").alias("s"))
            .select("doc", F.sort_array(F.array_distinct(F.flatten("s"))).alias("gone")))


def span_report(docs: DataFrame, least: int = SENTENCES,
                min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_sentences, n_removed, removed (numbers from
    0 of the sentences with words, ascending, comma-joined)."""
    keyed = row_ids(docs.select("doc_id", "text"))
    listed = list_runs(keyed, least, min_words)
    counts = listed.where("hash is null").select("doc", F.col("span").alias("n"))
    names = keyed.select(F.col(ROW).alias("doc"), F.col("doc_id").cast("long").alias("doc_id"))
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return (names.join(counts, "doc").join(_covered(repeated_runs(listed)), "doc", "left")
            .withColumn("gone", gone)
            .select("doc_id", F.col("n").cast("long").alias("n_sentences"),
                    F.size("gone").cast("long").alias("n_removed"),
                    F.array_join("gone", ",").alias("removed")))


def remove_repeats(docs: DataFrame, least: int = SENTENCES,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` without the sentences that repeated runs cover."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = row_ids(docs.select(row, "doc_id", "text"))
    gone = _covered(repeated_runs(list_runs(keyed, least, min_words)))
    joined = (keyed.select("row", F.col(ROW).alias("doc"), F.col("text"))
              .join(gone, "doc", "left").select("row", "text", "gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, numbers in zip(binary_rows(batch, "text"), batch.column(2).to_pylist()):
                if text is not None and numbers:
                    drop = set(numbers)
                    kept, at = [], 0
                    for i, (start, end, _) in enumerate(sentences(text)):
                        if i in drop:
                            kept.append(text[at:start])
                            at = end
                    text = b"".join([*kept, text[at:]])
                texts.append(None if text is None else text.decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), batch.column(2)],
                names=batch.schema.names)
    cut = joined.mapInArrow(run, joined.schema)
    return cut.select(*[(F.col("text") if c == "text" else F.col("row")[c]).alias(c)
                        for c in docs.columns])

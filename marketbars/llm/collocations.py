"""Collocations: phrases whose words stand together far more often than apart.

Texts (A-Z lower-cased) are cut into pieces at ``[.,;:!?]`` and line breaks, and
those into words at spaces and tabs. Every word, and every phrase of up to ``longest``
words inside a piece, has a Rabin-Karp fingerprint: polynomials over a batch's bytes as
numpy prefix sums give the words' fingerprints, and polynomials over those, again as
prefix sums, the phrases' (modulo 2^64; the bases are odd, so they have inverses).

Phrases are counted by length. A batch first adds up its own equal phrases; a shuffle
aggregates by fingerprint (mixed with the language) and a second, independent fingerprint
the count and the place of an occurrence: the least hash of a text that holds the
phrase. Only phrases with ``least`` occurrences are kept, and only phrases whose two shorter
ends were kept are counted at the next length (no phrase occurs more often than its
parts). The tasks test that in a bitmap of fixed size (``bits`` bits): false positives
cost rows, never results.

The kept phrases alone are spelt out, from the texts at the places of their occurrences:
the words that give both fingerprints back there. Phrases that meet in one fingerprint are
told apart by the other, and words of over ``LONG_WORD`` bytes, among which polynomials
modulo 2^64 have known collisions, are hashed by xxHash.

Scores and the comparison of counts are integer arithmetic in decimals of 38 digits.

Defined cases: a null text is empty; a null lang is ``und``; rows that repeat a doc_id are
documents of their own (places name the text, not the id); repeated texts count as often
as they occur; a text of any length is taken whole; an empty table gives no rows; columns
other than text and lang are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import LOWER_BYTES, arrow_rows, stage

LONGEST = 4
LEAST = 30
TOP = 2000
BITS = 27               # bitmap of kept fingerprints: 2^27 bits, 16 MB
CHUNK_BYTES = 1 << 20   # texts fingerprinted at once (a longer text is taken alone)
LONG_WORD = 256
NO_LANG = "und"

PIECE_END = np.zeros(256, bool)
PIECE_END[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
BLANK = np.zeros(256, bool)
BLANK[[0x20, 0x09]] = True

_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]


def _mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on every other."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Polynomial:
    """Fingerprints of runs of a sequence: sum of value[i] x base^i, freed of the
    run's place by the base's inverse."""

    def __init__(self, base: int):
        self.base = base
        self.inverse = pow(base, -1, 1 << 64)
        self.power = self.back = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) <= n or len(self.power) > 4 * max(n, CHUNK_BYTES):
            size = 1 << n.bit_length()
            for name, step in (("power", self.base), ("back", self.inverse)):
                steps = np.full(size, step, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def runs(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._powers(len(values))
        prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.power[:len(values)], out=prefix[1:])
        return (prefix[ends] - prefix[starts]) * self.back[starts]


def _byte_values(seed: int) -> np.ndarray:
    return _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(seed))


class Fingerprints:
    """Two independent fingerprints per run of words; ``width`` cuts the first to its
    low bits (for tests of meeting fingerprints)."""

    def __init__(self, width: int = 64):
        self.bytes = [(Polynomial(_ODD[i] | 1), _byte_values(_ODD[i + 2])) for i in (0, 1)]
        self.words = [Polynomial(_ODD[i + 2] | 1) for i in (0, 1)]
        self.mask = np.uint64((1 << width) - 1)

    def of_words(self, data: np.ndarray, starts, ends) -> list[np.ndarray]:
        out = [_mix(p.runs(table[data], starts, ends) + (ends - starts).astype(np.uint64))
               for p, table in self.bytes]
        for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
            word = data[starts[i]:ends[i]].tobytes()
            for seed, words in enumerate(out):
                words[i] = xxhash.xxh64_intdigest(word, seed + 1)
        return out

    def of_phrases(self, words: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first, second) of the ``n`` words from each word on."""
        start = np.arange(max(len(words[0]) - n + 1, 0))
        a, b = (_mix(p.runs(w, start, start + n) + np.uint64(n))
                for p, w in zip(self.words, words))
        return (a & self.mask).view(np.int64), b.view(np.int64)


# ---- texts to phrases --------------------------------------------------------

class Words:
    """The words of several texts in one byte array. A line break parts the texts, so
    no phrase runs from one into another."""

    def __init__(self, texts: list[bytes], langs: list[str], keys: list[int]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        gap = PIECE_END[self.data]
        solid = ~(gap | BLANK[self.data])
        edge = np.diff(solid.view(np.int8), prepend=0, append=0)
        self.starts, self.ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        before = np.cumsum(gap)
        self.piece = before[self.starts]
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.text_start = np.cumsum(sizes) - sizes
        self.text = np.searchsorted(self.text_start, self.starts, side="right") - 1
        names = sorted(set(langs))
        self.names = np.array(names, object)
        number = {name: i for i, name in enumerate(names)}
        self.lang = np.array([number[name] for name in langs], np.int64)[self.text]
        self.keys = np.array(keys, np.int64)

    def phrases(self, n: int) -> np.ndarray:
        """Which words start a phrase of ``n`` words inside one piece."""
        if len(self.starts) < n:
            return np.zeros(0, bool)
        return self.piece[:len(self.piece) - n + 1] == self.piece[n - 1:]

    def spelt(self, at: int, n: int) -> str:
        words = (self.data[s:e].tobytes() for s, e in
                 zip(self.starts[at:at + n], self.ends[at:at + n]))
        return b" ".join(words).decode()


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Batches of (text, lang, key) as words, about CHUNK_BYTES of text at a time."""
    texts, langs, keys, size = [], [], [], 0
    for batch in batches:
        for text, lang, key in zip(*(batch.column(i) for i in range(3))):
            data = (text.as_py() or "").encode().translate(LOWER_BYTES)
            if texts and size + len(data) > CHUNK_BYTES:
                yield Words(texts, langs, keys)
                texts, langs, keys, size = [], [], [], 0
            texts.append(data)
            langs.append(lang.as_py())
            keys.append(key.as_py())
            size += len(data)
    if texts:
        yield Words(texts, langs, keys)


def _mixed(first: np.ndarray, names: list[str] | np.ndarray, lang: np.ndarray) -> np.ndarray:
    """Fingerprints mixed with their language (a place in ``names``)."""
    own = np.array([xxhash.xxh64_intdigest(name.encode()) for name in names], np.uint64)
    return first.view(np.uint64) * np.uint64(_ODD[0]) ^ own[lang]


class Kept:
    """A bitmap of fingerprints: every one that was added is found."""

    def __init__(self, bits: int):
        self.words = np.zeros(1 << bits - 6, np.uint64)
        self.mask = np.uint64((1 << bits) - 1)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = _mix(keys) & self.mask
        return (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)

    def add(self, keys: np.ndarray) -> None:
        word, bit = self._places(keys)
        np.bitwise_or.at(self.words, word, np.uint64(1) << bit)

    def has(self, keys: np.ndarray) -> np.ndarray:
        word, bit = self._places(keys)
        return (self.words[word] >> bit) & np.uint64(1) == 1


def _parts(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Kept(bits)
        for batch in batches:
            own.add(batch.column(0).to_numpy().view(np.uint64))
        at = np.flatnonzero(own.words)
        for i in range(0, len(at), 10_000):
            yield pa.RecordBatch.from_pydict({
                "at": pa.array(at[i:i + 10_000]),
                "word": pa.array(own.words[at[i:i + 10_000]].view(np.int64))})
    return run


def kept_bitmap(rows: DataFrame, bits: int = BITS) -> Kept:
    """Bitmap of the fingerprints of ``rows(fp)``: every task makes its own, a
    shuffle joins them by word, and the driver gets the result of 2^bits bits."""
    words = (rows.select("fp").mapInArrow(_parts(bits), "at long, word long")
             .groupBy("at").agg(F.bit_or("word").alias("word")).toArrow())
    out = Kept(bits)
    out.words[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return out


# ---- counting ----------------------------------------------------------------

_COUNTED = "fp long, second long, a long, text_key long"
_SPELT = "lang string, n int, phrase string, a long"


def _occurrences(chunk: Words, prints: Fingerprints, n: int, kept: Kept | None):
    """(word, fingerprint with the language, second one) of the phrases of ``n`` words that
    may be frequent."""
    words = prints.of_words(chunk.data, chunk.starts, chunk.ends)
    some = chunk.phrases(n)
    if kept is not None and some.any():
        shorter = prints.of_phrases(words, n - 1)[0]
        there = kept.has(_mixed(shorter, chunk.names, chunk.lang[:len(shorter)]))
        some &= there[:len(some)] & there[1:len(some) + 1]
    first, second = prints.of_phrases(words, n)
    at = np.flatnonzero(some)
    return at, _mixed(first[at], chunk.names, chunk.lang[at]).view(np.int64), second[at]


def _count(n: int, shared, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints, kept = Fingerprints(width), shared.value if shared is not None else None
        for chunk in _chunks(batches):
            at, first, second = _occurrences(chunk, prints, n, kept)
            if not len(at):
                continue
            # equal fingerprints next to each other
            order = np.lexsort((second, first))
            at, first, second = at[order], first[order], second[order]
            cut = np.flatnonzero(np.append(True, (first[1:] != first[:-1])
                                           | (second[1:] != second[:-1])))
            yield pa.RecordBatch.from_pydict({
                "fp": pa.array(first[cut]), "second": pa.array(second[cut]),
                "a": pa.array(np.diff(np.append(cut, len(first)))),
                "text_key": pa.array(np.minimum.reduceat(chunk.keys[chunk.text[at]], cut))})
    return run


def _texts(docs: DataFrame) -> DataFrame:
    """(text, lang, hash of both)."""
    lang = F.coalesce("lang", F.lit(NO_LANG)).alias("lang")
    return docs.select(F.col("text"), lang, F.xxhash64("text", lang).alias("text_key"))


def count_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
                  bits: int = BITS, width: int = 64) -> DataFrame:
    """(n, fp, second, a, text_key): the fingerprints of the phrases of 1 to ``longest``
    words with ``least`` occurrences, their counts and a text that holds them."""
    spark = docs.sparkSession
    texts, shared, levels = _texts(docs), None, []
    for n in range(1, longest + 1):
        # columns of fixed width: Spark aggregates them by hash, first in the map tasks
        rows = (texts.mapInArrow(_count(n, shared, width), _COUNTED)
                .groupBy("fp", "second").agg(F.sum("a").alias("a"),
                                             F.min("text_key").alias("text_key"))
                .where(F.col("a") >= least).withColumn("n", F.lit(n)))
        levels.append(stage(rows, f"phrases-{n}"))
        if shared is not None:
            shared.destroy()
            shared = None
        if n < longest:
            shared = spark.sparkContext.broadcast(kept_bitmap(levels[-1], bits))
    counted = levels[0]
    for level in levels[1:]:
        counted = counted.unionByName(level)
    return counted


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches):
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array(chunk.names, pa.string()),
            "n": pa.array(np.bincount(chunk.lang, minlength=len(chunk.names)).astype(np.int64))})


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, n): all words of each language."""
    return (_texts(docs).mapInArrow(_totals, "lang string, n long")
            .groupBy("lang").agg(F.sum("n").alias("n")))


# ---- spelling ----------------------------------------------------------------

def _spell(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prints = Fingerprints(width)
        for batch in batches:
            out = []
            for text, lang, phrases in zip(*(batch.column(i) for i in range(3))):
                data = text.as_py().encode().translate(LOWER_BYTES)
                chunk = Words([data], [lang.as_py()], [0])
                wanted: dict[int, dict] = {}
                for p in phrases.as_py():
                    wanted.setdefault(p["n"], {})[p["fp"], p["second"]] = p["a"]
                for n, counts in wanted.items():
                    at, first, second = _occurrences(chunk, prints, n, None)
                    some = np.flatnonzero(np.isin(first, [fp for fp, _ in counts]))
                    for i in some.tolist():
                        a = counts.pop((int(first[i]), int(second[i])), None)
                        if a is not None:
                            out.append((lang.as_py(), n, chunk.spelt(int(at[i]), n), a))
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(
                    ("lang", "n", "phrase", "a"),
                    (pa.array(c, t) for c, t in zip(zip(*out), (
                        pa.string(), pa.int32(), pa.string(), pa.int64()))))))
    return run


def spell_phrases(docs: DataFrame, counted: DataFrame, width: int = 64) -> DataFrame:
    """(lang, n, phrase, a) of the counted fingerprints."""
    places = stage(counted.groupBy("text_key")      # a text's own frequent phrases
                   .agg(F.collect_list(F.struct("n", "fp", "second", "a")).alias("phrases")),
                   "places")                        # of known size: small, it is broadcast
    # equal texts give equal phrases: one of them stays
    spelt = (_texts(docs.where("text IS NOT NULL")).join(places, "text_key")
             .groupBy("text_key").agg(F.any_value("text").alias("text"),
                                      F.any_value("lang").alias("lang"),
                                      F.any_value("phrases").alias("phrases"))
             .select("text", "lang", "phrases").mapInArrow(_spell(width), _SPELT))
    return stage(spelt, "spelt")


# ---- scoring -----------------------------------------------------------------

def score_phrases(totals: DataFrame, phrases: DataFrame, longest: int = LONGEST,
                  top: int = TOP) -> DataFrame:
    """The first ``top`` collocations of each language from the counts of its phrases.

    Phrases are many fewer than the corpus's words; the joins are by language and text,
    in which every row is another phrase, so a language of most rows is no hot key."""
    words = F.split("phrase", " ")
    parts = phrases.withColumn("words", words)

    def joined(first: Column | int, size: Column | int) -> Column:
        return F.array_join(F.slice("words", first, size), " ")
    cuts = (parts.where("n > 1")
            .select("lang", "n", "phrase", "a", "words",
                    F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
            .select("lang", "n", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("left"),
                    joined(F.col("k") + 1, F.col("n") - F.col("k")).alias("right")))
    known = phrases.select("lang", "phrase", "a")
    both = (cuts.join(known.toDF("lang", "left", "l"), ["lang", "left"])
            .join(known.toDF("lang", "right", "r"), ["lang", "right"]))
    score = F.expr("cast(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0)) "
                   "div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    lowest = (both.withColumn("score", score)
              .groupBy("lang", "n", "phrase", "a")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    # the shorter phrases inside every candidate
    inside = (parts.where("n > 2")
              .select("lang", F.col("a").alias("longer"), "n", "words",
                      F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("size"))
              .select("lang", "longer", "words", "size",
                      F.explode(F.sequence(F.lit(1), F.col("n") - F.col("size") + 1)).alias("i"))
              .select("lang", "longer", joined(F.col("i"), F.col("size")).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    covered = F.expr("cast(100 as decimal(3,0)) * cast(longer as decimal(20,0)) >= "
                     "cast(80 as decimal(3,0)) * cast(a as decimal(20,0))")
    own = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (lowest.join(inside, ["lang", "phrase"], "left")
              .where(~F.coalesce(covered, F.lit(False)))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
              .withColumn("rank", F.row_number().over(own))
              .where(F.col("rank") <= top))        # limited per language before the shuffle too
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"),
                                              "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP,
                 bits: int = BITS, width: int = 64) -> DataFrame:
    """The ``top`` collocations of each language of ``docs(text, lang)``: lang, rank,
    phrase, a, l and r (of the lowest-scoring cut), n, score."""
    with arrow_rows(docs.sparkSession):
        totals = stage(count_words(docs), "word-totals")
        phrases = spell_phrases(docs, count_phrases(docs, longest, least, bits, width), width)
    return score_phrases(totals, phrases, longest, top)

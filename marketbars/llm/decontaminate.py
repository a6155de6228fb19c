"""Benchmark decontamination with a generalised suffix automaton.

The words of all test items form one automaton that knows every run of words of
every item. A training text streams through it word by word; the automaton
tracks the longest run of words, ending here, that some item holds. Where that
length reaches a window (``min_words`` words, or a whole shorter item), the words
of the run are hit. The states that hold a window also name the items it is of.

The items are read in blocks of at most ``BLOCK_WORDS`` words; each block's
automaton is built once, broadcast, and every text streams through it; with
several blocks the scan repeats, one block at a time. Texts are never shuffled.

Words are the runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z.

Defined cases: null and wordless texts and items have no words, no hits and no
windows; rows that repeat an id are separate; repeated items are all named; an
item with a null id is matched, but not named; empty tables give no hits;
columns other than the id and the text pass through ``remove_spans`` as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import WORD_BYTES, alnum_words, binary_rows, stage

MIN_WORDS = 10
MAX_COVERAGE = 0.5              # a text with more of its words hit is removed whole
BLOCK_WORDS = 200_000           # words of one automaton (about 100 MB in a task)


class SuffixAutomaton:
    """Generalised suffix automaton over the words of (item_id, words) pairs."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], min_words: int = MIN_WORDS):
        self.min_words = min_words
        self.shortest = min([min(len(w), min_words) for _, w in items if w], default=0)
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        # the items of every state whose strings include a window's
        self.named: dict[int, set[str]] = {}
        self.whole: dict[int, int] = {}         # state of a short item -> its words
        for item_id, words in items:
            if not words:
                continue
            if len(words) < min_words:
                state = 0
                for word in words:
                    state = self.next[state][word]
                self.whole[state] = len(words)
                self._name(state, item_id)
            else:
                for state, _ in self._windows(words):
                    self._name(state, item_id)
        # nearest short item that ends where a state's strings end
        self.short = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            self.short[state] = (state if state in self.whole
                                 else self.short[self.link[state]] if self.link[state] > 0 else -1)

    def _name(self, state: int, item_id: str | None) -> None:
        names = self.named.setdefault(state, set())
        if item_id is not None:
            names.add(item_id)

    def _extend(self, last: int, word: bytes) -> int:
        there = self.next[last].get(word)
        if there is not None:
            if self.length[there] == self.length[last] + 1:
                return there
            return self._split(last, word, there)
        new = self._state(self.length[last] + 1, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at < 0:
            self.link[new] = 0
        else:
            there = self.next[at][word]
            self.link[new] = (there if self.length[there] == self.length[at] + 1
                              else self._split(at, word, there))
        return new

    def _state(self, length: int, edges: dict[bytes, int]) -> int:
        self.next.append(edges)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, at: int, word: bytes, there: int) -> int:
        copy = self._state(self.length[at] + 1, dict(self.next[there]))
        self.link[copy] = self.link[there]
        self.link[there] = copy
        while at >= 0 and self.next[at].get(word) == there:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int, int]]:
        """(position, state, longest matching length) of the words that match."""
        nexts, link, lengths = self.next, self.link, self.length
        known = nexts[0]
        state = length = 0
        for i, word in enumerate(words):
            if word not in known:
                state = length = 0
                continue
            there = nexts[state].get(word)
            while there is None:
                state = link[state]
                length = lengths[state]
                there = nexts[state].get(word)
            state = there
            length += 1
            yield i, state, length

    def _windows(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(state of the last ``min_words`` words, position) where they match."""
        link, lengths, n = self.link, self.length, self.min_words
        for i, state, length in self.matches(words):
            if length >= n:
                while lengths[link[state]] >= n:
                    state = link[state]
                yield state, i

    def findings(self, words: list[bytes]) -> tuple[np.ndarray | None, set[str]]:
        """Which words are hit (None: no word), and the items with a window here."""
        if not self.shortest or len(words) < self.shortest or not self._runs(words):
            return None, set()
        hit, items = None, set()
        n, link, lengths, short = self.min_words, self.link, self.length, self.short
        for i, state, length in self.matches(words):
            if length >= n:
                if hit is None:
                    hit = np.zeros(len(words), bool)
                hit[i - length + 1:i + 1] = True
                window = state
                while lengths[link[window]] >= n:
                    window = link[window]
                items |= self.named.get(window, set())
            if self.whole:
                # a state longer than the match holds strings that are not here
                at = state if lengths[state] <= length else link[state]
                at = short[at] if at > 0 else -1
                while at > 0:
                    if hit is None:
                        hit = np.zeros(len(words), bool)
                    hit[i - lengths[at] + 1:i + 1] = True
                    items |= self.named[at]
                    at = short[link[at]] if link[at] > 0 else -1
        return hit, items

    def _runs(self, words: list[bytes]) -> bool:
        """Whether ``shortest`` words in a row are words of the items at all."""
        known, run, least = self.next[0], 0, self.shortest
        for word in words:
            if word in known:
                run += 1
                if run >= least:
                    return True
            else:
                run = 0
        return False


def automaton_blocks(items: DataFrame, min_words: int, id_col: str = "item_id",
                     text_col: str = "text") -> Iterator[SuffixAutomaton]:
    """Automata of the items, fetched one partition at a time, in bounded blocks."""
    held, size = [], 0
    rows = (items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
            .where("t is not null"))
    for row in rows.toLocalIterator():
        words = alnum_words(row.t.encode())
        if words:
            held.append((row.i, words))
            size += len(words)
        if size >= BLOCK_WORDS:
            yield SuffixAutomaton(held, min_words)
            held, size = [], 0
    if held:
        yield SuffixAutomaton(held, min_words)


def _broadcast_blocks(items: DataFrame, min_words: int) -> Iterator:
    """The blocks' automata, broadcast one after the other: (automaton, is last)."""
    sc = items.sparkSession.sparkContext
    held = None
    for automaton in automaton_blocks(items, min_words):
        if held is not None:
            yield held, False
        held = sc.broadcast(automaton)
    if held is not None:
        yield held, True


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            lengths, counts, hits, names = [], [], [], []
            for text, before, listed in zip(binary_rows(batch, "text"),
                                            _column(batch, "hits").to_pylist(),
                                            _column(batch, "items").to_pylist()):
                words = alnum_words(text) if text else []
                hit, items = automaton.findings(words)
                if before is not None:
                    old = np.unpackbits(np.frombuffer(before, np.uint8),
                                        count=len(words)).astype(bool)
                    hit = old if hit is None else hit | old
                lengths.append(len(words))
                counts.append(0 if hit is None else int(hit.sum()))
                hits.append(None if hit is None else np.packbits(hit).tobytes())
                names.append(sorted(items.union(listed or ())))
            changed = {"n_words": pa.array(lengths, pa.int64()),
                       "n_hit": pa.array(counts, pa.int64()),
                       "hits": pa.array(hits, pa.binary()),
                       "items": pa.array(names, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays(
                [changed.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)],
                names=batch.schema.names)
    return run


def find_leaks(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per text: doc_id, n_words, n_hit, hits (a bit per word, first word highest;
    null if none is hit), items (sorted ids, as strings)."""
    schema = ("doc_id long, text string, n_words long, n_hit long, hits binary, "
              "items array<string>")
    state = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).alias("text"),
                        F.lit(0).cast("long").alias("n_words"),
                        F.lit(0).cast("long").alias("n_hit"),
                        F.lit(None).cast("binary").alias("hits"),
                        F.lit(None).cast("array<string>").alias("items"))
    scanned = False
    for shared, last in _broadcast_blocks(items, min_words):
        state, scanned = state.mapInArrow(_scan(shared), schema), True
        if not last:                # a task holds one block's automaton at a time
            state = stage(state, "leaks")
    if not scanned:                 # no items: count the words all the same
        empty = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton([], min_words))
        state = state.mapInArrow(_scan(empty), schema)
    return state.drop("text")


def leak_digest(leaks: DataFrame) -> DataFrame:
    """The digest columns of ``find_leaks``: counts, the items' SHA-256, the verdict."""
    return leaks.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        F.col("hits").isNotNull().alias("contaminated"))


def cut_hits(text: bytes, automaton: SuffixAutomaton) -> tuple[bytes, int]:
    """``text`` without its hit spans, and the words cut.

    A span runs from its first word to the end of its last. Cutting is repeated
    until no window is left, as the words around a cut can form a new one.
    """
    cut = 0
    while True:
        words = alnum_words(text)
        hit, _ = automaton.findings(words)
        if hit is None:
            return text, cut
        cut += int(hit.sum())
        marked = text.translate(WORD_BYTES)
        kept, copied, end = [], 0, 0
        for i, word in enumerate(words):
            start = marked.index(word, end)
            end = start + len(word)
            if hit[i]:
                if not i or not hit[i - 1]:
                    kept.append(text[copied:start])
                copied = end
        kept.append(text[copied:])
        text = b"".join(kept)


def _cut(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            done = [(None, 0) if t is None else cut_hits(t, automaton)
                    for t in binary_rows(batch, "text")]
            texts = pa.array([None if t is None else t.decode() for t, _ in done], pa.string())
            cut = pc.add(_column(batch, "cut"), pa.array([n for _, n in done], pa.int64()))
            words = pa.array([len(alnum_words(t)) if t else 0
                              for t in binary_rows(batch, "text")], pa.int64())
            total = pc.if_else(pc.less(_column(batch, "total"), 0), words,
                               _column(batch, "total"))
            changed = {"text": texts, "cut": cut, "total": total}
            yield pa.RecordBatch.from_arrays(
                [changed.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)],
                names=batch.schema.names)
    return run


def remove_spans(docs: DataFrame, items: DataFrame, min_words: int = MIN_WORDS,
                 max_coverage: float = MAX_COVERAGE, text_col: str = "text",
                 chars_col: str | None = None) -> DataFrame:
    """``docs`` without the spans that items hold too, and without the texts of
    which more than ``max_coverage`` of the words lie in such spans; ``chars_col``
    gets the new length of a text that was cut."""
    names = docs.columns
    state = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                        F.col(f"`{text_col}`").alias("text"),
                        F.lit(0).cast("long").alias("cut"), F.lit(-1).cast("long").alias("total"))
    schema = state.schema
    while True:
        before = state
        blocks = 0
        for shared, last in _broadcast_blocks(items, min_words):
            blocks += 1
            state = state.mapInArrow(_cut(shared), schema)
            if not (last and blocks == 1):
                state = stage(state, "cut")
        if blocks <= 1 or not _cut_more(before, state):
            break                   # several blocks: until none cuts any more
    kept = state.where((F.col("cut") <= F.col("total") * F.lit(max_coverage))
                       | (F.col("cut") == 0))
    new = {text_col: F.col("text")}
    if chars_col:
        new[chars_col] = (F.when(F.col("cut") > 0, F.length("text"))
                          .otherwise(F.col("row")[chars_col])
                          .cast(docs.schema[chars_col].dataType))
    return kept.select(*[new.get(c, F.col("row")[c]).alias(c) for c in names])


def _cut_more(before: DataFrame, after: DataFrame) -> bool:
    total = F.coalesce(F.sum("cut"), F.lit(0)).alias("n")
    return before.agg(total).first().n != after.agg(total).first().n

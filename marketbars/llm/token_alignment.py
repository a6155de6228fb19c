"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut the bytes of a space and the text. An A and a B token are linked
where their byte ranges overlap; the linked tokens' groups are the stretches between
offsets at which a token of both ends. Groups come by pointer jumping: every token
points to the token that overlaps it and ends farthest to the right, and doubling the
successors (``next = next[next]``) takes every token to its group's last one in as many
rounds as the logarithm of the longest group. A whole batch of documents is
aligned in one set of arrays.

How many documents hold a pair of ids linked is counted over the corpus, and every
document is told what its links' counts add up to and how many of them are their A id's
most frequent. The tokens are made once: each document's distinct pairs are written to the
shared folder, counted by a shuffle, and met again by the counts. The table of counts goes
to every task as sorted arrays while it has at most ``most_pairs`` rows (16 bytes each);
beyond that, pairs and counts are joined by a shuffle.

Defined cases: texts that are null, empty or not given back byte for byte by both
tokenizers (a piece normalised away, say) have no tokens: zeros and an empty digest. Special
tokens' strings inside a text are plain text. Rows are documents: rows that repeat a
doc_id, or have none, count and are returned each for itself. An empty table gives no
rows; columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketbars.llm.common import arrow_rows, stage
from marketbars.llm.token_files import Encoder, _byte_level

MOST_PAIRS = 4_000_000
BATCH_BYTES = 1 << 20       # texts aligned at once (a longer text is taken alone)
SHIFT = 32                  # a pair of ids as one long: A id above, B id below

ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, pairs array<long>, times array<int>")
_ALIGNED = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                      ("n_groups", pa.int64()), ("n_links", pa.int64()),
                      ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int64())),
                      ("times", pa.list_(pa.int32()))])
REPORT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


# ---- tokens ------------------------------------------------------------------

class Tokens:
    """Texts to ids, and ids to the bytes they stand for, by both tokenizers."""

    def __init__(self, byte_level_file: str, pieces_file: str):
        import sentencepiece
        self.a = Encoder(byte_level_file)
        self.a.tokenizer.encode_special_tokens = True
        shown = {chr(c): b for b, c in _byte_level().items()}
        own = self.a.tokenizer
        vocabulary = own.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = (bytes(shown[c] for c in token) if all(c in shown for c in token)
                               else token.encode())
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = _sizes(self.a_bytes), _sizes(self.b_bytes)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[1:-1], 16)])
        return piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
        """A and B ids per text; None where they don't spell a space and the text."""
        for text, b_ids in zip(texts, self.b.encode(texts, num_threads=1)):
            data = b" " + text.encode()
            if not text or b"".join(map(self.b_bytes.__getitem__, b_ids)) != data:
                yield None
                continue
            a_ids = np.frombuffer(self.a.encode(" " + text), "<u4").astype(np.int64)
            if self._spells(a_ids, data):
                yield a_ids, np.array(b_ids, np.int64)
            else:
                yield None

    def _spells(self, a_ids: np.ndarray, data: bytes) -> bool:
        """Byte-level BPE without a normaliser writes every byte as one character and
        joins neighbours: its tokens spell the text if they have its length."""
        if self.a.by_piece:
            return int(self.a_size[a_ids].sum()) == len(data)
        return b"".join(map(self.a_bytes.__getitem__, a_ids.tolist())) == data


@lru_cache(maxsize=2)
def tokens(byte_level_file: str, pieces_file: str) -> Tokens:
    return Tokens(byte_level_file, pieces_file)


# ---- alignment ---------------------------------------------------------------

def ended(ends: np.ndarray) -> np.ndarray:
    """By offset: how many tokens have ended there or before."""
    marks = np.zeros(int(ends[-1]) + 1 if len(ends) else 1, np.int64)
    marks[ends] = 1
    return np.cumsum(marks)


def group_labels(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A and each B token, named by the B token that ends it. The
    ends ascend and finish at the same offset."""
    n_a = len(a_ends)
    over_a = ended(b_ends)[a_ends - 1]      # the B token holding an A token's last byte
    over_b = ended(a_ends)[b_ends - 1]
    own = np.arange(len(b_ends))
    # an A token's farthest-right overlap is that B token; a B token's is the A token
    # holding its last byte, if that one ends later, else the B token itself
    after = np.concatenate([n_a + over_a, np.where(a_ends[over_b] > b_ends, over_b, n_a + own)]) \
        if n_a else np.empty(0, np.int64)
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after[:n_a] - n_a, after[n_a:] - n_a
        after = further


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of every overlap of byte ranges, by A token."""
    before = ended(b_ends)
    first = before[np.concatenate([[0], a_ends[:-1]])]
    n = before[a_ends - 1] - first + 1
    a = np.repeat(np.arange(len(a_ends)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)


class Spelling:
    """Ids as decimal text with what follows them in a digest: a comma inside a group's
    side, a bar after its A ids, a semicolon after its B ids; a row of bytes each."""

    def __init__(self, a_ids: int, b_ids: int):
        self.a_ids, self.b_ids, self.b_start = a_ids, b_ids, 2 * a_ids
        text = [f"{i}{end}".encode() for ends, n in ((",|", a_ids), (",;", b_ids))
                for end in ends for i in range(n)]
        self.size = np.array([len(t) for t in text], np.int64)
        width = int(self.size.max())
        self.table = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in text),
                                   np.uint8).reshape(-1, width)

    def codes(self, a_ids, b_ids, a_label, b_label) -> np.ndarray:
        """All tokens, group by group with the A tokens first, as places in ``text``."""
        a_last = np.append(a_label[1:] != a_label[:-1], True)
        b_last = np.append(b_label[1:] != b_label[:-1], True)
        # labels are the places of the B tokens that end a group
        b_before = np.concatenate([[0], np.flatnonzero(b_last) + 1])    # by group
        a_before = np.concatenate([[0], np.flatnonzero(a_last) + 1])
        a_group = np.cumsum(a_last) - a_last
        b_group = np.cumsum(b_last) - b_last
        out = np.empty(len(a_ids) + len(b_ids), np.int64)
        out[np.arange(len(a_ids)) + b_before[a_group]] = a_ids + self.a_ids * a_last
        out[np.arange(len(b_ids)) + a_before[b_group + 1]] = (
            self.b_start + b_ids + self.b_ids * b_last)
        return out

    def spelt(self, codes: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """``a1,a2|b1;a3|b2,b3;`` of all documents, and where each code ends in it."""
        wide = self.table[codes]
        return memoryview(wide[wide != 0]), np.cumsum(self.size[codes])


def align(coded: list[tuple[np.ndarray, np.ndarray] | None], a_size: np.ndarray,
          b_size: np.ndarray, spelling: Spelling) -> list[tuple]:
    """Per document: n_a, n_b, n_groups, n_links, digest, distinct pairs, their times.
    ``a_size``, ``b_size``: bytes of every id."""
    held = [c for c in coded if c is not None]
    if not held:
        return [(0, 0, 0, 0, "", [], [])] * len(coded)
    a_ids, b_ids = (np.concatenate([c[i] for c in held]) for i in (0, 1))
    # one run of offsets for all documents: every document ends at an end of both
    a_ends, b_ends = np.cumsum(a_size[a_ids]), np.cumsum(b_size[b_ids])
    a_cut = np.cumsum([0, *(len(a) for a, _ in held)])
    b_cut = np.cumsum([0, *(len(b) for _, b in held)])
    a_label, b_label = group_labels(a_ends, b_ends)
    a, b = overlaps(a_ends, b_ends)
    link_cut = np.searchsorted(a, a_cut)
    pairs = (a_ids[a] << SHIFT) | b_ids[b]
    text, ends = spelling.spelt(spelling.codes(a_ids, b_ids, a_label, b_label))
    text_cut = np.concatenate([[0], ends[a_cut[1:] + b_cut[1:] - 1]])
    out, k = [], 0
    for c in coded:
        if c is None:
            out.append((0, 0, 0, 0, "", [], []))
            continue
        mine, times = np.unique(pairs[link_cut[k]:link_cut[k + 1]], return_counts=True)
        gb = b_label[b_cut[k]:b_cut[k + 1]]
        out.append((len(c[0]), len(c[1]), int(np.count_nonzero(gb[1:] != gb[:-1])) + 1,
                    int(link_cut[k + 1] - link_cut[k]),
                    hashlib.sha256(text[text_cut[k]:text_cut[k + 1] - 1]).hexdigest(), mine, times))
        k += 1
    return out


def _sizes(spelt: list[bytes]) -> np.ndarray:
    return np.array([len(data) for data in spelt], np.int64)


def _some(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows with about BATCH_BYTES of text."""
    held, size, first = [], 0, 0
    for i, text in enumerate(texts):
        value = text.as_py() or ""
        if held and size + len(value) > BATCH_BYTES:
            yield first, held
            held, size, first = [], 0, i
        held.append(value)
        size += len(value)
    if held:
        yield first, held


def _align(byte_level_file: str, pieces_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokens(byte_level_file, pieces_file)
        a_size, b_size = both.a_size, both.b_size
        spelling = Spelling(len(a_size), len(b_size))
        for batch in batches:
            for first, texts in _some(batch.column(1)):
                rows = align(list(both.encode(texts)), a_size, b_size, spelling)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)).cast(pa.int64())]
                    + [pa.array(c, type=f.type) for c, f in zip(columns, list(_ALIGNED)[1:])],
                    schema=_ALIGNED)
    return run


def align_texts(docs: DataFrame, byte_level_file: str, pieces_file: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and the distinct
    linked pairs of ids (A id x 2^32 + B id) with their times in the document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return rows.mapInArrow(_align(byte_level_file, pieces_file), ALIGNED)


# ---- counts over the corpus --------------------------------------------------

def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many rows a pair of ids is linked, and whether no
    pair of its A id is in more."""
    counts = (aligned.select(F.explode("pairs").alias("pair"))
              .groupBy("pair").agg(F.count(F.lit(1)).alias("docs")))
    a_id = F.shiftright("pair", SHIFT)
    # an A id has at most as many pairs as B has ids
    top = counts.groupBy(a_id.alias("a")).agg(F.max("docs").alias("top"))
    return (counts.withColumn("a", a_id).join(top, "a")
            .select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")))


def _look_up(shared):
    schema = pa.schema([*[_ALIGNED.field(c) for c in REPORT[:5]], ("n_best", pa.int64()),
                        ("count_sum", pa.int64()), _ALIGNED.field("groups_sha256")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, docs, best = (np.frombuffer(b, t) for b, t in zip(shared.value, ("<i8", "<i8", "?")))
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            lengths = pairs.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.searchsorted(known, pairs.flatten().to_numpy())
            n = times.flatten().to_numpy().astype(np.int64)
            ends = np.cumsum(lengths)

            def per_row(values, ends=ends, lengths=lengths):
                total = np.concatenate([[0], np.cumsum(values)])
                return pa.array(total[ends] - total[ends - lengths])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in REPORT[:5]], per_row(n * best[place]),
                 per_row(n * docs[place]), batch.column("groups_sha256")], schema=schema)
    return run


def alignment_report(docs: DataFrame, byte_level_file: str, pieces_file: str,
                     most_pairs: int = MOST_PAIRS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose
    pair's count is the highest of its A id), count_sum (over the links),
    groups_sha256."""
    spark = docs.sparkSession
    aligned = stage(align_texts(docs, byte_level_file, pieces_file), "aligned")
    counts = stage(pair_counts(aligned), "pair-counts")
    if counts.count() <= most_pairs:
        table = counts.orderBy("pair").toArrow()        # at most most_pairs rows
        columns = [np.ascontiguousarray(table.column(c).to_numpy().astype(t)).tobytes()
                   for c, t in (("pair", "<i8"), ("docs", "<i8"), ("best", "?"))]
        shared = spark.sparkContext.broadcast(columns)
        with arrow_rows(spark):
            return aligned.mapInArrow(_look_up(shared), ", ".join(
                f"{c} string" if c == "groups_sha256" else f"{c} long" for c in REPORT))
    return _joined(aligned, counts)


def _joined(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The same by a shuffle of the pairs; rows carry a key, as ids may repeat."""
    keyed = stage(aligned.withColumn("row", F.monotonically_increasing_id()), "aligned-rows")
    links = (keyed.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p"))
             .select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("n")))
    found = (links.join(counts, "pair").groupBy("row")
             .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
                  F.sum(F.col("n") * F.col("docs")).alias("count_sum")))
    none = F.lit(0).cast("long")
    return (keyed.join(found, "row", "left")
            .withColumns({c: F.coalesce(c, none) for c in ("n_best", "count_sum")})
            .select(*REPORT))

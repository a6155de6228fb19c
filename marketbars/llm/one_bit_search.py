"""Approximate nearest neighbours on randomly rotated one-bit codes.

A vector's unit direction is rotated by a fixed random rotation and kept as the
signs of its components, packed into bits, with one correction scalar: the inner
product of the rotated direction with its own sign vector. For a query the
packed bits and the scalar give an unbiased estimate of the cosine and a bound
on its error; a vector is reranked, with the exact cosine of the original
vectors in double precision, when its estimate plus bound reaches the k-th best
exact cosine found so far.

The index is a table (vec_id, vector, code, correction), written to the shared
folder: every row is indexed, nothing is fitted on a sample. Queries go in
blocks of bounded bytes, each broadcast to the index's partitions; a partition
keeps k candidates per query, and the partitions' candidates are merged by a
ranked window that cuts to k before its shuffle. Of equal vectors the index
keeps the k + 1 smallest ids, as no query can need more.

Defined cases: null, zero, null-holding and non-finite vectors take no part;
vectors meet only vectors of their own length; ties go to the smaller id; a
repeated id counts with its best score, and is no candidate of a query of that id; fewer than k candidates give fewer rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import record_batches, stage

BOUND = 2.5                     # width of the error bound, in its standard units
QUERY_BLOCK_BYTES = 8 << 20     # vectors of one broadcast block
CHUNK = 2048                    # index rows scored at once
QUERIES_AT_ONCE = 512
SEED = 20240917

HITS = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


@lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    """The same random orthogonal matrix in every task."""
    gauss = np.random.default_rng(SEED + dim).standard_normal((dim, dim))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col("v")
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x)
                       | (F.abs(x) == F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                           F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite
                   & F.exists(v, lambda x: x != 0)))


def encode(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit rows, and each row's correction."""
    unit = _unit(matrix)
    turned = unit @ rotation(matrix.shape[1])
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(matrix.shape[1])


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def estimate(codes: np.ndarray, corrections: np.ndarray,
             turned_queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (queries x rows) and the bound on each row's error."""
    dim = turned_queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    flat = turned_queries.astype(np.float32) @ signs.T / np.float32(np.sqrt(dim))
    error = BOUND * np.sqrt(np.maximum(1 - corrections ** 2, 0) / corrections ** 2
                            / max(dim - 1, 1))
    return flat / corrections.astype(np.float32), error.astype(np.float32)


def exact_cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, always summed in the same order: equal vectors score equally."""
    return ((a * b).sum(axis=1)
            / np.sqrt((a * a).sum(axis=1)) / np.sqrt((b * b).sum(axis=1)))


def _matrix(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _by_length(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    lengths = np.array([len(v) for v in batch.column(1)])
    for dim in np.unique(lengths):
        if dim:
            yield batch.filter(pa.array(lengths == dim))


def _encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _by_length(batch):
            codes, corrections = encode(_matrix(part.column(1)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(corrections)],
                names=["vec_id", "v", "code", "correction"])


def build_index(vectors: DataFrame, id_col: str, vec_col: str, k: int) -> DataFrame:
    """The stored index of all usable vectors."""
    alike = Window.partitionBy("v").orderBy("vec_id")
    kept = (usable(vectors, id_col, vec_col).distinct()
            .withColumn("place", F.row_number().over(alike))
            .where(F.col("place") <= k + 1).drop("place"))
    return stage(kept.mapInArrow(
        _encode_batches, "vec_id long, v array<double>, code binary, correction double"),
        "one-bit-index")


class _Best:
    """The k best candidates of every query of one length."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int):
        self.ids, self.matrix, self.k = ids, matrix, k
        self.turned = _unit(matrix) @ rotation(matrix.shape[1])
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, ids, matrix, codes, corrections) -> None:
        for q0 in range(0, len(self.ids), QUERIES_AT_ONCE):
            rows = slice(q0, q0 + QUERIES_AT_ONCE)
            guess, error = estimate(codes, corrections, self.turned[rows])
            top = np.argpartition(-guess, min(self.k, guess.shape[1] - 1), axis=1)[:, :self.k + 1]
            # the best guesses first, to raise the bar; then all that may pass it
            first = np.zeros(guess.shape, bool)
            np.put_along_axis(first, top, True, axis=1)
            self._rerank(q0, first, ids, matrix)
            bar = self.scores[rows, -1].astype(np.float32) - np.float32(1e-6)
            self._rerank(q0, (guess + error >= bar[:, None]) & ~first, ids, matrix)

    def _rerank(self, q0: int, mask: np.ndarray, ids: np.ndarray, matrix: np.ndarray) -> None:
        q, r = np.nonzero(mask)
        other = self.ids[q + q0] != ids[r]
        q, r = q[other] + q0, r[other]
        for start in range(0, len(q), 65_536):
            qq, rr = q[start:start + 65_536], r[start:start + 65_536]
            score = exact_cosines(self.matrix[qq], matrix[rr])
            good = score >= self.scores[qq, -1]
            qq, rr, score = qq[good], rr[good], score[good]
            if len(qq):
                self._merge(qq, ids[rr], score)

    def _merge(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        touched = np.unique(q)
        all_q = np.concatenate([np.repeat(touched, self.k), q])
        all_id = np.concatenate([self.found[touched].ravel(), ids])
        all_score = np.concatenate([self.scores[touched].ravel(), score])
        # an id with several vectors takes one place, at its best score
        order = np.lexsort((-all_score, all_id, all_q))
        all_q, all_id, all_score = all_q[order], all_id[order], all_score[order]
        again = (all_q[1:] == all_q[:-1]) & (all_id[1:] == all_id[:-1]) & (all_score[1:] > -np.inf)
        keep = np.concatenate([[True], ~again])
        all_q, all_id, all_score = all_q[keep], all_id[keep], all_score[keep]
        order = np.lexsort((all_id, -all_score, all_q))
        all_q, all_id, all_score = all_q[order], all_id[order], all_score[order]
        start = np.searchsorted(all_q, touched)
        pick = (start[:, None] + np.arange(self.k)).ravel()
        self.scores[touched] = all_score[pick].reshape(-1, self.k)
        self.found[touched] = all_id[pick].reshape(-1, self.k)

    def rows(self) -> Iterator[tuple]:
        for i, j in zip(*np.nonzero(np.isfinite(self.scores))):
            yield int(self.ids[i]), int(self.found[i, j]), float(self.scores[i, j])


def _search(block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {dim: _Best(ids, matrix, k) for dim, (ids, matrix) in block.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                for part in _by_length(batch.slice(start, CHUNK)):
                    matrix = _matrix(part.column(1))
                    if matrix.shape[1] in best:
                        codes = np.frombuffer(b"".join(part.column(2).to_pylist()),
                                              np.uint8).reshape(len(matrix), -1)
                        best[matrix.shape[1]].add(part.column(0).to_numpy(), matrix, codes,
                                                  part.column(3).to_numpy())
        yield from record_batches((row for b in best.values() for row in b.rows()), HITS)
    return run


def _query_blocks(queries: DataFrame) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The queries, fetched one partition at a time, in blocks of bounded bytes."""
    held: dict[int, list[tuple[int, list[float]]]] = {}
    size = 0

    def block():
        return {dim: (np.array([i for i, _ in rows]), np.array([v for _, v in rows], float))
                for dim, rows in held.items()}

    for row in queries.select("vec_id", "v").toLocalIterator():
        held.setdefault(len(row.v), []).append((row.vec_id, row.v))
        size += 8 * len(row.v)
        if size >= QUERY_BLOCK_BYTES:
            yield block()
            held, size = {}, 0
    if held:
        yield block()


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest other vectors."""
    spark = vectors.sparkSession
    index = build_index(vectors, id_col, vec_col, k)
    hits: DataFrame | None = None
    schema = "query_id long, vec_id long, score double"
    for block in _query_blocks(usable(queries, id_col, vec_col)):
        shared = spark.sparkContext.broadcast(block)
        found = stage(index.mapInArrow(_search(shared, k), schema), "one-bit-hits")
        shared.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = spark.createDataFrame([], schema)
    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # an id with several vectors is one candidate, at its best score
    return (hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(by_score))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))

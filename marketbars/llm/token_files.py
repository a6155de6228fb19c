"""Token ids in binary files that can be read document by document.

A file is a row of independent zstandard frames, one per document (more for a
document of over ``FRAME_IDS`` ids), each holding the ids as little-endian
unsigned 32-bit integers. Two skippable frames end it: the directory of the
documents (ids and id counts), and the seek table with the compressed size,
decompressed size and checksum (low 32 bits of XXH64 of the content) of every
frame. A plain zstandard decoder therefore reads a file as one run of ids, and a
reader of single documents fetches the tail, then only the frames it needs.

On Spark the documents are range-partitioned by id and sorted, each task
encodes its documents and writes one file, and the list of files is itself a
table: only files of tasks that ended well are listed, whatever was lost or
repeated. Reading back starts from that table, one task per file.

Texts are encoded by the tokenizers library. Byte-level BPE merges inside a
pre-token only, so a plain text (see ``_PLAIN``) is cut into its pre-tokens here and
the library's model encodes every one once, which is four times as fast; any
other text goes through the library whole. Both give the same ids.

Defined cases: a null text is empty and holds just the end id; null doc_ids come
last; rows that repeat a doc_id are written one after the other, in the order of
their text's hash; an empty table makes no file and no rows; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketbars.llm.common import record_batches, stage
from marketbars.session import scratch_path

END_ID = 0
FRAME_IDS = 1 << 22
LEVEL = 3
CACHED_PIECES = 300_000
CACHED_LENGTH = 64              # longer pieces are not kept

# fixed values of the seekable zstandard format
SKIPPABLE_SEEK = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
SKIPPABLE_DIRECTORY = 0x184D2A50
CHECKSUM_FLAG = 0x80

# The pieces of a plain text: the pre-tokenizer's pattern (contractions, then
# runs of letters, digits or marks, each with one space before) on characters up
# to U+00FF. Control characters, white space other than single spaces and line
# breaks, and letters and digits outside these classes make a text not plain.
_LETTERS = rb"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
_PIECE = re.compile(rb"'(?:[stmd]|re|ve|ll)| ?[" + _LETTERS + rb"]+| ?[0-9]+"
                    rb"| ?[^ \n0-9" + _LETTERS + rb"]+|\n")
_PLAIN = bytes(b for b in range(256) if b == 10 or 32 <= b < 127 or b > 160
               and b not in b"\xaa\xb2\xb3\xb5\xb9\xba\xbc\xbd\xbe")
_RUNS = (b"  ", b" \n", b"\n ", b"\n\n")


def _byte_level() -> dict[int, int]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in shown]
    return {**{b: b for b in shown}, **{b: 256 + i for i, b in enumerate(rest)}}


_BYTE_LEVEL = _byte_level()

MANIFEST = pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                      ("n_ids", pa.int64()), ("n_bytes", pa.int64())])
DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                       ("ids_crc32", pa.int64())])


class _Pieces(dict):
    """A piece's bytes to the bytes of its ids; the model is asked once a piece."""

    def __init__(self, tokenizer):
        super().__init__()
        self.model = tokenizer.model

    def __missing__(self, piece: bytes) -> bytes:
        spelt = piece.decode("latin-1").encode().decode("latin-1").translate(_BYTE_LEVEL)
        coded = np.array([t.id for t in self.model.tokenize(spelt)], "<u4").tobytes()
        if len(self) >= CACHED_PIECES:
            self.clear()
        if len(piece) <= CACHED_LENGTH:
            self[piece] = coded
        return coded


class Encoder:
    """Texts to the bytes of their ids, with a bounded memory of pieces."""

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, models, pre_tokenizers
        self.tokenizer = own = Tokenizer.from_file(tokenizer_file)
        before = own.pre_tokenizer
        self.by_piece = (own.normalizer is None
                         and isinstance(before, pre_tokenizers.ByteLevel)
                         and not before.add_prefix_space and before.use_regex
                         and isinstance(own.model, models.BPE))
        self.special = [t.content for t in own.get_added_tokens_decoder().values()]
        self.known = _Pieces(self.tokenizer)

    def encode(self, text: str) -> bytes:
        pieces = self._pieces(text) if self.by_piece else None
        if pieces is None:
            found = self.tokenizer.encode(text, add_special_tokens=False)
            return np.array(found.ids, "<u4").tobytes()
        return b"".join(map(self.known.__getitem__, pieces))

    def _pieces(self, text: str) -> list[bytes] | None:
        """The pre-tokenizer's pieces of a plain text, else None."""
        try:
            data = text.encode("latin-1")
        except UnicodeEncodeError:
            return None
        if (data.translate(None, _PLAIN) or any(pair in data for pair in _RUNS)
                or data.endswith((b" ", b"\n")) or any(t in text for t in self.special)):
            return None
        return _PIECE.findall(data)


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> Encoder:
    return Encoder(tokenizer_file)


# ---- the file format -------------------------------------------------------

class TokenFileWriter:
    """Appends documents to an open binary stream; ``close`` adds the tables."""

    def __init__(self, stream):
        self.stream = stream
        self.press = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []
        self.n_bytes = 0

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.n_bytes += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit integers."""
        for start in range(0, len(ids), 4 * FRAME_IDS):
            part = ids[start:start + 4 * FRAME_IDS]
            frame = self.press.compress(part)
            self._put(frame)
            self.frames.append((len(frame), len(part), xxhash.xxh64_intdigest(part) & 0xFFFFFFFF))
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)

    def close(self) -> None:
        n = len(self.doc_ids)
        directory = self.press.compress(
            struct.pack("<Q", n)
            + np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes()
            + np.array([d is None for d in self.doc_ids], "u1").tobytes()
            + np.array(self.counts, "<u8").tobytes())
        self._put(struct.pack("<II", SKIPPABLE_DIRECTORY, len(directory)) + directory)
        self.frames.append((8 + len(directory), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self._put(struct.pack("<II", SKIPPABLE_SEEK, len(table) + 9) + table + footer)


class TokenFileReader:
    """Reads the tables of one file, then any document without the others."""

    def __init__(self, source):
        self.source = source
        size = source.seek(0, 2)
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token file")
        table = np.frombuffer(self._at(size - 9 - 12 * n, 12 * n), "<u4").reshape(n, 3)
        self.sizes, self.contents, self.sums = (table[:, i].astype(np.int64) for i in range(3))
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])
        self.unpress = zstandard.ZstdDecompressor()
        body = self.unpress.decompress(
            self._at(int(self.offsets[n - 1]) + 8, int(self.sizes[n - 1]) - 8))
        docs, = struct.unpack_from("<Q", body)
        absent = np.frombuffer(body, "u1", docs, 8 + 8 * docs)
        self.doc_ids = [None if a else int(i) for i, a in
                        zip(np.frombuffer(body, "<i8", docs, 8), absent)]
        self.counts = np.frombuffer(body, "<u8", docs, 8 + 9 * docs).astype(np.int64)
        frames = np.maximum(-(-self.counts // FRAME_IDS), 0)
        self.first = np.concatenate([[0], np.cumsum(frames)])

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(size)

    def frames_of(self, place: int) -> Iterator[bytes]:
        """The ids of the document at ``place`` (bytes), frame by frame, each checked."""
        for frame in range(int(self.first[place]), int(self.first[place + 1])):
            data = self.unpress.decompress(
                self._at(int(self.offsets[frame]), int(self.sizes[frame])),
                max_output_size=int(self.contents[frame]))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.sums[frame]:
                raise ValueError(f"frame {frame}: checksum does not match")
            yield data

    def ids(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every document of that doc_id."""
        return [np.frombuffer(b"".join(self.frames_of(i)), "<u4")
                for i, d in enumerate(self.doc_ids) if d == doc_id]


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """Any file system that Arrow knows by URI; a bare path is a local one."""
    if re.match(r"[a-z][a-z0-9+.-]*:", folder):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", folder))
    return pafs.LocalFileSystem(), folder


# ---- on Spark --------------------------------------------------------------

def _write(folder: str, tokenizer_file: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = open_folder(folder)
        path = f"{place}/{uuid.uuid4().hex}.ids"
        writer = stream = None
        end = struct.pack("<I", END_ID)
        code = encoder(tokenizer_file)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, batch.num_rows, 256):
                some = [t or "" for t in texts.slice(start, 256).to_pylist()]
                if writer is None:
                    files.create_dir(place, recursive=True)
                    stream = files.open_output_stream(path)
                    writer = TokenFileWriter(stream)
                for doc_id, text in zip(ids.slice(start, 256).to_pylist(), some):
                    writer.add(doc_id, code.encode(text) + end)
        if writer is not None:
            writer.close()
            stream.close()
            yield from record_batches(
                [(TaskContext.get().partitionId(), path, len(writer.doc_ids),
                  sum(writer.counts), writer.n_bytes)], MANIFEST)
    return run


def write_token_files(docs: DataFrame, tokenizer_file: str,
                      folder: str | None = None) -> DataFrame:
    """Encode and write all documents in ascending doc_id order. Returns the table
    of files: part (their order), path, n_docs, n_ids, n_bytes."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    order = [F.col("doc_id").asc_nulls_last(), F.col("h")]
    rows = (docs.select(F.col("doc_id").cast("long"), F.col("text"))
            .withColumn("h", F.xxhash64("text"))
            .repartitionByRange(*order).sortWithinPartitions(*order).drop("h"))
    return stage(rows.mapInArrow(_write(folder, tokenizer_file),
                                 "part int, path string, n_docs long, n_ids long, n_bytes long"),
                 "token-manifest")


def _read(folder_uri: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder_uri)

        def rows() -> Iterable[tuple]:
            for batch in batches:
                for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    with files.open_input_file(path) as source:
                        reader = TokenFileReader(source)
                        for place, doc_id in enumerate(reader.doc_ids):
                            crc, n = 0, 0
                            for data in reader.frames_of(place):
                                crc = zlib.crc32(data, crc)
                                n += len(data) // 4
                            yield doc_id, start, n, crc
                            start += n
        yield from record_batches(rows(), DOCUMENTS)
    return run


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Read every listed file back: doc_id, start, n_tokens, ids_crc32 per document."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    listed = manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    n = max(1, manifest.count())
    return (listed.select("path", "start").repartition(n)
            .mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"))

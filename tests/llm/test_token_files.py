import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from marketbars.llm import token_files as tf

from .conftest import prose

FILE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a", "a  b", "a \n b", "a\n", "\n", "it's we'll I'd 's 'S don't", "a <|endoftext|> b",
       "tab\t x", "é è Ñ,ß÷×", "a\u2003 b", "a\u3000 b", "日本 語", "a\x1c b", "a\u200b b", " lead",
       "1 2 3.4", "!!! ??", "a\xadb", "¡hola! ¿qué?", "a_b", "½ x²", "ªº µ", "a1b2 3c", "«x»", "x 'll",
       "\x85a", "x" * 5000, "é" * 3000, "🙂 ok", "\x00"]


def library(text):
    own = Tokenizer.from_file(FILE)
    return np.array(own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_pieces_give_the_library_ids(monkeypatch):
    monkeypatch.setattr(tf, "CACHED_PIECES", 50)
    code = tf.Encoder(FILE)
    assert code.by_piece
    for text in ODD + [prose(i, 200) + "\nÉl niño, l'été." for i in range(20)]:
        assert code.encode(text) == library(text), repr(text[:30])


def test_file_round_trip_and_single_documents(monkeypatch):
    monkeypatch.setattr(tf, "FRAME_IDS", 7)
    docs = [(1, [5, 6, 0]), (None, [0]), (2, list(range(40))), (2, [9, 0]), (3, [])]
    stream = io.BytesIO()
    writer = tf.TokenFileWriter(stream)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    writer.close()
    data = stream.getvalue()
    reader = tf.TokenFileReader(io.BytesIO(data))
    assert reader.doc_ids == [d for d, _ in docs]
    assert [b"".join(reader.frames_of(i)) for i in range(5)] == [np.array(x, "<u4").tobytes() for _, x in docs]
    assert [x.tolist() for x in reader.ids(2)] == [list(range(40)), [9, 0]]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u4").tolist() == [i for _, ids in docs for i in ids]


class Counting(io.BytesIO):
    fetched = 0

    def read(self, n=-1):
        out = super().read(n)
        self.fetched += len(out)
        return out


def test_a_reader_fetches_only_its_frames_and_checks_them():
    stream = io.BytesIO()
    writer = tf.TokenFileWriter(stream)
    rng = np.random.default_rng(0)
    for i in range(50):
        writer.add(i, rng.integers(0, 50_000, 5_000).astype("<u4").tobytes())
    writer.close()
    data = stream.getvalue()
    source = Counting(data)
    reader = tf.TokenFileReader(source)
    assert len(reader.ids(17)[0]) == 5_000 and source.fetched < len(data) / 20
    broken = bytearray(data)
    broken[len(data) // 50 * 17 + 300] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        bad = tf.TokenFileReader(io.BytesIO(bytes(broken)))
        for i in range(50):
            bad.ids(i)


def test_spark_round_trip(spark, documents, tmp_path):
    rows = [(i * 3 % 101, prose(i, i * 2)) for i in range(101)] + [(500 + i, t) for i, t in enumerate(ODD)]
    rows += [(900, None), (901, "twice"), (901, "again"), (901, "twice"), (None, "no id")]
    folder = str(tmp_path / "tokens")
    manifest = tf.write_token_files(documents(rows, {"start": "x", "h": "y"}).repartition(5), FILE, folder)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32)
                 for r in tf.read_token_files(manifest, folder).collect())
    expected = {}
    for i, t in rows:
        data = library(t or "") + b"\0\0\0\0"
        expected.setdefault(i, []).append((len(data) // 4, zlib.crc32(data)))
    at, found = 0, {}
    for start, doc_id, n, crc in got:
        assert start == at
        at += n
        found.setdefault(doc_id, []).append((n, crc))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    ids = [i for _, i, _, _ in got]
    assert ids[-1] is None and ids[:-1] == sorted(ids[:-1])


def test_empty_table(spark, documents, tmp_path):
    folder = str(tmp_path / "none")
    manifest = tf.write_token_files(documents([]), FILE, folder)
    assert tf.read_token_files(manifest, folder).collect() == []

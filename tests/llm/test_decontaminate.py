import random

from marketbars.llm import decontaminate as dec
from marketbars.llm.common import alnum_words

from .conftest import prose


def brute(text, items, n=10):
    words = alnum_words((text or "").encode())
    hit, names = [False] * len(words), set()
    for item_id, item in items:
        own = alnum_words((item or "").encode())
        size = min(n, len(own))
        for j in range(len(own) - size + 1 if own else 0):
            for i in range(len(words) - size + 1):
                if words[i:i + size] == own[j:j + size]:
                    hit[i:i + size] = [True] * size
                    if item_id is not None:
                        names.add(str(item_id))
    return len(words), sum(hit), sorted(names)


ITEMS = [(1, prose(1, 40, 60)), (2, prose(2, 25, 60)), (3, "Three Short words"), (4, None), (5, "...."),
         (6, prose(1, 40, 60)), (None, prose(3, 30, 60)), (7, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1"),
         (8, "Übung macht"), (9, "x")]


def texts(seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(60):
        parts = [prose(100 + i, rng.randrange(0, 60), 60)]
        for _ in range(rng.randrange(0, 4)):
            words = (rng.choice(ITEMS)[1] or "").split()
            a = rng.randrange(0, len(words) + 1)
            parts += [" ".join(words[a:a + rng.randrange(5, 20)]), prose(rng.random(), 5, 60)]
        out.append((i, " - ".join(parts)))
    return out + [(100, None), (101, ""), (102, "three, SHORT... words!"), (103, "ÜBUNG macht"),
                  (104, "Übung\nmacht"), (105, "w1 " * 30), (106, "a" * 100_000), (100, "x X y")]


def test_findings_against_brute_force(spark, documents):
    rows = texts()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    leaks = dec.find_leaks(documents(rows, {"items": "z", "hits": "z"}), items)
    got = sorted((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in leaks.collect())
    assert got == sorted((i, *brute(t, ITEMS)[:2], tuple(brute(t, ITEMS)[2])) for i, t in rows)
    digest = {(r.doc_id, r.n_words): r for r in dec.leak_digest(leaks).collect()}
    clean = digest[(106, 1)]
    assert not clean.contaminated and clean.items_sha256.startswith("e3b0c442")


def test_several_blocks_find_the_same(spark, documents, monkeypatch):
    rows = texts(1)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    one = sorted(map(tuple, dec.leak_digest(dec.find_leaks(documents(rows), items)).collect()))
    cut = sorted(map(str, dec.remove_spans(documents(rows), items, chars_col="n_chars").collect()))
    monkeypatch.setattr(dec, "BLOCK_WORDS", 30)
    assert sorted(map(tuple, dec.leak_digest(dec.find_leaks(documents(rows), items)).collect())) == one
    again = dec.remove_spans(documents(rows), items, chars_col="n_chars")
    assert sorted(map(str, again.collect())) == cut


def test_removal_leaves_no_window_and_clean_texts_alone(spark, documents):
    rows = texts(2)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = documents(rows, {"cut": "c", "row": "r", "total": "t"})
    out = dec.remove_spans(docs, items, chars_col="n_chars")
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    kept = out.collect()
    for r in kept:
        assert brute(r.text, ITEMS)[1] == 0
        assert r.n_chars == len(r.text or "") and (r.cut, r["row"], r.total) == ("c", "r", "t")
    clean = [(i, t) for i, t in rows if not brute(t, ITEMS)[1]]
    assert len(clean) > 5 and all((i, t) in {(r.doc_id, r.text) for r in kept} for i, t in clean)
    gone = {i for i, t in rows if brute(t, ITEMS)[1] > 0.5 * max(1, brute(t, ITEMS)[0])}
    assert not gone & {r.doc_id for r in kept if r.doc_id != 100}


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = documents([(1, "a b c")])
    assert [tuple(r)[:4] for r in dec.leak_digest(dec.find_leaks(docs, none)).collect()] == [(1, 3, 0, 0)]
    assert dec.remove_spans(docs, none).collect() == docs.collect()
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dec.find_leaks(documents([]), items).collect() == []

import random

from marketbars.llm import sentence_spans as ss
from marketbars.llm.common import alnum_words

from .conftest import prose


def spans(text, least=2, min_words=20):
    parts = [w for _, _, w in ss.sentences((text or "").encode())]
    out = []
    for i in range(len(parts)):
        for j in range(i + least, len(parts) + 1):
            if sum(map(len, parts[i:j])) >= min_words:
                out.append((i, j, tuple(map(tuple, parts[i:j]))))
    return len(parts), out


def brute(rows):
    first, gone, counts = {}, {}, {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        counts[i], found = spans(text)
        gone[i] = set()
        for a, b, key in found:
            if key in first:
                gone[i].update(range(a, b))
            first.setdefault(key, (i, a))
    return {i: (counts[i], sorted(gone[i])) for i in counts}


def corpus(seed=1):
    rng = random.Random(seed)
    passages = [prose(i, rng.randrange(51, 120)) for i in range(8)]
    rows = []
    for i in range(80):
        parts = [prose(100 + i, rng.randrange(5, 80))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(passages), prose(rng.random(), rng.randrange(3, 40))]
        rows.append((i, rng.choice([" ", "\n", " is "]).join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(10)]
    return rows + [(300, None), (301, ""), (302, "One. Two. Three."), (303, "no end " * 900),
                   (304, ".\n.\n!"), (305, passages[0] + " " + passages[0]), (306, "A. " * 120)]


def test_sentences_cover_the_text():
    text = "One two. Three!  Four?\n\nfive 3.5 six.seven\n... Eight"
    parts = ss.sentences(text.encode())
    assert [b" ".join(w) for _, _, w in parts] == [b"one two", b"three", b"four", b"five 3 5 six seven", b"eight"]
    assert parts[0][0] == 0 and parts[-1][1] == len(text)
    assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))


def test_against_brute_force(spark, documents):
    rows = corpus()
    out = ss.span_report(documents(rows, {"doc": "x", "gone": "y"}).repartition(6)).collect()
    got = {r.doc_id: (r.n_sentences, [int(n) for n in r.removed.split(",") if n]) for r in out}
    assert got == brute(rows)
    assert all(r.n_removed == len(got[r.doc_id][1]) for r in out)


def test_passages_go_and_clean_texts_stay(spark, documents):
    rows = corpus(2)
    docs = documents(rows, {"gone": "x", "row": "y"})
    out = ss.remove_repeats(docs)
    assert out.columns == docs.columns
    kept = {r.doc_id: r.text for r in out.collect()}
    for i, (_, gone) in brute(rows).items():
        if not gone:
            assert kept[i] == dict(rows)[i]
    seen = {}
    for i, text in sorted(kept.items()):
        words = alnum_words((text or "").encode())
        for j in range(len(words) - 50):
            assert seen.setdefault(tuple(words[j:j + 51]), i) == i


def test_null_and_repeated_ids_and_empty(spark, documents):
    text = prose(1, 60)
    rows = [(None, text), (5, text), (5, text)]
    got = sorted((str(r.doc_id), r.n_removed > 0) for r in ss.span_report(documents(rows)).collect())
    assert got == [("5", False), ("5", True), ("None", True)]
    assert ss.span_report(documents([])).collect() == []


def plain(seed, n):
    rng = random.Random(seed)
    return " ".join(f"v{rng.randrange(4000):x}" for _ in range(n))


def test_passages_inside_one_sentence_go(spark, documents):
    rows, after = [], 1000
    for i in range(40):
        passage = plain(i, 51 + i)
        rows += [(i, f"{plain(100 + i, 9)} {passage} {plain(200 + i, 12)}."),
                 (after + i, f"{plain(300 + i, 30)} {passage}, {plain(400 + i, 5)}")]
    rows += [(3000, rows[0][1]), (3001, plain(500, 300)), (3002, plain(500, 300))]
    kept = {r.doc_id: alnum_words(r.text.encode()) for r in ss.remove_repeats(documents(rows)).collect()}
    for i in range(40):
        assert kept[i] == alnum_words(dict(rows)[i].encode())
        passage = alnum_words(plain(i, 51 + i).encode())
        left = b" ".join(kept[after + i])
        assert b" ".join(passage) not in left
        assert len(kept[after + i]) <= 35 + len(passage) - 20
    assert kept[3000] == [] and kept[3001] == alnum_words(plain(500, 300).encode())
    assert kept[3002] == []


def test_long_sentences_are_cut_by_content():
    for text in (plain(1, 400), "no end " * 300, "a, (b) c; " * 50 + "d!", plain(2, 21) + ". " + plain(3, 20)):
        raw = text.encode()
        parts = ss.sentences(raw)
        assert [w for _, _, words in parts for w in words] == alnum_words(raw)
        assert parts[0][0] == 0 and parts[-1][1] == len(raw)
        assert all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert all(alnum_words(raw[a:b]) == words for a, b, words in parts)
        assert max(len(words) for _, _, words in parts) <= ss.LONG
    assert len(ss.sentences(plain(3, 20).encode())) == 1


def test_sentence_ends_of_other_scripts():
    text = "\u4e00\u4e8c\u3002\u4e09\uff01\u0915 \u0916\u0964 \u0917"
    assert [len(words) for _, _, words in ss.sentences(text.encode())] == [1, 1, 2, 1]


def test_the_whole_of_a_repeated_passage_goes(spark, documents):
    shared = " ".join(f"{plain(70 + i, n)}." for i, n in enumerate((15, 15, 5, 3)))
    rows = [(1, f"{shared} {plain(90, 30)}."), (2, f"{plain(91, 30)}. {shared} {plain(92, 30)}.")]
    kept = {r.doc_id: r.text for r in ss.remove_repeats(documents(rows)).collect()}
    assert kept[1] == rows[0][1]
    assert alnum_words(kept[2].encode()) == alnum_words(f"{plain(91, 30)} {plain(92, 30)}".encode())


def test_rows_are_cut_not_ids(spark, documents):
    a, b, c = (f"{plain(95 + i, 30)}. {plain(195 + i, 30)}." for i in range(3))
    rows = [(1, a), (7, a), (7, b), (None, c), (None, c), (9, b), (None, None)]
    docs = documents(rows, {"_id": "x"})
    kept = sorted((r.doc_id or 0, r.text or "") for r in ss.remove_repeats(docs).collect())
    assert (1, a) in kept and sorted(t for _, t in kept if t) == sorted([a, b, c])
    report = ss.span_report(docs).collect()
    assert sorted(r.doc_id or 0 for r in report) == sorted(i or 0 for i, _ in rows)


def test_very_long_texts(spark, documents):
    long = "no end " * 9000
    got = {r.doc_id: r for r in ss.span_report(documents([(1, long), (2, long), (3, "x" * 300_000)])).collect()}
    assert got[2].n_removed == got[2].n_sentences > 100 and got[1].n_removed < got[1].n_sentences
    assert got[3].n_removed == 0

import random

import pytest

from marketbars.llm import jaccard_join as jj
from marketbars.llm.common import space_words

from .conftest import prose
from .test_components import brute as union


def shingle_set(text, words):
    w = space_words((text or "").encode())
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1)))


def brute(rows, words=4, percent=85):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    edges = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x]
             if s and t and 100 * len(s & t) >= percent * len(s | t)]
    names = union(edges)
    return sorted((i, len(s), names.get(i, i)) for i, s in sets)


def edited(text, rng, times):
    words = text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(words)


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(25):
        base = prose(i, rng.randrange(20, 200))
        rows += [base] * rng.randrange(1, 4) + [edited(base, rng, rng.randrange(0, 6)) for _ in range(6)]
    chain = prose(500, 150)
    for _ in range(15):                     # each links to the one before
        chain = edited(chain, rng, 1)
        rows.append(chain)
    passage = prose(900, 120)               # a passage that many share
    rows += [passage + " " + prose(1000 + i, 30) for i in range(30)]
    rows += ["a b c", "A B C", "a b", "a", "A", "", None, "  \n", "a b c d", "a b c d e"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def result(out):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())


def test_against_brute_force(spark, documents):
    rows = corpus()
    docs = documents(rows, {"n": "x", "k": "y", "token": "z"}).repartition(7)
    assert result(jj.link_texts(docs)) == brute(rows)


def test_five_words_and_other_thresholds(spark, documents):
    rows = corpus(2)
    assert result(jj.link_texts(documents(rows), 5, 80)) == brute(rows, 5, 80)


@pytest.mark.parametrize("rounds", [1, 6])
def test_a_large_group_of_near_copies(spark, documents, monkeypatch, rounds):
    """Copies of one base, many pairs of which don't link themselves."""
    monkeypatch.setattr(jj, "ROUNDS", rounds)
    rng = random.Random(9)
    base = prose(77, 120)
    rows = [(i, edited(base, rng, rng.randrange(1, 9))) for i in range(150)]
    rows += [(1000 + i, prose(5000 + i, 80)) for i in range(40)]
    assert result(jj.link_texts(documents(rows))) == brute(rows)


def test_repeated_and_null_ids(spark, documents):
    text, other = prose(1, 60), prose(2, 60)
    rows = [(1, text), (1, text), (1, other), (2, other), (None, text), (None, prose(3, 40)), (3, text + " x")]
    got = {(r.doc_id, r.n_shingles): r.component_id for r in jj.link_texts(documents(rows)).collect()}
    assert got[(2, 57)] == 1 and got[(3, 58)] == 1 and got[(None, 57)] == 1 and got[(None, 37)] is None


def test_keep_one(spark, documents):
    rows = corpus(3)
    docs = documents(rows, {"_gone": "g"})
    out = jj.keep_one(docs, 4, 85)
    assert out.columns == docs.columns
    names = {i: c for i, _, c in brute(rows)}
    assert sorted(r.doc_id for r in out.collect()) == sorted(i for i, c in names.items() if i == c)


def test_empty_table(spark, documents):
    assert jj.link_texts(documents([])).collect() == []
    assert result(jj.link_texts(documents([(1, None), (2, "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_rows_are_kept_or_dropped_not_ids(spark, documents):
    a, b, c = prose(50, 60), prose(51, 60), prose(52, 60)
    near = a.replace(a.split()[30], "changed", 1)
    rows = [(7, b), (7, a), (1, a), (None, a), (None, a), (None, c), (8, ""), (8, ""), (9, b), (3, near),
            (5, c), (5, c), (None, None), (4, "one two"), (4, "one two")]
    kept = jj.keep_one(documents(rows, {"component_id": "x", "k": "y"}), words=3, percent=70)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "component_id", "k"]
    got = sorted(((r.doc_id or 0), r.text or "") for r in kept.collect())
    assert got == sorted([(1, a), (7, b), (5, c), (8, ""), (8, ""), (0, ""), (4, "one two")])


def test_very_long_texts_link(spark, documents):
    long = prose(60, 40_000)
    rows = [(1, long), (2, long + " more words at its end"), (3, prose(61, 40_000)), (4, "z" * 200_000)]
    got = {r.doc_id: r.component_id for r in jj.link_texts(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}

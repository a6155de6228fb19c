import random
import re
from collections import Counter

import numpy as np
import pytest

from marketbars.llm import collocations as col


def brute(rows, longest=4, least=30, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                for i in range(len(words) - n + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i:i + n])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            if any(100 * b >= 80 * a and len(q) > len(p)
                   and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in candidates.items()):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                        for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        for i, (score, a, p, left, right) in enumerate(sorted(scored)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def corpus(seed=0, n=120):
    rng = random.Random(seed)
    fixed = ["New York City hall", "old\tyork", "zebra", "Übung macht den meister", "a a a a a"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(0, 60)):
            words.append(rng.choice(fixed) if rng.random() < 0.3 else f"w{int(40 * rng.random() ** 3)}")
            if rng.random() < 0.15:
                words[-1] += rng.choice([".", ",", " ;", "\n", "\r\n", "?!", "\x0b"])
        rows.append((rng.choice(["  ", " ", "\t "]).join(words), rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", "fr"), ("one two", "fr"), ("x" * 100_000, "en"), ("... ,", "en"),
                   ("go on " * 5_000, "en"), ("go on " * 5_000, "en"), ("und so weiter", "und")] * 2


def run(spark, rows, extra="", **more):
    docs = spark.createDataFrame([(i // 2 or None, t, g, *(["z"] if extra else []))
                                  for i, (t, g) in enumerate(rows)],
                                 "doc_id long, text string, lang string" + extra)
    return sorted(map(tuple, col.collocations(docs, **more).collect()))


def test_against_brute_force(spark):
    rows = corpus()
    got = run(spark, rows, ", `phrase` string")
    assert got == brute(rows) and len(got) > 15


@pytest.mark.parametrize("width, bits", [(6, 27), (64, 6), (9, 10)])
def test_meeting_fingerprints_and_a_full_bitmap_change_nothing(spark, width, bits):
    rows = corpus(3, 60)
    assert run(spark, rows, least=8, top=40, width=width, bits=bits) == brute(rows, least=8, top=40)


def test_small_chunks_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(col, "CHUNK_BYTES", 100)
    rows = corpus(5, 40)
    chunks = list(col._chunks(iter([])))
    assert chunks == []
    assert run(spark, rows, least=5) == brute(rows, least=5)
    assert run(spark, []) == [] and run(spark, [(None, None)]) == []


def test_fingerprints_name_the_words_wherever_they_stand():
    prints = col.Fingerprints()
    words = col.Words([b"a b  c", b"c a\tb c. b a"], ["x", "x"], [1, 2])
    own = prints.of_words(words.data, words.starts, words.ends)
    two = prints.of_phrases(own, 2)
    spelt = [words.spelt(i, 2) for i in range(len(two[0]))]
    same = {s: {int(f) for f, t in zip(two[0], spelt) if t == s} for s in spelt}
    assert all(len(v) == 1 for v in same.values()) and len(set.union(*same.values())) == len(same)
    assert words.phrases(2).tolist() == [True, True, False, True, True, True, False, True]
    assert len(np.unique(own[0])) == 3

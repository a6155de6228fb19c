import math
from collections import Counter

import pytest

from marketbars.llm import license_scan as ls

from .conftest import prose

SCHEMA = "path string, id long, text string, license string, dir string"


def files_of(spark, rows):
    return spark.createDataFrame([(p, i, t, "clash", "clash") for i, (p, t) in enumerate(rows)], SCHEMA)


def brute(rows, templates=ls.TEMPLATES, threshold=ls.THRESHOLD):
    def words(t):
        return ls.words_of(t.encode())

    def is_license(path):
        import re
        return bool(path and re.match(ls.LICENSE_NAMES, path.rsplit("/", 1)[-1]))
    found = []
    for i, (path, text) in enumerate(rows):
        for c in ls.candidates((text or "").encode(), is_license(path)):
            found.append((i, c.decode()))
    vocabulary = {w for _, t in templates for w in words(t)}
    df = Counter(w for _, c in found for w in set(words(c)))

    def vector(t):
        return {w: n * (math.log((1 + len(found)) / (1 + (df[w] if w in vocabulary else 0))) + 1)
                for w, n in Counter(words(t)).items()}

    def cosine(a, b):
        size = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return round(sum(x * b.get(w, 0) for w, x in a.items()) / size, 12) if size else 0.0
    own = {}
    for i, c in found:
        scores = [(cosine(vector(c), vector(t)), -k) for k, (_, t) in enumerate(templates)]
        top, k = max(scores)
        if top >= threshold and top > own.get(i, ("", 0.0))[1]:
            own[i] = (templates[-k][0], top)
    dirs = {}
    for i, (path, _) in enumerate(rows):
        if i in own and is_license(path):
            d = path[:path.rfind("/") + 1]
            dirs.setdefault(d, []).append((-own[i][1], path, own[i][0]))
    out = []
    for i, (path, _) in enumerate(rows):
        name, score = own.get(i, (None, None))
        got, source = name, None
        if name is None and path is not None:
            at = path[:path.rfind("/") + 1]
            while True:
                if at in dirs:
                    got, source = min(dirs[at])[2], at
                    break
                if not at:
                    break
                at = at[:at[:-1].rfind("/") + 1]
        out.append((i, name, None if score is None else pytest.approx(score), got, source))
    return out


ROWS = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.txt", prose(1, 50)),
        ("a/b/c/y.txt", "Licensed under CC BY-NC 4.0.\n" + prose(2, 30)), ("a/b/c/z.txt", None),
        ("d/COPYING.txt", prose(3, 20) + "\nThis work is licensed under the GNU General Public License, version 3."),
        ("d/e/f/g/h.c", ""), ("top.c", prose(4, 10)), ("LICENSE.md", "Licensed under the Apache License, Version 2.0."),
        ("q/r.c", prose(5, 20)), (None, "Released under the MIT License."), (None, "x"),
        ("d/LICENCE", "Released under the MIT License."), ("d/z", "licensed to nobody " + prose(6, 400)),
        ("a/b/c/NOTICE", "no licence here at all, only a warranty of " + prose(7, 60)), ("a//w", "w"),
        ("long/" * 200 + "f", prose(8, 5)), ("s/notlicense", "Released under the MIT License."),
        ("s/t", "plain"), ("q/r.c", prose(5, 20)), ("big/x", ("word " * 50_000) + "\nReleased under the MIT License.")]


def test_against_brute_force(spark):
    out = ls.scan_licenses(files_of(spark, ROWS).repartition(4)).collect()
    got = sorted((r.id, r.own, r.score, r.license, r.from_dir) for r in out)
    assert got == brute(ROWS)
    by = {r.id: r for r in out}
    assert by[1].license == "MIT" and by[1].from_dir == "a/" and by[2].own == "CC-BY-NC-4.0"
    assert by[8].license == "Apache-2.0" and by[8].from_dir == ""


def test_empty_table(spark):
    assert ls.scan_licenses(files_of(spark, [])).collect() == []


def test_common_words_weigh_by_share_not_by_table_size(spark):
    notice = "Licensed under the Apache License, Version 2.0, see LICENSE for copyright years"

    def score(n):
        rows = [(f"s/{i}.c", notice if i % 4 else "copyright years of the license, see " + prose(i, 6))
                for i in range(n)]
        out = ls.scan_licenses(files_of(spark, rows).repartition(4), all_words=True).collect()
        scores = {r.score for r in out if r.id % 4}
        assert len(scores) == 1 and all(r.own == "Apache-2.0" for r in out if r.id % 4)
        return scores.pop()
    assert score(2_000) == pytest.approx(score(40), abs=0.02)


def test_all_words_against_brute_force(spark):
    words = sorted({w for _, t in ROWS for w in ls.words_of((t or "").encode())})
    counted = ls.TEMPLATES + tuple(("none", w) for w in words)
    out = ls.scan_licenses(files_of(spark, ROWS).repartition(4), all_words=True).collect()
    got = sorted((r.id, r.own, r.score, r.license, r.from_dir) for r in out)
    assert got == brute(ROWS, counted)      # templates of one word, never the best, count every word

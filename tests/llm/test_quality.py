import random
import zlib

import numpy as np

from marketbars.llm import quality as q

from .conftest import prose


def corpus(n=600):
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        text = prose(i, rng.randrange(30, 300))
        bad = i % 4 == 0
        if bad:
            text = [text.upper().replace(" ", "!! "), " | ".join(text.split()),
                    " ".join(w + "&&&" for w in text.split()),
                    " ".join(w for w in text.split()[:4] for _ in range(30))][i // 4 % 4]
        docs.append((i, text))
        if i % 3:
            labels.append((i, int(not bad), 0))
    return docs, labels


LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy_and_contract(spark, documents):
    docs, labels = corpus()
    table = documents([*docs, (9000, None), (9001, ""), (None, "no id at all"), (9002, "a" * 300_000),
                       (5, docs[5][1])], {"words": "clash", "quality": "clash"})
    out = q.classify(table, spark.createDataFrame([*labels, (8, 0, 0), (8, 1, 0), (11, None, 0),
                                                   (None, 1, 0), (12, 7, 0)], LABELS))
    rows = out.collect()
    assert len(rows) == len(docs) + 5
    right = []
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is None:
            assert not r.held_out
            continue
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        if r.doc_id < 9000 and r.held_out:
            right.append(r.predicted == int(r.doc_id % 4 != 0))
    assert np.mean(right) > 0.97


def test_fit_matches_numpy(spark, documents):
    docs, labels = corpus(200)
    measured = q.text_statistics(documents(docs))
    model = q.fit(measured, spark.createDataFrame(labels, LABELS))
    x = {i: np.array(q.statistics(t.encode())) for i, t in docs}
    for label in (0, 1):
        rows = np.array([x[i] for i, y, _ in labels
                         if y == label and zlib.crc32(str(i).encode()) % 5])
        assert np.allclose(model.means[label], rows.mean(axis=0))
    own = [np.cov(np.array([x[i] for i, y, _ in labels if y == k
                            and zlib.crc32(str(i).encode()) % 5]).T, bias=True) for k in (0, 1)]
    n = [sum(1 for i, y, _ in labels if y == k and zlib.crc32(str(i).encode()) % 5) for k in (0, 1)]
    pooled = (n[0] * own[0] + n[1] * own[1]) / sum(n)
    for k in (0, 1):
        cov = (1 - q.TO_POOLED) * own[k] + q.TO_POOLED * pooled
        cov = (1 - q.TO_IDENTITY) * cov + q.TO_IDENTITY * np.trace(cov) / len(cov) * np.eye(len(cov))
        assert np.allclose(model.factors[k] @ model.factors[k].T, cov, atol=1e-8)


def test_held_out_labels_have_no_effect(spark, documents):
    docs, labels = corpus(200)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y, t) for i, y, t in labels]
    a, b = (q.fit(q.text_statistics(documents(docs)), spark.createDataFrame(x, LABELS))
            for x in (labels, turned))
    assert np.allclose(a.means, b.means)


def test_one_class_none_and_empty(spark, documents):
    docs = documents([(1, "x"), (2, None)])
    one = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert {r.score for r in q.classify(docs, one).collect()} == {1.0}
    assert {r.score for r in q.classify(docs, one.limit(0)).collect()} == {0.5}
    assert q.classify(documents([]), one).collect() == []
    assert q.keep_good(docs, one).collect() == docs.collect()


def test_keep_good_keeps_whole_rows(spark, documents):
    docs, labels = corpus(300)
    table = documents(docs, {"words": "w"})
    label = spark.createDataFrame(labels, LABELS)
    good = {r.doc_id for r in q.classify(table, label).collect() if r.predicted}
    kept = q.keep_good(table, label)
    assert kept.columns == table.columns
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in table.collect() if r.doc_id in good)

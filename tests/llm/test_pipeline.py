import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from marketbars.llm.decontaminate import SuffixAutomaton

from . import test_decontaminate as t_dec
from . import test_jaccard_join as t_jac
from .conftest import DOCS, prose


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(6)
    items = [(i, prose(9000 + i, 30)) for i in range(6)]
    rows, labels = [], []
    for i in range(260):
        text = prose(i, rng.randrange(20, 200))
        if i % 9 == 0:
            text = items[i % 6][1] + " " + text
        if i % 11 == 0 and i:
            text = rows[i // 2][1]
        if i % 7 == 0:
            text = " ".join(w + "&&&" for w in text.split())
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        if i % 2:
            labels.append((i, int("&&&" not in text), 0))
    rows += [(500, None, None, None, None), (501, "", "en", "s1", 0)]
    path = str(tmp_path_factory.mktemp("tables"))
    for name, data, schema in (("documents", rows, DOCS), ("benchmark", items, "item_id long, text string"),
                               ("labels", labels, "doc_id long, quality int, toxic int")):
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return path, rows, items


def test_every_stage_against_brute_force(spark, tables):
    path, rows, items = tables
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontaminate", "mix", "token_files"]
    stages = dict(corpus_pipeline.STAGES)

    good = stages["quality"](spark, docs, path)
    good = spark.createDataFrame(good.collect(), DOCS)
    kept = {r.doc_id for r in good.collect()}
    junk = {i for i, t, *_ in rows if t and "&&&" in t}
    assert not junk & kept and len(kept) >= len(rows) - len(junk) - 5

    one = stages["near_duplicates"](spark, good, path)
    one = spark.createDataFrame(one.collect(), DOCS)
    expected = t_jac.brute([(r.doc_id, r.text) for r in good.collect()], 5, 80)
    assert {r.doc_id for r in one.collect()} == {i for i, _, c in expected if i == c}

    clean = stages["decontaminate"](spark, one, path)
    clean = spark.createDataFrame(clean.collect(), DOCS)
    before = {r.doc_id: r.text for r in one.collect()}
    for r in clean.collect():
        assert t_dec.brute(r.text, items)[1] == 0
        if not t_dec.brute(before[r.doc_id], items)[1]:
            assert r.text == before[r.doc_id]

    mixed = stages["mix"](spark, clean, path)
    assert mixed.columns == docs.columns
    rows_mixed = [tuple(r) for r in mixed.collect()]
    assert set(rows_mixed) <= {tuple(r) for r in clean.collect()}
    words = sum(len((r[1] or "").split()) for r in rows_mixed)
    total = sum(len((r.text or "").split()) for r in clean.collect())
    assert abs(words - 1.5 * total) < 0.02 * total + 50

    out = stages["token_files"](spark, spark.createDataFrame(rows_mixed, DOCS), path).collect()
    code = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(r[0]), len(ids := code.encode(r[1] or "", add_special_tokens=False).ids) + 1,
                   zlib.crc32(np.array([*ids, 0], "<u4").tobytes())) for r in rows_mixed)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in out) == want


def test_run_is_the_stages_in_order(spark, tables):
    path, _, _ = tables
    rows = corpus_pipeline.run(spark, path).collect()
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert rows and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))


def test_automaton_needs_no_items():
    assert SuffixAutomaton([]).findings([b"a"]) == (None, set())

import hashlib
from collections import Counter

import numpy as np
import pytest

from marketbars.llm import token_alignment as ta
from marketbars.llm.queries import tokenizer_file

from .conftest import prose

A, B = tokenizer_file(), tokenizer_file("piece_bpe_32k.model")
NONE = (0, 0, 0, 0, 0, 0, "")


def tokens_of(text):
    """(ids, end offsets) by both libraries alone, or None."""
    import sentencepiece
    from tokenizers import Tokenizer
    own = Tokenizer.from_file(A)
    own.encode_special_tokens = True
    spell = {}
    bs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    for i, b in enumerate(bs + [b for b in range(256) if b not in bs]):
        spell[chr(b if b in bs else 256 + i - len(bs))] = b
    assert set(own.pre_tokenizer.alphabet()) == set(spell)
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    want = (" " + text).encode()
    a = own.encode(" " + text, add_special_tokens=False)
    a_bytes = [bytes(spell.get(c, 0) for c in own.id_to_token(i)) for i in a.ids]
    b_ids = pieces.encode(text)
    b_bytes = []
    for i in b_ids:
        p = pieces.id_to_piece(i)
        b_bytes.append(bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode())
    if not text or b"".join(a_bytes) != want or b"".join(b_bytes) != want:
        return None
    return (a.ids, np.cumsum([len(x) for x in a_bytes]).tolist(),
            b_ids, np.cumsum([len(x) for x in b_bytes]).tolist())


def brute(texts):
    out, linked, docs = [], [], Counter()
    for text in texts:
        got = tokens_of(text or "")
        linked.append([])
        if got is None:
            out.append(None)
            continue
        a, a_ends, b, b_ends = got
        groups = []
        for cut in sorted(set(a_ends) & set(b_ends)):
            groups.append(([i for i, e in zip(a, a_ends) if e <= cut], [i for i, e in zip(b, b_ends) if e <= cut]))
        shown, na, nb = [], 0, 0
        for ga, gb in groups:
            shown.append(",".join(map(str, ga[na:])) + "|" + ",".join(map(str, gb[nb:])))
            na, nb = len(ga), len(gb)
        for i, (s, e) in enumerate(zip([0, *a_ends], a_ends)):
            for j, (t, f) in enumerate(zip([0, *b_ends], b_ends)):
                if s < f and t < e:
                    linked[-1].append((a[i], b[j]))
        docs.update(set(linked[-1]))
        out.append((len(a), len(b), len(groups), hashlib.sha256(";".join(shown).encode()).hexdigest()))
    top = Counter()
    for (a, _), n in docs.items():
        top[a] = max(top[a], n)
    return [NONE if o is None else
            (o[0], o[1], o[2], len(p), sum(docs[x] == top[x[0]] for x in p), sum(docs[x] for x in p), o[3])
            for o, p in zip(out, linked)]


TEXTS = [prose(1, 40), prose(2, 60, 50), prose(2, 60, 50), None, "", " ", "  two  spaces ", "a▁b", "x<|endoftext|>y",
         "<s></s><unk><0x41>", "\n\n a\r\n\tb", "Übung 日本語 \U0001f389 é", "\x00\x01\x7f", "ﬁ ½ ①",
         "antidisestablishmentarianism " * 3, "12345678901234567890", "a", "don't can't  won't", "  x", "สวั"]


@pytest.mark.parametrize("most_pairs", [10 ** 6, 0])
def test_report_against_brute_force(spark, documents, most_pairs, monkeypatch):
    monkeypatch.setattr(ta, "BATCH_BYTES", 200)
    rows = [(None if i % 7 == 0 else i // 2, t) for i, t in enumerate(TEXTS)]
    report = ta.alignment_report(documents(rows, {"pairs": "z", "row": "z"}), A, B, most_pairs)
    assert report.columns == ta.REPORT
    got = sorted(map(str, map(tuple, report.collect())))
    assert got == sorted(map(str, [(i, *r[:4], *r[4:]) for (i, _), r in zip(rows, brute(TEXTS))]))
    assert sum(r == NONE for r in brute(TEXTS)) < 6


def test_long_texts_and_no_rows(spark, documents):
    long = prose(5, 60_000)
    rows = [(1, long), (2, long), (3, "z" * 20_000), (4, "na" * 5_000 + " ")]
    got = {r.doc_id: r for r in ta.alignment_report(documents(rows), A, B).collect()}
    assert tuple(got[1])[1:] == tuple(got[2])[1:] and got[1].n_a > 60_000
    assert got[1].n_groups <= min(got[1].n_a, got[1].n_b) and got[3].n_links > 0
    assert got[1].n_a <= got[1].n_links <= got[1].n_a + got[1].n_b - got[1].n_groups
    assert ta.alignment_report(documents([]), A, B).collect() == []
    assert [tuple(r) for r in ta.alignment_report(documents([(9, None)]), A, B).collect()] == [(9, *NONE)]


def test_doubling_reaches_the_end_of_a_long_chain():
    # ends that meet only at the last offset: one group of 2,000 tokens
    a = np.array([*range(2, 2001, 2), 2001])
    b = np.arange(1, 2002, 2)
    a_label, b_label = ta.group_labels(a, b)
    assert set(a_label) == set(b_label) == {len(b) - 1}
    x, y = ta.overlaps(a, b)
    assert len(x) == len(a) + len(b) - 1 and list(zip(x, y))[:3] == [(0, 0), (0, 1), (1, 1)]

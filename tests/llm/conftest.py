import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, extra=None):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        if extra is None:
            return spark.createDataFrame(full, DOCS)
        names = "".join(f", `{name}` string" for name in extra)
        return spark.createDataFrame([(*r, *extra.values()) for r in full], DOCS + names)
    return make


def prose(seed: int, words: int, vocabulary: int = 4000) -> str:
    """Sentences of invented words, the same for the same seed."""
    import random
    rng = random.Random(seed)
    out = []
    for i in range(words):
        k = int(vocabulary * rng.random() ** 2)
        out.append(f"w{k:x}" + (". " if rng.random() < 0.1 else " "))
    return "".join(out).strip() + "."

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(n: int = 60, words: int = 60, seed: int = 1):
    """Documents from a small vocabulary with copies, near copies, shared passages, nulls, blanks and a long text."""
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "nu", "re", "sé") for b in ("ta", "vo", "zi", "x", "ñe")]
    text = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    passage, rows = text(25), []
    for i in range(n):
        kind = rng.randrange(6)
        t = text(rng.randrange(1, words))
        if kind == 0 and rows:
            t = rng.choice(rows)[1] or ""
        elif kind == 1 and rows:
            own = (rng.choice(rows)[1] or "x").split()
            own[rng.randrange(len(own)) if own else 0 : 1] = ["anders"]
            t = " ".join(own)
        elif kind == 2:
            t = f"{t}\n{passage} {text(5)}"
        elif kind == 3:
            t = " ".join([text(3)] * 6)
        rows.append((i, t))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, text(4000)), (None, passage), (n + 4, "one two")]
    return rows


@pytest.fixture
def rows():
    return corpus()


@pytest.fixture
def frame(spark):
    """rows -> documents with every column, and columns whose names operators use themselves."""

    def make(rows, lang="en", source="s"):
        full = [(i, t, lang if callable(lang) is False else lang(i), source, None if t is None else len(t), "k", 1.5) for i, t in rows]
        return spark.createDataFrame(full, DOCS + ", key string, score double")

    return make

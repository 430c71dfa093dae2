"""Substring, suffix-array and Jaccard dedup against brute force, with every odd row there is."""

import re

import pytest

from libretto.llm import jaccard, registry, substrings, suffixes
from tests.llm.conftest import corpus


def brute_words(rows, length):
    words = [(i, re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for i, t in rows]
    low = {}
    for i, ws in words:
        for a in range(len(ws) - length + 1):
            k = tuple(ws[a : a + length])
            if i is not None:
                low[k] = min(i, low.get(k, i))
    out = []
    for i, ws in words:
        gone = set()
        for a in range(len(ws) - length + 1):
            if i is not None and low[tuple(ws[a : a + length])] < i:
                gone |= set(range(a, a + length))
        out.append((i, len(ws), len(gone), b" ".join(w for n, w in enumerate(ws) if n not in gone)))
    return out


def brute_bytes(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, b in texts:
        for a in range(len(b) - length + 1):
            if i is not None:
                k = b[a : a + length]
                first[k] = min((i, a), first.get(k, (i, a)))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for a in range(len(b) - length + 1):
            if i is not None and first[b[a : a + length]] < (i, a):
                gone[a : a + length] = [True] * length
        spans, at = [], 0
        while at < len(b):
            end = at
            while end < len(b) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                spans.append((at, end))
            at = end
        out.append((i, len(b), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def got_words(df):
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), None if r.kept is None else bytes(r.kept)) for r in df.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 3])
def test_substrings(frame, rows, parts):
    rows = [*rows, rows[3], rows[-3]]  # repeated rows
    got = got_words(substrings.deduplicated(frame(rows), parts, length=6, k=3))
    want = sorted(((i, n, g, k if g else None) for i, n, g, k in brute_words(rows, 6)), key=repr)
    assert got == want


def test_substring_runs_are_compacted(spark, frame, rows):
    index = substrings.SubstringIndex(spark, length=6, k=3, most_runs=2)
    rows = [r for r in rows if r[0] is not None]
    got = []
    for at in range(0, len(rows), 24):
        got += got_words(index.add(frame(rows[at : at + 24])))
        index = substrings.SubstringIndex.open(spark, index.folder)  # as another session would go on
    assert len(index.runs) <= 2 and len(index.texts) == 3 and index.version > 3
    assert sorted(got, key=repr) == sorted(((i, n, g, k if g else None) for i, n, g, k in brute_words(rows, 6)), key=repr)


@pytest.mark.parametrize(("kinds", "seed"), [(4096, 1), (2, 2)])
def test_suffixes(frame, kinds, seed):
    rows = corpus(40, 30, seed)
    rows = [*rows, rows[3], rows[-3]]
    out = suffixes.deduplicated(frame(rows), length=14, k=6, kinds=kinds).collect()  # kinds: cuts minimisers over shards
    got = sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], None if r.kept is None else bytes(r.kept)) for r in out), key=repr)
    want = sorted(((i, n, s, k if s else None) for i, n, s, k in brute_bytes(rows, 14)), key=repr)
    assert got == want
    for r in out:
        if r.kept is not None:
            assert set(r.kept_text) <= set("".join(t or "" for _, t in rows))  # characters are never cut


def test_suffix_array_and_prefixes():
    import random

    import numpy as np

    rng = random.Random(3)
    for trial in range(60):
        t = np.array([rng.choice([97, 97, 98]) for _ in range(rng.randrange(300))], dtype=np.uint8)
        t = np.tile(t[: rng.randrange(1, 9)], 40)[:200] if trial % 3 == 0 and len(t) else t
        b = t.tobytes()
        order, rank = suffixes.suffix_array(t)
        assert list(order) == sorted(range(len(b)), key=lambda i: b[i:])
        for lanes in (1, 7, 4096):
            prefix = suffixes.common_prefixes(t, order, rank, 20, lanes)
            for s in range(1, len(b)):
                x, y = b[order[s - 1] :], b[order[s] :]
                n = next((i for i in range(20) if x[i : i + 1] != y[i : i + 1] or not x[i : i + 1]), 20)
                assert prefix[s] == n


def shingles(t, size=5):
    ws = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())
    return {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)} if len(ws) >= size else ({tuple(ws)} if ws else set())


def brute_links(rows, similarity=0.8):
    sets = [(i, shingles(t)) for i, t in rows]
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a][0] is not None and sets[b][0] is not None and sets[a][1] and len(sets[a][1] & sets[b][1]) / max(1, len(sets[a][1] | sets[b][1])) >= similarity]
    low = [i for i, _ in sets]
    count = [0] * len(sets)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return sorted(((i, n, c) for (i, _), n, c in zip(sets, count, low, strict=True)), key=repr)


@pytest.mark.parametrize("chunk", [400_000, 150])
def test_jaccard(frame, rows, chunk):
    base = " ".join(f"w{i}" for i in range(120))
    near = [(200 + i, " ".join("changed" if j == 5 * i else w for j, w in enumerate(base.split()))) for i in range(9)]  # a group of near copies
    rows = [*rows, *near, (209, base), rows[4], rows[4]]
    got = sorted(((r.doc_id, r.n_links, r.class_id) for r in jaccard.linked(frame(rows), chunk=chunk).collect()), key=repr)
    assert got == brute_links(rows)


def test_bands_reach_the_recall():
    b = jaccard.bands_for(0.8, 5, 0.9999)
    assert 1 - (1 - 0.8**5) ** b >= 0.9999 > 1 - (1 - 0.8**5) ** (b - 1)


def test_many_texts_of_one_id(frame, rows):
    rows = [(7 if i is not None and i % 3 else i, t) for i, t in rows]
    assert got_words(substrings.deduplicated(frame(rows), 2, length=6, k=3)) == sorted(((i, n, g, k if g else None) for i, n, g, k in brute_words(rows, 6)), key=repr)


def test_empty_tables(spark, frame):
    for run in (substrings.deduplicated, suffixes.deduplicated, jaccard.linked):
        assert run(frame([])).count() == 0
        assert run(frame([(1, None), (None, "a")])).count() == 2


def test_queries_equal_the_contract(spark):
    import hashlib

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted((i, n, sum(b - a for a, b in s), len(s), hashlib.sha256(k).hexdigest()) for i, n, s, k in brute_bytes(rows, 100))
    assert sorted(map(tuple, registry.op3_suffix_dedup(spark, sf).collect())) == want
    want = sorted((i, n, g, hashlib.sha256(k).hexdigest()) for i, n, g, k in brute_words(rows, 50))
    assert sorted(map(tuple, registry.op1_substring_dedup(spark, sf).collect())) == want

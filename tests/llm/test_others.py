"""Tokens, urls, vectors, mixing, languages, top-k and licences against brute force, with odd rows."""

import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from libretto.llm import langid, licences, mixing, registry, tokens, topk, urls, vectors

SF = "/root/testdata/sf0.001"


# ---- tokens


def test_tokens_are_the_library_s(spark):
    sp = tokens.processor(registry.piece_model())
    rng = random.Random(1)
    parts = [*"ab cd  eé\n\t ▁ñ漢🙂​\x01!", "the ", "  ", " a", "▁▁"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(2000)]
    texts += [None, "", " ", "   ", "long " * 30_000, "x" * 5000, texts[5], texts[5]]
    df = spark.createDataFrame([(i, t, "keep", "gone") for i, t in enumerate(texts)], "i int, text string, other string, ids string")
    for r in tokens.encoded(df, registry.piece_model()).collect():
        want = sp.encode(texts[r.i] or "")
        assert r.ids == want and r.decoded == sp.decode(want) and r.other == "keep"
    assert tokens.encoded(df.limit(0), registry.piece_model()).count() == 0


def test_a_small_chunk_table_changes_nothing():
    table = tokens.Chunks(registry.piece_model(), most=3)
    for t in ("a b c d e", "e d c", "f g h"):
        words = table.cut(t)
        table.learn([w for w in set(words) if w not in table.ids])
        assert [i for w in words for i in table.ids[w]] == table.sp.encode(t)


# ---- urls


def test_redirects_move_blocks_and_rules_stand_above(spark):
    pages = [
        (1, "https://Example.com/en/a", '<link rel="canonical" href="https://other.org/x">'),
        (2, "https://other.org/x", ""),
        (3, "https://third.org/", "<meta http-equiv='refresh' content='0; url=https://other.org/x'>"),
        (4, "https://www.example.com/en/b", '<link href="https://other.org/x" rel=canonical>'),
        (5, None, "<link rel=canonical href=https://other.org/x>"),
        (6, "no scheme", None),
        (7, "http://a.net", None),
        (8, "http://a.net/fr/?q#f", None),
        (9, "https://free.org/", ""),
        (2, "https://other.org/x", ""),
        (10, "", ""),
    ]
    df = spark.createDataFrame([(*p, "clash") for p in pages], "page_id int, url string, html string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filtered(df).collect()}
    assert got == {
        1: ("example.com", "/en/a", "example.com/en/", "block"),
        2: ("other.org", "/x", None, "block"),
        3: ("third.org", "/", None, "block"),
        4: ("www.example.com", "/en/b", "www.example.com/en/", "allow"),
        5: ("", "", None, "allow"),
        6: ("", "", None, "allow"),
        7: ("a.net", "", None, "allow"),
        8: ("a.net", "/fr/", "net/fr/", "block"),
        9: ("free.org", "/", None, "allow"),
        10: ("", "", None, "allow"),
    }
    more = spark.createDataFrame([("https://free.org/", "https://third.org/"), (None, "x")], "src string, dst string")
    assert {r.verdict for r in urls.filtered(df, redirects=more).where("page_id = 9").collect()} == {"block"}
    assert urls.filtered(df).count() == len(pages) and urls.filtered(df.limit(0)).count() == 0


def test_relative_targets_entities_and_fragments(spark):
    block = "https://x.net/fr/1"
    pages = [
        (1, "http://x.example.org/p/5", '<link rel=canonical href="//x.net/fr/1">', "block"),
        (2, "https://x.example.org/p/5", '<link rel=canonical href="//x.net/fr/1">', "block"),
        (3, "https://x.net/a/b", '<LINK HREF="/fr/1" REL="canonical">', "block"),
        (4, "https://x.net/a/c", '<link rel="canonical" href="../fr/1#part">', "block"),
        (5, "https://x.net/a/d#top", "", "block"),
        (6, "https://x.net/a/d", f'<meta http-equiv="refresh" content="0; URL=\'{block}#x\'">', "block"),
        (7, "https://y.org/", '<base href="https://x.net/fr/"><link rel=canonical href=1>', "block"),
        (8, "https://y.org/q?a=1&b=2", "", "block"),
        (9, "https://x.net/fr/2", '<link rel=canonical href="https://y.org/q?a=1&amp;b=2">', "block"),
        (10, "https://y.org/r?a=1&b=2", "", "block"),
        (11, "https://x.net/fr/3", '<meta content="1;url=//y.org/r?a=1&amp;b=2" http-equiv=refresh>', "block"),
        (12, "no scheme", '<link rel=canonical href="/fr/1">', "allow"),
        (13, "https://y.org/[", '<link rel=canonical href="//[bad/"><link rel=canonical href="">', "allow"),
        (14, "https://y.org/s", '<link rel=stylesheet href="//x.net/fr/1"><p>canonical', "allow"),
    ]
    df = spark.createDataFrame([p[:3] for p in pages], "page_id int, url string, html string")
    got = {r.page_id: r.verdict for r in urls.filtered(df).collect()}
    rules = (*urls.RULES, ("x.net", "/a/", "allow"))
    assert got == {p[0]: p[3] for p in pages}
    assert {r.page_id for r in urls.filtered(df, rules).where("verdict = 'block'").collect()} == {1, 2, 7, 8, 9, 10, 11}


# ---- vectors


def brute_cosine(rows, least):
    fine = {}
    for n, (i, v) in enumerate(rows):
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, dtype=np.float64) / np.abs(v).max()
            fine[n] = x / np.linalg.norm(x)
    count, low = [0] * len(rows), [i for i, _ in rows]
    links = [(a, b) for a, b in itertools.combinations(fine, 2) if len(fine[a]) == len(fine[b]) and fine[a] @ fine[b] >= least]
    for _ in rows:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return [(i, c, k) for (i, _), c, k in zip(rows, count, low, strict=True)]


@pytest.mark.parametrize("chunk", [2048, 16])
def test_vectors(spark, chunk):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, list(map(float, centres[i % 12] + rng.normal(size=16) * (0.1 if i % 3 else 2)))) for i in range(150)]
    rows += [(150, None), (151, [0.0] * 16), (152, [float("nan")] * 16), (153, [None, 1.0]), (154, rows[0][1]), (155, [2 * x for x in rows[0][1]]), (156, rows[0][1][:5]), (157, []), (None, rows[0][1]), (5, rows[5][1]), (158, [1e200] * 16), (159, [3e200] * 16)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.linked(df, probes=6, chunk=chunk).collect()), key=repr)
    want = sorted(brute_cosine(rows, 0.9), key=repr)
    assert sum(c for _, c, _ in got) >= 0.9 * sum(c for _, c, _ in want)  # recall of an index
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert got == want  # and here in full
    assert vectors.linked(df.limit(0)).count() == 0


def test_kept_is_the_component_s_first(spark):
    for r in registry.op4_embedding_neardup(spark, SF).collect():
        assert r.kept == (r.vec_id == r.component_id)


# ---- mixing


def test_targets():
    assert [float(x) for x in mixing.targets([10, 10, 10], [1, 2, 3], 30)] == [5, 10, 15]
    got = mixing.targets([100, 1, 1], [1, 2, 3], 102)
    assert [float(x) for x in got] == [96, 3, 3]
    assert mixing.targets([], [], 0) == [] and mixing.targets([0, 0], [1, 2], 0) == [0, 0]


def test_flow_meets_quotas_at_least_cost():
    rng = random.Random(4)
    for _ in range(60):
        patterns = [(tuple(sorted(rng.sample(range(3), rng.randint(1, 3)))), rng.randint(0, 3)) for _ in range(3)]
        quotas = [rng.randint(0, 4) for _ in range(3)]
        sent = mixing.flow(patterns, quotas, 2)
        cost = lambda x, s: sum(n // s for n in range(x)) if s else 0
        assert all(sum(f.values()) <= 2 * s for f, (_, s) in zip(sent, patterns, strict=True))
        got = [sum(f.get(q, 0) for f in sent) for q in range(3)]
        assert all(g <= q for g, q in zip(got, quotas, strict=True))
        best = None
        ways = [[dict(zip(p, x, strict=True)) for x in itertools.product(*(range(quotas[q] + 1) for q in p)) if sum(x) <= 2 * s] for p, s in patterns]
        for plan in itertools.product(*ways):
            if all(sum(f.get(q, 0) for f in plan) <= quotas[q] for q in range(3)):
                total = sum(sum(f.values()) for f in plan)
                price = sum(cost(sum(f.values()), s) for f, (_, s) in zip(plan, patterns, strict=True))
                best = min(best or (1, 0), (-total, price))
        mine = (-sum(got), sum(cost(sum(f.values()), s) for f, (_, s) in zip(sent, patterns, strict=True)))
        assert mine == best


@pytest.mark.parametrize("whole", [False, True])
def test_mix(spark, whole):
    rng = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(30))), ["a", "b", None, "c"][min(i % 7, 3)]) for i in range(300)] + [(300, None, "a"), (301, "", None), (5, "w w", "b"), (5, "w w", "b"), (None, "w", "é")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, target int")
    once, again = (sorted(map(tuple, mixing.mixed(df, F.array("source"), mixing.words_of(F.col("text")), whole=whole).drop("sources").collect()), key=repr) for _ in "ab")
    assert once == again and len(once) == len(rows)
    out = mixing.mixed(df, F.array("source"), mixing.words_of(F.col("text")), whole=whole)
    for r in out.groupBy("sources").agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.sum("size").alias("s"), F.max("source_size").alias("z"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        assert r.s == r.z and r.over <= 0 and abs(r.t - r.g) <= (30 if whole else 1)
    assert mixing.mixed(df.limit(0), F.array("source"), mixing.words_of(F.col("text"))).count() == 0


# ---- languages


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    scores, move, start = rng.normal(size=(7, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    p, logz, pairs = langid.marginals(scores, np.array([4, 1, 2]), move, start)
    at, total, seen = 0, 0.0, np.zeros((3, 3))
    for n in (4, 1, 2):
        weight, z, joint = np.zeros((n, 3)), 0.0, np.zeros((3, 3))
        for path in itertools.product(range(3), repeat=n):
            w = math.exp(start[path[0]] + sum(scores[at + i, s] for i, s in enumerate(path)) + sum(move[a, b] for a, b in itertools.pairwise(path)))
            z += w
            for i, s in enumerate(path):
                weight[i, s] += w
            for a, b in itertools.pairwise(path):
                joint[a, b] += w
        assert np.allclose(p[at : at + n], weight / z)
        total, seen, at = total + math.log(z), seen + joint / z, at + n
    assert math.isclose(total, logz) and np.allclose(pairs, seen)


def test_held_out_accuracy_and_odd_texts(spark):
    rows = registry.op8_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.95 and all(0 <= r.score <= 1 for r in rows)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.trained(docs, F.lit(True))
    by = {r.lang: r.text for r in docs.where("length(text) between 200 and 2000").dropDuplicates(["lang"]).collect()}
    de, fr = (" ".join(by[x].split()[:25]) for x in ("de", "fr"))
    (name, score, spans), *rest = model.label([f"{de} {fr}", None, "", "12 34 !!", "é", de.upper(), "ß" * 50_000, "\n\n"])
    assert len({model.labels[s[0]] for s in spans}) >= 2 and {model.labels[spans[0][0]], model.labels[spans[-1][0]]} == {"de", "fr"}
    assert [r[:2] for r in rest[:3]] == [("und", 0.0)] * 3 and rest[3][0] in model.labels and rest[4][0] == "de" and rest[6][0] == "und"
    same = docs.select("doc_id", "text", F.lit("x").alias("score")).limit(3)
    assert langid.predicted(same.union(same), model).count() == 6


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = langid.trained(df, F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.predicted(df, model).collect()} == {("und", 0.0)}
    one = spark.createDataFrame([(1, "abc", "en")], "doc_id long, text string, lang string")
    assert langid.predicted(one, langid.trained(one, F.lit(True))).first().lang_pred == "en"
    assert langid.predicted(one.limit(0), langid.trained(one.limit(0), F.lit(True))).count() == 0


def test_every_label_is_learned(spark):
    rng = random.Random(21)
    names = [f"l{i:02d}" for i in range(80)]
    sounds = "bdfgklmnprst"
    own = {x: ["".join(rng.choice(sounds) + rng.choice("aeiou") for _ in range(3)) + x[1:].translate(str.maketrans("0123456789", "qwxyzvjhcö")) for _ in range(12)] for x in names}
    # The rarest labels have the fewest rows: l00 has one, l79 has five.
    rows = [(n * 100 + k, " ".join(rng.choice(own[x]) for _ in range(30)), x) for n, x in enumerate(names) for k in range(1 + n // 16)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.trained(df, F.lit(True))
    assert model.labels == names and model.weight.size <= langid.CELLS
    new = [(n, " ".join(rng.choice(own[x]) for _ in range(20)), x) for n, x in enumerate(names)]
    got = langid.predicted(spark.createDataFrame(new, "doc_id long, text string, lang string"), model).collect()
    wrong = [r.lang for r in got if r.lang_pred != r.lang]
    assert len(wrong) <= 2, wrong


def test_more_labels_take_fewer_bits_and_blocks_change_nothing(monkeypatch):
    assert [langid.bits_for(n) for n in (0, 4, 64, 128, 129, 1000)] == [17, 17, 17, 17, 16, 14]
    model = langid.Model(["a", "b"]).fit([("ka lo mi nu re ka", 0), ("sé ta vo zi ñe sé", 1)], rounds=20)
    texts = ["ka lo\nsé ta\n\nmi", None, "vo " * 50 + "\nka ka", "12", "zi\nñe\nka"]
    whole = model.label(texts)
    monkeypatch.setattr(langid, "BLOCK_CELLS", 4)
    parts = model.label(texts)
    assert [(x[0], x[2]) for x in whole] == [(x[0], x[2]) for x in parts] and np.allclose([x[1] for x in whole], [x[1] for x in parts])


def test_training_reads_the_whole_text(spark):
    rng = random.Random(8)
    header = " ".join(f"shared notice {i} about terms" for i in range(100))
    word = {"fr": ["le", "chat", "été", "garçon", "où"], "de": ["der", "hund", "straße", "schön", "wo"]}
    text = lambda x, n: " ".join(rng.choice(word[x]) for _ in range(n))
    rows = [(i, f"{'12 ' * 2000 if i % 4 > 1 else header} {text(x, 2000)}", x) for i in range(12) for x in [("fr", "de")[i % 2]]]
    model = langid.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    for x in word:
        name, score, _ = model.label([text(x, 30)])[0]
        assert name == x and score > 0.9
    took = langid.excerpt(rows[0][1]).split()
    assert len(took) == langid.WORDS_EACH and took != [w for line in langid.cut(rows[0][1]) for w in line][: len(took)]
    assert langid.excerpt("A b\nC, 1") == b"a b c" and langid.excerpt("") == b""
    long = langid.excerpt("a " + "漢字" * 50_000 + " b")
    assert len(long) <= langid.BYTES_EACH + langid.WORDS_EACH and "漢" in long.decode()


# ---- top-k


@pytest.mark.parametrize(("block", "chunk"), [(8192, 512), (13, 4)])
def test_topk(spark, block, chunk):
    rng = np.random.default_rng(7)
    rows = [(i, list(map(float, rng.normal(size=8).round(1)))) for i in range(120)] + [(120, None), (121, [float("inf")] * 8), (122, [None] * 8), (123, [1.0, 2.0]), (150, [0.0] * 8), (None, [1.0] * 8), (124, [1e9] * 8), (130, [1e300, -1e300] * 4), (7, [0.5] * 8), (200, [])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.topk(df, F.col("vec_id") % 10 == 0, 5, block=block, chunk=chunk).collect())
    most = 2**63 - 1
    near = lambda n: min(max(n, -most - 1), most)
    fine = [(i, [near(math.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for i, q in fine:
        if i % 10 == 0:
            scores = sorted((-near(sum(a * b for a, b in zip(q, v, strict=True))), j) for j, v in fine if j != i and len(v) == len(q))[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    assert got == sorted(want)
    assert topk.topk(df.limit(0), F.lit(True), 5).count() == 0


# ---- licences


def brute_licence(text):
    grams = lambda ws: set(zip(ws, ws[1:], strict=False)) if len(ws) > 1 else {(w,) for w in ws}
    found = lambda t: re.findall(r"[a-z0-9]+(?:\.[0-9]+)*", "".join(c.lower() if c.isascii() else c for c in t))
    lines = re.split("\r\n|\r|\n", text or "")
    best = None
    for i in range(len(lines)):
        for n in range(1, min(4, len(lines) - i) + 1):
            a = grams(found("\n".join(lines[i : i + n])))
            for name, t in licences.TEMPLATES.items():
                b = grams(found(t))
                score = 2 * len(a & b) / (len(a) + len(b))
                if score >= 0.8 and (best is None or (-score, name, i, n) < best):
                    best = (-score, name, i, n)
    return best and (best[1], -best[0], *best[2:])


def test_licences(spark):
    rng = random.Random(9)
    names = list(licences.TEMPLATES.values())
    texts = []
    for _ in range(150):
        ws = rng.choice(names).split()
        for _ in range(rng.randrange(3)):
            ws[rng.randrange(len(ws))] = rng.choice(["x", "of the", "ÀÉ", ""])
        t = rng.choice([" ", "\n", "  \r\n"]).join(ws[:3]) + " " + rng.choice([" ", "\n"]).join(ws[3:])
        texts.append(rng.choice(["", "intro line\n", "a\nb\n"]) + t + rng.choice(["", "\nmore", " and a long tail of words that follow"]))
    texts += [None, "", "\n\n", "mit", "word " * 50_000, texts[0]]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, licence string")
    for r in licences.scanned(df).collect():
        want = brute_licence(texts[r.i])
        assert (None if r.licence is None else (r.licence, r.score, r.first_line, r.n_lines)) == want, texts[r.i]
    assert licences.scanned(df.limit(0)).count() == 0


def brute_statements(text, templates, threshold=0.8):
    """All windows of words that begin with a template's bigram, the best first, then the best that share no word with one taken."""
    ws, out = licences.words(text.encode()), []
    for name, t in templates.items():
        own = licences.words(t.encode())
        b, most = licences.bigrams(own), max(1, int((len(own) - 1) * (2 - threshold) / threshold + 1e-9) + (len(own) > 1))
        scored = []
        for i in range(len(ws)):
            if len(own) > 1 and tuple(ws[i : i + 2]) not in b:
                continue
            for n in range(1, min(most, len(ws) - i) + 1):
                a = licences.bigrams(ws[i : i + n])
                if (score := 2 * len(a & b) / (len(a) + len(b))) >= threshold:
                    scored.append((-score, i, n))
        taken = set()
        for score, i, n in sorted(scored):
            if taken.isdisjoint(range(i, i + n)):
                taken |= set(range(i, i + n))
                out.append((name, -score, i, n))
    return sorted(out, key=lambda x: (x[2], x[3], x[0]))


def test_statements_inside_lines_and_in_full(spark):
    inline = {
        "Copyright 2020 Example Corp. All rights reserved.": "all-rights-reserved",
        "This package is released under the MIT License, see the file LICENSE for details.": "MIT",
        "The text of this article is licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0",
        "It is\nlicensed\nunder\nthe\nApache\nLicense,\nVersion\n2.0, so": "Apache-2.0",
    }
    wordings = licences.wordings()
    whole = {f"Intro words. {' '.join(wordings[n].split())} And more.": n for n in ("ISC text", "LGPL-2.1 text", "MPL-2.0 text", "GPL-3.0 text")}
    both = "Code: released under the MIT License. Images: licensed under CC BY-SA 4.0. All rights reserved. Again: all rights reserved."
    texts = [*inline, *whole, both, None, "", "12 words that state nothing of the kind", "mit"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "i int, text string, statements string")
    got = {r.i: r.statements for r in licences.stated(df).collect()}
    for i, want in enumerate([*inline.values(), *whole.values()]):
        assert max((s.score, s.licence) for s in got[i] if s.licence == want)[0] >= 0.97, texts[i][:80]
    assert (got[3][0].first_line, got[3][0].n_lines) == (1, 7)
    assert sorted(s.licence for s in got[len(inline) + len(whole)] if s.score == 1) == ["CC-BY-SA-4.0", "MIT", "all-rights-reserved", "all-rights-reserved"]
    assert all(got[i] == [] for i in range(len(texts) - 4, len(texts)))
    assert licences.stated(df.limit(0)).count() == 0


def test_statements_are_all_windows():
    rng = random.Random(12)
    templates = {"a": "p q r s", "b": "q r q r s t", "c": "p", "d": "s s t", "e": "p q"}
    scan = licences.Statements(templates, 0.8)
    for _ in range(400):
        text = " ".join(rng.choice("pqrst") for _ in range(rng.randrange(30)))
        assert [x[:4] for x in scan.all(text.encode())] == brute_statements(text, templates), text

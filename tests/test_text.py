"""Sentences, limits, packing, metrics and small text functions."""

import random
import re

import pytest
from pyspark.sql import functions as F

from libretto.functions import audio, metrics, sentences, text


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values))
    return df.select(column.alias("x")).first().x


def test_sentences_protect_abbreviations_and_initials(spark):
    t = "Con la sig.ra Neri e il prof. U. Bassi canta. Che gioia! Davvero?  Sì"
    assert one(spark, sentences.sentences(F.col("t")), t=t) == ["Con la sig.ra Neri e il prof. U. Bassi canta.", "Che gioia!", "Davvero?", "Sì"]
    t = "Ecco due cose: pane e vino. Treno 18:45 da Roma. Vedi PAG. 3."
    assert one(spark, sentences.sentences(F.col("t"), True), t=t) == ["Ecco due cose:", "pane e vino.", "Treno 18:45 da Roma.", "Vedi pag. 3."]
    assert one(spark, sentences.sentences(F.col("t")), t="") == []


def test_limits():
    assert sentences.limited("seta", 4) == ["seta"]
    assert sentences.limited("alba, tramonto", 8) == ["alba,", "tramonto"]
    assert sentences.limited("uno due tre quattro", 9) == ["uno due", "tre", "quattro"]
    # The stronger sign wins over the one nearer the middle; a cut is weighed behind its blanks.
    assert sentences.limited("vento e mare; vele bianche, remi e lunghe corde", 34) == ["vento e mare;", "vele bianche, remi e lunghe corde"]
    assert sentences.limited("abcdefgh; xx, " + "y" * 30, 40) == ["abcdefgh;", "xx, " + "y" * 30]
    with pytest.raises(ValueError, match="cannot split"):
        sentences.limited("precipitevolissimevolmente", 9)
    rng = random.Random(1)
    for _ in range(200):
        t = " ".join("a" * rng.randint(1, 9) + rng.choice(["", "", ",", ";", "."]) for _ in range(rng.randint(1, 40)))
        parts = sentences.limited(t, 30)
        assert all(0 < len(p) <= 30 for p in parts) and " ".join(parts).split() == t.split()


def test_packing(spark):
    got = one(spark, sentences.packed(F.col("s"), 10), s=["aaa", "bbb", "ccc", "dddddddddddd", "e"])
    assert [(u.text, u.first, u.last) for u in got] == [("aaa bbb", 0, 1), ("ccc", 2, 2), ("dddddddddddd", 3, 3), ("e", 4, 4)]


def test_text_functions(spark):
    assert one(spark, text.cleaned(F.col("t")), t=" a \n\t b €c ") == "a b € c"
    assert one(spark, text.tidied(F.col("t")), t="a ,\n b .") == "a, b."
    assert one(spark, text.clock(F.col("n")), n=3_723_045) == "01:02:03.045"
    assert one(spark, text.kebab(F.col("t")), t="ChunkManifest") == "chunk-manifest"
    assert [one(spark, text.letters_of(F.col("n")), n=n) for n in (1, 26, 27, 702, 703)] == ["A", "Z", "AA", "ZZ", "AAA"]
    assert one(spark, text.is_references(F.col("t")), t=" Riferimenti: ")
    assert one(spark, text.percentile_nearest(F.col("v"), 50), v=[2, 1]) == 2


#: (reference, transcript, (substitutions, deletions, insertions))
WER = [("mare calmo", "mare calmo", (0, 0, 0)), ("mare calmo", "mare mosso", (1, 0, 0)), ("il mare", "il grande mare", (0, 0, 1)), ("il grande mare", "il mare", (0, 1, 0)), ("", "", (0, 0, 0)), ("", "onda su onda", (0, 0, 3)), ("vela rossa", "", (0, 2, 0)), ("a b c d", "b c e d f", (0, 1, 2))]


@pytest.mark.parametrize(("a", "b", "counts"), WER)
def test_word_errors(a, b, counts):
    assert metrics.edits(a.split(), b.split()) == counts


def test_alignment_agrees_with_the_counts():
    rng = random.Random(2)
    for _ in range(500):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 7))] for _ in "ab")
        steps = metrics.alignment(a, b)
        assert tuple(sum(s[0] == k for s in steps) for k in ("substitute", "delete", "insert")) == metrics.edits(a, b)
    steps = metrics.alignment("oggi poi il sole scalda qui".split(), "il sole scalda".split())
    assert metrics.missing_ends(steps) == (2, 1)


def test_comparison_text():
    for a, b, want in (("Però: così è!", "pero cosi e", "pero cosi e"), ("quell’ORA", "quell'ora", "quell'ora"), ("“Ehi”… (tu)", "EHI tu", "ehi tu"), ("citta\u0300", "Città", "citta")):
        assert metrics.comparable(a) == metrics.comparable(b) == want


def test_repetitions():
    assert metrics.repetitions("su su su e giù e giù e".split()) == {("su",): 2, ("e", "giù"): 1, ("giù", "e"): 1}
    words = [random.Random(3).choice("xy") for _ in range(60)]
    brute = {}
    for n in (1, 2, 3):
        for i in range(60 - 2 * n + 1):
            if words[i : i + n] == words[i + n : i + 2 * n]:
                brute[tuple(words[i : i + n])] = brute.get(tuple(words[i : i + n]), 0) + 1
    assert metrics.repetitions(words) == brute
    assert metrics.repetition_excess("su su e via".split(), "su e via".split()) == 0
    assert metrics.repetition_excess("e via".split(), "e via e via e via".split()) == 2


def test_scored_and_micro_average(spark):
    df = spark.createDataFrame([("sale fino", "sale grosso"), ("", "a"), (None, "a")], "a string, b string")
    rows = metrics.scored(df, "a", "b")
    assert [r.wer and r.wer.rate for r in rows.collect()] == [0.5, 1.0, None]
    assert rows.agg(metrics.micro_average("wer").alias("x")).first().x == 1.0


def test_audio():
    assert audio.pcm_of([0.0, 1.0, -1.0, 0.5]) == b"\x00\x00\xff\x7f\x00\x80\x00@"
    with pytest.raises(ValueError):
        audio.pcm_of([float("nan")])
    pcm = audio.voice("ciao", 7)
    state, rate = int.from_bytes(__import__("hashlib").sha256(b"7\0ciao").digest()[:8], "little"), 24_000
    want = []
    for _ in range(len(pcm) // 2):
        state = (state * audio.MULTIPLIER + audio.INCREMENT) % 2**64
        want.append(((state >> 48) & 0x3FFF) - 8192)
    assert len(pcm) // 2 == round(0.08 * rate) and pcm == b"".join(v.to_bytes(2, "little", signed=True) for v in want)
    data = audio.wav_bytes(pcm, rate)
    assert audio.wav_problem(data, rate) == (len(pcm) // 2, None)
    assert audio.wav_problem(data, 8000)[1] == "sample-rate" and audio.wav_problem(data[:-10], rate)[1] and audio.wav_problem(b"x", rate)[1]
    assert audio.pcm_quality(b"\x00\x00" * 3) == (1.0, 0.0, -120.0)


def test_abbreviations_agree_with_one_replacement_after_the_other(spark):
    def slowly(text):
        for a in sorted(sentences.ABBREVIATIONS, key=len, reverse=True):
            text = re.sub(re.escape(a), a.replace(".", "§"), text, flags=re.IGNORECASE)
        return [p.replace("§", ".").strip() for p in re.sub(r"([.!?])\s+", r"\1|", text).split("|") if p.strip()]

    texts = ["La DOTT.SSA. Neri parla. Poi il Dott. Ssa. tace. Fine", "sig.ra. e Sig.na. e sig. x. ok", "n. 4. pagN. 5 ECſ. fine. Eſ. b", ".n.n. ca.es. vs. z", "", "secc. ecc.ecc. a! b? c", "prof.ssa prof.ssa. PROF. x"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    got = dict(map(tuple, df.select("n", sentences.sentences(F.col("t"))).collect()))
    assert [got[n] for n in range(len(texts))] == [slowly(t) for t in texts]


def test_limit_split_sends_long_sentences_alone(spark):
    rows = [(0, ["uno due", "x" * 9 + ", " + "y" * 9, "uno due", "x" * 9 + ", " + "y" * 9]), (1, []), (2, None)]
    df = spark.createDataFrame(rows, "n int, ss array<string>")
    got = dict(map(tuple, sentences.limit_split(df, "ss", 15).select("n", "parts").collect()))
    assert got == {0: [["uno due"], ["x" * 9 + ",", "y" * 9]] * 2, 1: [], 2: None}

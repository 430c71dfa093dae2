"""The text stages in one call, engine checks and the environment's report."""

import json

import pytest
from pyspark.sql import functions as F

from libretto.operators import engines
from libretto.plans import stages
from libretto.sources import doctor


def words(text):
    out = []
    for w in text.split():
        out += [{"t": "Space"}] * bool(out) + [{"t": "Str", "c": w}]
    return out


def head(text, level=1):
    return {"t": "Header", "c": [level, ["", [], []], words(text)]}


def para(text, *more):
    return {"t": "Para", "c": [*words(text), *more]}


def test_text_stages(spark):
    note = {"t": "Note", "c": [para("una nota")]}
    formula = {"t": "Para", "c": [{"t": "Math", "c": [{"t": "DisplayMath"}, "x = y"]}]}
    blocks = [para("Prima di tutto."), head("Mare"), para("Costa 5 €. Poi basta.", note), formula, {"t": "HorizontalRule"}, head("Bibliografia"), para("Un libro."), head("Vento"), para("Soffia forte.")]
    books = spark.createDataFrame([("b", json.dumps({"blocks": blocks})), ("vuoto", json.dumps({"blocks": []})), ("nullo", None)], "book_id string, ast string")
    out = stages.run(books, 60, ["footnote"])
    got = out["blocks"].orderBy("pos").collect()
    assert [(r.chapter_id, r.chapter_title, r.kind) for r in got] == [
        ("chapter-0001", "Front matter", "paragraph"), ("chapter-0002", "Mare", "heading"), ("chapter-0002", "Mare", "paragraph"), ("chapter-0002", "Mare", "equation"),
        ("chapter-0003", "Vento", "heading"), ("chapter-0003", "Vento", "paragraph"),
    ]
    assert got[2].spoken_text == "Costa cinque euro. Poi basta." and got[3].spoken_text == "ics uguale a ipsilon" and got[3].warnings == []
    gone = sorted((r.reason_code, r.description) for r in out["exclusions"].collect())
    assert gone == [("bibliography", "Bibliografia"), ("bibliography", "Un libro."), ("configured-block-exclusion", "footnote: una nota"), ("unsupported-block", "paragraph")]
    chunks = out["chunks"].orderBy("sequence").collect()
    assert [r.spoken_text for r in chunks] == ["Prima di tutto.", "Mare", "Costa cinque euro.", "Poi basta.", "ics uguale a ipsilon", "Vento", "Soffia forte."]
    assert [r.pause.break_before for r in chunks] == ["chapter", "chapter", "paragraph", "sentence", "paragraph", "chapter", "paragraph"]
    assert [tuple(r) for r in out["summary"].collect()] == [("b", 3, 6, 0, 4)]
    with pytest.raises(ValueError, match="excluded"):
        stages.ingest(books, ["paragraph"])


def test_engine_requests(spark):
    rows = [(0, "ciao", 24000, "v", None, 0, 1.0, None), (1, "ciao", 8000, "v", None, 0, 1.0, None), (2, "x" * 9, 24000, "v", None, 0, 1.0, None), (3, "a", 24000, "v", "r.wav", 0, 1.0, None),
            (4, "a", 24000, "w", None, 0, 1.0, None), (5, "a", 24000, None, None, 0, 1.0, None), (6, "a", 24000, "v", None, 3, 1.0, None), (7, "a", 24000, "v", None, 0, 1.1, None), (8, "a", 24000, "v", None, 0, 1.0, 0.5)]
    df = spark.createDataFrame(rows, "n int, spoken_text string, sample_rate_hz int, voice_id string, reference_path string, seed long, speed double, temperature double")
    have = engines.Capabilities("e", "m", 24000, 8, named_voices=("v",), seed=False, speed=False)
    got = {r.n: r.x for r in df.select("n", engines.refused(have).alias("x")).collect()}
    assert got == dict(enumerate([None, "sample-rate", "text-length", "reference-voice", "unknown-voice", "unknown-voice", "seed", "speed", "temperature"]))
    free = engines.Capabilities("e", "m", 24000, reference_voices=True, named_voices=None, temperature=True)
    got = {r.n: r.x for r in df.select("n", engines.refused(free).alias("x")).collect()}
    assert got[3] is None and got[0] == "named-voice" and got[1] == "sample-rate"
    engines.pinned(have, "e", "m", ("e", "m", True, ""))
    with pytest.raises(ValueError, match="pinned"):
        engines.pinned(have, "e", "n", ("e", "m", True, ""))
    with pytest.raises(ValueError, match="pinned"):
        engines.pinned(have, "e", "m", ("e", "n", True, ""))
    with pytest.raises(ValueError, match="no model file"):
        engines.pinned(have, "e", "m", ("e", "m", False, "no model file"))


def test_results_match_their_requests(spark):
    asked = spark.createDataFrame([(1, "v", 0), (2, "v", 1)], "n int, voice_id string, seed int")
    made = asked.withColumn("result_rate_hz", F.when(F.col("n") == 1, 24000).otherwise(8000)).withColumn("seed", F.lit(0))
    assert [(r.n, r.wrong) for r in engines.mismatched(made, asked, "n", ["voice_id", "seed"], 24000).collect()] == [(2, ["seed", "result_rate_hz"])]


def test_environment(spark):
    found = doctor.environment(spark)
    assert found["healthy"] and found["versions"]["spark"] == spark.version and found["modules"]["pyarrow"]
    assert found["settings"]["spark.sql.shuffle.partitions"] == "4" and set(found["tools"]) == set(doctor.TOOLS)

"""Byte timelines, media checks, reviews and artifact checks on small cases."""

import io

import pytest
from pyspark.sql import functions as F

from libretto.operators import assembly, reviews, timeline
from libretto.sources import artifacts


def test_pieces_are_written_in_order(spark):
    rows = [("b", 1, 2, 3, b"\1\0\2\0\3\0"), ("b", 0, 1, 1, b"\7\0"), ("b", 2, 0, 0, b"")]
    df = spark.createDataFrame(rows, "book string, seq int, pause_frames long, audio_frames long, pcm binary")
    pieces = assembly.pcm_pieces(timeline.timeline(df, ["book"], ["seq"]))
    out = io.BytesIO()
    assert assembly.write_pieces(pieces, out, ["seq"]) == 14
    assert out.getvalue() == b"\0\0\7\0" + b"\0\0" * 2 + b"\1\0\2\0\3\0"
    bad = assembly.pcm_pieces(timeline.timeline(df.withColumn("audio_frames", F.lit(5).cast("long")), ["book"], ["seq"]))
    with pytest.raises(ValueError, match="frame-count"):
        assembly.write_pieces(bad, io.BytesIO())
    with pytest.raises(ValueError, match="gap"):
        assembly.write_pieces(pieces.where("seq <> 1"), io.BytesIO())


def test_media(spark):
    kind = "id int, codec string, channels int, sample_rate int, duration_ms long, expected_ms long, loudness double, true_peak double, tags map<string,string>, expected_tags map<string,string>, has_cover boolean, wants_cover boolean, chapters array<struct<title:string,start_ms:long,end_ms:long>>, expected_chapters array<struct<title:string,start_ms:long,end_ms:long>>"
    marks = [("uno", 0, 500), ("due", 500, 900)]
    good = ("aac", 1, 24000, 900, 950, -18.2, -2.2, {"title": "t", "more": "m"}, {"title": "t"}, True, True, marks, [("uno", 0, 501), ("due", 501, 900)])
    rows = [(0, *good), (1, "mp3", 2, 8000, 900, 1200, -10.0, 0.0, {}, {"title": "t"}, False, True, marks[:1], marks), (2, *good[:-2], [("uno", 0, 499), ("due", 500, 900)], marks), (3, *good[:-2], None, marks)]
    got = {r.id: r for r in assembly.media_faults(timeline.media_problems(spark.createDataFrame(rows, kind), 24000), 24000).collect()}
    assert got[0].problems == [] and got[0].faults == []
    assert got[1].problems == ["codec", "channels", "sample-rate", "duration", "loudness", "true-peak"] and got[1].faults == ["tags", "cover", "chapters"]
    assert got[2].faults == ["markers-not-contiguous"] and got[3].faults == ["chapters"]


def test_agreement_counts_nulls(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), ("b", None), ("c", None)], "k string, v int")
    assert sorted(map(tuple, assembly.agreement(df, "k", "v").collect())) == [("a", 1, 1, True), ("b", None, 2, False), ("c", None, 1, True)]


def test_reviews(spark):
    df = spark.createDataFrame([(1, "paragraph", "a ```` b", [], []), (2, "quote", "x", [], []), (3, "paragraph", "y", ["w"], []), (4, "paragraph", "z", [], ["r"])], "block_id int, kind string, display_text string, warnings array<string>, transformations array<string>")
    assert [r.block_id for r in reviews.extraction_review(df).collect()] == [2, 3] and [r.block_id for r in reviews.normalization_review(df).collect()] == [3, 4]
    lines = [r.lines for r in reviews.block_lines(df.withColumn("c", F.lit(1)), "c", "block_id").orderBy("block_id").collect()]
    assert lines[0] == "## 1 (paragraph)\n\n`````text\na ```` b\n`````\n" and lines[2].endswith("```\n- w\n")


def test_envelopes_are_checked(spark, tmp_path):
    sha = artifacts.write_envelope(str(tmp_path), "a.json", "chunks", {"t": "è \"x\"", "payload_sha256": "no"})
    artifacts.write_envelope(str(tmp_path), "b.json", "book", [1, {"u": None}], [("a.json", sha)])
    (tmp_path / "c.json").write_text((tmp_path / "b.json").read_text().replace("null", "true"))
    got = {r.path[-6:]: r.problem for r in artifacts.checked_envelopes(spark, str(tmp_path)).collect()}
    assert got == {"a.json": None, "b.json": None, "c.json": "payload-checksum"}
    assert {r.path[-6:]: r.problem for r in artifacts.checked_envelopes(spark, str(tmp_path), "book").collect()} == {"a.json": "type", "b.json": None, "c.json": "payload-checksum"}

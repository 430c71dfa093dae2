"""Chunks, timelines, structure, states, lineage and studies on small cases."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from libretto.operators import chapters, chunks, lineage, states, studies, timeline
from libretto.sources import artifacts
from libretto.sources.ast import block_rows
from libretto.streaming import resume

BLOCKS = [
    ("b", "chapter-0001", 0, "block-1", 0, "Vento freddo. La notte scende su di noi."),
    ("b", "chapter-0001", 0, "block-2", 1, "Tacque."),
    ("b", "chapter-0002", 1, "block-3", 2, "Ora alba."),
]


@pytest.fixture
def blocks(spark):
    return spark.createDataFrame([(*b, b[-1]) for b in BLOCKS], "book_id string, chapter_id string, chapter_order int, block_id string, block_pos int, display_text string, spoken_text string")


def test_chunks(spark, blocks):
    got = chunks.chunked(blocks, 20).orderBy("sequence").collect()
    assert [r.chunk_id for r in got] == ["block-1.s0000.p0000", "block-1.s0001.p0000", "block-1.s0001.p0001", "block-2.s0000.p0000", "block-3.s0000.p0000"]
    assert [r.pause.break_before for r in got] == ["chapter", "sentence", "none", "paragraph", "chapter"]
    assert [r.sequence for r in got] == list(range(5)) and all(len(r.spoken_text) <= 20 for r in got)
    r = got[0]
    assert r.content_sha256 == artifacts.digest({"chapter_id": r.chapter_id, "expected_language": "it", "paragraph_id": r.paragraph_id, "sentence_id": r.sentence_id, "spoken_text": r.spoken_text})
    packed = chunks.chunked(blocks, 40, pack=True).orderBy("sequence").collect()
    assert [r.chunk_id for r in packed] == ["block-1.s0000-s0001.p0000", "block-2.s0000.p0000", "block-3.s0000.p0000"]
    assert packed[0].display_text == "Vento freddo. La notte scende su di noi."
    assert chunks.anomalies(chunks.chunked(blocks, 20), 20).count() == 0
    assert chunks.anomalies(chunks.chunked(blocks, 20), 5).count() == 5


def test_clause_pause_behind_a_colon(spark):
    t = "Un invito: vieni al porto. Ora."
    df = spark.createDataFrame([("b", "c", 0, "k", 0, t, t)], "book_id string, chapter_id string, chapter_order int, block_id string, block_pos int, display_text string, spoken_text string")
    got = chunks.chunked(df, 60, at_colons=True).orderBy("sequence").collect()
    assert [(r.spoken_text, r.pause.duration_ms) for r in got] == [("Un invito:", 1500), ("vieni al porto.", 150), ("Ora.", 250)]


def test_timeline_and_markers(spark):
    df = spark.createDataFrame([("b", 0, "x", 10, 100), ("b", 1, "x", 20, 200), ("b", 2, "y", 30, 50)], "book string, seq int, chapter string, pause_frames long, audio_frames long")
    t = timeline.timeline(df, ["book"], ["seq"])
    assert [r.start_frame for r in t.orderBy("seq").collect()] == [10, 130, 360]
    assert [(r.chapter, r.start_frame, r.end_frame) for r in timeline.markers(t, ["book"], "chapter").orderBy("start_frame").collect()] == [("x", 0, 360), ("y", 360, 410)]
    text = timeline.ffmetadata(timeline.markers(t, ["book"], "chapter").withColumn("t", F.lit("a=b;")), 24_000, "t", "book").first().ffmetadata
    assert text.startswith(";FFMETADATA1\n[CHAPTER]\nTIMEBASE=1/24000\nSTART=0\nEND=360\n") and r"title=a\=b\;" in text
    assert spark.range(1).select(timeline.frames_of(F.lit(0.5), 1000).alias("x")).first().x == 0


def brute_segments(rows, fallback):
    """One book's rows (pos, level, text), walked in order: {pos: (chapter, title, block)}, None for the excluded."""
    closed, own, waiting, title, seen, out = [], [], [], fallback, False, {}

    def close(name):
        if own:
            closed.append((name, list(own)))
            own.clear()

    off = False
    for pos, level, text in rows:
        if level is not None and level < 1:
            close(title if seen else "Front matter")
            waiting.append((pos, text))
            off = False
        elif level == 1 and text == "Bibliografia":
            close(title if seen else "Front matter")
            out |= {p: None for p, _ in waiting} | {pos: None}
            waiting, off = [], True
        else:
            if level == 1:
                close(title if seen else "Front matter")
                title, seen, off = text, True, False
                own += [p for p, _ in waiting]
                waiting = []
            if off:
                out[pos] = None
            else:
                own.append(pos)
    own += [p for p, _ in waiting]
    close(waiting[-1][1] if waiting and not seen else title)
    block = 0
    for n, (name, places) in enumerate(closed):
        for p in places:
            block += 1
            out[p] = (n, name, block)
    return out


def test_segments(spark):
    rng = random.Random(8)
    books = {"empty": []}
    for b in range(60):
        kinds = [rng.choice([None, None, None, 0, 1, 1, "refs"][: rng.choice([4, 6, 7])]) for _ in range(rng.randint(1, 12))]
        books[f"b{b}"] = [(i, 1 if k == "refs" else k, "Bibliografia" if k == "refs" else f"t{i}") for i, k in enumerate(kinds)]
    df = spark.createDataFrame([(b, *r) for b, rows in books.items() for r in rows], "book_id string, pos int, level int, text string")
    got = {}
    for r in chapters.segmented(df, fallback="Il libro").collect():
        got.setdefault(r.book_id, {})[r.pos] = None if r.excluded else (r.chapter_no, r.chapter_title, r.block_no)
    for b, rows in books.items():
        assert got.get(b, {}) == brute_segments(rows, "Il libro"), rows


def test_intervals_draw_as_the_seeded_generator_does(spark):
    values = [5.0, 1.0, 9.0, 2.5]
    rng = random.Random(0)
    medians = sorted(statistics.median(rng.choices(values, k=4)) for _ in range(200))
    want = (medians[round(0.025 * 199)], medians[round(0.975 * 199)])
    assert studies.median_interval(values, 200) == studies.median_interval(values, 200, block=7) == want
    assert studies.median_interval([1.0]) is None
    df = spark.createDataFrame([("g", v, i) for i, v in enumerate(values)] + [("h", None, 0)], "g string, v double, i int")
    got = {r.g: r for r in studies.median_intervals(df, "g", "v", "i", 200).collect()}
    assert (got["g"].low, got["g"].high) == want and got["g"].median == 3.75 and got["h"].low is None


def test_scope(spark):
    df = spark.createDataFrame([(f"c{i}", i) for i in range(4)], "chapter_id string, chapter_order int")
    assert chapters.scope(df, ["c1", "c2"]).count() == 2 and chapters.scope(df, None).count() == 4
    for bad in ([], ["c1", "c1"], ["c1", "c3"], ["c2", "c1"], ["nope"], [" "]):
        with pytest.raises(ValueError):
            chapters.scope(df, bad)


def test_classification(spark):
    base = {"transcript": "un passo avanti", "wer": 0.0, "cer": 0.0, "missing_prefix_words": 0, "missing_suffix_words": 0, "repeated_ngram_count": 0, "silence_ratio": 0.0, "clipped_sample_ratio": 0.0, "speaking_rate_wpm": 131.0, "word_count": 25, "attempt_number": 0}
    cases = [({}, [], "accepted"), ({"missing_suffix_words": 2}, ["missing-suffix"], "retryable"), ({"missing_prefix_words": 2, "attempt_number": 1}, ["missing-prefix"], "review"), ({"silence_ratio": 0.99}, ["excessive-silence"], "retryable"), ({"speaking_rate_wpm": 400.0}, ["speaking-rate-high"], "retryable"), ({"speaking_rate_wpm": 48.0, "word_count": 1}, [], "accepted"), ({"wer": 0.8, "cer": 0.9}, ["wer-high", "cer-high"], "review"), ({"transcript": " "}, ["empty-transcript"], "retryable")]
    df = spark.createDataFrame([(i, *{**base, **u}.values()) for i, (u, _, _) in enumerate(cases)], ["i", *base])
    got = states.classified(df, retries=1).orderBy("i").collect()
    assert [(r.reason_codes, r.status) for r in got] == [(a, b) for _, a, b in cases]
    assert states.overall(states.classified(df, retries=1)).first().status == "retryable"


def test_state_joins(spark):
    c = spark.createDataFrame([(i, i) for i in range(4)], "chunk_id int, sequence int").withColumn("cache_key", F.lit("k"))
    s = states.generation_state(c, c.where("chunk_id = 0"), c.where("chunk_id in (0, 1)"))
    assert [r.state for r in s.orderBy("sequence").collect()] == ["generated", "failed", "missing", "missing"]
    assert states.pending(s).count() == 3 and states.selected(s, 1, 2).count() == 2 and states.selected(s, failed_only=True).count() == 1
    v = spark.createDataFrame([("a", "g", "review", ["wer-high"]), ("b", "g", "accepted", [])], "chunk_id string, generation_sha256 string, status string, reason_codes array<string>")
    d = spark.createDataFrame([("a", "g", "accept"), ("b", "old", "regenerate")], "chunk_id string, generation_sha256 string, action string")
    got = {r.chunk_id: r for r in states.decided(v, d).collect()}
    assert got["a"].status == "accepted" and got["a"].reason_codes[-1] == "manual-accept" and got["b"].refused == "stale"


def test_lineage(spark, tmp_path):
    a = spark.createDataFrame([("x", "1", []), ("y", "2", [("x", "1"), ("z", "0")]), ("w", "3", [("y", "9")])], "path string, sha256 string, dependencies array<struct<path:string,sha256:string>>")
    assert sorted(map(tuple, lineage.stale(a).collect())) == [("w", "y", "changed"), ("y", "z", "missing")]
    sha = artifacts.write_envelope(str(tmp_path), "m/one.json", "book-document", {"b": 1, "a": "è"})
    artifacts.write_envelope(str(tmp_path), "m/two.json", "chunk-manifest", [], [("m/one.json", sha)])
    rows = {r.path.rsplit("/", 1)[1]: r for r in artifacts.read_envelopes(spark, str(tmp_path)).collect()}
    assert rows["one.json"].sha256 == sha and rows["two.json"].dependencies[0].sha256 == sha
    assert rows["one.json"].payload_sha256 == artifacts.digest({"a": "è", "b": 1})
    with pytest.raises(ValueError):
        artifacts.write_envelope(str(tmp_path), "m/two.json", "x", [], [("m/one.json", "0")])
    with pytest.raises(ValueError):
        artifacts.within("/r", "../x")


def test_latex_tree(tmp_path):
    (tmp_path / "main.tex").write_text("a % \\input{b}\n\\input{b} c\\% d\n")
    (tmp_path / "b.tex").write_text("inner")
    assert artifacts.inlined(str(tmp_path), "main") == "a\ninner c\\% d"
    (tmp_path / "b.tex").write_text("\\input{main}")
    with pytest.raises(ValueError):
        artifacts.inlined(str(tmp_path), "main")


def test_ast_blocks():
    s = lambda t: {"t": "Str", "c": t}
    note = {"t": "Note", "c": [{"t": "Para", "c": [s("n")]}]}
    doc = [
        {"t": "Header", "c": [1, ["", [], []], [s("T")]]},
        {"t": "Para", "c": [s("a"), {"t": "Space"}, s("b"), note]},
        {"t": "Para", "c": [{"t": "Math", "c": [{"t": "DisplayMath"}, "x"]}]},
        {"t": "BulletList", "c": [[{"t": "Plain", "c": [s("i")]}]]},
        {"t": "BlockQuote", "c": [{"t": "Para", "c": [s("q")]}]},
        {"t": "Para", "c": [{"t": "Image", "c": [["", [], []], [s("image")], ["f", ""]]}]},
        {"t": "HorizontalRule"},
    ]
    got = [(r[0], r[2], r[4]) for r in block_rows(doc)]
    assert got == [("heading", "T", None), ("paragraph", "a b", None), ("footnote", "n", None), ("equation", "x", None), ("list_item", "i", None), ("quotation", "q", None), ("caption", "", "non-narratable-image"), ("paragraph", "", "unsupported-block")]


def test_studies(spark):
    rows = [("s", p, "base" if p in (1, 4) else "variant", "x", g, g / 2) for p, g in ((1, 40.0), (2, 30.0), (3, 32.0), (4, 44.0))] + [("t", 1, "base", "x", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "session_id string, pass_index int, candidate string, excerpt string, generation_seconds double, rtf double")
    (got,) = studies.paired(df, "base", "variant").collect()
    assert (got.base_s, got.variant_s) == (42.0, 31.0) and got.reduction == pytest.approx(1 - 31 / 42)
    assert studies.median_interval([1.0]) is None and studies.median_interval([1.0, 2.0, 3.0]) == studies.median_interval([1.0, 2.0, 3.0])
    assert studies.blind(spark.range(3).withColumnRenamed("id", "excerpt_id"), ["a", "b"]).count() == 6


def test_streams_write_once_and_total_by_hour(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "y")], "k string, v string")
    rows.write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    for run in ("c1", "c2"):  # a second run from nothing writes nothing twice
        resume.write_once(read(), str(tmp_path / "out"), str(tmp_path / run), "k").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
    events = spark.createDataFrame([("click", "2024-01-01 10:10:00", 1.0), ("click", "2024-01-01 10:50:00", 2.0)], "event_type string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert [(r.n, r.total) for r in resume.hourly(events).collect()] == [(2, 3.0)]


def test_synthesis_resumes_and_the_loop_ends(spark, tmp_path):
    from libretto.functions import audio
    from libretto.operators import synthesis

    c = spark.createDataFrame([("a", "uno due tre quattro", "h1"), ("b", "bad", "h2"), ("c", "cinque sei sette otto", "h3")], "chunk_id string, spoken_text string, content_sha256 string")
    keyed = synthesis.cache_keys(c, "fake", "1", "v", 8000, 3, 1.0)

    def engine():
        def run(text, seed, rate, speed):
            if text == "bad":
                raise RuntimeError("no voice")
            return audio.voice(text, seed, rate, speed / 8)

        return run

    stores = iter(range(100))

    def keep(df):
        path = str(tmp_path / f"k{next(stores)}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    nothing = spark.createDataFrame([], synthesis.GENERATED)
    made = keep(synthesis.synthesised(keyed, nothing, engine, 8000, 3))
    got = {r.chunk_id: r for r in made.collect()}
    assert got["b"].exception_type == "RuntimeError" and got["b"].attempt_count == 2 and got["a"].frame_count > 0
    assert synthesis.state(made).first().status == "partial"
    again = synthesis.synthesised(keyed, made, engine, 8000, 3)
    assert [r.chunk_id for r in again.select("chunk_id").collect()] == ["b"]
    said = {bytes(audio.voice(t, 3 + n, 8000, 1 / 8)): (t if i == "a" or n else "") for i, t in (("a", "uno due tre quattro"), ("c", "cinque sei sette otto")) for n in range(3)}
    final, checked = synthesis.verification_loop(keyed, made, engine, lambda: lambda pcm: said[pcm], keep, 8000, 3)
    status = {r.chunk_id: (r.status, r.attempt_number) for r in checked.collect()}
    assert status["a"][0] == "accepted" and status["c"] == ("accepted", 1)
    assert final.count() == 3


def test_pages_and_references(spark):
    from libretto.operators import pages

    p = spark.createDataFrame([(1, "text", 0, 0), (2, " ", 0, 3), (3, "", 1, 0)], "page int, text string, images int, drawings int")
    cls = [r.c for r in p.select("page", pages.page_class(F.col("text"), F.col("images"), F.col("drawings")).alias("c")).orderBy("page").collect()]
    assert cls == ["text", "blank", "scanned"]
    with pytest.raises(Exception, match="scanned"):
        pages.checked_pages(p).collect()
    t = r"\chapter{A}\label{a}\section{S}\label{s}\begin{figure}\label{f}\chapter*{X}\label{x}\appendix\chapter{B}\label{b} see \ref{f}, \autoref{s} and \appref{no}"
    books = spark.createDataFrame([("k", t)], "book_id string, text string")
    index = pages.reference_index(books)
    assert {r.label: r.target for r in index.collect()} == {"a": "capitolo 1", "s": "sezione 1.1", "f": "figura 1.1", "x": None, "b": "appendice A"}
    row = pages.resolved(books, index).first()
    assert row.text.endswith("see figura 1.1, sezione 1.1 and appendice non risolta") and row.unresolved == ["no"]


def test_bundles_and_reports(spark, tmp_path):
    from libretto.sources import bundles

    (tmp_path / "a.txt").write_text("x")
    first = bundles.publish(str(tmp_path), str(tmp_path / "out"), {"a.txt": "text"})
    assert bundles.publish(str(tmp_path), str(tmp_path / "out"), {"a.txt": "text"}) == first
    (tmp_path / "out" / first.rsplit("/", 1)[1] / "b").write_text("y")
    with pytest.raises(ValueError):
        bundles.verify(first)
    assert bundles.fenced("a`b") == "``a`b``" and bundles.fenced("x") == "`x`"
    text = bundles.report("T", spark.range(1), ("Rows", spark.range(3)), most=2)
    assert "| 0 |" in text and "first 2 rows" in text


def test_qualification(spark):
    from libretto.functions import audio
    from libretto.operators import qualification as q

    c = spark.createDataFrame([(1, 0, ["a", "b"], "uno due"), (2, 1, ["a"], "tre")], "excerpt_id int, pos int, categories array<string>, spoken_text string")
    assert q.corpus_problems(c, ["a", "b"], 2).count() == 0
    assert {r.problem for r in q.corpus_problems(c.union(c), ["z"], 2).collect()} == {"4 excerpts", "repeated: 1", "repeated: 2", "no excerpt for z"}
    s = q.qualified(c, lambda: audio.voice, 8000, 1).withColumn("generation_seconds", F.lit(1.0))
    t = q.totals(s).first()
    assert (t.n, t.failed, t.status) == (2, 0, "completed") and t.rtf == pytest.approx(2 / (2 * 0.084), rel=0.1)
    heard = c.withColumn("transcript", F.lit("uno tre"))
    assert q.scores(heard).first().wer == pytest.approx(2 / 3)
    assert {r.value: r.n for r in q.scores(heard, "categories").collect()} == {"a": 2, "b": 1}
    assert q.mismatched(c, c).count() == 0 and q.mismatched(c.where("pos = 0"), c).count() == 1


def test_media(spark):
    from libretto.sources import media

    report = '{"streams":[{"codec_type":"audio","codec_name":"aac","channels":1,"sample_rate":"24000"}],"format":{"duration":"1.2345","tags":{"title":"t"}},"chapters":[]}'
    r = media.probed(spark.createDataFrame([(report,)], "p string"), "p").first()
    assert (r.codec, r.channels, r.sample_rate, r.duration_ms, r.has_cover) == ("aac", 1, 24_000, 1234, False)
    assert media.token_diff("ha 5 anni.", "ha cinque anni.") == [("replace", "5", "cinque")]
    names = spark.createDataFrame([("b", None, None), ("b", "c1", "c1"), ("b", "c1", "c2")], "b string, f string, l string")
    assert [x.n for x in names.select(media.output_name(F.col("b"), F.col("f"), F.col("l")).alias("n")).collect()] == ["b.m4b", "b-c1.m4b", "b-c1-to-c2.m4b"]
    assert spark.range(1).select(media.redacted(F.lit("x /a/b/c /a"), {"/a": "home", "/a/b": "root"}).alias("x")).first().x == "x <root>/c <home>"
    text = 'x {"a":1} {"input_i":"-18","output_i":"-18","input_tp":"-2"} y'
    assert spark.createDataFrame([(text,)], "t string").select(artifacts.loudness(F.col("t")).alias("x")).first().x.input_tp == "-2"


def test_length_stats(spark):
    df = spark.createDataFrame([("a", n) for n in (9, 1, 5, 5, 2)] + [("b", 1), ("b", 2)], "k string, n int")
    got = {r.k: (r.n, r.shortest, r.median, r.p95, r.longest, r.at_limit) for r in chunks.length_stats(df, F.col("n"), 5, "k").collect()}
    assert got == {"a": (5, 1, 5, 9, 9, 3), "b": (2, 1, 2, 2, 2, 0)}


def test_diverted_blocks_and_their_warnings(spark):
    df = spark.createDataFrame([(1, "footnote", "n" * 130), (2, "paragraph", "p"), (3, None, "x")], "id int, kind string, display_text string")
    stay, gone = chapters.diverted(df, ["footnote", "table"])
    assert [r.id for r in stay.orderBy("id").collect()] == [2, 3]
    (r,) = gone.collect()
    assert r.reason_code == "configured-block-exclusion" and r.description == "footnote: " + "n" * 117 + "..."
    for bad in (["heading"], ["table", "table"]):
        with pytest.raises(ValueError):
            chapters.diverted(df, bad)
    w = spark.createDataFrame([("equation", ["equation-requires-review: x", "b"]), ("paragraph", ["equation-requires-review: x"])], "k string, w array<string>")
    assert [r.x for r in w.select(chapters.own_warnings(F.col("w"), F.col("k")).alias("x")).collect()] == [["b"], ["equation-requires-review: x"]]

"""The registered queries: name -> callable(spark, sf_dir), and the SQL for the same rows.

Each query reads the columns it needs, so that scans are pruned; SQL is stated where DuckDB can
express the result. Conversations stand for books (a conversation), chapters (three turns) and
blocks (a turn) where an operator needs that structure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from libretto.functions import audio, metrics, rules, sentences, text
from libretto.operators import chapters, chunks, lineage, states, studies, timeline
from libretto.sources.ast import AstBlocks

QUERIES: dict = {}
SQL: dict[str, str] = {}
RATE = 24_000


def query(sql: str | None = None):
    """Register a function under its name, with the SQL of its rows if there is one."""

    def put(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return put


def queries() -> dict:
    """All of them, the flagship first."""
    return {"chunk_manifest": QUERIES["chunk_manifest"]} | QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    return df.select(*columns) if columns else df


def blocks_of(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations as blocks: a conversation is a book, three turns a chapter, a turn a block."""
    c = table(spark, sf, "conversations", "conv_id", "turn", "text")
    chapter = F.floor(F.col("turn") / 3).cast("int")
    return c.select(
        F.col("conv_id").alias("book_id"), F.format_string("chapter-%04d", chapter + 1).alias("chapter_id"), chapter.alias("chapter_order"),
        F.format_string("block-%06d", F.col("turn")).alias("block_id"), F.col("turn").alias("block_pos"),
        text.cleaned(F.col("text")).alias("display_text"), text.cleaned(F.col("text")).alias("spoken_text"),
    ).where("display_text <> ''")


# ---- text functions

CLEAN = r"""regexp_replace(trim(regexp_replace(text, '\s+', ' ', 'g')), '([€$£])(\p{L})', '\1 \2', 'g')"""


@query(f"SELECT doc_id, md5({CLEAN}) AS cleaned, length({CLEAN})::BIGINT AS n FROM documents")
def text_cleanup(spark, sf):
    t = text.cleaned(F.col("text"))
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(t).alias("cleaned"), F.length(t).cast("long").alias("n"))


@query(r"SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[ \t\r\n]+', ' ', 'g'), ' +([.,;:!?])', '\1', 'g'))) AS tidied FROM documents")
def whitespace_rule(spark, sf):
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5(text.tidied(F.col("text"))).alias("tidied"))


COUNT = r"len(regexp_extract_all(text, '[\p{L}\p{N}_]+(?:[''’][\p{L}\p{N}_]+)*'))"


@query(f"SELECT lang, count(*) AS documents, sum({COUNT})::BIGINT AS words FROM documents GROUP BY lang")
def word_count_by_lang(spark, sf):
    d = table(spark, sf, "documents", "lang", "text")
    return d.groupBy("lang").agg(F.count("*").alias("documents"), F.sum(text.word_count(F.col("text"))).alias("words"))


@query(f"SELECT source, sum({COUNT} * 400)::BIGINT AS speech_ms, max({COUNT} * 400)::BIGINT AS longest_ms FROM documents GROUP BY ROLLUP (source)")
def speech_estimate(spark, sf):
    d = table(spark, sf, "documents", "source", "text").withColumn("ms", text.speech_ms(text.word_count(F.col("text"))))
    return d.rollup("source").agg(F.sum("ms").alias("speech_ms"), F.max("ms").alias("longest_ms"))


@query("SELECT order_id, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS clock FROM (SELECT o_orderkey AS order_id, (o_totalprice * 100)::BIGINT AS ms FROM orders)")
def duration_clock(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_totalprice")
    return o.select(F.col("o_orderkey").alias("order_id"), text.clock(F.bround(F.col("o_totalprice") * 100).cast("long")).alias("clock"))


@query("SELECT doc_id, CASE WHEN length(text) <= 120 THEN text ELSE left(text, 117) || '...' END AS preview FROM documents")
def previews(spark, sf):
    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", text.preview(F.col("text")).alias("preview"))


@query("SELECT c_custkey, lower(regexp_replace(replace(c_mktsegment || 'Plan' || c_custkey, ' ', ''), '(.)([A-Z])', '\\1-\\2', 'g')) AS kebab FROM (SELECT c_custkey, lower(c_mktsegment) AS c_mktsegment FROM customer)")
def artifact_types(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    return c.select("c_custkey", text.kebab(F.concat(F.lower("c_mktsegment"), F.lit("Plan"), F.col("c_custkey"))).alias("kebab"))


@query("SELECT doc_id, coalesce(list_sort(list_distinct(regexp_extract_all(text, '[<>@#%€$£]'))), []) AS symbols FROM documents WHERE regexp_matches(text, '[<>@#%€$£]')")
def unresolved_symbols(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "text").where(F.col("text").rlike("[<>@#%€$£]"))
    return d.select("doc_id", text.unresolved(F.col("text")).alias("symbols"))


@query("""SELECT p_partkey, CASE WHEN n > 702 THEN chr((65 + ((n - 1) // 26 - 1) // 26 - 1)::INT) ELSE '' END || CASE WHEN n > 26 THEN chr((65 + ((n - 1) // 26 - 1) % 26)::INT) ELSE '' END || chr((65 + (n - 1) % 26)::INT) AS letters
FROM (SELECT p_partkey, p_partkey % 18278 + 1 AS n FROM part)""")
def appendix_letters(spark, sf):
    return table(spark, sf, "part", "p_partkey").select("p_partkey", text.letters_of(F.col("p_partkey") % 18278 + 1).alias("letters"))


@query(r"""SELECT item_id, trim(regexp_replace(regexp_replace(translate(lower(text), '’‘ʼ`´＇', ''''''''''''''''), '[!-&(-/:-@\[-`{-~¡§«¶·»¿–—“”…]', ' ', 'g'), '\s+', ' ', 'g')) AS comparable FROM benchmark""")
def comparison_text(spark, sf):
    return table(spark, sf, "benchmark", "item_id", "text").select("item_id", text.comparable(F.col("text")).alias("comparable"))


# ---- sentences and chunks


def _split_sql(t: str) -> str:
    for a in sorted(sentences.ABBREVIATIONS, key=len, reverse=True):
        t = f"regexp_replace({t}, '{a.replace('.', chr(92) + '.')}', '{a.replace('.', sentences.HELD)}', 'gi')"
    for _ in range(2):
        t = f"regexp_replace({t}, '(^|[^\\p{{L}}\\p{{N}}_])(\\p{{Lu}})\\.(\\s+\\p{{Lu}})', '\\1\\2{sentences.HELD}\\3', 'g')"
    t = f"string_split(regexp_replace({t}, '([.!?])\\s+', '\\1{sentences.CUT}', 'g'), '{sentences.CUT}')"
    return f"list_filter(list_transform({t}, lambda s: trim(translate(s, '{sentences.HELD}', '.'))), lambda s: s <> '')"


SPLIT = f"SELECT doc_id, lang, {_split_sql(CLEAN)} AS ss FROM documents"


def _sentences(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "lang", "text")
    return d.select("doc_id", "lang", sentences.sentences(text.cleaned(F.col("text"))).alias("ss"))


@query(f"SELECT doc_id, i - 1 AS i, s AS sentence FROM (SELECT doc_id, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM ({SPLIT}))")
def sentence_split(spark, sf):
    return sentences.rows_of(_sentences(spark, sf), "ss", "doc_id").withColumn("i", F.col("i").cast("long"))


@query(f"""WITH s AS (SELECT lang, length(unnest(ss))::INT AS n FROM ({SPLIT})), l AS (SELECT lang, list_sort(list(n)) AS v FROM s GROUP BY lang)
SELECT lang, len(v)::BIGINT AS n, v[1] AS shortest, v[-1] AS longest, len(list_filter(v, lambda x: x >= 300))::BIGINT AS at_limit, v[((len(v) - 1) * 50 + 99) // 100 + 1] AS median, v[((len(v) - 1) * 95 + 99) // 100 + 1] AS p95 FROM l""")
def chunk_length_stats(spark, sf):
    s = sentences.rows_of(_sentences(spark, sf), "ss", "lang", value="s")
    return chunks.length_stats(s, F.length("s"), 300, "lang")


@query(f"SELECT lang, CASE WHEN n < 20 THEN 'short' ELSE 'near character limit' END AS outlier, count(*) AS n FROM (SELECT lang, length(unnest(ss)) AS n FROM ({SPLIT})) WHERE n < 20 OR n >= 270 GROUP BY ALL")
def chunk_outliers(spark, sf):
    s = sentences.rows_of(_sentences(spark, sf), "ss", "lang", value="s")
    return chunks.outliers(s, F.length("s"), 300).groupBy("lang", "outlier").agg(F.count("*").alias("n"))


def _parts_sql(keys: str, units: str, limit: int) -> str:
    """CTEs that end in parts (keys, f, part, spoken): the units (keys, f, u) of a query cut by the rules of cut_at."""
    ends = f"list_filter(range(2, {limit + 1}), lambda e: substr(rest, e, 1) = ' ' AND substr(rest, e - 1, 1) IN (';', ':', ','))"
    halves = f"list_filter(ends, lambda e: e >= {limit // 4} AND n - e BETWEEN {limit // 4} AND {limit})"
    best = f"list_sort(list_transform({halves}, lambda e: {{'weak': (substr(rest, e - 1, 1) = ',')::INT, 'off': abs(2 * e - n), 'cut': e}}))[1]['cut']"
    blank = f"list_max(list_filter(range(2, {limit + 2}), lambda q: substr(rest, q, 1) = ' ')) - 1"
    return f"""cuts AS (SELECT {keys}, f, 0 AS part, NULL::VARCHAR AS spoken, u AS rest FROM ({units})
    UNION ALL SELECT {keys}, f, part + 1, trim(substr(rest, 1, cut::INT)), trim(substr(rest, cut::INT + 1)) FROM (SELECT *, coalesce({best}, ends[-1], {blank}) AS cut FROM
    (SELECT *, length(rest) AS n, {ends} AS ends FROM cuts WHERE length(rest) > {limit}))),
parts AS (SELECT {keys}, f, part - 1 AS part, spoken FROM cuts WHERE part > 0 UNION ALL SELECT {keys}, f, part, rest FROM cuts WHERE length(rest) <= {limit} AND rest <> '')"""


@query(f"""WITH RECURSIVE {_parts_sql("doc_id", f"SELECT doc_id, unnest(ss) AS u, generate_subscripts(ss, 1) AS f FROM ({SPLIT})", 300)}
SELECT doc_id, (SELECT count(*) FROM parts WHERE parts.doc_id = d.doc_id)::INT AS n_parts, (SELECT count(*) FILTER (part > 0) FROM parts WHERE parts.doc_id = d.doc_id)::INT AS forced_splits FROM documents d WHERE text IS NOT NULL""")
def limit_split(spark, sf):
    out = sentences.limit_split(_sentences(spark, sf).where("ss is not null"), "ss", 300)
    return out.select("doc_id", F.size(F.flatten("parts")).alias("n_parts"), F.aggregate("parts", F.lit(0), lambda n, p: n + F.size(p) - 1).alias("forced_splits"))


KEYS = "book_id, chapter_order, block_pos"
#: Units of blocks (KEYS, ss), each a sentence.
ALONE = f"SELECT {KEYS}, unnest(ss) AS u, generate_subscripts(ss, 1) - 1 AS f, generate_subscripts(ss, 1) - 1 AS l FROM blocks"


def _packs_sql(limit: int) -> str:
    """CTE packs: units of blocks, each as many neighbouring sentences as fit."""
    return f"""packs AS (SELECT {KEYS}, ss, 1 AS i, ss[1] AS u, 0 AS f, 0 AS l FROM blocks WHERE len(ss) > 0
    UNION ALL SELECT {KEYS}, ss, i + 1, CASE WHEN fits THEN u || ' ' || n ELSE n END, CASE WHEN fits THEN f ELSE i END, i FROM (SELECT *, ss[i + 1] AS n, length(u) + 1 + length(ss[i + 1]) <= {limit} AS fits FROM packs WHERE i < len(ss)))"""


def _chunks_sql(blocks: str, units: str, limit: int, before: str = "") -> str:
    """Chunks of blocks (KEYS, block_id, ss), their pauses in two columns."""
    return f"""WITH RECURSIVE blocks AS ({blocks}), {before} units AS ({units}), {_parts_sql(KEYS, "SELECT * FROM units", limit)},
c AS (SELECT book_id, chapter_order, block_pos, f, part, spoken, u, printf('chapter-%04d', (chapter_order + 1)::INT) AS chapter_id, block_id, block_id || '.s' || printf('%04d', f::INT) || CASE WHEN l > f THEN '-s' || printf('%04d', l::INT) ELSE '' END AS sentence_id
    FROM parts JOIN units USING ({KEYS}, f) JOIN blocks USING ({KEYS})),
w AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY chapter_order, block_pos, f, part) - 1 AS sequence, lag(block_pos) OVER o AS pb, lag(spoken) OVER o AS ps FROM c WINDOW o AS (PARTITION BY book_id, chapter_order ORDER BY block_pos, f, part)),
k AS (SELECT *, CASE WHEN pb IS NULL THEN 'chapter' WHEN pb <> block_pos THEN 'paragraph' WHEN part > 0 THEN 'none' WHEN ps LIKE '%:' THEN 'clause' ELSE 'sentence' END AS break_before FROM w)
SELECT book_id, sentence_id || '.p' || printf('%04d', part::INT) AS chunk_id, chapter_id, block_id AS paragraph_id, sentence_id, sequence::INT AS sequence, u AS display_text, spoken AS spoken_text, 'it' AS expected_language, break_before,
CASE break_before WHEN 'none' THEN 0 WHEN 'clause' THEN 150 WHEN 'sentence' THEN 250 WHEN 'paragraph' THEN 600 ELSE 1500 END AS duration_ms,
sha256('{{"chapter_id":"' || chapter_id || '","expected_language":"it","paragraph_id":"' || block_id || '","sentence_id":"' || sentence_id || '","spoken_text":' || to_json(spoken)::VARCHAR || '}}') AS content_sha256 FROM k"""


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(*(c for c in rows.columns if c != "pause"), "pause.*")


@query(_chunks_sql(f"SELECT doc_id AS book_id, 0 AS chapter_order, 0 AS block_pos, 'block-000001' AS block_id, ss FROM ({SPLIT})", ALONE, 300))
def chunk_manifest(spark, sf):
    """Documents as one-chapter books, chunked at 300 characters: ids, pauses and content hashes (flagship)."""
    d = table(spark, sf, "documents", "doc_id", "text")
    t = text.cleaned(F.col("text"))
    b = d.select(F.col("doc_id").alias("book_id"), F.lit("chapter-0001").alias("chapter_id"), F.lit(0).alias("chapter_order"), F.lit("block-000001").alias("block_id"), F.lit(0).alias("block_pos"), t.alias("display_text"), t.alias("spoken_text"))
    return _flat(chunks.chunked(b.where("display_text <> ''"), 300))


@query(f"""WITH RECURSIVE s AS (SELECT doc_id, ss FROM ({SPLIT}) WHERE len(ss) > 0),
p AS (SELECT doc_id, ss, 1 AS i, length(ss[1]) AS cur, 1 AS units, length(ss[1]) AS longest FROM s
    UNION ALL SELECT doc_id, ss, i + 1, CASE WHEN fits THEN cur + 1 + n ELSE n END, units + CASE WHEN fits THEN 0 ELSE 1 END, greatest(longest, CASE WHEN fits THEN cur + 1 + n ELSE n END)
    FROM (SELECT *, length(ss[i + 1]) AS n, cur + 1 + length(ss[i + 1]) <= 300 AS fits FROM p WHERE i < len(ss)))
SELECT doc_id, units::INT AS units, longest::INT AS longest FROM p WHERE i = len(ss)""")
def pack_sentences(spark, sf):
    found = _sentences(spark, sf).withColumn("u", sentences.packed(F.col("ss"), 300))
    both = F.struct(F.size("u").alias("units"), F.array_max(F.transform("u", lambda u: F.length(u["text"]))).alias("longest"))
    return sentences.rows_of(found, F.array(both), "doc_id", value="x").select("doc_id", "x.units", "x.longest").where("units > 0")


@query(_chunks_sql(f"SELECT conv_id AS book_id, turn // 3 AS chapter_order, turn AS block_pos, printf('block-%06d', turn::INT) AS block_id, {_split_sql(CLEAN)} AS ss FROM conversations", "SELECT * FROM packs QUALIFY row_number() OVER (PARTITION BY book_id, chapter_order, block_pos, f ORDER BY l DESC) = 1", 120, _packs_sql(120) + ","))
def conversation_chunks(spark, sf):
    return _flat(chunks.chunked(blocks_of(spark, sf), 120, pack=True))


@query("""WITH c AS (SELECT conv_id, turn, turn // 3 AS ch, turn // 2 AS pa, text, turn + (turn > 4)::INT AS seq, CASE WHEN turn = 0 THEN 'chapter' ELSE 'paragraph' END AS br FROM conversations),
w AS (SELECT *, lag(seq) OVER o AS ps, lag(ch) OVER o AS pc, lag(pa) OVER o AS pp, lag(text) OVER o AS pt FROM c WINDOW o AS (PARTITION BY conv_id ORDER BY seq)),
k AS (SELECT *, CASE WHEN pc IS NULL OR pc <> ch THEN 'chapter' WHEN pp <> pa THEN 'paragraph' WHEN pt LIKE '%:' THEN 'clause' ELSE 'sentence' END AS want FROM w),
a AS (SELECT conv_id AS book_id, 'c' || turn AS chunk_id, list_concat(list_concat(CASE WHEN seq <> coalesce(ps + 1, 0) THEN ['sequence'] ELSE [] END, CASE WHEN length(text) > 120 THEN ['limit'] ELSE [] END), CASE WHEN br <> want THEN ['break'] ELSE [] END) AS anomalies FROM k)
SELECT * FROM a WHERE len(anomalies) > 0""")
def chunk_anomalies(spark, sf):
    """Turns as chunks, with a gap in their sequence and breaks that don't follow their chapters and paragraphs."""
    c = table(spark, sf, "conversations", "conv_id", "turn", "text")
    kind = F.when(F.col("turn") == 0, "chapter").otherwise("paragraph")
    rows = c.select(
        F.col("conv_id").alias("book_id"), F.concat(F.lit("c"), "turn").alias("chunk_id"), F.floor(F.col("turn") / 3).alias("chapter_id"), F.floor(F.col("turn") / 2).alias("paragraph_id"),
        F.col("turn").alias("sentence_id"), (F.col("turn") + (F.col("turn") > 4).cast("int")).alias("sequence"), F.col("text").alias("spoken_text"), F.struct(kind.alias("break_before")).alias("pause"),
    )
    return chunks.anomalies(rows, 120).select("book_id", "chunk_id", "anomalies")


PAUSE = """WITH b AS (SELECT conv_id, turn, turn // 3 AS chapter, text, lag(turn // 3) OVER w AS before, lag(trim(text)) OVER w AS said FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
k AS (SELECT *, CASE WHEN before IS NULL OR before <> chapter THEN 'chapter' WHEN said LIKE '%:' THEN 'clause' ELSE 'paragraph' END AS kind FROM b)"""


def _paused(spark, sf):
    c = table(spark, sf, "conversations", "conv_id", "turn", "text").withColumn("chapter", F.floor(F.col("turn") / 3))
    w = Window.partitionBy("conv_id").orderBy("turn")
    before, said = F.lag("chapter").over(w), F.lag(F.trim("text")).over(w)
    kind = F.when(before.isNull() | (before != F.col("chapter")), "chapter").when(said.endswith(":"), "clause").otherwise("paragraph")
    return c.withColumn("kind", kind).withColumn("pause_ms", chunks.pause_ms(F.col("kind")))


@query(f"{PAUSE} SELECT conv_id, turn, kind, CASE kind WHEN 'chapter' THEN 1500 WHEN 'clause' THEN 150 ELSE 600 END::INT AS pause_ms FROM k")
def pause_plan(spark, sf):
    return _paused(spark, sf).select("conv_id", "turn", "kind", "pause_ms")


TIMED = f"""{PAUSE}, f AS (SELECT conv_id, turn, chapter, round_even(CASE kind WHEN 'chapter' THEN 1500 WHEN 'clause' THEN 150 ELSE 600 END * {RATE} / 1000.0, 0)::BIGINT AS pause_frames, round_even(length(text) * 12.5 * {RATE} / 1000, 0)::BIGINT AS audio_frames FROM k),
t AS (SELECT *, coalesce(sum(audio_frames + pause_frames) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + pause_frames AS start_frame FROM f)"""


def _timed(spark, sf):
    p = _paused(spark, sf).withColumn("pause_frames", timeline.frames_of(F.col("pause_ms"), RATE)).withColumn("audio_frames", timeline.frames_of(F.length("text") * F.lit(12.5), RATE))
    return timeline.timeline(p, ["conv_id"], ["turn"])


@query(f"{TIMED} SELECT conv_id, turn, pause_frames, audio_frames, start_frame FROM t")
def timeline_frames(spark, sf):
    return _timed(spark, sf).select("conv_id", "turn", "pause_frames", "audio_frames", "start_frame")


@query(f"""{TIMED}, m AS (SELECT conv_id, chapter, min(start_frame) AS s, max(start_frame + audio_frames) AS e FROM t GROUP BY ALL)
SELECT conv_id, chapter, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE s END::BIGINT AS start_frame, coalesce(lead(s) OVER w, max(e) OVER (PARTITION BY conv_id))::BIGINT AS end_frame FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY s)""")
def chapter_markers(spark, sf):
    return timeline.markers(_timed(spark, sf), ["conv_id"], "chapter")


@query(f"""{TIMED}, m AS (SELECT conv_id, chapter, min(start_frame) AS s, max(start_frame + audio_frames) AS e FROM t GROUP BY ALL),
k2 AS (SELECT conv_id, chapter, CASE WHEN row_number() OVER w = 1 THEN 0 ELSE s END::BIGINT AS a, coalesce(lead(s) OVER w, max(e) OVER (PARTITION BY conv_id))::BIGINT AS b FROM m WINDOW w AS (PARTITION BY conv_id ORDER BY s))
SELECT conv_id, ';FFMETADATA1' || chr(10) || string_agg('[CHAPTER]' || chr(10) || 'TIMEBASE=1/{RATE}' || chr(10) || 'START=' || a || chr(10) || 'END=' || b || chr(10) || 'title=Part \\#' || (chapter + 1)::INT, chr(10) ORDER BY a) || chr(10) AS ffmetadata FROM k2 GROUP BY conv_id""")
def chapter_file(spark, sf):
    marks = timeline.markers(_timed(spark, sf), ["conv_id"], "chapter").withColumn("title", F.format_string("Part #%d", F.col("chapter") + 1))
    return timeline.ffmetadata(marks, RATE, "title", "conv_id")


# ---- structure


def _headed(spark, sf):
    c = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    level = F.when(F.col("role") == "system", 0).when((F.col("role") == "user") & (F.col("turn") % 4 == 2), 1)
    return c.select(F.col("conv_id").alias("book_id"), F.col("turn").alias("pos"), level.alias("level"), F.when(F.col("turn") == 6, "References").otherwise(F.left("text", F.lit(40))).alias("text"))


@query("""WITH r AS (SELECT conv_id AS book_id, turn AS pos, CASE WHEN role = 'system' THEN 0 WHEN role = 'user' AND turn % 4 = 2 THEN 1 END AS level, CASE WHEN turn = 6 THEN 'References' ELSE left(text, 40) END AS text FROM conversations),
k AS (SELECT *, CASE WHEN level = 1 AND lower(text) = 'references' THEN 'refs' WHEN level = 1 THEN 'chapter' WHEN level < 1 THEN 'higher' END AS kind FROM r),
e AS (SELECT a.book_id, a.pos, max(b.pos) FILTER (b.kind IS NOT NULL AND b.pos <= a.pos) AS cut, max(b.pos) FILTER (b.kind = 'chapter' AND b.pos <= a.pos) AS own,
    min(b.pos) FILTER (b.kind IN ('refs', 'chapter') AND b.pos > a.pos) AS next, max(b.pos) FILTER (b.kind IS NOT NULL) AS final, max(b.pos) FILTER (b.kind = 'chapter') AS seen
    FROM k a JOIN k b USING (book_id) GROUP BY ALL),
f AS (SELECT k.*, e.* EXCLUDE (book_id, pos), c.kind AS cut_kind, n.kind AS next_kind, n.text AS next_title, o.text AS own_title, s.text AS seen_title, coalesce(k.kind = 'higher' AND e.next IS NULL, false) AS waits
    FROM k JOIN e USING (book_id, pos) LEFT JOIN k c ON c.book_id = k.book_id AND c.pos = e.cut LEFT JOIN k n ON n.book_id = k.book_id AND n.pos = e.next
    LEFT JOIN k o ON o.book_id = k.book_id AND o.pos = e.own LEFT JOIN k s ON s.book_id = k.book_id AND s.pos = e.seen),
g AS (SELECT *, CASE WHEN kind = 'higher' THEN coalesce(next_kind = 'refs', false) ELSE coalesce(cut_kind = 'refs', false) END AS excluded,
    CASE WHEN waits THEN final WHEN kind = 'higher' THEN next ELSE cut END AS home, (SELECT arg_max(x.text, x.pos) FROM f x WHERE x.book_id = f.book_id AND x.waits) AS last_title FROM f)
SELECT book_id, pos, false AS excluded, (dense_rank() OVER (PARTITION BY book_id ORDER BY coalesce(home, -1)) - 1)::INT AS chapter_no,
    CASE WHEN waits OR (home IS NOT DISTINCT FROM final AND seen IS NULL) THEN coalesce(seen_title, last_title, 'Front matter') WHEN kind = 'higher' THEN next_title ELSE coalesce(own_title, 'Front matter') END AS chapter_title,
    row_number() OVER (PARTITION BY book_id ORDER BY coalesce(home, -1), waits, pos)::INT AS block_no FROM g WHERE NOT excluded
UNION ALL SELECT book_id, pos, true, NULL, NULL, NULL FROM g WHERE excluded""")
def chapter_segmentation(spark, sf):
    return chapters.segmented(_headed(spark, sf)).select("book_id", "pos", "excluded", "chapter_no", "chapter_title", "block_no")


@query("""WITH r AS (SELECT conv_id, turn, CASE role WHEN 'system' THEN 'chapter' WHEN 'user' THEN 'section' ELSE 'subsection' END AS kind FROM conversations),
c AS (SELECT *, sum((kind = 'chapter')::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS a FROM r), s AS (SELECT *, sum((kind = 'section')::INT) OVER (PARTITION BY conv_id, a ORDER BY turn) AS b FROM c),
u AS (SELECT *, sum((kind = 'subsection')::INT) OVER (PARTITION BY conv_id, a, b ORDER BY turn) AS d FROM s)
SELECT conv_id, turn, CASE kind WHEN 'chapter' THEN a::VARCHAR WHEN 'section' THEN a || '.' || b ELSE a || '.' || b || '.' || d END AS number FROM u""")
def section_numbering(spark, sf):
    c = table(spark, sf, "conversations", "conv_id", "turn", "role")
    kind = F.when(F.col("role") == "system", "chapter").when(F.col("role") == "user", "section").otherwise("subsection")
    return chapters.numbered(c.withColumn("kind", kind), "conv_id", "turn").select("conv_id", "turn", "number")


@query("SELECT conv_id, role AS kind, count(*) AS n, arg_min(turn, turn) AS first_turn, max(turn) AS last_turn FROM conversations GROUP BY ALL")
def kind_counts(spark, sf):
    c = table(spark, sf, "conversations", "conv_id", "turn", "role")
    return c.groupBy("conv_id", F.col("role").alias("kind")).agg(F.count("*").alias("n"), F.min_by("turn", "turn").alias("first_turn"), F.max("turn").alias("last_turn"))


@query("SELECT lang AS reason, count(*) AS n, min(doc_id) AS first_seen, row_number() OVER (ORDER BY min(doc_id))::INT AS position FROM documents GROUP BY lang")
def exclusion_groups(spark, sf):
    g = table(spark, sf, "documents", "doc_id", "lang").groupBy(F.col("lang").alias("reason")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_seen"))
    return g.withColumn("position", F.row_number().over(Window.orderBy("first_seen")))  # a row a reason


@query("SELECT conv_id, count(*) FILTER (turn BETWEEN 1 AND 3) AS asked, coalesce(max(turn) FILTER (turn BETWEEN 1 AND 3) - min(turn) FILTER (turn BETWEEN 1 AND 3) + 1 = count(*) FILTER (turn BETWEEN 1 AND 3), false) AS contiguous FROM conversations GROUP BY conv_id")
def scope_contiguity(spark, sf):
    c = table(spark, sf, "conversations", "conv_id", "turn")
    inside = F.when(F.col("turn").between(1, 3), F.col("turn"))
    return c.groupBy("conv_id").agg(F.count(inside).alias("asked"), F.coalesce(F.max(inside) - F.min(inside) + 1 == F.count(inside), F.lit(False)).alias("contiguous"))


@query(r"""SELECT conv_id, turn, 0 AS pos, CASE role WHEN 'user' THEN 'quotation' ELSE 'paragraph' END AS kind, length(t)::INT AS n FROM (SELECT *, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM conversations) WHERE t <> ''""")
def ast_blocks(spark, sf):
    c = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    inline = F.transform(F.split(F.trim("text"), " +"), lambda w: F.struct(F.lit("Str").alias("t"), w.alias("c")))
    spaced = F.flatten(F.transform(inline, lambda x: F.array(F.to_json(x), F.lit('{"t":"Space"}'))))
    para = F.concat(F.lit('{"t":"Para","c":['), F.array_join(spaced, ","), F.lit("]}"))
    doc = F.concat(F.lit('{"blocks":['), F.when(F.col("role") == "user", F.concat(F.lit('{"t":"BlockQuote","c":['), para, F.lit("]}"))).otherwise(para), F.lit("]}"))
    c.select("conv_id", "turn", doc.alias("ast")).createOrReplaceTempView("libretto_ast")
    spark.udtf.register("ast_blocks", AstBlocks)
    return spark.sql("SELECT conv_id, turn, b.pos, b.kind, length(b.text) AS n FROM libretto_ast, LATERAL ast_blocks(ast) b")


@query("""SELECT conv_id, turn, 'configured-block-exclusion' AS reason_code, 'footnote: ' || CASE WHEN length(text) <= 120 THEN text ELSE left(text, 117) || '...' END AS description FROM conversations WHERE role = 'system'""")
def configured_exclusions(spark, sf):
    c = table(spark, sf, "conversations", "conv_id", "turn", "role", "text").select("conv_id", "turn", F.when(F.col("role") == "system", "footnote").otherwise("paragraph").alias("kind"), F.col("text").alias("display_text"))
    return chapters.diverted(c, ["footnote"])[1]


# ---- hashes, keys, lineage


@query("""SELECT doc_id, sha256('{"chapter_id":"' || source || '","expected_language":"' || lang || '","paragraph_id":"p' || doc_id || '","spoken_text":"' || md5(text) || '"}') AS content_sha256 FROM documents""")
def content_hash(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "source", "lang", "text")
    h = chunks.content_hash(chapter_id=F.col("source"), expected_language=F.col("lang"), paragraph_id=F.concat(F.lit("p"), F.col("doc_id")), spoken_text=F.md5("text"))
    return d.select("doc_id", h.alias("content_sha256"))


@query("SELECT md5(text) AS text_md5, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def exact_duplicates(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "text").select("doc_id", F.md5("text").alias("text_md5"))
    return d.groupBy("text_md5").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_labels(spark, sf):
    return lineage.to_make(table(spark, sf, "documents", "doc_id"), table(spark, sf, "labels", "doc_id"), "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def labelled_docs(spark, sf):
    return table(spark, sf, "documents", "doc_id", "lang").join(table(spark, sf, "labels", "doc_id"), "doc_id", "left_semi")


@query("SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'generated' WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 'failed' ELSE 'missing' END AS state FROM documents")
def state_join(spark, sf):
    labels = table(spark, sf, "labels", "doc_id", "quality")
    return states.generation_state(table(spark, sf, "documents", "doc_id"), labels.where("quality = 1"), labels.where("quality = 0"), ("doc_id",))


@query("SELECT state, count(*) AS n FROM (SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'generated' WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) THEN 'failed' ELSE 'missing' END AS state FROM documents) GROUP BY state")
def state_summary(spark, sf):
    s = state_join(spark, sf).withColumn("sequence", F.col("doc_id"))
    return states.selected(s).groupBy("state").agg(F.count("*").alias("n"))


@query("SELECT doc_id, 'fresh' AS origin FROM labels WHERE toxic = 1 UNION ALL SELECT doc_id, 'prior' FROM labels WHERE toxic = 0 AND doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def state_merge(spark, sf):
    labels = table(spark, sf, "labels", "doc_id", "toxic")
    fresh = labels.where("toxic = 1").select("doc_id", F.lit("fresh").alias("origin"))
    prior = labels.select("doc_id", F.lit("prior").alias("origin"))
    return states.merged(fresh, prior, table(spark, sf, "documents", "doc_id", "lang").where("lang = 'en'"), "doc_id")


@query("SELECT doc_id AS block_id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'extra' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def block_mismatches(spark, sf):
    return states.block_mismatches(table(spark, sf, "documents").select(F.col("doc_id").alias("block_id")), table(spark, sf, "labels").select(F.col("doc_id").alias("block_id")))


@query("""WITH a AS (SELECT o_orderkey AS id, md5(o_orderpriority) AS sha, o_orderkey - 1 AS dep, md5(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE '1-URGENT' END) AS want FROM orders)
SELECT 'a' || a.id AS path, 'a' || a.dep AS dependency, CASE WHEN b.id IS NULL THEN 'missing' ELSE 'changed' END AS problem FROM a LEFT JOIN a b ON b.id = a.dep WHERE b.id IS NULL OR b.sha <> a.want""")
def lineage_stale(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_orderstatus")
    want = F.md5(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderstatus")).otherwise("1-URGENT"))
    name = lambda c: F.concat(F.lit("a"), c)
    return lineage.stale(o.select(name(F.col("o_orderkey")).alias("path"), F.md5("o_orderpriority").alias("sha256"), F.array(F.struct(name(F.col("o_orderkey") - 1).alias("path"), want.alias("sha256"))).alias("dependencies")))


@query("(SELECT s_nationkey AS key, 'missing' AS side FROM (SELECT s_nationkey FROM supplier EXCEPT ALL SELECT c_nationkey FROM customer)) UNION ALL (SELECT c_nationkey, 'unexpected' FROM (SELECT c_nationkey FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier))")
def bundle_difference(spark, sf):
    return lineage.set_difference(table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key")), table(spark, sf, "customer").select(F.col("c_nationkey").alias("key")))


@query("SELECT l_orderkey, l_linenumber, (l_partkey * 4000000 + l_linenumber) % 4294967296 AS seed FROM lineitem")
def retry_seeds(spark, sf):
    x = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    return x.select("l_orderkey", "l_linenumber", states.retry_seed(F.col("l_partkey") * 4_000_000, F.col("l_linenumber")).alias("seed"))


# ---- verification

MEASURED = """SELECT d.doc_id, text AS transcript, (n_chars % 97) / 100.0 AS wer, (n_chars % 89) / 100.0 AS cer, n_chars % 3 AS missing_prefix_words, 0 AS missing_suffix_words, 0 AS repeated_ngram_count,
    CASE WHEN n_chars % 11 = 0 THEN 0.99 ELSE 0.1 END AS silence_ratio, 0.0 AS clipped_sample_ratio, n_chars % 300 AS speaking_rate_wpm, n_chars % 9 AS word_count, coalesce(quality, 0) AS attempt_number FROM documents d LEFT JOIN labels USING (doc_id)"""

CLASSIFIED = f"""WITH m AS ({MEASURED}), c AS (SELECT doc_id, attempt_number, list_filter([CASE WHEN length(trim(transcript)) = 0 THEN 'empty-transcript' END, CASE WHEN missing_prefix_words > 1 THEN 'missing-prefix' END,
    CASE WHEN silence_ratio > 0.95 THEN 'excessive-silence' END, CASE WHEN word_count >= 4 AND speaking_rate_wpm < 70 THEN 'speaking-rate-low' END, CASE WHEN word_count >= 4 AND speaking_rate_wpm > 260 THEN 'speaking-rate-high' END,
    CASE WHEN wer > 0.70 THEN 'wer-high' END, CASE WHEN cer > 0.85 THEN 'cer-high' END], lambda x: x IS NOT NULL) AS reason_codes FROM m),
s AS (SELECT doc_id, reason_codes, CASE WHEN len(reason_codes) = 0 THEN 'accepted' WHEN len(list_filter(reason_codes, lambda x: x NOT IN ('wer-high', 'cer-high'))) > 0 AND attempt_number < 1 THEN 'retryable' ELSE 'review' END AS status FROM c)"""


def _classified(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "text", "n_chars").join(table(spark, sf, "labels", "doc_id", "quality"), "doc_id", "left")
    n = F.col("n_chars")
    m = d.select(
        "doc_id", F.col("text").alias("transcript"), (n % 97 / 100).alias("wer"), (n % 89 / 100).alias("cer"), (n % 3).alias("missing_prefix_words"), F.lit(0).alias("missing_suffix_words"), F.lit(0).alias("repeated_ngram_count"),
        F.when(n % 11 == 0, 0.99).otherwise(0.1).alias("silence_ratio"), F.lit(0.0).alias("clipped_sample_ratio"), (n % 300).alias("speaking_rate_wpm"), (n % 9).alias("word_count"), F.coalesce("quality", F.lit(0)).alias("attempt_number"),
    )
    return states.classified(m, retries=1)


@query(f"{CLASSIFIED} SELECT doc_id, reason_codes, status FROM s")
def classify_docs(spark, sf):
    return _classified(spark, sf).select("doc_id", "reason_codes", "status")


@query(f"{CLASSIFIED}, t AS (SELECT count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'retryable') AS retryable, count(*) FILTER (status = 'review') AS review FROM s) SELECT *, CASE WHEN retryable > 0 THEN 'retryable' WHEN review > 0 THEN 'review' ELSE 'completed' END AS status FROM t")
def verification_summary(spark, sf):
    return states.overall(_classified(spark, sf))


@query(f"{CLASSIFIED} SELECT doc_id, status, rn <= 5 OR status <> 'accepted' AS listed FROM (SELECT doc_id, status, row_number() OVER (PARTITION BY doc_id % 7, status <> 'accepted' ORDER BY sha256(doc_id::VARCHAR)) AS rn FROM s) WHERE rn <= 5 OR status <> 'accepted'")
def listening_checklist(spark, sf):
    c = _classified(spark, sf).select("doc_id", "status").withColumn("chapter", F.col("doc_id") % 7).withColumn("flagged", F.col("status") != "accepted")
    return studies.checklist(c, "chapter", "doc_id", "flagged").select("doc_id", "status", F.lit(True).alias("listed"))


PAIRS = "SELECT item_id, regexp_replace(text, '[^ -~]', '', 'g') AS a, regexp_replace(replace(replace(text, 'th', 't'), 'ci', 'chi'), '[^ -~]', '', 'g') AS b FROM benchmark"


def _pairs(spark, sf):
    b = table(spark, sf, "benchmark", "item_id", "text")
    ascii_ = lambda c: F.regexp_replace(c, F.lit("[^ -~]"), F.lit(""))
    return b.select("item_id", ascii_(F.col("text")).alias("a"), ascii_(F.replace(F.replace("text", F.lit("th"), F.lit("t")), F.lit("ci"), F.lit("chi"))).alias("b"))


CER = f"SELECT item_id, levenshtein(replace(a, ' ', ''), replace(b, ' ', ''))::INT AS edits, length(replace(a, ' ', ''))::INT AS n FROM ({PAIRS})"


@query(f"SELECT item_id, edits, n, edits / n AS rate FROM ({CER})")
def cer_pairs(spark, sf):
    p = _pairs(spark, sf).select("item_id", metrics.character_edits(F.col("a"), F.col("b")).alias("edits"), F.length(F.regexp_replace("a", F.lit(r"\s+"), F.lit(""))).alias("n"))
    return p.withColumn("rate", F.col("edits") / F.col("n"))


@query(f"SELECT item_id, edits / n AS cer FROM ({CER}) WHERE edits > 0 ORDER BY cer DESC, item_id LIMIT 5")
def worst_samples(spark, sf):
    p = cer_pairs(spark, sf).select(F.col("item_id"), F.col("rate").alias("cer"))
    return studies.worst(p, 5, "cer", "cer", "item_id")


@query(f"SELECT sum(edits) / sum(n) AS cer FROM ({CER})")
def cer_micro_average(spark, sf):
    return metrics.scored(_pairs(spark, sf), "a", "b").agg(metrics.micro_average("cer").alias("cer"))


#: The weighted distance of metrics.edits, a row of its table at a time; minima up to each column stand for insertions.
WER = f"""WITH RECURSIVE p AS (SELECT item_id, list_filter(string_split(a, ' '), lambda w: w <> '') AS x, list_filter(string_split(b, ' '), lambda w: w <> '') AS y FROM ({PAIRS})),
d AS (SELECT *, len(x) + len(y) + 1 AS k, 0 AS i, list_transform(range(0, len(y) + 1), lambda j: j * (len(x) + len(y) + 2)) AS r FROM p
    UNION ALL SELECT item_id, x, y, k, i + 1, list_transform(range(1, len(z) + 1), lambda j: list_min(z[1:j]) + (j - 1) * (k + 1)) FROM
    (SELECT *, list_transform(range(1, len(r) + 1), lambda j: CASE WHEN j = 1 THEN r[1] + k + 1 ELSE least(r[j - 1] + CASE WHEN y[j - 1] = x[i + 1] THEN 0 ELSE k END, r[j] + k + 1) END - (j - 1) * (k + 1)) AS z FROM d WHERE i < len(x))),
e AS (SELECT item_id, len(x) AS n, len(y) AS m, r[-1] // k AS total, r[-1] % k AS gaps FROM d WHERE i = len(x))
SELECT item_id, (total - gaps)::INT AS substitutions, ((gaps + n - m) // 2)::INT AS deletions, ((gaps - n + m) // 2)::INT AS insertions, n::INT AS denominator, CASE WHEN n > 0 THEN total / n ELSE total END AS rate FROM e"""


@query(WER)
def wer_counts(spark, sf):
    return metrics.scored(_pairs(spark, sf), "a", "b").select("item_id", "wer.*")


@query(r"""WITH w AS (SELECT doc_id, string_split_regex(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ') AS ws FROM documents)
SELECT doc_id, len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1]))::INT AS once, len(list_filter(range(1, len(ws) - 2), lambda i: ws[i : i + 1] = ws[i + 2 : i + 3]))::INT AS twice FROM w""")
def adjacent_repetitions(spark, sf):
    ws = F.split(F.trim(F.regexp_replace("text", F.lit(r"\s+"), F.lit(" "))), " ")

    def follows(n: int):
        last = F.size("ws") - 2 * n + 1
        same = F.filter(F.sequence(F.lit(1), last), lambda i: F.slice("ws", i, n) == F.slice("ws", i + n, n))
        return F.when(last >= 1, F.size(same)).otherwise(0)

    return table(spark, sf, "documents", "doc_id", "text").select("doc_id", ws.alias("ws")).select("doc_id", follows(1).alias("once"), follows(2).alias("twice"))


@query("SELECT NULL AS category, count(*) AS n, sum(n_chars)::BIGINT AS n_chars FROM documents UNION ALL SELECT c, count(*), sum(n_chars)::BIGINT FROM (SELECT n_chars, unnest(list_distinct([lang, source])) AS c FROM documents) GROUP BY c")
def category_metrics(spark, sf):
    d = table(spark, sf, "documents", "lang", "source", "n_chars").withColumn("categories", F.array("lang", "source"))
    return studies.by_category(d, "categories", "n_chars")


# ---- studies

AB = """WITH s AS (SELECT user_id % 50 AS session_id, event_id % 4 AS pass_index, CASE WHEN event_id % 4 IN (0, 3) THEN 'base' ELSE 'variant' END AS candidate, event_type AS excerpt, abs(value) + 1 AS g, (abs(value) + 1) / 2 AS r FROM events),
w AS (SELECT session_id FROM s GROUP BY session_id HAVING count(DISTINCT pass_index) = 4),
m AS (SELECT session_id, excerpt, candidate, median(g) AS g, median(r) AS r FROM s WHERE session_id IN (SELECT session_id FROM w) GROUP BY ALL),
t AS (SELECT session_id, sum(g) FILTER (candidate = 'base') AS base_s, sum(g) FILTER (candidate = 'variant') AS variant_s, sum(r) FILTER (candidate = 'base') AS br, sum(r) FILTER (candidate = 'variant') AS vr FROM m GROUP BY session_id)"""


@query(f"{AB} SELECT session_id, round(base_s, 6) AS base_s, round(variant_s, 6) AS variant_s, round(1 - variant_s / base_s, 6) AS reduction, round(1 - vr / br, 6) AS rtf_reduction FROM t WHERE base_s IS NOT NULL AND variant_s IS NOT NULL")
def ab_summary(spark, sf):
    e = table(spark, sf, "events", "event_id", "user_id", "event_type", "value")
    g = F.abs("value") + 1
    s = e.select((F.col("user_id") % 50).alias("session_id"), (F.col("event_id") % 4).alias("pass_index"), F.when((F.col("event_id") % 4).isin(0, 3), "base").otherwise("variant").alias("candidate"), F.col("event_type").alias("excerpt"), g.alias("generation_seconds"), (g / 2).alias("rtf"))
    out = studies.paired(s, "base", "variant")
    return out.select("session_id", *(F.round(c, 6).alias(c) for c in ("base_s", "variant_s", "reduction", "rtf_reduction")))


@query()
def bootstrap_ci(spark, sf):
    return studies.median_intervals(table(spark, sf, "events", "user_id", "value", "event_id"), "user_id", "value", "event_id")  # a user's events are few


@query("""SELECT excerpt_id, candidate, position, excerpt_id || '-' || chr((96 + position)::INT) AS clip_id FROM (SELECT item_id AS excerpt_id, c AS candidate, row_number() OVER (PARTITION BY item_id ORDER BY md5('0:' || item_id || ':' || c))::INT AS position FROM benchmark, (VALUES ('fast'), ('fine'), ('turbo')) v(c))""")
def blind_package(spark, sf):
    return studies.blind(table(spark, sf, "benchmark").select(F.col("item_id").alias("excerpt_id")), ["fast", "fine", "turbo"])


# ---- rules, numbers, audio


@query()
def normalization_rules(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "text")
    out = rules.normalized(d, "text")
    return out.select("doc_id", F.md5("spoken_text").alias("spoken_md5"), F.transform("transformations", lambda t: t["rule_id"]).alias("rules"), "warnings")


@query()
def rule_counts(spark, sf):
    d = table(spark, sf, "documents", "text")
    return rules.normalized(d, "text").select(F.explode("transformations.rule_id").alias("rule_id")).groupBy("rule_id").agg(F.count("*").alias("n"))


@query("""WITH s AS (SELECT vec_id, list_transform(embedding, lambda x: trunc(x::DOUBLE * 32768)::INT) AS x FROM embeddings)
SELECT vec_id, len(list_filter(x, lambda v: abs(v) <= 104)) / len(x) AS silence_ratio, len(list_filter(x, lambda v: abs(v) >= 32760)) / len(x) AS clipped_sample_ratio, round(greatest(-120.0, least(0.0, 20 * log10(list_max(list_transform(x, lambda v: abs(v))) / 32768.0))), 6) AS peak_dbfs FROM s""")
def pcm_heuristics(spark, sf):
    e = table(spark, sf, "embeddings", "vec_id", "embedding").select("vec_id", F.transform("embedding", lambda v: (v.cast("double") * 32768).cast("int")).alias("x"))
    q = audio.quality(F.col("x"))
    return e.select("vec_id", q["silence_ratio"].alias("silence_ratio"), q["clipped_sample_ratio"].alias("clipped_sample_ratio"), F.round(q["peak_dbfs"], 6).alias("peak_dbfs"))


@query()
def synthetic_voice(spark, sf):
    b = table(spark, sf, "benchmark", "item_id", "text").select("item_id", F.col("text").alias("spoken_text"), F.lit(7).cast("long").alias("seed"))
    return audio.synthesised(b).select("item_id", "frames", F.sha2("pcm", 256).alias("pcm_sha256"))


@query("SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS hour, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def event_hours(spark, sf):
    """Extension: the batch form of the streaming hourly totals in libretto.streaming."""
    e = table(spark, sf, "events", "event_type", "ts", "value")
    return e.groupBy("event_type", F.date_trunc("hour", "ts").alias("hour")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


from libretto.plans import reviews, speech  # noqa: E402, F401  (they register further queries)

"""Queries of assembly and reviews, over turns as blocks and line items as chunks."""

from __future__ import annotations

from pyspark.sql import functions as F

from libretto.functions.text import word_count
from libretto.operators import assembly, engines, reviews, timeline
from libretto.plans import stages
from libretto.plans.registry import query, table

_KIND = "CASE role WHEN 'system' THEN 'heading' WHEN 'user' THEN 'paragraph' ELSE 'quote' END"
_WARN = "CASE WHEN length(text) > 120 THEN ['long'] ELSE [] END"


def _blocks(spark, sf):
    c = table(spark, sf, "conversations")
    kind = F.when(F.col("role") == "system", "heading").when(F.col("role") == "user", "paragraph").otherwise("quote")
    warned = F.when(F.length("text") > 120, F.array(F.lit("long"))).otherwise(F.array().cast("array<string>"))
    return c.select(F.col("conv_id").alias("book_id"), F.floor(F.col("turn") / 3).cast("long").alias("chapter_id"), F.col("turn").alias("block_id"), kind.alias("kind"), F.col("text").alias("display_text"), warned.alias("warnings"))


@query(f"SELECT conv_id AS book_id, turn AS block_id, {_KIND} AS kind FROM conversations WHERE {_KIND} <> 'paragraph' OR length(text) > 120")
def extraction_review(spark, sf):
    return reviews.extraction_review(_blocks(spark, sf)).select("book_id", "block_id", "kind")


@query("""WITH b AS (SELECT conv_id AS book_id, count(DISTINCT turn // 3) AS chapters, count(*) AS blocks, count(*) FILTER (length(text) > 120) AS warnings FROM conversations WHERE role <> 'system' GROUP BY 1),
x AS (SELECT conv_id AS book_id, count(*) AS exclusions FROM conversations WHERE role = 'system' GROUP BY 1)
SELECT book_id, coalesce(chapters, 0) AS chapters, coalesce(blocks, 0) AS blocks, coalesce(warnings, 0) AS warnings, coalesce(exclusions, 0) AS exclusions FROM b FULL JOIN x USING (book_id)""")
def ingest_summary(spark, sf):
    b = _blocks(spark, sf)
    return reviews.ingest_summary(b.where("kind <> 'heading'"), b.where("kind = 'heading'"))


@query("""SELECT l_suppkey, count(*) AS chunks, count(DISTINCT l_partkey) AS blocks, count(DISTINCT l_partkey || ':' || l_linenumber) AS sentences, count(*) - count(DISTINCT l_partkey || ':' || l_linenumber) AS forced_splits, max(l_quantity)::INT AS longest FROM lineitem GROUP BY 1""")
def chapter_distincts(spark, sf):
    x = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_linenumber", "l_quantity")
    x = x.select("l_suppkey", F.col("l_partkey").alias("paragraph_id"), F.col("l_linenumber").alias("sentence_id"), F.repeat(F.lit("x"), F.col("l_quantity").cast("int")).alias("spoken_text"))
    return reviews.chapter_distincts(x, "l_suppkey")


@query(r"""WITH r AS (SELECT conv_id AS book_id, turn // 3 AS chapter_id, sum(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')))::BIGINT AS words, count(*) FILTER (length(text) > 120) AS warnings, count(*) FILTER (length(text) > 160) AS outliers, sum(600) AS pause_ms FROM conversations GROUP BY ALL),
s AS (SELECT book_id, chapter_id, words, warnings, outliers, round_even(words * 60000 / 150.0, 0)::BIGINT AS speech_ms, pause_ms::BIGINT AS pause_ms FROM r),
u AS (SELECT * FROM s UNION ALL SELECT book_id, NULL, sum(words), sum(warnings) + 1, sum(outliers), sum(speech_ms), sum(pause_ms) FROM s GROUP BY book_id)
SELECT book_id, chapter_id, words::BIGINT AS words, warnings::BIGINT AS warnings, outliers::BIGINT AS outliers, speech_ms::BIGINT AS speech_ms, pause_ms::BIGINT AS pause_ms, (speech_ms + pause_ms)::BIGINT AS total_ms FROM u""")
def chapter_qualification(spark, sf):
    b = _blocks(spark, sf)
    chunks = b.select("book_id", "chapter_id", F.col("display_text").alias("spoken_text"), F.lit(600).alias("pause_ms"))
    return reviews.qualification(chunks, b, "book_id", "chapter_id", 160, word_count(F.col("spoken_text")), b.select("book_id").distinct())


@query("""SELECT conv_id AS book_id, turn AS block_id, '## ' || turn || ' (' || """ + _KIND + """ || ')' || chr(10) || chr(10) || '```text' || chr(10) || text || chr(10) || '```' || chr(10) || CASE WHEN length(text) > 120 THEN '- long' || chr(10) ELSE '' END AS lines FROM conversations WHERE NOT contains(text, '```')""")
def chapter_review(spark, sf):
    return reviews.block_lines(_blocks(spark, sf).where("not contains(display_text, '```')"), "book_id", "block_id")


@query("""WITH c AS (SELECT conv_id, turn, (turn * 3)::BIGINT AS p, strlen(text) // 2 AS a, hex(encode(text)) AS h FROM conversations),
t AS (SELECT *, coalesce(sum(p + a) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT conv_id, turn, (before * 2)::BIGINT AS first_byte, md5(repeat('0000', p) || substr(h, 1, 4 * a)) AS piece_md5 FROM t""")
def pcm_timeline(spark, sf):
    """Silence and audio of each turn as bytes in place; a turn's text stands for its audio."""
    c = table(spark, sf, "conversations", "conv_id", "turn", "text")
    frames = F.floor(F.octet_length("text") / 2).cast("int")
    c = c.select("conv_id", "turn", (F.col("turn") * 3).alias("pause_frames"), frames.cast("long").alias("audio_frames"), F.substring(F.encode("text", "UTF-8"), F.lit(1), frames * 2).alias("pcm"))
    pieces = assembly.pcm_pieces(timeline.timeline(c, ["conv_id"], ["turn"]))
    return pieces.select("conv_id", "turn", "first_byte", F.md5(F.hex("piece")).alias("piece_md5"))


@query("""WITH w AS (SELECT c_custkey AS book, sha256('{"a":' || c_custkey || ',"b":"' || c_mktsegment || '","c":null}') AS assembly_sha256 FROM customer)
SELECT book, assembly_sha256, book % 3 = 0 AS reuse FROM w""")
def assembly_reuse(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_mktsegment")
    wanted = assembly.input_hash(c.select(F.col("c_custkey").alias("book"), F.col("c_mktsegment").alias("b"), F.col("c_custkey").alias("a"), F.lit(None).cast("string").alias("c")), ["c", "b", "a"])
    kept = wanted.where("book % 3 < 2").select("book", "assembly_sha256", F.lit("x").alias("output_sha256"), F.when(F.col("book") % 3 == 0, "x").otherwise("y").alias("actual_sha256"))
    return assembly.reusable(wanted, kept, "book").select("book", "assembly_sha256", "reuse")


@query("SELECT l_orderkey, CASE WHEN count(DISTINCT l_linestatus) = 1 THEN min(l_linestatus) END AS l_linestatus, count(DISTINCT l_linestatus) AS values, count(DISTINCT l_linestatus) = 1 AS agrees FROM lineitem GROUP BY 1")
def agreement(spark, sf):
    return assembly.agreement(table(spark, sf, "lineitem", "l_orderkey", "l_linestatus"), "l_orderkey", "l_linestatus")


@query("WITH m AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) SELECT doc_id, (SELECT count(*) FROM m) AS missing FROM m ORDER BY doc_id LIMIT 5")
def first_missing(spark, sf):
    return reviews.first_missing(table(spark, sf, "documents", "doc_id"), table(spark, sf, "labels", "doc_id"), "doc_id", "doc_id")


@query("""SELECT c.conv_id AS book_id, c.turn // 3 AS chapter_id, c.turn AS block_id, md5(n.text) AS spoken_text, k.part FROM conversations c
LEFT JOIN (SELECT * FROM conversations WHERE role <> 'system') n ON n.conv_id = c.conv_id AND n.turn = c.turn
LEFT JOIN (SELECT conv_id, turn, unnest(range(1 + turn % 2)) AS part FROM conversations WHERE role <> 'user') k ON k.conv_id = c.conv_id AND k.turn = c.turn
WHERE c.turn // 3 < 2""")
def scoped_star(spark, sf):
    b = _blocks(spark, sf)
    chapters = b.select("book_id", "chapter_id").distinct()
    said = b.where("kind <> 'heading'").select("book_id", "block_id", F.md5("display_text").alias("spoken_text"))
    parts = b.where("kind <> 'paragraph'").select("book_id", "block_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("block_id") % 2)).alias("part"))
    out = reviews.selection(chapters, b, said, parts, chapters.where("chapter_id < 2"))
    return out.select("book_id", "chapter_id", "block_id", "spoken_text", "part")


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 2 WHEN 3 THEN 2 ELSE 1 END AS level, 'verification/attempts/c' || doc_id || '/g-k.json' AS attempt, 'audio/c' || doc_id || '/k.wav' AS audio, 'failures/c' || doc_id || '/k.json' AS failure FROM documents")
def paths_and_levels(spark, sf):
    n = F.col("doc_id") % 4
    source = F.when(n == 0, "a\n\\part* {x}").when(n == 1, "% \\part{x}\n\\chapter{y}").when(n == 2, "\\partial{x} 5\\% % \\part{x}").otherwise("5\\% \\part{x}")
    chunk = F.concat(F.lit("c"), "doc_id")
    paths = reviews.generation_paths(chunk, F.lit("k"))
    d = table(spark, sf, "documents", "doc_id")
    return d.select("doc_id", reviews.chapter_level(source).alias("level"), reviews.attempt_path(chunk, F.lit("g"), F.lit("k")).alias("attempt"), paths["audio"].alias("audio"), paths["failure"].alias("failure"))


@query("""WITH c AS (SELECT o_orderkey, 20000 + 4000 * (o_orderkey % 3 = 0)::INT AS rate, o_orderpriority, o_custkey, o_orderkey % 5 AS seed FROM orders)
SELECT o_orderkey, CASE WHEN rate <> 24000 THEN 'sample-rate' WHEN length(o_orderpriority) > 8 THEN 'text-length' WHEN o_custkey % 4 = 0 THEN 'reference-voice' WHEN o_custkey % 4 <> 1 THEN 'unknown-voice' WHEN seed <> 0 THEN 'seed' END AS refused FROM c""")
def engine_requests(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_orderpriority", "o_custkey")
    n = F.col("o_custkey") % 4
    o = o.select(
        "o_orderkey", F.col("o_orderpriority").alias("spoken_text"), (F.lit(20000) + F.when(F.col("o_orderkey") % 3 == 0, 4000).otherwise(0)).alias("sample_rate_hz"), n.cast("string").alias("voice_id"),
        F.when(n == 0, "a.wav").alias("reference_path"), (F.col("o_orderkey") % 5).alias("seed"), F.lit(1.0).alias("speed"), F.lit(None).cast("double").alias("temperature"),
    )
    return o.select("o_orderkey", engines.refused(engines.Capabilities("e", "m", 24000, 8, named_voices=("0", "1"), seed=False)).alias("refused"))


@query("""WITH b AS (SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS pos, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t FROM conversations),
g AS (SELECT *, count(*) FILTER (turn % 3 = 0) OVER (PARTITION BY conv_id ORDER BY turn) AS part, last_value(CASE WHEN turn % 3 = 0 THEN t END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS title FROM b)
SELECT conv_id AS book_id, pos::INT AS pos, printf('chapter-%04d', dense_rank() OVER (PARTITION BY conv_id ORDER BY part)::INT) AS chapter_id, coalesce(title, 'Front matter') AS chapter_title, printf('block-%06d', row_number() OVER (PARTITION BY conv_id ORDER BY pos)::INT) AS block_id,
CASE WHEN turn % 3 = 0 THEN 'heading' WHEN role = 'user' THEN 'quotation' ELSE 'paragraph' END AS kind, md5(t) AS text_md5 FROM g""")
def ingest_blocks(spark, sf):
    """A conversation's turns as one document AST: every third a heading, a user's other turns quotations."""
    c = table(spark, sf, "conversations", "conv_id", "turn", "role", "text")
    words = F.transform(F.split(F.trim("text"), " +"), lambda w: F.to_json(F.struct(F.lit("Str").alias("t"), w.alias("c"))))
    para = F.concat(F.lit('{"t":"Para","c":['), F.array_join(words, ',{"t":"Space"},'), F.lit("]}"))
    head = F.concat(F.lit('{"t":"Header","c":[1,["",[],[]],['), F.array_join(words, ',{"t":"Space"},'), F.lit("]]}"))
    block = F.when(F.col("turn") % 3 == 0, head).when(F.col("role") == "user", F.concat(F.lit('{"t":"BlockQuote","c":['), para, F.lit("]}"))).otherwise(para)
    turns = F.array_sort(F.collect_list(F.struct("turn", block.alias("j"))))
    books = c.groupBy(F.col("conv_id").alias("book_id")).agg(F.concat(F.lit('{"blocks":['), F.array_join(F.transform(turns, lambda x: x["j"]), ","), F.lit("]}")).alias("ast"))
    return stages.ingest(books)[0].select("book_id", "pos", "chapter_id", "chapter_title", "block_id", "kind", F.md5("display_text").alias("text_md5"))

"""The operators' queries over their whole tables, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from libretto.llm import jaccard, langid, licences, mixing, substrings, suffixes, tokens, topk, urls, vectors
from libretto.llm.common import table


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = F.coalesce(F.sha2("kept", 256), "sha256")
    return out.select("doc_id", "n_words", removed.alias("n_removed"), kept.alias("kept_sha256"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokens.encoded(docs, piece_model())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffixes.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = F.coalesce(F.sha2("kept", 256), "sha256")
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), kept.alias("kept_sha256"))


def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urls.filtered(pages).select("page_id", "host", "path", "rule", "verdict")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = mixing.mixed(docs, F.array("source"), mixing.words_of(F.col("text")))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("x")


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1
    model = langid.trained(docs, ~held_out)
    out = langid.predicted(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return out.select("doc_id", "held_out", "lang_pred", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.topk(rows, F.pmod("vec_id", F.lit(50)) == 0, k=5)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scanned(docs).select("doc_id", "licence", "score", "first_line", "n_lines")


def op10_licence_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every statement by windows of words; op10_licences gives the best window of lines, as its SQL does."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.stated(docs).select("doc_id", "statements")


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def op5_sql() -> str:
    rules = sorted(urls.RULES, key=lambda r: (-len(r[0] + r[1]), r))

    def case(host: str, path: str, say) -> str:
        fits = (f"WHEN ({host} = {_quoted(h)} OR ends_with({host}, {_quoted('.' + h)})) AND starts_with({path}, {_quoted(p)}) THEN {_quoted(say(h, p, v))}" for h, p, v in rules)
        return f"CASE {' '.join(fits)} END"

    def host(url: str) -> str:
        return f"translate(regexp_extract(coalesce({url}, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def path(url: str) -> str:
        return f"regexp_extract(coalesce({url}, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"

    links = " UNION ALL ".join(f"SELECT url AS src, regexp_extract(html, {_quoted(p)}, 1) AS dst FROM pages WHERE url IS NOT NULL" for p in urls.LINKS)
    return f"""
WITH RECURSIVE links AS (SELECT DISTINCT src, dst FROM ({links}) WHERE dst LIKE '%://%' AND src <> dst),
step AS (SELECT src AS a, dst AS b FROM links UNION SELECT dst, src FROM links),
reach(a, b) AS (SELECT a, b FROM step UNION SELECT r.a, s.b FROM reach r JOIN step s ON r.b = s.a),
moved AS (SELECT DISTINCT a FROM reach WHERE {case(host('b'), path('b'), lambda h, p, v: v)} = 'block'),
judged AS (SELECT page_id, url, {host('url')} AS host, {path('url')} AS path FROM pages)
SELECT page_id, host, path, {case('host', 'path', lambda h, p, v: h + p)} AS rule,
    coalesce({case('host', 'path', lambda h, p, v: v)}, CASE WHEN url IN (SELECT a FROM moved) THEN 'block' END, 'allow') AS verdict
FROM judged"""


OP1_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws, row_number() OVER () AS row FROM documents),
w AS (SELECT row, doc_id, i, sha256(array_to_string(ws[i : i + 49], ' ')) AS h FROM (SELECT row, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)),
m AS (SELECT h, min(doc_id) AS low FROM w GROUP BY h),
g AS (SELECT DISTINCT row, i + j AS i FROM w JOIN m USING (h), range(0, 50) r(j) WHERE doc_id > low),
l AS (SELECT row, list(i) AS gone FROM g GROUP BY row),
k AS (SELECT doc_id, ws, coalesce(len(gone), 0) AS n, CASE WHEN gone IS NULL THEN ws
    ELSE list_transform(list_filter(range(1, len(ws) + 1), lambda i: NOT list_contains(gone, i)), lambda i: ws[i]) END AS kept FROM d LEFT JOIN l USING (row))
SELECT doc_id, len(ws)::BIGINT AS n_words, n::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k"""

OP3_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, '')))::BIGINT AS n, row_number() OVER () AS row FROM documents),
w AS (SELECT row, doc_id, i, md5_number(substr(h, 2 * i - 1, 200)) AS k FROM (SELECT row, doc_id, h, unnest(range(1, n - 98)) AS i FROM d)),
m AS (SELECT k, min({'d': doc_id, 'i': i}) AS low FROM w GROUP BY k HAVING count(*) > 1),
g AS (SELECT row, i, i - lag(i) OVER (PARTITION BY row ORDER BY i) AS gap FROM w JOIN m USING (k) WHERE {'d': doc_id, 'i': i} > low),
r AS (SELECT row, i, sum((gap IS NULL OR gap > 100)::INT) OVER (PARTITION BY row ORDER BY i) AS span FROM g),
s AS (SELECT row, min(i) AS a, max(i) + 99 AS b FROM r GROUP BY row, span),
p AS (SELECT row, a, b, coalesce(lag(b) OVER (PARTITION BY row ORDER BY a), 0) AS before FROM s),
k AS (SELECT row, count(*) AS n_spans, sum(b - a + 1)::BIGINT AS n_removed, string_agg(substr(h, 2 * before + 1, 2 * (a - before - 1)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept FROM p JOIN d USING (row) GROUP BY row)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256 FROM d LEFT JOIN k USING (row)"""

OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.vec_id <> q.vec_id AND len(p.e) = len(q.e) WHERE list_cosine_similarity(p.e, q.e) >= 0.9),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
o AS (SELECT vec_id, coalesce((SELECT count(*) FROM l WHERE a = vec_id), 0)::BIGINT AS n_links, least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id FROM embeddings)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM o"""

OP6_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':{mixing.SEED}') AS o FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS held FROM d GROUP BY source),
n AS (SELECT *, 1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS w FROM s),
c AS (SELECT *, row_number() OVER (ORDER BY held / w, source) AS pos FROM n),
l AS (SELECT *, sum(held) OVER () - coalesce(sum(3 * held) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS den FROM c),
k AS (SELECT pos AS lowest, num, den FROM l WHERE num * w <= 3 * held * den ORDER BY pos LIMIT 1),
t AS (SELECT source, held, CASE WHEN pos < lowest THEN (3 * held)::DOUBLE ELSE (k.num * w)::DOUBLE / k.den::DOUBLE END AS target FROM l, k),
q AS (SELECT source, held, target, round_even(target, 0)::BIGINT AS quota FROM t),
r AS (SELECT d.*, held AS source_size, target, quota // greatest(held, 1) AS times, quota % greatest(held, 1) AS rest,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, (times * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r"""

OP7_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) END) AS g FROM d),
u AS (SELECT doc_id, unnest(g) AS x FROM s),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM met JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE n / (len(p.g) + len(q.g) - n) >= 0.8),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT doc_id, coalesce((SELECT count(*) FROM e WHERE a = doc_id), 0)::BIGINT AS n_links,
    least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS class_id FROM d"""

OP9_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


def op10_sql() -> str:
    def grams(ws: str) -> str:
        pairs = f"list_distinct(list_transform(range(1, len({ws})), lambda i: {ws}[i] || ' ' || {ws}[i + 1]))"
        return f"CASE WHEN len({ws}) = 1 THEN {ws} ELSE {pairs} END"

    def found(text: str) -> str:
        return f"regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+(?:\\.[0-9]+)*')"

    rows = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in sorted(licences.TEMPLATES.items()))
    return f"""
WITH t AS (SELECT name, {grams('ws')} AS g FROM (SELECT name, {found('body')} AS ws FROM (VALUES {rows}) x(name, body))),
d AS (SELECT doc_id, row_number() OVER () AS row, regexp_split_to_array(coalesce(text, ''), '\r\n|\r|\n') AS ls FROM documents),
w AS (SELECT row, i - 1 AS first_line, n AS n_lines, {found("array_to_string(ls[i : i + n - 1], chr(10))")} AS ws
    FROM (SELECT row, ls, unnest(range(1, len(ls) + 1)) AS i FROM d), range(1, {licences.LINES + 1}) r(n) WHERE i + n - 1 <= len(ls)),
g AS (SELECT row, first_line, n_lines, {grams('ws')} AS g FROM w WHERE len(ws) > 0),
s AS (SELECT row, first_line, n_lines, name, 2 * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) AS score FROM g, t
    WHERE 2 * least(len(g.g), len(t.g)) >= {licences.THRESHOLD} * (len(g.g) + len(t.g))),
b AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, name, first_line, n_lines) AS k FROM s WHERE score >= {licences.THRESHOLD})
SELECT doc_id, name AS licence, score, first_line::INTEGER AS first_line, n_lines::INTEGER AS n_lines FROM d LEFT JOIN (SELECT * FROM b WHERE k = 1) USING (row)"""


def queries() -> dict:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_sentencepiece": op2_sentencepiece,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_embedding_neardup": op4_embedding_neardup,
        "op5_url_filter": op5_url_filter,
        "op6_mixing": op6_mixing,
        "op7_jaccard_join": op7_jaccard_join,
        "op8_langid": op8_langid,
        "op9_topk": op9_topk,
        "op10_licences": op10_licences,
        "op10_licence_statements": op10_licence_statements,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1_SQL, "op3_suffix_dedup": OP3_SQL, "op4_embedding_neardup": OP4_SQL, "op5_url_filter": op5_sql(), "op6_mixing": OP6_SQL, "op7_jaccard_join": OP7_SQL, "op9_topk": OP9_SQL, "op10_licences": op10_sql()}

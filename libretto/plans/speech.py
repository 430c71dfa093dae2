"""Queries of the speech rules. Their SQL composes Italian numbers by itself, from the names of units and tens."""

from __future__ import annotations

from pyspark.sql import functions as F

from libretto.functions import rules
from libretto.plans.registry import query, table
from libretto.sources.lexicons import Entry

_UNITS = "['uno','due','tre','quattro','cinque','sei','sette','otto','nove','dieci','undici','dodici','tredici','quattordici','quindici','sedici','diciassette','diciotto','diciannove']"
_TENS = "['venti','trenta','quaranta','cinquanta','sessanta','settanta','ottanta','novanta']"
_MONTHS = "['gennaio','febbraio','marzo','aprile','maggio','giugno','luglio','agosto','settembre','ottobre','novembre','dicembre']"
_FEMININE = "['prima','seconda','terza','quarta','quinta','sesta','settima','ottava','nona']"


def _below(n: str) -> str:
    """SQL of a number below 1000 in words, nothing for 0."""
    h, r = f"(({n}) // 100)", f"(({n}) % 100)"
    ten, unit = f"{_TENS}[{r} // 10 - 1]", f"{_UNITS}[{r} % 10]"
    low = f"CASE WHEN {r} = 0 THEN '' WHEN {r} < 20 THEN {_UNITS}[{r}] WHEN {r} % 10 = 0 THEN {ten} WHEN {r} % 10 IN (1, 8) THEN left({ten}, -1) || {unit} ELSE {ten} || {unit} END"
    head = f"CASE {h} WHEN 0 THEN '' WHEN 1 THEN 'cento' ELSE {_UNITS}[{h}] || 'cento' END"
    return f"(CASE WHEN {h} > 0 AND ({r} = 8 OR {r} // 10 = 8) THEN left({head}, -1) ELSE {head} END || {low})"


def said(n: str) -> str:
    """SQL of a whole number below a million in words."""
    t = f"(({n}) // 1000)"
    thousands = f"CASE {t} WHEN 0 THEN '' WHEN 1 THEN 'mille' ELSE {_below(t)} || 'mila' END"
    return f"(CASE WHEN ({n}) = 0 THEN 'zero' ELSE regexp_replace({thousands} || {_below(f'({n}) % 1000')}, '(.)tre$', '\\1tré') END)"


@query(f"WITH p AS (SELECT p_partkey, p_partkey * 487 % 1000000 AS n FROM part) SELECT p_partkey, n, {said('n')} AS words FROM p")
def italian_numbers(spark, sf):
    p = table(spark, sf, "part", "p_partkey").withColumn("n", F.col("p_partkey") * 487 % 1_000_000)
    return rules.normalized(p.withColumn("text", F.col("n").cast("string")), "text", only=("integer",)).select("p_partkey", "n", F.col("spoken_text").alias("words"))


@query(f"""WITH x AS (SELECT l_orderkey, l_linenumber, round(l_extendedprice * 100)::BIGINT AS v FROM lineitem), y AS (SELECT *, v // 100 AS w, v % 100 AS c FROM x)
SELECT l_orderkey, l_linenumber, 'Costa ' || {said('w')} || ' euro' || CASE c WHEN 0 THEN '' WHEN 1 THEN ' e uno centesimo' ELSE ' e ' || {said('c')} || ' centesimi' END || '.' AS spoken_text FROM y""")
def currency_words(spark, sf):
    x = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    t = F.concat(F.lit("Costa € "), F.translate(F.format_string("%.2f", "l_extendedprice"), ".", ","), F.lit("."))
    return rules.normalized(x.select("l_orderkey", "l_linenumber", t.alias("text")), "text").select("l_orderkey", "l_linenumber", "spoken_text")


_PARTS = "SELECT doc_id, doc_id % 1000 AS a, 1 + doc_id % 9 AS b, 10 + doc_id % 80 AS c, 1 + doc_id % 31 AS d, 1 + doc_id % 12 AS m, 1000 + doc_id * 7 % 8000 AS y, doc_id % 100 AS z FROM documents"


@query(f"""WITH p AS ({_PARTS}) SELECT doc_id, 'Il ' || {said('a')} || ' per cento di ' || {said('b')} || ' a ' || {said('c')} || ', tra ' || {said('b')} || ' a ' || {said('c')} || ' e ' || {said('b')} || ' a ' || {said('c')} || ' per cento; ' || {said('b')} || ' a ' || {said('c')} || ' euro; il '
|| CASE d WHEN 1 THEN 'primo' ELSE {said('d')} END || ' ' || {_MONTHS}[m] || ' ' || {said('y')} || ', capitolo ' || {said('b')} || ' punto ' || {said('c')} || ', ' || {said('a')} || CASE WHEN a = 1 AND z = 0 THEN ' dollaro' ELSE ' dollari' END
|| CASE z WHEN 0 THEN '' WHEN 1 THEN ' e uno centesimo' ELSE ' e ' || {said('z')} || ' centesimi' END || '; la ' || {_FEMININE}[b] || ' a meno ' || {said('a')} || ' virgola zero ' || {said('b')} || ' gradi, articolo ' || {said('c')} || ' e dottor Bo con ' || {said('y')} || ' passi.' AS spoken_text,
['date', 'section-reference', 'percentage-range', 'currency-range', 'range', 'percentage', 'currency', 'ratio', 'ordinal', 'abbreviation', 'decimal', 'integer', 'whitespace'] AS rules FROM p""".replace("'percentage-range', 'currency-range'", "'currency-range', 'percentage-range'"))
def rule_numbers(spark, sf):
    """Every rule of numbers, in one made sentence a document."""
    d = table(spark, sf, "documents", "doc_id")
    n = F.col("doc_id")
    a, b, c, day, m, y, z = n % 1000, n % 9 + 1, n % 80 + 10, n % 31 + 1, n % 12 + 1, n * 7 % 8000 + 1000, n % 100
    t = F.format_string("Il %d%% di %d/%d, tra %d-%d e %d -- %d%%; %d–%d €; il %d/%d/%d, cap. %d.%d, $%d,%02d; la %dª a -%d,0%d0 gradi, art. %d e dott. Bo con %d passi.", a, b, c, b, c, b, c, b, c, day, m, y, b, c, a, z, b, a, b, c, y)
    out = rules.normalized(d.withColumn("text", t), "text")
    return out.select("doc_id", "spoken_text", F.transform("transformations", lambda r: r["rule_id"]).alias("rules"))


_BLANK = r"[\s\v\x{1c}-\x{1f}\x{85}\pZ]"


@query(rf"""WITH t AS (SELECT doc_id, text || ' & 2+2=4 €' || chr(10) || chr(10) || chr(9) || CASE WHEN doc_id % 2 = 0 THEN '<b>_#' ELSE '' END AS t FROM documents),
s AS (SELECT doc_id, replace(replace(replace(replace(replace(replace(t, '&', ' e '), '+', ' più '), '=', ' uguale a '), '€', ' euro '), '$', ' dollari '), '£', ' sterline ') AS t FROM t),
w AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '[ \t\r\f\v]+', ' ', 'g'), ' ?\n+ ?', ' ', 'g'), '{_BLANK}+([.,;:!?])', '\1', 'g') AS t FROM s),
v AS (SELECT doc_id, regexp_replace(regexp_replace(t, '^{_BLANK}+', ''), '{_BLANK}+$', '') AS t FROM w)
SELECT doc_id, md5(t) AS spoken_md5, list_concat(CASE WHEN regexp_matches(t, '\\[A-Za-z]+|[{{}}_^]') THEN ['unresolved-math: unsupported equation notation remains in spoken text'] ELSE [] END,
    CASE WHEN regexp_matches(t, '[<>@#%€$£]') THEN ['unresolved-symbols: ' || array_to_string(list_sort(list_distinct(regexp_extract_all(t, '[<>@#%€$£]'))), '')] ELSE [] END) AS warnings FROM v WHERE t IS NOT NULL""")
def rule_symbols(spark, sf):
    """Signs, blanks and warnings over whole documents."""
    d = table(spark, sf, "documents", "doc_id", "text").where("text is not null")
    t = F.concat("text", F.lit(" & 2+2=4 €\n\n\t"), F.when(F.col("doc_id") % 2 == 0, "<b>_#").otherwise(""))
    return rules.normalized(d.select("doc_id", t.alias("text")), "text", only=("symbol", "whitespace")).select("doc_id", F.md5("spoken_text").alias("spoken_md5"), "warnings")


@query(r"""SELECT item_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace('e' || chr(769) || ' «' || text, 'e' || chr(769), 'é'), '([\pL\pN_])-[ \t]*\n[ \t]*([\pL\pN_])', '\1\2', 'g'), '\\label *\{[^{}]*\}', ' ', 'g'), '\\text *\{([^{}]*)\}', '\1', 'g'), '$', ' so-no 7,5 per 2  porta a  x diviso 8% fine')
 AS spoken_text FROM benchmark""")
def rule_notation(spark, sf):
    """Composition, line breaks, LaTeX and its operators."""
    b = table(spark, sf, "benchmark", "item_id", "text")
    t = F.concat(F.lit("e\u0301 «"), "text", F.lit(" so-no \\text {7}{,}5\\times2 \\to x\u00ad\\div8\\% fi-\n ne"))
    t = F.regexp_replace(t, F.lit(r"\{7\}\{,\}5"), F.lit("{7{,}5}"))
    t = F.regexp_replace(t, F.lit(r"\\text \{7\{,\}5\}"), F.lit(r"7{,}5"))
    return rules.normalized(b.select("item_id", t.alias("text")), "text", only=("unicode-cleanup", "dehyphenation", "latex-cleanup", "latex-operator")).select("item_id", "spoken_text")


_ENTRIES = (Entry("licence", "License", "licenza", word_boundaries=False), Entry("rights", r"rights\s+reserved", "diritti riservati", mode="regex", word_boundaries=False, priority=5))


@query(r"SELECT doc_id, md5(regexp_replace(regexp_replace(text, 'rights\s+reserved', 'diritti riservati', 'gi'), 'License', 'licenza', 'gi')) AS spoken, list_concat(CASE WHEN regexp_matches(text, '(?i)rights\s+reserved') THEN ['lexicon.local.rights'] ELSE [] END, CASE WHEN regexp_matches(text, '(?i)License') THEN ['lexicon.local.licence'] ELSE [] END) AS rules FROM documents WHERE text IS NOT NULL")
def lexicon_apply(spark, sf):
    d = table(spark, sf, "documents", "doc_id", "text").where("text is not null")
    out = rules.normalized(d, "text", _ENTRIES, only=(rules.LEXICON,))
    return out.select("doc_id", F.md5("spoken_text").alias("spoken"), F.transform("transformations", lambda r: r["rule_id"]).alias("rules"))


@query(r"SELECT doc_id, regexp_replace(regexp_replace('per ' || (CASE doc_id % 4 WHEN 0 THEN 'cento' WHEN 1 THEN 'venti' WHEN 2 THEN 'settanta' ELSE 'tanti' END) || ' anni', 'cento anni|venti anni|settanta anni', CASE doc_id % 4 WHEN 0 THEN 'cent’anni' WHEN 1 THEN 'vent’anni' ELSE 'settant’anni' END), '$', ' di ' || CASE WHEN doc_id % 2 = 0 THEN 'a bi emme' ELSE 'ABMNPQR' END) AS spoken_text FROM documents")
def rule_words(spark, sf):
    """Elision before anni, and acronyms."""
    n = F.col("doc_id") % 4
    t = F.concat(F.lit("per "), F.when(n == 0, "100").when(n == 1, "venti").when(n == 2, "settanta").otherwise("tanti"), F.lit(" anni di "), F.when(n % 2 == 0, "ABM").otherwise("ABMNPQR"))
    d = table(spark, sf, "documents", "doc_id")
    return rules.normalized(d.withColumn("text", t), "text", only=("integer", "anni-elision", "acronym")).select("doc_id", "spoken_text")


_LETTERS = "['a','bi','ci','di','e','effe','gi','acca','i','i lunga','cappa','elle','emme','enne','o','pi','cu','erre','esse','ti','u','vi','doppia vu','ics','ipsilon','zeta']"


def _letter(n: str) -> str:
    return f"{_LETTERS}[(({n}) % 26 + 1)::INT]"


@query(f"""SELECT p_partkey, {_letter("p_partkey")} || ' diviso ' || p_partkey || ' più ' || {_letter("p_partkey // 26")} || ' elevato alla ' || p_partkey % 7 || ' uguale a ' || {_letter("p_partkey // 7")} || ' con pedice ' || {_letter("p_partkey // 5")} || ' meno ' || {_letter("p_partkey // 3")} || ' per ' || {_letter("p_partkey // 11")} || ' diviso ' || {_letter("p_partkey // 13")} AS spoken FROM part""")
def rule_equation(spark, sf):
    """Scripts, fractions, operators and identifiers, in equations made of a part's number."""
    n = F.col("p_partkey")
    letter = lambda c: F.char(F.lit(97) + F.floor(c).cast("long") % 26)
    pieces = [F.lit("\\frac{"), letter(n), F.lit("}{"), n.cast("string"), F.lit("} + "), letter(n / 26), F.lit("^"), (n % 7).cast("string"), F.lit(" = "), letter(n / 7), F.lit("_{"), letter(n / 5), F.lit("} - "), letter(n / 3), F.lit(" * "), letter(n / 11), F.lit("/"), letter(n / 13)]
    d = table(spark, sf, "part", "p_partkey").select("p_partkey", F.concat(*pieces).alias("t"), F.lit("equation").alias("kind"))
    only = ("latex-script", "equation-fraction", "equation-operators", "equation-identifiers", "whitespace")
    return rules.normalized(d, "t", kind="kind", only=only).select("p_partkey", F.col("spoken_text").alias("spoken"))

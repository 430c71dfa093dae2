"""A training-data pipeline over `documents`, stage by stage with the operators of libretto.llm.

Each stage takes (spark, docs, sf_dir) and returns what it keeps, in the columns of docs; run()
writes each stage's rows to the shared folder and hands them to the next. The last stage adds the
tokens. Columns that docs has beside those of `documents` travel along, whatever their names; only
those named ids, n_tokens or round_trips give way to the last stage's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from libretto.llm import jaccard, langid, mixing, suffixes, tokens
from libretto.llm.common import stored
from libretto.llm.registry import piece_model

#: A text whose language is this uncertain is rejected.
LEAST_SCORE = 0.4


def own(docs: DataFrame) -> list[Column]:
    """The columns of docs, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def unused(docs: DataFrame) -> Callable[[str], str]:
    """Names for a stage's own columns: a prefix that no column of docs starts with."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    return lambda name: prefix + name


def undotted(docs: DataFrame) -> DataFrame:
    """docs for Arrow functions, which know no column names with dots."""
    my = unused(docs)
    return docs.toDF(*(my(f"c{n}") if "." in c else c for n, c in enumerate(docs.columns)))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and those whose words agree on no language, go."""
    my = unused(docs)
    lang, score, spans = map(my, ("lang", "score", "spans"))
    plain = undotted(docs)
    out = langid.predicted(plain, langid.trained(docs, F.lit(True)), added=(lang, score, spans))
    return out.where((F.col(lang) != langid.UND) & (F.col(score) >= LEAST_SCORE)).select(plain.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that links connect, the one with the smallest id stays, once; so do rows without an id."""
    my = unused(docs)
    x, i, n = map(my, ("x", "id", "n"))
    kept = jaccard.linked(docs.select("doc_id", "text")).where("doc_id = class_id")
    kept = kept.select(F.col("doc_id").alias(i), F.coalesce("x", F.lit(0)).alias(my("of"))).distinct()
    found = docs.withColumn(x, F.coalesce(F.xxhash64("text"), F.lit(0)))
    found = found.join(kept, (F.col("doc_id") == F.col(i)) & (F.col(x) == F.col(my("of"))), "left_semi")
    one = Window.partitionBy("doc_id", x).orderBy("doc_id")
    found = found.withColumn(n, F.row_number().over(one)).where(F.col(n) == 1)
    return found.select(own(docs)).unionByName(docs.where("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand earlier in the corpus are cut out of texts; documents with nothing left go."""
    my = unused(docs)
    x, i, of, kept = map(my, ("x", "id", "of", "kept"))
    changed = suffixes.deduplicated(docs.select("doc_id", "text")).where("kept is not null")
    changed = changed.select(F.col("doc_id").alias(i), F.col("x").alias(of), F.col("kept_text").alias(kept)).dropDuplicates([i, of])
    found = docs.withColumn(x, F.xxhash64(F.coalesce("text", F.lit("")))).join(changed, (F.col("doc_id") == F.col(i)) & (F.col(x) == F.col(of)), "left")
    found = found.where(F.col(kept).isNull() | (F.length(F.trim(kept)) > 0))
    new = {"text": F.coalesce(kept, "text"), "n_chars": F.when(F.col(kept).isNull(), F.col("n_chars")).otherwise(F.length(kept).cast("long"))}
    return found.withColumns({k: v for k, v in new.items() if k in docs.columns}).select(own(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them; rows alike in id and text are taken alike."""
    my = unused(docs)
    x, i, of, times, turn = map(my, ("x", "id", "of", "times", "turn"))
    mix = mixing.mixed(docs.select("doc_id", "text", "source"), F.array("source"), mixing.words_of(F.col("text")), whole=True)
    mix = mix.where("taken > 0").groupBy(F.col("doc_id").alias(i), F.col("_text_hash").alias(of)).agg(F.max(F.col("taken") / F.col("size")).cast("int").alias(times))
    found = docs.withColumn(x, F.xxhash64("text")).join(mix, F.col("doc_id").eqNullSafe(F.col(i)) & (F.col(x) == F.col(of)))
    return found.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(times)))).select(own(docs))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids (the text's SentencePiece ids), n_tokens and round_trips (whether the ids decode to the text)."""
    my = unused(docs)
    added = ("ids", "n_tokens", "round_trips")
    plain = undotted(docs)
    out = tokens.encoded(plain, piece_model(), ids=my("ids"), decoded=my("decoded"))
    whole = F.col(my("decoded")) == F.coalesce("text", F.lit(""))
    kept = [F.col(c).alias(name) for c, name in zip(plain.columns, docs.columns, strict=True) if name.lower() not in added]
    return out.select(*kept, F.col(my("ids")).alias("ids"), F.size(my("ids")).cast("long").alias("n_tokens"), whole.alias("round_trips"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("tokenised", tokenised),
]

#: A learned labeller, MinHash and a suffix sort are beyond SQL; tests hold run() and its stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs

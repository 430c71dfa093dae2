"""What a person looks at: projections of blocks to review, summaries a chapter and a book, report lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def extraction_review(blocks: DataFrame) -> DataFrame:
    """Blocks that are no paragraph or carry warnings."""
    return blocks.where((F.col("kind") != "paragraph") | (F.size("warnings") > 0))


def normalization_review(blocks: DataFrame) -> DataFrame:
    """Blocks that rules have changed or warned about."""
    return blocks.where((F.size("transformations") > 0) | (F.size("warnings") > 0))


def ingest_summary(blocks: DataFrame, exclusions: DataFrame, by: str = "book_id") -> DataFrame:
    """A row a book: chapters, blocks, warnings, exclusions. A book may have exclusions alone."""
    b = blocks.groupBy(by).agg(F.count_distinct("chapter_id").alias("chapters"), F.count("*").alias("blocks"), F.sum(F.size("warnings")).cast("long").alias("warnings"))
    x = exclusions.groupBy(by).agg(F.count("*").alias("exclusions"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("chapters", "blocks", "warnings", "exclusions")]
    return b.join(x, by, "full").select(by, *zero)


def chapter_distincts(chunks: DataFrame, *by: str) -> DataFrame:
    """A row a chapter: chunks, distinct blocks and sentences, forced splits (parts beyond a sentence's first), longest chunk."""
    one = chunks.groupBy(*by, "paragraph_id", "sentence_id").agg(F.count("*").alias("_n"), F.max(F.length("spoken_text")).alias("_m"))
    return one.groupBy(*by).agg(
        F.sum("_n").cast("long").alias("chunks"), F.count_distinct("paragraph_id").alias("blocks"), F.count("*").alias("sentences"),
        F.sum(F.col("_n") - 1).cast("long").alias("forced_splits"), F.max("_m").alias("longest"),
    )


def qualification(chunks: DataFrame, blocks: DataFrame, book: str, chapter: str, limit: int, words: Column, document_warnings: DataFrame | None = None, per_minute: int = 150) -> DataFrame:
    """A row a chapter and, with chapter null, a row a book: words, warnings, outliers, speech_ms, pause_ms, total_ms.

    speech_ms is rounded a chapter; a book's is the sum of its chapters'. A book's warnings count
    those of the document (rows of document_warnings) as well.
    """
    c = chunks.groupBy(book, chapter).agg(F.sum(words).cast("long").alias("words"), F.count_if(F.length("spoken_text") > limit).alias("outliers"), F.sum("pause_ms").cast("long").alias("pause_ms"))
    w = blocks.groupBy(book, chapter).agg(F.sum(F.size("warnings")).cast("long").alias("warnings"))
    rows = c.join(w, [book, chapter], "left").withColumn("warnings", F.coalesce("warnings", F.lit(0)))
    rows = rows.withColumn("speech_ms", F.bround(F.col("words") * 60000 / per_minute).cast("long"))
    names = ("words", "warnings", "outliers", "speech_ms", "pause_ms")
    books = rows.groupBy(book).agg(*(F.sum(n).cast("long").alias(n) for n in names))
    if document_warnings is not None:
        more = document_warnings.groupBy(book).agg(F.count("*").alias("_more"))
        books = books.join(more, book, "left").withColumn("warnings", F.col("warnings") + F.coalesce("_more", F.lit(0))).drop("_more")
    books = books.withColumn(chapter, F.lit(None).cast(dict(rows.dtypes)[chapter]))
    return rows.select(book, chapter, *names).unionByName(books).withColumn("total_ms", F.col("speech_ms") + F.col("pause_ms"))


def selection(chapters: DataFrame, blocks: DataFrame, normalized: DataFrame, chunks: DataFrame, scope: DataFrame) -> DataFrame:
    """scope joined with chapters, blocks, normalized texts and chunks: a row a chunk of a chapter in scope.
    Blocks without a normalized text or a chunk stay, so that what is missing shows."""
    b = blocks.join(scope.join(chapters, ["book_id", "chapter_id"], "left_semi").select("book_id", "chapter_id"), ["book_id", "chapter_id"], "left_semi")
    return b.join(normalized, ["book_id", "block_id"], "left").join(chunks, ["book_id", "block_id"], "left")


def first_missing(wanted: DataFrame, had: DataFrame, key: str, order: str, most: int = 5) -> DataFrame:
    """The first rows of wanted that had lacks, for an error text; with how many there are in all."""
    lost = wanted.join(had.select(key), key, "left_anti")
    return lost.orderBy(order).limit(most).crossJoin(F.broadcast(lost.agg(F.count("*").alias("missing"))))


def block_lines(blocks: DataFrame, by: str, order: str) -> DataFrame:
    """The lines of a chapter's review, every block of it: heading, text in a fence that the text can't close, warnings."""
    ticks = F.array_max(F.concat(F.array(F.lit(2)), F.transform(F.regexp_extract_all("display_text", F.lit("(`+)"), F.lit(1)), F.length)))
    fence = F.repeat(F.lit("`"), F.greatest(F.lit(3), ticks + 1))
    warned = F.array_join(F.transform("warnings", lambda w: F.concat(F.lit("- "), w, F.lit("\n"))), "")
    return blocks.select(by, order, F.concat(F.lit("## "), "block_id", F.lit(" ("), "kind", F.lit(")\n\n"), fence, F.lit("text\n"), "display_text", F.lit("\n"), fence, F.lit("\n"), warned).alias("lines"))


def chapter_level(source: Column) -> Column:
    r"""Level of chapter headings in a LaTeX source: 2 below a \part{ that no comment hides, else 1."""
    return F.when(source.rlike(r"(?m)^(?:[^%\n]|\\%)*\\part\*?\s*\{"), 2).otherwise(1)


# Where attempts, audio and failures are kept below an artifact root.
ATTEMPT, AUDIO, SIDECAR, FAILURE = "verification/attempts/%s/%s-%s.json", "audio/%s/%s.wav", "audio/%s/%s.json", "failures/%s/%s.json"


def attempt_path(chunk: Column, generation_sha256: Column, config_sha256: Column) -> Column:
    return F.format_string(ATTEMPT, chunk, generation_sha256, config_sha256)


def generation_paths(chunk: Column, cache_key: Column) -> Column:
    """Struct of a generation's audio, state and failure paths."""
    return F.struct(F.format_string(AUDIO, chunk, cache_key).alias("audio"), F.format_string(SIDECAR, chunk, cache_key).alias("state"), F.format_string(FAILURE, chunk, cache_key).alias("failure"))

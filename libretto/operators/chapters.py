"""Structure of documents: chapters from headings, numbering of sections, and references to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from libretto.functions.text import is_references, preview


def segmented(rows: DataFrame, book: str = "book_id", pos: str = "pos", level: str = "level", text: str = "text", at: int = 1, front: str = "Front matter", fallback: str | None = None) -> DataFrame:
    """Rows (one a block; level is null for all but headings) with chapter_no, chapter_title, block_no and excluded.

    Every heading at level `at` or above it (smaller level) closes what stands before it.
    * One at level `at` opens a chapter of its title.
    * A higher one waits: it stands first in the chapter that the next heading at level `at` opens,
      last in the book's last chapter if none follows, and is dropped if a bibliography follows
      first. Blocks right behind it are a chapter of their own under the title before it.
    * A bibliography's heading excludes what follows up to the next heading of either kind.
    Without a chapter heading before it a closed chapter is `front`; the book's last one then has the
    title of the last waiting heading, or else `fallback` (`front` if not given). Dropped headings
    come back excluded, without a chapter. block_no counts the kept blocks in their new order.
    """
    order = Window.partitionBy(book).orderBy(pos)
    ran = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    later = order.rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(book)
    lvl = F.col(level)
    opens, higher = lvl == at, lvl < at
    r = rows.withColumn("_kind", F.when(opens & is_references(F.col(text)), "refs").when(opens, "chapter").when(higher, "higher"))
    mark = F.struct(F.col(pos).alias("at"), F.col("_kind").alias("kind"), F.col(text).alias("title"))
    only = lambda *kinds: F.when(F.col("_kind").isin(*kinds), mark)
    r = r.withColumn("_cut", F.last(only("refs", "chapter", "higher"), True).over(ran)).withColumn("_title", F.last(only("chapter"), True).over(ran)["title"])
    r = r.withColumn("_next", F.first(only("refs", "chapter"), True).over(later)).withColumn("_end", F.max(F.when(F.col("_kind").isNotNull(), F.col(pos))).over(whole))
    r = r.withColumn("_any", F.last(only("chapter"), True).over(whole.orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))["title"])
    waits = F.col("_kind") == "higher"
    r = r.withColumn("_open", F.coalesce(waits, F.lit(False)) & F.col("_next").isNull())  # goes to the last chapter
    r = r.withColumn("_last", F.max(F.when(F.col("_open"), F.struct(F.col(pos).alias("at"), F.col(text).alias("title")))).over(whole)["title"])
    lost = F.when(waits, F.coalesce(F.col("_next.kind") == "refs", F.lit(False))).otherwise(F.coalesce(F.col("_cut.kind") == "refs", F.lit(False)))
    r = r.withColumn("excluded", F.coalesce(lost, F.lit(False)))
    home = F.when(F.col("_open"), F.col("_end")).when(waits, F.col("_next.at")).otherwise(F.col("_cut.at"))
    r = r.withColumn("_home", home)
    ends = F.col("_home").eqNullSafe(F.col("_end"))
    last = F.coalesce("_any", "_last", F.lit(fallback or front))
    title = F.when(F.col("_open") | ends & F.col("_any").isNull(), last).when(waits, F.col("_next.title")).otherwise(F.coalesce("_title", F.lit(front)))
    kept = r.where("not excluded").withColumn("chapter_title", title)
    kept = kept.withColumn("chapter_no", F.dense_rank().over(Window.partitionBy(book).orderBy(F.asc_nulls_first("_home"))) - 1)
    kept = kept.withColumn("block_no", F.row_number().over(Window.partitionBy(book).orderBy("chapter_no", F.col("_open").cast("int"), pos)))
    gone = r.where("excluded").withColumns({"chapter_title": F.lit(None).cast("string"), "chapter_no": F.lit(None).cast("int"), "block_no": F.lit(None).cast("int")})
    names = [*rows.columns, "excluded", "chapter_no", "chapter_title", "block_no"]
    return kept.select(names).unionByName(gone.select(names))


def ids(chapter_no: Column, block_no: Column) -> tuple[Column, Column]:
    return F.format_string("chapter-%04d", chapter_no + 1), F.format_string("block-%06d", block_no)


def numbered(rows: DataFrame, book: str = "book_id", pos: str = "pos", kind: str = "kind") -> DataFrame:
    """Heading rows (kind chapter, section or subsection, others pass) with number: counters that restart below a higher heading."""
    order = Window.partitionBy(book).orderBy(pos)
    one = lambda k: F.sum(F.when(F.col(kind) == k, 1).otherwise(0))
    r = rows.withColumn("_c", one("chapter").over(order))
    r = r.withColumn("_s", one("section").over(Window.partitionBy(book, "_c").orderBy(pos)))
    r = r.withColumn("_u", one("subsection").over(Window.partitionBy(book, "_c", "_s").orderBy(pos)))
    number = F.when(F.col(kind) == "chapter", F.col("_c").cast("string")).when(F.col(kind) == "section", F.concat_ws(".", "_c", "_s")).when(F.col(kind) == "subsection", F.concat_ws(".", "_c", "_s", "_u"))
    return r.withColumn("number", number).drop("_c", "_s", "_u")


def scope(chapters: DataFrame, requested: list[str] | None, chapter: str = "chapter_id", order: str = "chapter_order") -> DataFrame:
    """The chapters asked for (None: all), which must be known, in order, unique and contiguous."""
    if requested is None:
        return chapters
    if not requested or any(not r.strip() for r in requested) or len(set(requested)) != len(requested):
        raise ValueError("chapters must be named, once each")
    found = chapters.where(F.col(chapter).isin(requested)).orderBy(order)
    rows = [(r[0], r[1]) for r in found.select(chapter, order).limit(len(requested) + 1).collect()]
    if {r[0] for r in rows} != set(requested):
        raise ValueError(f"unknown chapters: {sorted(set(requested) - {r[0] for r in rows})}")
    if [r[0] for r in rows] != requested or rows[-1][1] - rows[0][1] + 1 != len(rows):
        raise ValueError("chapters must be contiguous and in order")
    return found

#: Kinds of blocks that a configuration may exclude; fixed values.
EXCLUDABLE = ("caption", "footnote", "table")


def diverted(blocks: DataFrame, kinds: list[str], kind: str = "kind", text: str = "display_text", allowed: tuple[str, ...] = EXCLUDABLE) -> tuple[DataFrame, DataFrame]:
    """(blocks that stay, exclusions): blocks of the kinds become exclusions with a preview of their text."""
    if len(set(kinds)) != len(kinds) or not set(kinds) <= set(allowed):
        raise ValueError(f"only {', '.join(allowed)} can be excluded, once each")
    gone = F.coalesce(F.col(kind).isin(kinds), F.lit(False))
    rest = [c for c in blocks.columns if c not in (kind, text)]
    said = F.concat(F.col(kind), F.lit(": "), preview(F.col(text)))
    return blocks.where(~gone), blocks.where(gone).select(*rest, F.lit("configured-block-exclusion").alias("reason_code"), said.alias("description"))


def own_warnings(warnings: Column, kind: Column) -> Column:
    """A block's warnings, less the request to review equations where the block is one."""
    return F.filter(warnings, lambda w: ~((kind == "equation") & w.startswith("equation-requires-review")))

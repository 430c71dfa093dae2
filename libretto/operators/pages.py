"""Pages of extracted documents: classes of pages, layout boxes, furniture; and LaTeX references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from libretto.functions.text import letters_of


def page_class(text: Column, images: Column, drawings: Column, many: int = 20) -> Column:
    """text, scanned (no text but images or many drawings) or blank."""
    return F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) > 0, "text").when((images > 0) | (drawings >= many), "scanned").otherwise("blank")


def checked_pages(pages: DataFrame) -> DataFrame:
    """Pages (page, text, images, drawings) with page_class; a scanned page fails the whole read."""
    out = pages.withColumn("page_class", page_class(F.col("text"), F.col("images"), F.col("drawings")))
    fine = F.assert_true(F.col("page_class") != "scanned", F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(" is scanned")))
    return out.where(fine.isNull())


def exclusions(pages: DataFrame) -> DataFrame:
    """(page, reason_code) for blank pages, page furniture (column furniture: its text) and pictures (column boxes)."""
    blank = pages.where("page_class = 'blank'").select("page", F.lit("blank-page").alias("reason_code"))
    furniture = pages.where("length(furniture) > 0").select("page", F.lit("pdf-header-footer").alias("reason_code"))
    pictures = pages.select("page", F.explode(F.filter("boxes", lambda b: F.lower(b["class"]).isin("image", "picture")))).select("page", F.lit("non-narratable-image").alias("reason_code"))
    return blank.unionByName(furniture).unionByName(pictures)


TOKEN = r"\\(chapter|section|subsection)(\*?)\{[^{}]*\}|\\(label)\{([^{}]+)\}|\\(appendix)\b|\\begin\{(figure|table|equation)\}"
NAMES = {"figure": "figura", "table": "tabella", "equation": "equazione", "chapter": "capitolo", "appendix": "appendice", "section": "sezione", "subsection": "sottosezione"}


def reference_index(books: DataFrame, book: str = "book_id", text: str = "text") -> DataFrame:
    """(book, label, target, pos): what each \\label names, e.g. `figura 2.1`; numbers restart in each chapter, appendices have letters."""
    tokens = books.select(book, F.posexplode(F.regexp_extract_all(text, F.lit(r"(\\chapter\*?\{[^{}]*\}|\\section\*?\{[^{}]*\}|\\subsection\*?\{[^{}]*\}|\\label\{[^{}]+\}|\\appendix\b|\\begin\{(?:figure|table|equation)\})"), F.lit(1))).alias("pos", "t"))
    kind = F.regexp_extract("t", r"^\\(chapter|section|subsection|label|appendix)", 1)
    kind = F.when(kind == "", F.regexp_extract("t", r"\\begin\{(\w+)\}", 1)).otherwise(kind)
    r = tokens.withColumn("kind", kind).withColumn("star", F.col("t").rlike(r"^\\\w+\*")).withColumn("label", F.regexp_extract("t", r"^\\label\{([^{}]+)\}", 1))
    order = Window.partitionBy(book).orderBy("pos")
    count = lambda k, w: F.sum(F.when((F.col("kind") == k) & ~F.col("star"), 1).otherwise(0)).over(w)
    r = r.withColumn("_back", F.max(F.when(F.col("kind") == "appendix", 1).otherwise(0)).over(order))
    r = r.withColumn("_c", F.sum(F.when((F.col("kind") == "chapter") & ~F.col("star"), 1).otherwise(0)).over(Window.partitionBy(book, "_back").orderBy("pos")))
    inside = Window.partitionBy(book, "_back", "_c").orderBy("pos")
    r = r.withColumn("_s", count("section", inside))
    r = r.withColumn("_u", count("subsection", Window.partitionBy(book, "_back", "_c", "_s").orderBy("pos")))
    for k in ("figure", "table", "equation"):
        r = r.withColumn(f"_{k}", count(k, inside))
    letter = letters_of(F.col("_c"))
    chapter = F.when(F.col("_back") == 1, letter).otherwise(F.col("_c").cast("string"))
    named = lambda k, *n: F.concat_ws(" ", F.lit(NAMES[k]), F.concat_ws(".", *n))
    home = F.when(F.col("_c") == 0, None).when(F.col("_back") == 1, named("appendix", chapter)).otherwise(named("chapter", chapter))
    section = F.when(F.col("_s") > 0, named("section", chapter, F.col("_s"))).otherwise(home)
    target = (
        F.when((F.col("kind") == "chapter") & ~F.col("star"), home)
        .when((F.col("kind") == "section") & F.col("star"), home)
        .when(F.col("kind") == "section", section)
        .when((F.col("kind") == "subsection") & F.col("star"), section)
        .when(F.col("kind") == "subsection", named("subsection", chapter, F.col("_s"), F.col("_u")))
    )
    for k in ("figure", "table", "equation"):
        target = target.when(F.col("kind") == k, named(k, chapter, F.col(f"_{k}")))
    heads = ("chapter", "section", "subsection", "figure", "table", "equation")
    marks = F.struct(target.alias("x"))
    r = r.withColumn("target", F.last(F.when(F.col("kind").isin(*heads), marks), True).over(order)["x"])
    return r.where("label <> ''").select(book, "label", "target", "pos")


def resolved(books: DataFrame, index: DataFrame, book: str = "book_id", text: str = "text") -> DataFrame:
    """books with \\ref, \\autoref and \\appref put into words, and the labels that nothing names (column unresolved)."""
    once = index.where("target is not null").groupBy(book, "label").agg(F.max_by("target", "pos").alias("target"))  # a repeated label: the last one
    known = once.groupBy(book).agg(F.map_from_entries(F.collect_list(F.struct("label", "target"))).alias("_m"))
    pattern = r"\\((?:auto|app)?ref)\{([^{}]+)\}"
    out = books.join(known, book, "left").withColumn("_m", F.coalesce("_m", F.create_map().cast("map<string,string>")))
    between = F.split(text, r"\\(?:auto|app)?ref\{[^{}]+\}", -1)
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("k"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("l"))
    say = lambda z: F.coalesce(F.try_element_at(F.col("_m"), z["l"]), F.when(z["k"] == "appref", "appendice non risolta").otherwise("riferimento non risolto"))
    words = F.concat(F.transform(found, say), F.array(F.lit("")))
    whole = F.array_join(F.flatten(F.zip_with(between, words, lambda a, b: F.array(a, b))), "")
    lost = F.filter(F.array_distinct(found["l"]), lambda x: ~F.map_contains_key(F.col("_m"), x))
    return out.withColumn("unresolved", lost).withColumn(text, whole).drop("_m")

"""Substring dedup with a log-structured fingerprint index.

A document's words are removed where LENGTH consecutive words also start, in the same sequence, in
a document with a smaller id. The index grows by batches of documents:

* its fingerprints are hashes of GRAM-word windows, of each LENGTH-word window the smallest one
  (grams.py), so that equal LENGTH-word windows share a fingerprint and the search loses nothing;
* each batch is written as a run: fingerprint rows (hash, document) sorted by hash, never changed
  later. A new batch is merge-joined with the earlier runs and with itself, which names the
  documents, old and new, that share a fingerprint;
* the hits are verified in the documents' texts. Neighbouring windows under one shared fingerprint are
  a piece; equal pieces (by a hash of all their words, under one fingerprint) are aggregated to their first document,
  which settles all others. Only where a fingerprint has different pieces, the first of each kind are
  compared window by window, by two 64-bit hashes of the words' hashes. A window of the new batch that also starts in a
  document with a smaller id covers words to remove;
* when there are more than `most_runs` runs they are compacted: merged into one sorted run;
* the index keeps the texts its fingerprints stand for, so that a later batch needs nothing else.

Of documents of a batch with the same words only the first is searched; the others lose all their
words (if LENGTH or more). Runs are dealt with a rebalance, so a fingerprint that very many
documents hold is cut over several files and tasks, and joins on it are split where skewed.

Batches must come in rising order of ids. Rows with one id don't remove from each other; a row
without an id is never matched; null texts have no words; texts of fewer than LENGTH words lose
nothing; repeated rows get the same result; an empty batch gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from libretto.llm.common import PLAIN, batches, bucketed, buckets, lean, shared_dir, stored, unrepeated
from libretto.llm.suffixes import firsts, heads_of, union, whole

LENGTH, GRAM, MOST_RUNS = 50, 26, 8
RUN = "hash long, key long, x long"


def fingerprints(df: DataFrame, length: int, k: int) -> DataFrame:
    """Rows key, x, n_words, sha256 (of the words joined by a space), anchors (distinct fingerprints)."""

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from libretto.llm import grams

        for batch in batches(frame, "text"):
            size, sha, anchors = [], [], []
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                text = value or b""
                starts, ends = grams.words(text)
                size.append(len(starts))
                sha.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
                at, all_grams = grams.minimisers(grams.word_hashes(text, starts, ends), length, k)
                anchors.append(np.unique(all_grams[np.unique(at)]).view(np.int64))
            ends = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(anchors)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("x"), pa.array(size, pa.int64()), pa.array(sha), lists], names=["key", "x", "n_words", "sha256", "anchors"])

    return df.mapInArrow(run, "key long, x long, n_words long, sha256 string, anchors array<long>")


class SubstringIndex:
    """Sorted immutable runs of fingerprints, and the texts of the documents they stand for.

    All of it lives in a folder. Each add() and compact() ends by writing a new manifest there, so a
    later session goes on from the last state with open(); what a broken add() left is not in it.
    """

    def __init__(self, spark: SparkSession, length: int = LENGTH, k: int = GRAM, most_runs: int = MOST_RUNS, folder: str | None = None):
        self.spark, self.length, self.k, self.most_runs = spark, length, k, most_runs
        lean(spark)
        self.folder = folder or f"{shared_dir(spark)}/libretto/index-{uuid.uuid4().hex}"
        self.runs: list[str] = []
        self.texts: list[str] = []
        self.size = 0
        self.version = 0

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> SubstringIndex:
        """The index as its last manifest in that folder says."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/manifests")
        files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
        last = max(int(f.getPath().getName()) for f in files)
        about = json.loads(spark.read.text(f"{folder}/manifests/{last}").first()[0])
        index = cls(spark, about["length"], about["k"], about["most_runs"], folder)
        index.runs, index.texts, index.size, index.version = about["runs"], about["texts"], about["size"], last
        return index

    def _commit(self) -> None:
        self.version += 1
        names = ("length", "k", "most_runs", "runs", "texts", "size")
        about = json.dumps({n: getattr(self, n) for n in names})
        self.spark.createDataFrame([(about,)], "value string").coalesce(1).write.text(f"{self.folder}/manifests/{self.version}")

    def _run(self, rows: DataFrame) -> str:
        """A new run; a rebalance deals it, so that a fingerprint of very many documents is cut over files."""
        name = f"run-{uuid.uuid4().hex}"
        rows.hint("rebalance", "hash").sortWithinPartitions("hash", "key").write.options(**PLAIN).parquet(f"{self.folder}/{name}")
        return name

    def read(self, names: list[str], schema: str = RUN) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{n}" for n in names))

    def compact(self) -> None:
        """Merge all runs into one; the old ones stay until nothing reads them."""
        if len(self.runs) > 1:
            self.runs = [self._run(self.read(self.runs))]
            self._commit()

    def add(self, df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Index a batch. One row for each row of df: <key>, x (hash of its text), n_words, sha256 (of
        all words joined by a space), spans (array of start, end: removed runs of words) and kept
        (the words that remain, joined by a space; null if nothing was removed)."""
        docs = df.select(F.col(key).cast("long").alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("x"), F.col(text).alias("text"))
        prints = stored(fingerprints(docs, self.length, self.k))
        about = prints.agg(F.count("*").alias("n"), F.sum("n_words").alias("words")).first()
        known = stored(firsts(prints.drop("anchors"), "n_words", self.length, about.n), about.n)
        heads = stored(heads_of(known), about.n)
        # The index keeps the texts it may have to verify later: of equal ones the first, where a window fits.
        texts_ = f"texts-{uuid.uuid4().hex}"
        docs.join(heads.hint("merge"), ["key", "x"]).write.options(**PLAIN).parquet(f"{self.folder}/{texts_}")
        fresh = self._run(prints.where("key is not null").select(F.explode("anchors").alias("hash"), "key", "x"))
        new = self.read([fresh])
        span = new.groupBy("hash").agg(F.min("x").alias("a"), F.max("x").alias("b"))  # copies of one text have one hash
        if self.runs:
            history = self.read(self.runs)
            met = span.join(history.select("hash").distinct().withColumn("old", F.lit(True)).hint("merge"), "hash", "left")
            shared = stored(met.where("old or a < b").select("hash", "old"))
            hits = new.join(shared.select("hash").hint("merge"), "hash").unionByName(history.join(shared.where("old").select("hash").hint("merge"), "hash"))
        else:
            hits = new.join(stored(span.where("a < b").select("hash")).hint("merge"), "hash")
        self.runs, self.texts, self.size = [*self.runs, fresh], [*self.texts, texts_], self.size + 7 * (about.words or 0)
        self._commit()
        if len(self.runs) > self.most_runs:
            self.compact()
        wanted = hits.groupBy("key", "x").agg(F.collect_set("hash").alias("shared"))
        every = self.read(self.texts, "key long, x long, text string")  # only texts that the index keeps are found
        texts = bucketed(every.join(wanted.hint("merge"), ["key", "x"]), ["key", "x"], buckets(self.spark, self.size))
        pieces = stored(self._pieces(texts))
        n = pieces.count()
        low = stored(pieces.groupBy("mini", "c").agg(F.min("key").alias("low")), n)
        several = stored(low.groupBy("mini").agg(F.count("*").alias("kinds")).where("kinds > 1"), n)
        low = low.join(several.hint("merge"), "mini", "left")
        gone = F.col("key") > F.col("low")
        placed = stored(pieces.join(low.hint("merge"), ["mini", "c"]).where(gone | F.col("kinds").isNotNull()).select("key", "x", "start", "n", gone.alias("gone")), n)
        open_ = placed.where("not gone").groupBy("key", "x").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
        windows = stored(self._windows(texts.drop("shared").join(open_.hint("merge"), ["key", "x"])))
        met = windows.groupBy("w1", "w2").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("w1", "w2", "low")
        found = windows.join(stored(met).hint("merge"), ["w1", "w2"]).where("key > low").select("key", "x", "start", F.lit(1).alias("n"))
        covered = placed.where("gone").select("key", "x", "start", "n").unionByName(found).groupBy("key", "x").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
        changed = self._rest(texts.drop("shared").join(covered.hint("merge"), ["key", "x"]))
        return whole(known, changed, "n_words", key)

    def _pieces(self, texts: DataFrame) -> DataFrame:
        """Runs of windows with one shared fingerprint: its hash, another of all the words, document, first window, windows."""
        length, k = self.length, self.k

        def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import numpy as np

            from libretto.llm import grams

            for batch in batches(unrepeated(frame, ["key", "x"]), "text"):
                out = []
                for value, shared, key, x in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("shared"), batch.column("key").to_pylist(), batch.column("x").to_pylist(), strict=True):
                    symbols = grams.word_hashes(value, *grams.words(value))
                    at, all_grams = grams.minimisers(symbols, length, k)
                    if not len(at):
                        continue
                    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                    n = np.diff(np.append(start, len(at)))
                    mini = all_grams[at[start]].view(np.int64)
                    keep = np.isin(mini, shared.values.to_numpy())
                    mini, start, n = mini[keep], start[keep], n[keep]
                    c = grams.ranges(grams.sums(symbols, grams.BASES[1]), start, start + n + length - 1, grams.BASES[1]).view(np.int64)
                    out.append((mini, c, np.full(len(mini), key), np.full(len(mini), x), start.astype(np.int32), n.astype(np.int32)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["mini", "c", "key", "x", "start", "n"])

        return texts.mapInArrow(run, "mini long, c long, key long, x long, start int, n int")

    def _windows(self, texts: DataFrame) -> DataFrame:
        """The windows of the runs in column runs: two independent hashes, document and place."""
        length = self.length

        def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import numpy as np

            from libretto.llm import grams

            for batch in batches(unrepeated(frame, ["key", "x"]), "text", 1 << 20):
                out = []
                for value, runs, key, x in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs"), batch.column("key").to_pylist(), batch.column("x").to_pylist(), strict=True):
                    symbols = grams.word_hashes(value, *grams.words(value))
                    first, n = (runs.values.field(i).to_numpy() for i in (0, 1))
                    at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
                    w = [grams.windows(symbols, length, lane)[at].view(np.int64) for lane in (0, 1)]
                    out.append((*w, np.full(len(at), key), np.full(len(at), x), at.astype(np.int32)))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["w1", "w2", "key", "x", "start"])

        return texts.mapInArrow(run, "w1 long, w2 long, key long, x long, start int")

    def _rest(self, df: DataFrame) -> DataFrame:
        length = self.length

        def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import numpy as np

            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            for batch in batches(unrepeated(frame, ["key", "x"]), "text"):
                spans, kept = [], []
                for value, runs in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs"), strict=True):
                    words = value.split()
                    first, n = (runs.values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
                    merged = union(first, first + n + length - 1)
                    spans.append([{"start": a, "end": b} for a, b in merged])
                    ends = [0, *(b for _, b in merged)]
                    kept.append(b" ".join(w for a, b in zip(ends, [*(a for a, _ in merged), len(words)], strict=True) for w in words[a:b]))
                yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("x"), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["key", "x", "spans", "kept"])

        return df.mapInArrow(run, "key long, x long, spans array<struct<start:int,end:int>>, kept binary")


def deduplicated(df: DataFrame, parts: int = 3, key: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = GRAM, most_runs: int = 2) -> DataFrame:
    """All of df through the index in `parts` batches of rising ids; rows as SubstringIndex.add() gives them.
    With more parts than most_runs the runs are compacted on the way. Ids must be whole numbers."""
    ends = df.agg(F.min(key).alias("a"), F.max(key).alias("b")).first()
    index = SubstringIndex(df.sparkSession, length, k, most_runs)
    if ends.a is None:
        return index.add(df, key, text)
    cuts = [ends.a + (ends.b + 1 - ends.a) * i // parts for i in range(1, parts)]
    out, low = None, None
    for cut in [*cuts, None]:
        part = df if low is None else df.where(F.col(key) >= low)
        part = part if cut is None else part.where(F.col(key) < cut)
        if low is None and cut is not None:  # rows without an id go with the first batch
            part = df.where((F.col(key) < cut) | F.col(key).isNull())
        done = index.add(part, key, text)
        out = done if out is None else out.unionByName(done)
        low = cut
    return out

"""Suffix-array dedup of byte strings that repeat across or within documents.

Texts are UTF-8 bytes. A byte is removed if a LENGTH-byte string over it also starts earlier: in a
document with a smaller id, or in the same document further left. Strings are judged on the input.

1. Each document's k-gram minimisers are its fingerprints (grams.py: equal strings pick equal
   ones, so the search loses nothing). Exact copies are set aside; only the first is searched.
2. In documents that hold a fingerprint met elsewhere, the runs of strings with one minimiser are
   cut out (a piece of 100 to 160 bytes). Equal pieces are aggregated to their first document before
   anything is shuffled to a shard, which settles all others of them, however many copies there are.
   Pieces under one minimiser are told apart by a 64-bit hash of all their bytes: of m distinct ones
   two are taken for one with a probability below m * m / 2^65.
3. The distinct pieces go to shards by minimiser, so that equal strings meet in a shard. Each
   shard's suffix array is built by Larsson-Sadakane refinement, the common prefixes by Kasai's
   scan (both in numpy), and strings with a common prefix of LENGTH form a class, of which the
   earliest stays. A minimiser with more than KINDS distinct pieces is cut over several shards,
   which are merged pairwise by binary search in their sorted strings. A task takes about TASK_BYTES
   of shards, so that tasks grow in number with the input, not in size.

Rows with one id and one text are one document and get the same result; rows of one id with
different texts don't remove from each other. A null text counts as empty; a row without an id is
never matched; texts shorter than LENGTH only lose nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from libretto.llm.common import batches, bucketed, buckets, grouped, lean, partitions, stored, unrepeated

LENGTH, GRAM, KINDS, SHARD_BYTES, TASK_BYTES = 100, 40, 4096, 1 << 20, 32 << 20


def suffix_array(text):
    """Suffixes of a byte array in order, and their ranks (Larsson-Sadakane: only unsettled groups are refined)."""
    import numpy as np

    n = len(text)
    key = words_at(text)
    order = np.argsort(key)
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, dtype=bool)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    known = 8
    while n:
        # Slots of groups with more than one suffix; all others are in place.
        slots = np.flatnonzero(~(head & np.append(head[1:], True)))
        if not len(slots):
            break
        own = order[slots]
        further = own + known
        key = rank[own] * (n + 1) + np.where(further < n, rank[np.minimum(further, n - 1)] + 1, 0)
        by = np.argsort(key)
        order[slots] = own = own[by]
        key = key[by]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head[slots] = new
        rank[own] = np.maximum.accumulate(np.where(new, slots, 0))
        known *= 2
    return order, rank


def words_at(text):
    """The 8 bytes from each position on, as one number; zeros stand behind the end."""
    import numpy as np

    n = len(text)
    pad = np.concatenate([text, np.zeros(8, dtype=np.uint8)])
    out = np.zeros(n, dtype=np.uint64)
    for i in range(8):
        out = (out << np.uint64(8)) | pad[i : i + n]
    return out


def common_prefixes(text, order, rank, most: int, lanes: int = 4096):
    """Kasai's scan: for each slot the common prefix with the slot before it, up to `most`.

    The text is cut into lanes that are scanned in step, 8 bytes at a time; within a lane, the
    prefix of a position is at least that of the position before it less one.
    """
    import numpy as np

    n = len(text)
    out = np.zeros(n, dtype=np.int32)
    if n < 2:
        return out
    word = words_at(text)
    steps = -(-n // min(lanes, n))
    starts = np.arange(0, n, steps)
    have = np.zeros(len(starts), dtype=np.int64)
    for t in range(steps):
        p = starts + t
        if p[-1] >= n:
            p, have = p[:-1], have[:-1]
            starts = starts[:-1]
        slot = rank[p]
        q = order[np.maximum(slot - 1, 0)]
        room = np.minimum(most, n - np.maximum(p, q))
        room[slot == 0] = 0
        got = np.minimum(np.maximum(have - 1, 0), room)
        go = np.flatnonzero(got < room)
        while len(go):
            differ = word[p[go] + got[go]] ^ word[q[go] + got[go]]
            got[go] += sum((differ < np.uint64(1 << (8 * i))).astype(np.int64) for i in range(8))
            go = go[(differ == 0) & (got[go] < room[go])]
        have = got = np.minimum(got, room)
        out[slot] = got
    return out


def pieces_of(text: bytes, shared, length: int, k: int):
    """Runs of windows with one minimiser that is in `shared` or repeats here: (minimiser, start, windows)."""
    import numpy as np

    from libretto.llm import grams

    symbols = grams.BYTES[0][np.frombuffer(text, dtype=np.uint8)]
    at, all_grams = grams.minimisers(symbols, length, k)
    if not len(at):
        return (np.empty(0, dtype=np.int64),) * 3
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    n = np.diff(np.append(starts, len(at)))
    mini = all_grams[at[starts]].view(np.int64)
    value, count = np.unique(mini, return_counts=True)
    keep = np.isin(mini, np.concatenate([np.asarray(shared, dtype=np.int64), value[count > 1]]))
    return mini[keep], starts[keep], n[keep]


def fingerprints(df: DataFrame, length: int, k: int) -> DataFrame:
    """Rows key, x, n_bytes, sha256, anchors (distinct minimisers), repeats (one of them more than once)."""

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from libretto.llm import grams

        for batch in batches(frame, "text"):
            size, sha, anchors, repeats = [], [], [], []
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                text = value or b""
                size.append(len(text))
                sha.append(hashlib.sha256(text).hexdigest())
                at, all_grams = grams.minimisers(grams.BYTES[0][np.frombuffer(text, dtype=np.uint8)], length, k)
                own = all_grams[at[np.concatenate([[True], at[1:] != at[:-1]])]] if len(at) else all_grams[:0]
                distinct = np.unique(own)
                anchors.append(distinct.view(np.int64))
                repeats.append(len(distinct) < len(own))
            ends = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(anchors)))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("x"), pa.array(size, pa.int64()), pa.array(sha), lists, pa.array(repeats)], names=["key", "x", "n_bytes", "sha256", "anchors", "repeats"])

    return df.mapInArrow(run, "key long, x long, n_bytes long, sha256 string, anchors array<long>, repeats boolean")


def firsts(known: DataFrame, size: str, least: int, n: int) -> DataFrame:
    """known with column low: the smallest key that has the row's sha256, where it holds `least` at least."""
    low = known.where((F.col(size) >= least) & F.col("key").isNotNull()).groupBy("sha256").agg(F.min("key").alias("low"))
    return known.join(stored(low, n).hint("merge"), "sha256", "left")  # stored, so that a skewed side of the join can be split


def heads_of(known: DataFrame, *more: str) -> DataFrame:
    """The texts to search: key and x, once each."""
    return known.where("key = low").select("key", "x", *more).distinct()


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = GRAM, kinds: int = KINDS) -> DataFrame:
    """One row for each row of df: <key>, x (hash of its text), n_bytes, sha256 (of the whole text),
    spans (array of start, end: the maximal removed runs), kept (the bytes that remain, null if nothing
    was removed) and kept_text (kept with the characters that a cut would split left whole)."""
    spark = df.sparkSession
    lean(spark)
    docs = df.select(F.col(key).cast("long").alias("key"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("x"), F.col(text).alias("text"))
    prints = stored(fingerprints(docs, length, k))
    about = prints.agg(F.count("*").alias("n"), F.sum("n_bytes").alias("size")).first()
    known = stored(firsts(prints.drop("anchors"), "n_bytes", length, about.n), about.n)
    postings = prints.where("key is not null").select(F.explode("anchors").alias("anchor"), "key", "x")
    # Met in different texts; copies of one text have one hash.
    shared = stored(postings.groupBy("anchor").agg(F.min("x").alias("a"), F.max("x").alias("b")).where("a < b").select("anchor"))
    met = postings.join(shared.hint("merge"), "anchor").groupBy("key", "x").agg(F.collect_list("anchor").alias("shared"))
    wanted = heads_of(known, "repeats").join(met.hint("merge"), ["key", "x"], "left").where("repeats or shared is not null").drop("repeats")
    texts = bucketed(docs.join(wanted.hint("merge"), ["key", "x"]).select("key", "x", "text", "shared"), ["key", "x"], buckets(spark, about.size or 0))

    def cut(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from libretto.llm import grams

        names = ["mini", "c", "key", "x", "start", "n", "again"]
        for batch in batches(unrepeated(frame, ["key", "x"]), "text"):
            out = []
            for text, shared, key, x in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("shared"), batch.column("key").to_pylist(), batch.column("x").to_pylist(), strict=True):
                mini, start, n = pieces_of(text, shared.values.to_numpy() if shared.is_valid else [], length, k)
                if not len(mini):
                    continue
                b = np.frombuffer(text, dtype=np.uint8)
                c = grams.ranges(grams.sums(grams.BYTES[1][b], grams.BASES[1]), start, start + n + length - 1, grams.BASES[1]).view(np.int64)
                order = np.lexsort((start, c, mini))
                same = np.zeros(len(mini), dtype=bool)
                same[order[1:]] = (c[order[1:]] == c[order[:-1]]) & (mini[order[1:]] == mini[order[:-1]])
                out.append((mini, c, np.full(len(mini), key), np.full(len(mini), x), start.astype(np.int32), n.astype(np.int32), same))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=names)

    # A piece is known by its minimiser and by a hash of all of its bytes; repeated pieces are aggregated before they are shuffled.
    pieces = stored(texts.mapInArrow(cut, "mini long, c long, key long, x long, start int, n int, again boolean"))
    n = pieces.count()
    low = stored(pieces.where("not again").groupBy("mini", "c").agg(F.min("key").alias("low")), n)
    several = stored(low.groupBy("mini").agg(F.count("*").alias("kinds")).where("kinds > 1"), n)
    low = low.join(several.hint("merge"), "mini", "left")
    gone = F.col("again") | (F.col("key") > F.col("low"))
    open_ = ~gone & F.col("kinds").isNotNull()
    placed = stored(pieces.join(low.hint("merge"), ["mini", "c"]).where(gone | open_).select("key", "x", "start", "n", F.when(~gone, F.col("mini")).alias("mini"), F.when(~gone, F.col("kinds")).alias("kinds")), n)
    total = placed.where("kinds is not null").agg(F.sum(F.col("n") + length)).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    chunks = F.ceil(F.col("kinds") / F.lit(kinds)).cast("int")
    shard = F.when(chunks > 1, F.xxhash64("mini")).otherwise(F.pmod(F.xxhash64("mini"), F.lit(shards)))
    lists = placed.where("kinds is not null").groupBy("key", "x").agg(F.collect_list(F.struct("start", "n", shard.alias("shard"), chunks.alias("chunks"))).alias("pieces"))

    def fetch(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds_ = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        names = ["shard", "chunks", "key", "x", "start", "n", "piece"]
        for batch in batches(unrepeated(frame, ["key", "x"]), "text", 1 << 20):
            out = []
            for text, ps, key, x in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("pieces").to_pylist(), batch.column("key").to_pylist(), batch.column("x").to_pylist(), strict=True):
                out += [(p["shard"], p["chunks"], key, x, p["start"], p["n"], text[p["start"] : p["start"] + p["n"] + length - 1]) for p in ps]
            for at in range(0, len(out), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out[at : at + 20_000], strict=True), kinds_, strict=True)], names=names)

    cut_out = texts.drop("shared").join(lists.hint("merge"), ["key", "x"]).mapInArrow(fetch, "shard long, chunks int, key long, x long, start int, n int, piece binary")
    own = F.pmod(F.xxhash64("key", "x", "start"), F.col("chunks")).cast("int")
    rows = cut_out.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).drop("other")
    dealt = rows.repartition(max(-(-total // TASK_BYTES), partitions(spark)), "shard", "chunks", "a", "b").sortWithinPartitions("shard", "chunks", "a", "b")

    def search(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(frame, ["shard", "chunks", "a", "b"]):
            found = later(t, length, t["a"][0].as_py(), t["b"][0].as_py())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(found, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["key", "x", "start", "n"])

    found = dealt.mapInArrow(search, "key long, x long, start int, n int")
    spans = placed.where("kinds is null").select("key", "x", "start", "n").unionByName(found)
    spans = spans.groupBy("key", "x").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    changed = keep_rest(texts.drop("shared").join(spans.hint("merge"), ["key", "x"]), length)
    return whole(known.drop("repeats"), changed, "n_bytes", key)


def whole(known: DataFrame, changed: DataFrame, size: str, key: str) -> DataFrame:
    """Every row's result: as changed says, nothing left of later copies, all of the others."""
    out = known.join(changed.hint("merge"), ["key", "x"], "left")
    copy = F.coalesce(F.col("key") > F.col("low"), F.lit(False))
    every = F.array(F.struct(F.lit(0).alias("start"), F.col(size).cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.when(copy, every).otherwise(F.coalesce("spans", none))
    kept = F.when(copy, F.lit(b"")).otherwise(F.col("kept")).alias("kept")
    more = [F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text")] if "kept_text" in out.columns else []
    return out.select(F.col("key").alias(key), "x", size, "sha256", spans.alias("spans"), kept, *more)


def later(t: pa.Table, length: int, a: int, b: int):
    """Runs of strings (key, x, start, windows) that start earlier in another row of the unit, or of the other chunk."""
    import numpy as np

    key, x, start, n, own = (t[c].to_numpy() for c in ("key", "x", "start", "n", "own"))
    side = [np.flatnonzero(own == c) for c in ((a,) if a == b else (a, b))]
    sorted_ = [classes(t["piece"].take(pa.array(ix)), n[ix], length) for ix in side]
    if a == b:
        row, place, group, _ = sorted_[0]
        row = side[0][row]
    else:  # merge the second chunk's strings into the first's by binary search
        (row1, at1, g1, s1), (row2, at2, g2, s2) = sorted_
        slot = np.minimum(np.searchsorted(s1, s2), max(0, len(s1) - 1))
        fits = s1[slot] == s2 if len(s1) else np.zeros(len(s2), dtype=bool)
        to = np.where(fits, slot, len(s1) + np.arange(len(s2)))
        row, place, group = np.concatenate([side[0][row1], side[1][row2]]), np.concatenate([at1, at2]), np.concatenate([g1, to[g2]])
    at = start[row] + place
    order = np.lexsort((at, x[row], key[row], group))
    row, place, group, at = row[order], place[order], group[order], at[order]
    k, h = key[row], x[row]
    if not len(row):
        return (np.empty(0, dtype=np.int64),) * 4
    fresh = np.concatenate([[True], group[1:] != group[:-1]])
    here = fresh | np.concatenate([[True], (k[1:] != k[:-1]) | (h[1:] != h[:-1])])
    at_first = lambda new: np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    low, second = k[at_first(fresh)], at > at[at_first(here)]  # a repeated row has the same places again
    gone = np.flatnonzero((k > low) | second)
    order = gone[np.lexsort((place[gone], row[gone]))]
    row, place = row[order], place[order]
    if not len(row):
        return (np.empty(0, dtype=np.int64),) * 4
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)]))
    return key[row[new]], x[row[new]], start[row[new]] + place[new], np.diff(np.append(new, len(row)))


def classes(pieces, n, length: int):
    """Strings of `length` in the pieces, sorted: (piece, offset, class of equal strings, each class's string)."""
    import numpy as np

    parts = pieces.to_pylist()
    text = np.frombuffer(b"".join(parts), dtype=np.uint8)
    size = np.array([len(p) for p in parts], dtype=np.int64)
    first = np.cumsum(size) - size
    order, rank = suffix_array(text)
    prefix = common_prefixes(text, order, rank, length)
    group = np.cumsum(prefix < length) - 1
    owner = np.repeat(np.arange(len(parts)), size)
    row = owner[order] if len(order) else owner
    place = order - first[row] if len(order) else order
    ok = place < n[row]  # a whole string starts here
    row, place, group = row[ok], place[ok], group[ok]
    names, group = np.unique(group, return_inverse=True)
    head = np.searchsorted(group, np.arange(len(names)))
    begin = first[row[head]] + place[head]
    strings = text[begin[:, None] + np.arange(length)].reshape(-1).view(f"S{length}") if len(begin) else np.empty(0, dtype=f"S{length}")
    return row, place, group, strings


def keep_rest(df: DataFrame, length: int) -> DataFrame:
    """Rows key, x, spans, kept, kept_text from text and runs (start, n: strings that go)."""

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches(unrepeated(frame, ["key", "x"]), "text"):
            spans, kept, texts = [], [], []
            for text, runs in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("runs"), strict=True):
                start, n = (runs.values.field(i).to_numpy() for i in (0, 1))
                merged = union(start, start + n + length - 1)
                spans.append([{"start": a, "end": b} for a, b in merged])
                ends = [0, *(b for _, b in merged)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in merged), len(text)], strict=True)))
                inner = [(s, e) for a, b in merged if (s := boundary(text, a, 1)) < (e := boundary(text, b, -1))]
                ends = [0, *(b for _, b in inner)]
                texts.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in inner), len(text)], strict=True)).decode("utf-8", "replace"))
            columns = [batch.column("key"), batch.column("x"), pa.array(spans, kind), pa.array(kept, pa.binary()), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "x", "spans", "kept", "kept_text"])

    return df.mapInArrow(run, "key long, x long, spans array<struct<start:int,end:int>>, kept binary, kept_text string")


def boundary(text: bytes, at: int, step: int) -> int:
    """The nearest start of a character at or after (step 1) or at or before (step -1) a byte."""
    while 0 < at < len(text) and text[at] & 0xC0 == 0x80:
        at += step
    return at


def union(start, end) -> list[tuple[int, int]]:
    """Maximal runs covered by the spans; touching spans are one."""
    import numpy as np

    order = np.argsort(start, kind="stable")
    start, end = start[order].astype(np.int64), np.maximum.accumulate(end[order].astype(np.int64))
    new = np.concatenate([[True], start[1:] > end[:-1]])
    first = np.flatnonzero(new)
    return list(zip(start[first].tolist(), end[np.append(first[1:] - 1, len(end) - 1)].tolist(), strict=True))

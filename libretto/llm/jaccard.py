"""N-gram Jaccard join by MinHash banding.

A document's set is that of its runs of SHINGLE words (bytes other than ASCII white space,
unchanged); a text of fewer words has one shingle, all of its words. Two documents link if the
Jaccard similarity of their sets is SIMILARITY or more.

1. Documents with equal sets are one class, whose first document stands for it.
2. The number of bands is chosen so that a pair at the threshold meets in a band with probability
   RECALL, from ROWS hashes a band. Documents are shuffled on their bands' hashes; those that meet
   in a bucket are joined to the bucket's smallest document, and the connected components of these
   star edges are groups outside of which no pair meets in any band.
3. Within a group all pairs are verified on the full sets, which units make again from the whole
   texts, shipped once. A large group is cut into chunks of about CHUNK shingles that meet pairwise,
   so that a unit of work is bounded. Units give
   the number of links of each document (a class counts with all its members) and a spanning
   forest, never the pairs; a group in one unit has its components there, the others' forests are
   joined by connected components.

A null or wordless text links with nothing and is a component of its own; repeated rows are
documents of their own and link with each other; a row without an id takes no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from libretto.llm.common import batches, block_units, components, forest, grouped, lean, stored

SHINGLE, SIMILARITY, ROWS, RECALL, CHUNK = 5, 0.8, 5, 0.9999, 100_000


def bands_for(similarity: float, rows: int, recall: float) -> int:
    """The least number of bands of `rows` hashes in which a pair of that similarity meets with probability recall."""
    meets = similarity**rows
    return 1 if meets >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - meets))


def shingles(text: bytes, size: int):
    """The distinct hashes of a text's word n-grams, sorted."""
    import numpy as np

    from libretto.llm import grams

    starts, ends = grams.words(text)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    symbols = grams.word_hashes(text, starts, ends)
    return np.unique(grams.windows(symbols, min(size, len(symbols)), 1))


def named(own) -> tuple[int, int]:
    """Two hashes of a set of shingles."""
    import numpy as np

    from libretto.llm import grams

    return tuple(int(np.sum(grams.mix(own + np.uint64(i))).view(np.int64)) for i in (0, 99))


def signed(df: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """Rows key, x (both as they come), s1, s2 (hashes of the set; null if empty), n (its shingles), bands (hash of each band)."""

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        from libretto.llm import grams

        count = bands * rows
        seeds = grams.mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        odd, even = grams.mix(seeds) | np.uint64(1), seeds | np.uint64(1)
        place = grams.mix(np.arange(bands, dtype=np.uint64) + np.uint64(77))
        for batch in batches(frame, "text"):
            sizes, hashes, ids = [], [], []
            for value in batch.column("text").cast(pa.binary()).to_pylist():
                own = shingles(value or b"", size)
                sizes.append(len(own))
                if not len(own):
                    hashes.append(np.empty(0, dtype=np.int64))
                    ids.append((None, None))
                    continue
                low = np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64)
                for at in range(0, len(own), 512):
                    h = own[at : at + 512, None] * odd[None, :]
                    h ^= h >> np.uint64(32)
                    h *= even[None, :]
                    np.minimum(low, h.min(0), out=low)
                band = place.copy()
                for r in range(rows):
                    band = grams.mix(band * np.uint64(0x9E3779B97F4A7C15) + low[r::rows])
                hashes.append(band.view(np.int64))
                ids.append(named(own))
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, hashes)]).astype(np.int32)), pa.array(np.concatenate(hashes)))
            s = [pa.array(v, pa.int64()) for v in zip(*ids, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("x"), *s, pa.array(sizes, pa.int32()), lists], names=["key", "x", "s1", "s2", "n", "bands"])

    return df.mapInArrow(run, "key long, x long, s1 long, s2 long, n int, bands array<long>")


def linked(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL, chunk: int = CHUNK) -> DataFrame:
    """One row for each row of df: <key>, n_links (other documents linked directly), class_id (the smallest id
    reachable by links), x (hash of its text, which tells rows of one id apart)."""
    lean(df.sparkSession)
    docs = df.select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("x"), F.col(text).alias("text"))
    sets = stored(signed(docs, size, bands_for(similarity, rows, recall), rows))
    fine = sets.where("s1 is not null and key is not null")
    n = sets.count()
    # A class is known by its set's hash, as two classes may share an id where rows do.
    classes = stored(fine.groupBy("s1", "s2").agg(F.min("key").alias("rep"), F.count("*").alias("members"), F.min("n").alias("n")), n)
    heads = fine.select("key", "s1", "s2", "bands").join(classes.select("s1", "s2", "rep"), ["s1", "s2"]).where("key = rep").select("s1", F.explode("bands").alias("band"))
    buckets = stored(heads.groupBy("band").agg(F.min("s1").alias("low"), F.max("s1").alias("high")).where("low < high").select("band", "low"))
    edges = heads.join(buckets, "band").select(F.col("s1").alias("u"), F.col("low").alias("v"))
    group = components(edges)
    met = stored(classes.join(group, classes["s1"] == group["node"]).select("s1", "s2", "rep", "members", "n", F.col("component").alias("part")), n)
    volume = met.groupBy("part").agg(F.ceil(F.sum("n") / F.lit(chunk)).cast("int").alias("chunks"))
    wanted = met.join(volume, "part").drop("n")
    dealt = block_units(docs.drop("x").join(wanted.hint("merge"), F.col("key") == F.col("rep")).drop("key"), "part", "chunks", ["s1", "s2"])

    def verify(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for t in grouped(frame, ["part", "_a", "_b"]):
            a, b, chunks = (t[c][0].as_py() for c in ("_a", "_b", "chunks"))
            ids = list(zip(t["s1"].to_pylist(), t["s2"].to_pylist(), strict=True))
            own_sets, at, seen = [], [], set()
            for i, value in enumerate(t["text"].cast(pa.binary()).to_pylist()):
                if ids[i] not in seen and named(s := shingles(value, size)) == ids[i]:  # not another text of this id, nor a repeated row
                    seen.add(ids[i])
                    own_sets.append(s)
                    at.append(i)
            t = t.take(pa.array(at))
            own, members, rep = (t[c].to_numpy() for c in ("_own", "members", "rep"))
            ends = np.cumsum([0, *map(len, own_sets)])
            i, j = similar(np.concatenate(own_sets), ends, np.flatnonzero(own == a), np.flatnonzero(own == b), similarity)
            count = np.bincount(i, members[j], len(own)) + np.bincount(j, members[i], len(own))
            order = np.argsort(rep, kind="stable")
            rank = np.empty_like(order)
            rank[order] = np.arange(len(order))
            low = rep[order[np.asarray(forest(len(own), rank[i], rank[j]), dtype=np.int64)[rank]]]
            columns = [t["s1"].combine_chunks(), t["s2"].combine_chunks(), pa.array(rep), pa.array(low), pa.array(count.astype(np.int64)), pa.array(np.full(len(own), chunks > 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["s1", "s2", "rep", "low", "links", "cut"])

    found = stored(dealt.mapInArrow(verify, "s1 long, s2 long, rep long, low long, links long, cut boolean"))
    joined = components(found.where("cut").select(F.col("rep").alias("u"), F.col("low").alias("v")))
    about = found.groupBy("s1", "s2").agg(F.sum("links").alias("links"), F.min("low").alias("low"))
    known = classes.join(about, ["s1", "s2"], "left").join(joined, F.col("rep") == F.col("node"), "left")
    known = stored(known.select("s1", "s2", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("_n"), F.coalesce("component", "low", "rep").alias("_c")), n)
    out = sets.select("key", "x", "s1", "s2").join(known, ["s1", "s2"], "left")
    none = F.col("key").isNull()
    return out.select(F.col("key").alias(key), F.when(none, 0).otherwise(F.coalesce("_n", F.lit(0))).cast("long").alias("n_links"), F.when(~none, F.coalesce("_c", "key")).alias("class_id"), "x")


def similar(flat, ends, a, b, similarity: float):
    """Pairs (i of a, j of b, as row numbers; i < j where a is b) of sets with that Jaccard similarity."""
    import numpy as np

    same = len(a) == len(b) and bool((a == b).all())
    size = np.diff(ends)
    if same and len(a) <= 8:  # most groups are a pair or a few
        out = []
        for x in range(len(a)):
            for y in range(x + 1, len(a)):
                i, j = a[x], a[y]
                if min(size[i], size[j]) < similarity * max(size[i], size[j]) - 1e-9:
                    continue
                both = len(np.intersect1d(flat[ends[i] : ends[i + 1]], flat[ends[j] : ends[j + 1]], assume_unique=True))
                if both / (size[i] + size[j] - both) >= similarity:
                    out.append((i, j))
        pairs = np.array(out, dtype=np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]
    # A matrix of sets by shingles, as slices of columns; shingles of a single set can't be shared.
    value, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(size)), size)
    ok = count[column] > 1
    row, column = row[ok], (np.cumsum(count > 1) - 1)[column[ok]]
    where_a, where_b = np.full(len(size), -1), np.full(len(size), -1)
    where_a[a], where_b[b] = np.arange(len(a)), np.arange(len(b))
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out_i, out_j = [], []
    wide, tall = 4096, 1024
    total = int(column[-1]) + 1 if len(column) else 0
    cuts = np.searchsorted(column, np.arange(0, total + wide, wide))
    for top in range(0, len(a), tall):
        both = np.zeros((min(tall, len(a) - top), len(b)), dtype=np.float32)
        for s, (x, y) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            r, c = row[x:y], column[x:y] - s * wide
            m1, m2 = np.zeros((len(both), wide), dtype=np.float32), np.zeros((len(b), wide), dtype=np.float32)
            p = where_a[r] - top
            in_a = (where_a[r] >= 0) & (p >= 0) & (p < len(both))
            m1[p[in_a], c[in_a]] = 1
            in_b = where_b[r] >= 0
            m2[where_b[r][in_b], c[in_b]] = 1
            both += m1 @ m2.T
        either = size[a[top : top + tall]][:, None] + size[b][None, :] - both.astype(np.float64)
        p, q = np.nonzero(both / either >= similarity)
        i, j = a[top + p], b[q]
        ok = i < j if same else np.ones(len(i), dtype=bool)
        out_i.append(i[ok])
        out_j.append(j[ok])
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (none, none)

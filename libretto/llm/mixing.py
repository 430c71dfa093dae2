"""Mixing overlapping sources to target weights by min-cost flow.

A document belongs to one or more sources; documents are aggregated by membership pattern, so the
flow network has a node per pattern and per source and does not grow with the documents. Source
targets share the total size by weight; a target stops at `most` times what its source holds and
the excess is shared again by weight among the others until none is above. A pattern sends at
most its size through each of `most` layers; layer r (the r-th repetition) costs r - 1 a word, a
convex cost, so that nothing is repeated before everything useful was taken once. The flow is
exact (successive shortest paths on integers).

A pattern's flow of q full passes and a rest selects documents: all of them q times, and once
more those first in a seeded order whose running size stays within the rest; the document on the
boundary gives just the words still missing (or, with whole=True, is taken where that is nearer
to the rest). Running sizes are two-level: sums of hash ranges, then rows within a range, so that
no source, however large, is sorted in one task.

A null or wordless text has size 0 and takes nothing; a null source is a source of its own, last;
repeated rows count each for themselves; no document exceeds `most` times its size; an empty table
gives an empty result; reruns agree.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from libretto.llm.common import WORD, stored

WEIGHTS, MOST, RANGE_ROWS, SEED = (1, 2, 3), 3, 1024, "mix-1"
#: Patterns of at most this number are broadcast to the rows; more are joined by a shuffle.
BROADCAST_PATTERNS = 10_000
#: More patterns than this are refused, as the driver holds them all while it solves the flow.
MOST_PATTERNS = 100_000


def targets(sizes: Sequence[int], weights: Sequence[int], total: int, most: int = MOST) -> list[Fraction]:
    """Shares of total by weight, none above most times its size; exact."""
    rest, open_, out = Fraction(total), set(range(len(sizes))), [Fraction(0)] * len(sizes)
    while open_:
        level = rest / sum(weights[i] for i in open_)
        full = {i for i in open_ if level * weights[i] > most * sizes[i]}
        if not full:
            for i in open_:
                out[i] = level * weights[i]
            break
        for i in full:
            out[i] = Fraction(most * sizes[i])
            rest -= out[i]
        open_ -= full
    return out


def flow(patterns: Sequence[tuple[Sequence[int], int]], quotas: Sequence[int], most: int = MOST) -> list[dict[int, int]]:
    """For each pattern (its sources, its size): words sent to each source, at least total cost.

    Residual costs are found by label correcting; a pattern's next word costs its number of full
    passes so far, and one word less gives back the last one's cost.
    """
    sent: list[dict[int, int]] = [dict.fromkeys(s, 0) for s, _ in patterns]
    used, got = [0] * len(patterns), [0] * len(quotas)
    members: list[list[int]] = [[] for _ in quotas]
    for p, (sources, _) in enumerate(patterns):
        for s in sources:
            members[s].append(p)
    while True:
        # Shortest ways from fresh capacity of any pattern to every source, through re-routing.
        cost: dict[tuple[str, int], int] = {}
        came: dict[tuple[str, int], tuple[str, int] | None] = {}
        todo: deque = deque()
        for p, (sources, size) in enumerate(patterns):
            if sources and size and used[p] < most * size:
                cost["p", p], came["p", p] = used[p] // size, None
                todo.append(("p", p))
        while todo:
            kind, i = node = todo.popleft()
            ways = [("s", s) for s in patterns[i][0]] if kind == "p" else [("p", p) for p in members[i] if sent[p][i] > 0]
            for way in ways:
                if cost[node] < cost.get(way, 1 << 60):
                    cost[way], came[way] = cost[node], node
                    todo.append(way)
        ends = [s for s in range(len(quotas)) if got[s] < quotas[s] and ("s", s) in cost]
        if not ends:
            return sent
        end = min(ends, key=lambda s: (cost["s", s], s))
        path = [("s", end)]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        first = path[0][1]
        size = patterns[first][1]
        room = min(quotas[end] - got[end], size - used[first] % size)
        for (k, i), (_, j) in zip(path, path[1:], strict=False):
            if k == "s":
                room = min(room, sent[j][i])
        for (k, i), (_, j) in zip(path, path[1:], strict=False):
            if k == "p":
                sent[i][j] += room
            else:
                sent[j][i] -= room
        used[first] += room
        got[end] += room


def mixed(df: DataFrame, sources: Column, size: Column, weights: Sequence[int] = WEIGHTS, most: int = MOST, key: str = "doc_id", seed: str = SEED, whole: bool = False) -> DataFrame:
    """Rows of df's <key>, _text_hash (of column text), sources, size and taken, with the sources' figures.

    df must have a column text, whose hash tells rows of one key apart. sources: array of source names of a row (its membership pattern); size: its words.
    Adds source_size and target (those of the first source of the pattern).
    """
    rows = df.select(F.col(key), F.xxhash64("text").alias("_text_hash"), F.array_sort(F.array_distinct(sources)).alias("pattern"), size.cast("long").alias("size"))
    rows = stored(rows.withColumn("_order", F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":" + seed)))))
    held = rows.groupBy("pattern").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MOST_PATTERNS + 1).collect()  # patterns, not documents
    if len(held) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns: the flow is solved on the driver")
    held.sort(key=lambda r: [(s is None, s or "") for s in r.pattern])
    names = sorted({s for r in held for s in r.pattern}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(names)}
    sizes = [sum(r.size for r in held if s in r.pattern) for s in names]
    share = [weights[i % len(weights)] for i in range(len(names))]
    goal = targets(sizes, share, sum(r.size for r in held), most)
    sent = flow([([at[s] for s in r.pattern], r.size) for r in held], [round(g) for g in goal], most)
    plan = [(i, list(r.pattern), *divmod(sum(x.values()), r.size or 1), sizes[at[r.pattern[0]]] if len(r.pattern) else 0, float(goal[at[r.pattern[0]]]) if len(r.pattern) else 0.0) for i, (r, x) in enumerate(zip(held, sent, strict=True))]
    spark = df.sparkSession
    plans = spark.createDataFrame(plan, "_p int, pattern array<string>, _full long, _rest long, source_size long, target double")
    if len(plan) <= BROADCAST_PATTERNS:
        plans = F.broadcast(plans)
    ranges = max(1, -(-sum(r.n for r in held) // RANGE_ROWS))
    digits = len(f"{ranges - 1:x}")
    named = rows.withColumn("_k", F.to_json("pattern", {"ignoreNullFields": "false"}))
    looked = named.join(plans.select(F.to_json("pattern", {"ignoreNullFields": "false"}).alias("_k"), "_p", "_full", "_rest", "source_size", "target"), "_k").withColumn("_range", F.substring("_order", 1, digits))
    sums = looked.groupBy("_p", "_range").agg(F.sum("size").alias("_sum"))
    before = sums.select("_p", "_range", (F.sum("_sum").over(Window.partitionBy("_p").orderBy("_range")) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy("_p", "_range").orderBy("_order", F.col(key), "_text_hash").rowsBetween(Window.unboundedPreceding, -1)
    ran = looked.join(before, ["_p", "_range"]).withColumn("_at", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    left = F.col("_rest") - F.col("_at")
    if whole:
        last = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(0)
    else:
        last = F.greatest(F.lit(0), F.least("size", left))
    return ran.withColumn("taken", F.col("_full") * F.col("size") + last).select(key, "_text_hash", F.col("pattern").alias("sources"), "size", "source_size", "target", "taken")


def words_of(text: Column) -> Column:
    """Number of words; each ASCII white-space byte ends one."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")

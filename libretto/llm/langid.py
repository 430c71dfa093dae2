"""Language identification with a linear-chain conditional random field.

A text's words (runs of letters, lower-cased) are labelled one by one with languages; transitions
are learned, so that code-switched text is labelled where it switches. A word's features are its
prefixes and suffixes of up to 4 bytes (affixes), its inner 2- and 3-grams, and itself (lexicon);
they are hashed into one table of weights per language. Each line is a sequence. Forward-backward
gives every word's marginal probabilities; a text's language is the one with the largest mean
marginal over its words, which is the score (ties: the smaller label).

Training takes a bounded sample of labelled rows, at most PER_LANGUAGE of each language, chosen by
hash, and of each text at most WORDS_EACH words in runs of RUN at hashed places of the whole text
(BYTES_EACH bytes; what is left of a longer word's room is a hashed piece of it); half of the training sequences splice two texts of
different languages, so that switches are seen. Predictions read whole texts and nothing but text.

A text that is null or has no letters is `und` with score 0, as is every text when nothing could be
learned; a single learned language gets all other texts, with score 1. Repeated rows are predicted
alike; other columns are kept.

Every label that occurs is learned. What grows with their number is bounded otherwise: the weights
by fewer hash bits (CELLS), the words held and scored at a time by smaller tables and blocks; rounds
of training grow with the labels beyond ROUNDS_FOR, and texts taken of each label shrink where there are
more than ALL_TEXTS / PER_LANGUAGE labels. A line is one sequence and is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from libretto.llm.common import batches, lean

PER_LANGUAGE, WORDS_EACH, ALL_TEXTS = 400, 240, 102_400
BITS, ROUNDS, LENGTH, STEP, KNOWN = 17, 240, 40, 64, 200_000
#: Words of a run, and bytes, that training takes of a text.
RUN, BYTES_EACH = 40, 48 * WORDS_EACH
#: Weights; labels up to which ROUNDS suffice; scores (words x labels) of the table of words and of a block.
CELLS, ROUNDS_FOR, TABLE_CELLS, BLOCK_CELLS = 1 << 24, 64, 1 << 23, 1 << 21
UND = "und"

#: Bytes that part words: ASCII but letters; line breaks part sequences.
_PART = bytes(c if c >= 128 or chr(c).isalpha() or c in (10, 13) else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")


class Features:
    """Hashed features of distinct words, all words of a block at once."""

    def __init__(self, bits: int = BITS):
        self.mask = (1 << bits) - 1

    def of(self, words: list[bytes]):
        """(feature ids, start of each word's features)."""
        import numpy as np

        flat = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words), dtype=np.uint8).astype(np.uint64)
        size = np.array([len(w) + 2 for w in words], dtype=np.int64)
        end = np.cumsum(size)
        start = end - size
        word = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(flat)) - start[word]
        left = size[word] - place  # bytes from here to the word's end
        m = np.uint64(0x9E3779B97F4A7C15)

        def mixed(h):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            return ((h ^ (h >> np.uint64(32))) & np.uint64(self.mask)).astype(np.int64)

        ids, owner = [], []
        h = flat + np.uint64(1)
        for n in range(2, 6):  # with the marks for start and end: affixes of up to 4 bytes, inner 2- and 3-grams
            h = h[:-1] * m + flat[n - 1 :] + np.uint64(n) if len(h) > 1 else h[:0]
            ok = left[: len(h)] >= n
            if n > 3:
                ok &= (place[: len(h)] == 0) | (left[: len(h)] == n)
            ids.append(mixed(h[ok]))
            owner.append(word[: len(h)][ok])
        lexicon = np.array([hash_word(w) for w in words], dtype=np.uint64)
        ids.append(mixed(lexicon))
        owner.append(np.arange(len(words)))
        ids, owner = np.concatenate(ids), np.concatenate(owner)
        order = np.argsort(owner, kind="stable")
        return ids[order], np.searchsorted(owner[order], np.arange(len(words)))


def hash_word(w: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(w, 7)


def cut(text: str) -> list[list[bytes]]:
    """Sequences (lines) of words."""
    lines = text.lower().encode("utf-8", "surrogatepass").translate(_PART).replace(b"\r", b"\n").split(b"\n")
    return [ws for line in lines if (ws := line.split())]


def excerpt(text: str) -> bytes:
    """The words of text that training takes, parted by spaces, in the text's order."""
    import xxhash

    words = [w for line in cut(text) for w in line]
    left, room = WORDS_EACH, BYTES_EACH
    if len(words) <= left and sum(map(len, words)) <= room:
        return b" ".join(words)
    seed = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    taken = []
    for h, i in sorted((xxhash.xxh3_64_intdigest(i.to_bytes(8, "little"), seed), i) for i in range(0, len(words), RUN)):
        run = words[i : i + min(RUN, left)]
        for k, w in enumerate(run):
            if len(w) > room:  # the last piece
                at = h % (len(w) - room + 1)
                run = [*run[:k], *w[at : at + room].decode("utf-8", "ignore").encode().split()]
                room = 0
                break
            room -= len(w)
        taken.append((i, run))
        left -= len(run)
        if left <= 0 or room <= 0:
            break
    return b" ".join(w for _, run in sorted(taken) for w in run)


def marginals(scores, lengths, transition, start):
    """Forward-backward over many sequences at once.

    scores: (words, labels), the sequences one after another; lengths: words of each. Returns the
    words' marginals (words, labels), the log-likelihood's normaliser and the expected transitions.
    """
    import numpy as np

    labels = scores.shape[1]
    n = len(lengths)
    order = np.argsort(-lengths, kind="stable")
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    size = lengths[order]
    most = int(size[0])
    alive = np.searchsorted(-size, -np.arange(most), side="left")  # sequences longer than t
    top = scores.max(1, keepdims=True)
    emit = np.exp(scores - top)
    move = np.exp(transition - transition.max())
    alpha = np.empty_like(emit)
    scale = np.empty(len(emit))
    before = None
    for t in range(most):
        at = first[: alive[t]] + t
        a = emit[at] * (np.exp(start - start.max()) if t == 0 else before[: alive[t]] @ move)
        s = a.sum(1)
        before = a / s[:, None]
        alpha[at], scale[at] = before, s
    logz = float(np.log(scale).sum() + top.sum() + start.max() * n + transition.max() * (size.sum() - n))
    beta = np.ones((n, labels))
    out = np.empty_like(emit)
    pairs = np.zeros((labels, labels))
    for t in range(most - 1, -1, -1):
        k = alive[t]
        at = first[:k] + t
        b = beta[:k]
        out[at] = alpha[at] * b
        if t:
            e = emit[at] * b / scale[at][:, None]
            pairs += (alpha[at - 1].T @ e) * move
            beta[:k] = e @ move.T
    return out, logz, pairs


def bits_for(labels: int) -> int:
    """As many hash bits, BITS at most, as leave the weights of all labels within CELLS."""
    return max(1, min(BITS, (CELLS // max(1, labels)).bit_length() - 1))


class Model:
    """Weights (features, labels), transitions (labels, labels) and start scores."""

    def __init__(self, labels: list[str], bits: int | None = None):
        import numpy as np

        bits = bits_for(len(labels)) if bits is None else bits
        self.labels, self.features = labels, Features(bits)
        self.weight = np.zeros((1 << bits, len(labels)), dtype=np.float32)
        self.move = np.zeros((len(labels), len(labels)))
        self.start = np.zeros(len(labels))

    def emissions(self, words: list[bytes]):
        import numpy as np

        out = np.empty((len(words), len(self.labels)))
        step = max(1, BLOCK_CELLS // (16 * len(self.labels)))  # about 16 features a word
        for i in range(0, len(words), step):
            ids, starts = self.features.of(words[i : i + step])
            out[i : i + step] = np.add.reduceat(self.weight[ids], starts, axis=0)
        return out

    def fit(self, texts: list[tuple[str, int]], rounds: int | None = None, each: int = STEP, length: int = LENGTH, seed: int = 11) -> Model:
        """Adagrad on the likelihood of sequences cut from texts [(text, label)], half of them spliced."""
        import numpy as np

        rng = np.random.default_rng(seed)
        rounds = ROUNDS * max(ROUNDS_FOR, len(self.labels)) // ROUNDS_FOR if rounds is None else rounds
        by = [[] for _ in self.labels]
        for text, label in texts:
            if words := excerpt(text):
                by[label].append(words)
        full = [i for i, x in enumerate(by) if x]
        if len(full) < 2:
            return self
        grad2, move2, start2 = np.full_like(self.weight, 1e-3), np.full_like(self.move, 1e-2), np.full_like(self.start, 1e-2)
        for _ in range(rounds):
            words, gold, lengths = [], [], []
            for s in range(each):
                chosen = rng.choice(full, size=1 + (s % 2), replace=False)
                got = 0
                for label in chosen:
                    own = by[label][rng.integers(len(by[label]))].split(b" ")
                    n = int(rng.integers(2, 1 + max(2, length // len(chosen))))
                    at = int(rng.integers(0, max(1, len(own) - n + 1)))
                    piece = own[at : at + n]
                    words += piece
                    gold += [label] * len(piece)
                    got += len(piece)
                lengths.append(got)
            distinct = sorted(set(words))
            where = {w: i for i, w in enumerate(distinct)}
            of = np.array([where[w] for w in words])
            gold, lengths = np.array(gold), np.array(lengths)
            ids, starts = self.features.of(distinct)
            scores = self.emissions(distinct)[of]
            p, _, pairs = marginals(scores, lengths, self.move, self.start)
            diff = -p
            diff[np.arange(len(gold)), gold] += 1
            per = np.zeros((len(distinct), len(self.labels)), dtype=np.float32)
            np.add.at(per, of, diff.astype(np.float32))
            counts = np.diff(np.append(starts, len(ids)))
            used, back = np.unique(ids, return_inverse=True)
            step = max(1, BLOCK_CELLS // len(ids))
            for i in range(0, len(self.labels), step):
                block = slice(i, min(i + step, len(self.labels)))
                g = np.zeros((len(used), block.stop - i), dtype=np.float32)
                np.add.at(g, back, np.repeat(per[:, block], counts, axis=0))
                g = g / each - 1e-4 * self.weight[used, block]
                grad2[used, block] += g * g
                self.weight[used, block] += 0.3 * g / np.sqrt(grad2[used, block])
            first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            inner = np.ones(len(gold), dtype=bool)
            inner[first] = False
            seen = np.zeros_like(self.move)
            np.add.at(seen, (gold[np.flatnonzero(inner) - 1], gold[inner]), 1)
            g = (seen - pairs) / each
            move2 += g * g
            self.move += 0.1 * g / np.sqrt(move2)
            g = (np.bincount(gold[first], minlength=len(self.labels)) - p[first].sum(0)) / each
            start2 += g * g
            self.start += 0.1 * g / np.sqrt(start2)
        return self

    def looked_up(self, words: list[bytes]):
        """Emission scores of words; a bounded table keeps those of the words met so far."""
        import numpy as np

        if not hasattr(self, "known") or len(self.known) > min(KNOWN, TABLE_CELLS // len(self.labels)):
            self.known, self.table = {}, np.empty((0, len(self.labels)))
        known = self.known
        if new := [w for w in set(words) if w not in known]:
            for w in new:
                known[w] = len(known)
            if len(known) > len(self.table):
                more = np.empty((max(len(known), 2 * len(self.table)), len(self.labels)))
                more[: len(known) - len(new)] = self.table[: len(known) - len(new)]
                self.table = more
            self.table[len(known) - len(new) : len(known)] = self.emissions(new)
        return self.table[np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))]

    def label(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, int]]]]:
        """(language, score, [(label, first word, words)]) of each text."""
        import numpy as np

        none = (UND, 0.0, [])
        docs = [cut(x) if x else [] for x in texts]
        for i, x in enumerate(texts):
            if docs[i] and not has_letter(x):
                docs[i] = []
        words = [w for d in docs for line in d for w in line]
        if not words or not self.labels:
            return [none] * len(texts)
        lengths = np.array([len(line) for d in docs for line in d])
        of = np.repeat([i for i, d in enumerate(docs) for _ in d], lengths)  # each word's document
        picked = np.empty(len(words), dtype=np.int64)
        sums = np.zeros((len(docs), len(self.labels)))
        ends, line, start = np.cumsum(lengths), 0, 0
        while line < len(lengths):  # whole lines, of about BLOCK_CELLS scores
            stop = max(line + 1, int(np.searchsorted(ends, start + BLOCK_CELLS // len(self.labels), side="right")))
            end = int(ends[stop - 1])
            p, _, _ = marginals(self.looked_up(words[start:end]), lengths[line:stop], self.move, self.start)
            picked[start:end] = p.argmax(1)
            first = np.flatnonzero(np.append(True, of[start + 1 : end] != of[start : end - 1]))
            sums[of[start:end][first]] += np.add.reduceat(p, first, axis=0)
            line, start = stop, end
        out, at = [], 0
        for i, d in enumerate(docs):
            n = sum(map(len, d))
            if not n:
                out.append(none)
                continue
            mean = sums[i] / n
            best = int(mean.argmax())
            own = picked[at : at + n]
            turns = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            spans = list(zip(own[turns].tolist(), turns.tolist(), np.diff(np.append(turns, n)).tolist(), strict=True))
            out.append((self.labels[best], min(1.0, float(mean[best])), spans))
            at += n
        return out


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def excerpts(df: DataFrame) -> DataFrame:
    """df with what training takes in the place of column text."""
    lean(df.sparkSession)

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(frame, "text"):
            cut_down = pa.array([excerpt(x).decode("utf-8", "ignore") for x in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([cut_down if n == "text" else batch.column(n) for n in batch.schema.names], names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def sample(df: DataFrame, usable: Column, text: str, lang: str, key: str, most: int) -> list[tuple[str, str]]:
    """At most `most` texts of each language, ALL_TEXTS in all, those with the smallest hashes of their ids; texts come as excerpts."""
    names = df.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), key, F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":lang"))).alias("o"), F.col(text).alias("text"))
    # A sum per language and hash range first: the ranges that hold enough rows bound what is ranked.
    sizes = names.groupBy("lang", F.substring("o", 1, 3).alias("r")).agg(F.count("*").alias("n"))
    labels = sizes.agg(F.countDistinct("lang")).first()[0]
    if not labels:
        return []
    most = max(1, min(most, ALL_TEXTS // labels))
    few = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("lang").orderBy("r")) - F.col("n")).where(F.col("before") < most)
    limits = few.groupBy("lang").agg(F.max("r").alias("top"))
    near = excerpts(names.join(F.broadcast(limits), "lang").where(F.substring("o", 1, 3) <= F.col("top")).select("lang", key, "o", "text"))
    ranked = near.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("o", key, "text"))).where(F.col("k") <= most)
    return [(r.text, r.lang) for r in ranked.orderBy("lang", "k").select("text", "lang").collect()]


def trained(df: DataFrame, usable: Column, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = PER_LANGUAGE) -> Model:
    rows = sample(df, usable, text, lang, key, most)
    labels = sorted({x for _, x in rows})
    at = {x: i for i, x in enumerate(labels)}
    return Model(labels).fit([(t, at[x]) for t, x in rows])


def predicted(df: DataFrame, model: Model, text: str = "text", added: tuple[str, str, str] = ("lang_pred", "score", "spans")) -> DataFrame:
    """df with lang_pred, score and spans: array of (lang, first word, words) over the text's words.

    added: the new columns' names; columns of df that have these names are replaced.
    """
    lean(df.sparkSession)
    span = StructType([StructField("lang", StringType()), StructField("first", IntegerType()), StructField("words", IntegerType())])
    keep = [c for c in df.columns if c not in added]
    schema = StructType([f for f in df.schema.fields if f.name in keep]).add(added[0], StringType()).add(added[1], DoubleType()).add(added[2], ArrayType(span))
    shared = df.sparkSession.sparkContext.broadcast(model)  # CELLS weights at most, for all languages together

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("words", pa.int32())]))
        for batch in batches(frame, text, 2 << 20):
            found = m.label(batch.column(text).to_pylist())
            spans = [[{"lang": m.labels[a], "first": b, "words": n} for a, b, n in x[2]] for x in found]
            columns = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array(spans, kind)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *columns], names=[*keep, *added])

    return df.mapInArrow(run, schema)

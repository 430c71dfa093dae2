"""SentencePiece encoding and decoding through a distinct-chunk table.

No piece of the model has a whitespace marker behind another character, so that no merge can cross
the place where a marker follows something else: text is cut there into marked words. Each task
keeps a table of the marked words it has met; a word is segmented by the library once, when it is
first met, and its ids are joined back by position. The table holds at most TABLE words, then
starts anew, so memory does not follow the vocabulary of the input. A byte-fallback run cannot
cross a cut either (a marker stands first in each word), so decoding is joined word by word too.

A null text counts as empty and gives no ids; whole texts are encoded, of any length; repeated
rows are encoded each for itself; other columns are kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from libretto.llm.common import batches, lean

MARK = "▁"
TABLE = 200_000


@lru_cache(maxsize=4)
def processor(model: str):
    """The library's processor; the model must cut at whitespace markers as the module says."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    across = re.compile(f"[^{MARK}]{MARK}")
    if any(across.search(sp.id_to_piece(i)) for i in range(sp.get_piece_size())):
        raise ValueError("this model has pieces that cross whitespace markers")
    return sp


class Chunks:
    """Marked word -> (ids, decoded text with its leading space)."""

    def __init__(self, model: str, most: int = TABLE):
        self.sp, self.most = processor(model), most
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, tuple[int, ...]] = {}
        self.text: dict[str, str] = {}

    def learn(self, words: list[str]) -> None:
        """words: marked words without their first marker; the library's dummy prefix is that marker."""
        if not words:
            return
        if len(self.ids) > self.most:
            self.clear()
        found = self.sp.encode(words, num_threads=1)
        for word, ids in zip(words, found, strict=True):
            if not word:  # a marker alone; the library gives nothing for an empty text
                ids = [self.sp.piece_to_id(MARK)]
            self.ids[word] = tuple(ids)
        for word, text in zip(words, self.sp.decode(found, num_threads=1), strict=True):
            self.text[word] = " " + text

    @staticmethod
    def cut(text: str) -> list[str]:
        """Marked words without their first marker; joined by markers they are the text."""
        if not text:
            return []
        words = text.replace(" ", MARK).split(MARK)
        if "" not in words:
            return words
        out, held = [], None  # held: markers that still need a word
        for word in words:
            if word == "":
                held = "" if held is None else held + MARK
            else:
                out.append(word if held is None else held + MARK + word)
                held = None
        return out if held is None else [*out, held]


def encoded(df: DataFrame, model: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """df with `ids` (array of int, without begin or end ids) and `decoded` (the library's decode of them)."""
    lean(df.sparkSession)
    keep = [c for c in df.columns if c not in (ids, decoded)]
    schema = StructType([f for f in df.schema.fields if f.name in keep]).add(ids, ArrayType(IntegerType())).add(decoded, StringType())

    def run(frame: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        table = Chunks(model)
        for batch in batches(frame, text, 2 << 20):
            docs = [table.cut(x) if x else [] for x in batch.column(text).to_pylist()]
            distinct = set().union(*docs)
            if len(distinct) + len(table.ids) > table.most:
                table.clear()
            table.learn([w for w in distinct if w not in table.ids])
            known, flat, ends, out = table.ids, [], [0], []
            for words in docs:
                for w in words:
                    flat += known[w]
                ends.append(len(flat))
                out.append("".join(map(table.text.__getitem__, words))[1:])
            lists = pa.ListArray.from_arrays(pa.array(np.array(ends, dtype=np.int32)), pa.array(np.array(flat, dtype=np.int32)))
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(out, type=pa.string())], names=[*keep, ids, decoded])

    return df.mapInArrow(run, schema)

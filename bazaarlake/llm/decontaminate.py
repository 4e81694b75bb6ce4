"""Benchmark decontamination with one Aho-Corasick automaton.

Words of the benchmark become single characters, so a window of ten words is a string of ten characters and the
automaton holds one node per word, not per letter. A document is turned into the same alphabet (words that the
benchmark lacks become one character that no window holds) and scanned once. A match ends at a word number, which maps
to the place of the word in the original text.

The automaton is broadcast; its size is bounded by BLOCK_BYTES of benchmark text. A larger benchmark is cut into
blocks of items with one scan each; what a scan has found travels with its row to the next one.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import loaded, pieces, share, stored

WINDOW = 10
BLOCK_BYTES = 1_000_000
SLICE_BYTES = 4_000_000
# Digits and letters stay, A-Z in lower case; other ASCII separates words; bytes from 0x80 belong to words.
_WORDS = bytes(b if chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" or b >= 0x80 else b + 32 if 65 <= b <= 90 else 32
               for b in range(256))
_HITS = "array<struct<low:int,high:int,item:string>>"


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


def _letter(number: int) -> str:
    """A character for a word number from 1; surrogates are left out."""
    return chr(number if number < 0xD800 else number + 0x800)


class Windows:
    """The automaton over the windows of some items; picklable, as the nodes are rebuilt where it is used."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.items, self.width = items, width
        self.__setstate__(self.__getstate__())

    def __getstate__(self):
        return {"items": self.items, "width": self.width}

    def __setstate__(self, state):
        self.items, self.width = state["items"], state["width"]
        self.letters: dict[bytes, str] = {}
        owners: dict[str, set[str]] = {}
        for item, text in self.items:
            words = words_of(text)
            for word in words:
                self.letters.setdefault(word, _letter(len(self.letters) + 1))
            line = "".join(map(self.letters.__getitem__, words))
            for start in range(max(1, len(line) - self.width + 1) if line else 0):
                owners.setdefault(line[start:start + self.width], set()).add(item)
        self.machine = ahocorasick.Automaton()
        for window, who in owners.items():
            self.machine.add_word(window, (len(window), sorted(who)))
        if owners:
            self.machine.make_automaton()

    def find(self, words: list[bytes]) -> list[tuple[int, int, list[str]]]:
        """(first word, word after the last, items) of each occurrence of a window."""
        if not len(self.machine):
            return []
        line = "".join(map(self.letters.get, words, repeat("\0")))
        return [(end + 1 - size, end + 1, items) for end, (size, items) in self.machine.iter(line)]


def _spans(text: str, low: np.ndarray, high: np.ndarray) -> list[dict]:
    """Character offsets in `text` of runs of words from low to high (exclusive)."""
    raw = np.frombuffer(text.encode(), np.uint8)
    inside = np.frombuffer(text.encode().translate(_WORDS), np.uint8) != 32
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return [{"start": int(chars[starts[a]]), "end": int(chars[ends[b - 1]])} for a, b in zip(low, high, strict=True)]


def _joined(hits: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Overlapping or adjoining word ranges as disjoint ones."""
    low, high = [], []
    for a, b in sorted(hits):
        if high and a <= high[-1]:
            high[-1] = max(high[-1], b)
        else:
            low.append(a)
            high.append(b)
    return low, high


def blocks(benchmark: DataFrame, item: str, text: str, limit: int) -> tuple[DataFrame, int]:
    """The items with text and the block of each, in blocks of about `limit` bytes, and the number of blocks."""
    clean = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).filter("text is not null")
    size = clean.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // limit))
    return clean.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count))), count


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
         item_text: str = "text", width: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Add `contamination`: n_words, n_hit, items (sorted as strings) and spans (character offsets in the text).

    A window is `width` consecutive words of an item; an item of fewer words, but not none, is one window. A missing
    text has no words and no hit; an empty benchmark hits nothing. Repeated items count once. An item without id hits words
    like any other and is not named. The driver holds one block of items at a time. Other columns of `docs`
    pass through; a column named `contamination` is replaced.
    """
    rest = [c for c in docs.columns if c != "contamination"]
    rows = docs.select(F.col(text).alias("_text"), F.lit(None).cast(_HITS).alias("_hits"), F.struct(*rest).alias("_rest"))
    dealt, count = blocks(benchmark, item, item_text, block_bytes)

    def scanned(frame: DataFrame, items: list[tuple[str, str]], last: bool) -> DataFrame:
        shared = share(docs.sparkSession, Windows(items, width))
        result = ("struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:int,end:int>>>"
                  if last else _HITS)
        kind = frame.select(F.expr(f"cast(null as {result})").alias("x")).schema.fields[0].dataType
        schema = frame.select("_text", "_hits", "_rest").schema
        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind)

        def run(batches):
            windows = loaded(shared)
            for batch in pieces(batches, SLICE_BYTES, "_text"):
                out = []
                for value, before in zip(batch.column(0), batch.column(1), strict=True):
                    value = value.as_py()
                    words = words_of(value) if value is not None else []
                    hits = [(h["low"], h["high"], h["item"]) for h in before.as_py() or ()]
                    hits += [(a, b, x) for a, b, items in windows.find(words) for x in items]
                    if not last:
                        out.append([{"low": a, "high": b, "item": x} for a, b, x in hits])
                        continue
                    low, high = _joined([h[:2] for h in hits])
                    out.append({"n_words": len(words), "n_hit": sum(high) - sum(low),
                                "items": sorted({h[2] for h in hits} - {None}),
                                "spans": _spans(value, low, high) if low else []})
                made = pa.array(out, arrow)
                if last:
                    yield pa.RecordBatch.from_arrays([batch.column(2), made], ["_rest", "contamination"])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), made, batch.column(2)], ["_text", "_hits", "_rest"])

        if not last:
            return stored(frame.mapInArrow(run, schema), "scan")
        return frame.mapInArrow(run, frame.select("_rest").schema.add("contamination", kind))

    for k in range(count):
        items = [tuple(r) for r in dealt.filter(F.col("block") == k).select("item", "text").distinct().collect()]
        rows = scanned(rows, items, k == count - 1)
    return rows.select("_rest.*", "contamination")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its words, the words hit, the items that occur, and whether it is contaminated."""
    found = scan(docs.select("doc_id", "text"), benchmark)
    items = F.col("contamination.items")
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"))

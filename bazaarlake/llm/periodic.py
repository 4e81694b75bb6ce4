"""Periodic runs of words: stretches that repeat with a period, at least four times over.

Method: maximal pairs from a bottom-up traversal of the LCP-interval tree. Suffixes are sorted by prefix doubling; an
LCP interval is a set of places that share a prefix of words. Each interval carries its places in order together with
the classes of their left words. Where two children of an interval meet, two places with different left words are a
maximal pair: neither side can be extended. A maximal pair at distance q with a match of at least 3 q words is exactly
a run of period q (start: the left place, length: match plus q); nothing is extended afterwards. A stretch that is found
with several distances keeps the smallest, its period.

Why two neighbours are enough for each place of the smaller child: matches at distances of at most a third of their
length lie in one periodic stretch, so of all places of the window to the left only the leftmost can have another left
word, and to the right at most one place of another child lies in the window. So the work is O(n log n) besides the
runs, however often something is repeated.

The tree is cut where no run can be: places are listed only in intervals of at least LEAST - 1 words (a run has LEAST
words at least), in which left words differ and the longest match is three times the smallest distance.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import pieces, texts_of, with_text

LEAST, TIMES = 6, 4
SLICE_BYTES = 2_000_000
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def coded(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """All words as numbers that no two texts share, with one separator after each text; and where each text starts."""
    known: dict[bytes, int] = {}
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    flat = np.empty(starts[-1], np.int64)
    for at, words in zip(starts[:-1].tolist(), texts, strict=True):
        flat[at:at + len(words)] = [known.setdefault(w, len(known)) for w in words]
        flat[at + len(words)] = -1
    flat += np.repeat(np.arange(len(texts)) * (len(known) + 1), sizes + 1) + 1
    return flat, starts


def grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorting order of `key` and, for each sorted row, the row at which its group of equal keys starts."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.ones(len(key), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return order, np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))


def repeated(group: np.ndarray) -> np.ndarray:
    """Sorted rows whose group has at least two."""
    same = np.zeros(len(group), bool)
    same[1:] = group[1:] == group[:-1]
    same[:-1] |= same[1:]
    return same


def doubled(flat: np.ndarray) -> list[np.ndarray]:
    """Ranks by the first 1, 2, 4, ... words, until no two places agree. A place that is alone keeps its rank."""
    size = len(flat)
    order, group = grouped(flat)
    rank = np.empty(size, np.int32)
    rank[order] = group
    ranks, alive = [rank], order[repeated(group)]
    while len(alive):
        step = 1 << (len(ranks) - 1)
        old = rank[alive].astype(np.int64)  # a repeated stretch has no separator, so `alive + step` exists
        order, group = grouped(old * size + rank[alive + step])
        alive, old = alive[order], old[order]
        starts = np.zeros(len(old), bool)
        starts[0] = True
        starts[1:] = old[1:] != old[:-1]
        first = np.maximum.accumulate(np.where(starts, np.arange(len(old)), 0))
        rank = rank.copy()
        rank[alive] = old + group - first
        ranks.append(rank)
        alive = alive[repeated(group)]
    return ranks


def matching(ranks: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words agree from the places `a` and `b` on."""
    a, b = a.copy(), b.copy()
    total, last = np.zeros(len(a), np.int64), len(ranks[0]) - 1
    for level in range(len(ranks) - 1, -1, -1):
        step = (ranks[level][a] == ranks[level][b]).astype(np.int64) << level
        total += step
        a, b = np.minimum(a + step, last), np.minimum(b + step, last)
    return total


def intervals(flat: np.ndarray, ranks: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The topmost intervals that may hold a run: places in suffix order, and each one's match with the one before."""
    if len(ranks) <= 2:
        return []
    rank, rest = ranks[2], LEAST - 1 - (1 << 2)  # LEAST - 1 words agree where two overlapping ranks do
    order, group = grouped(rank)
    places = order[repeated(group)]
    if not len(places):
        return []
    order, group = grouped(rank[places].astype(np.int64) * len(flat) + rank[np.minimum(places + rest, len(flat) - 1)])
    some = repeated(group)
    places, group = places[order][some], group[some]
    if not len(places):
        return []
    left = np.where(places > 0, flat[places - 1], -1)
    starts = np.concatenate([[0], 1 + np.flatnonzero(group[1:] != group[:-1])])
    mixed = np.minimum.reduceat(left, starts) < np.maximum.reduceat(left, starts)
    number = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(places))))
    keep = mixed[number]
    places, number = places[keep], number[keep]
    if not len(places):
        return []
    by_place = np.lexsort((places, number))
    gap = np.full(len(places), np.iinfo(np.int64).max)
    near = number[by_place][1:] == number[by_place][:-1]
    gap[1:][near] = np.diff(places[by_place])[near]
    order = np.lexsort((ranks[-1][places], number))
    places, number = places[order], number[order]
    same = np.append(False, number[1:] == number[:-1])
    match = np.zeros(len(places), np.int64)
    match[same] = matching(ranks, places[:-1][same[1:]], places[1:][same[1:]])
    starts = np.concatenate([[0], 1 + np.flatnonzero(~same[1:])])
    ends = np.append(starts[1:], len(places))
    possible = np.maximum.reduceat(match, starts) >= (TIMES - 1) * np.minimum.reduceat(gap, starts)
    return [(places[a:b], match[a:b]) for a, b in zip(starts[possible].tolist(), ends[possible].tolist(), strict=True)]


class Interval:
    """Places of an LCP interval, sorted, and the classes of left words among them."""

    def __init__(self, place: int, left: int):
        self.places, self.classes = [place], {left}

    def join(self, other: Interval, depth: int, left: np.ndarray, found: list[tuple[int, int, int]]) -> Interval:
        """Both intervals as children of one of `depth`; maximal pairs across them go to `found`."""
        small, large = (self, other) if len(self.places) < len(other.places) else (other, self)
        window = depth // (TIMES - 1)
        if len(small.classes | large.classes) > 1:
            around = large.places
            for place in small.places:
                own = left[place]
                k = bisect_left(around, place - window)
                if k < len(around) and around[k] < place and left[around[k]] != own:
                    found.append((around[k], place - around[k], depth))
                k = bisect_right(around, place)
                if k < len(around) and around[k] - place <= window and left[around[k]] != own:
                    found.append((place, around[k] - place, depth))
        if len(small.places) * 8 < len(large.places):
            for place in small.places:
                insort(large.places, place)
        else:
            large.places += small.places
            large.places.sort()
        large.classes |= small.classes
        return large


def maximal_pairs(places: list[int], match: list[int], left: np.ndarray) -> list[tuple[int, int, int]]:
    """(place, distance, match) of the maximal pairs whose match is at least TIMES - 1 distances."""
    found: list[tuple[int, int, int]] = []
    open_intervals: list[tuple[int, Interval]] = []
    for k, place in enumerate(places):
        child = Interval(place, int(left[place]))
        depth = match[k + 1] if k + 1 < len(places) else -1
        while open_intervals and open_intervals[-1][0] >= depth:
            own, earlier = open_intervals.pop()
            child = earlier.join(child, own, left, found)
            if own == depth:
                break
        open_intervals.append((depth, child))
    return found


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text as rows (start, length, period), by start and then period."""
    flat, starts = coded(texts)
    found: list[tuple[int, int, int]] = []
    if len(flat):
        left = np.concatenate([[-1], flat[:-1]])
        for places, match in intervals(flat, doubled(flat)):
            found += maximal_pairs(places.tolist(), match.tolist(), left)
    rows = np.array(found, np.int64).reshape(-1, 3)
    start, period, length = rows[:, 0], rows[:, 1], rows[:, 1] + rows[:, 2]
    order = np.lexsort((period, length, start))
    start, period, length = start[order], period[order], length[order]
    smallest = np.ones(len(start), bool)
    smallest[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, period, length = start[smallest], period[smallest], length[smallest]
    order = np.lexsort((period, start))
    rows = np.column_stack([start, length, period])[order]
    cuts = np.searchsorted(rows[:, 0], starts)
    return [rows[a:b] - [at, 0, 0] for a, b, at in zip(cuts[:-1], cuts[1:], starts[:-1], strict=True)]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words outside runs and the first period of each run, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, runs (start, length, period in words, by start and period) and collapsed (text without repeats).

    Words are `[^\\x20\\x09-\\x0D]+`, compared as they are written. A run is a stretch of at least LEAST words and four
    times its smallest period that no neighbouring word extends. `collapsed` keeps what no run contains after its first
    period. A missing, empty or wordless text has no words, no runs and an empty `collapsed`. Repeated rows are kept.
    Other columns pass through; columns with the three names are replaced. An empty table gives an empty result.
    """
    rest = [c for c in docs.columns if c not in ("n_words", "runs", "collapsed")]
    packed = with_text(docs, rest, text)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in pieces(texts_of(batches, text), SLICE_BYTES, "text"):
            texts = [(t.as_py() or "").encode().split() for t in batch.column("text")]
            found = runs_of(texts)
            sizes = np.concatenate([[0], np.cumsum([len(r) for r in found])])
            flat = np.concatenate(found) if found else np.empty((0, 3), np.int64)
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.StructArray.from_arrays(
                [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(kind.value_type)))
            shorter = [collapsed(words, r) for words, r in zip(texts, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(w) for w in texts], pa.int64()), lists,
                 pa.array(shorter, pa.binary()).cast(pa.string())], ["_rest", "n_words", "runs", "collapsed"])

    schema = packed.select("_rest", F.lit(0).cast("bigint").alias("n_words"), F.expr(f"cast(null as {RUNS})").alias("runs"),
                           F.lit("").alias("collapsed")).schema
    return packed.mapInArrow(run, schema).select(*[F.col("_rest")[c].alias(c) for c in rest], "n_words", "runs", "collapsed")


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; of equal ones the first. Null without runs."""
    return F.reduce(
        F.slice(runs, 2, F.greatest(F.size(runs) - 1, F.lit(0))), F.get(runs, F.lit(0)),
        lambda best, x: F.when(x["length"] * best["period"] > best["length"] * x["period"], x).otherwise(best))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which every tenth document by checksum of its id is made periodic from some word on."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    split = docs.select("doc_id", "text", F.floor(code / 10).cast("bigint").alias("g"),
                        F.when(code % 10 == 0, words).alias("words")).withColumn("n", F.size("words").cast("bigint"))
    placed = split.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n"))).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    made = F.array_join(F.transform("words", lambda w, i: F.when(
        i >= F.col("a"), F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))).otherwise(w)), " ")
    return placed.select("doc_id", F.when(F.col("n") > 0, made).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document with its runs counted and digested, its strongest run, and the collapsed text digested.

    A document without runs, or without text, has n_runs 0, four nulls and the digests of what is left (never null).
    """
    found = find(with_planted_periods(docs)).withColumn("best", strongest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))

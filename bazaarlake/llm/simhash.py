"""Near-duplicates by SimHash: 64-bit fingerprints of 3-word shingles, linked when at most two bits differ.

Method: the 64 bits are cut into SEGMENTS = RADIUS // 2 + 1 segments, fewer than the RADIUS + 1 that exact segment
matches would need. Two linked fingerprints then have a segment that differs by at most one bit, so they agree on one
variant of it, in which one bit is a wildcard. Every distinct fingerprint is listed under its 64 variants; an equality
join on the variant brings candidates together and the full distance verifies them. A pair is accepted under one
variant only (its first fitting segment, its differing bit), and a variant hands on a spanning forest of its links,
which is all that components need: a dense group never becomes all of its pairs.

Documents are pre-aggregated to distinct fingerprints, so copies meet as one row. A variant with more than BUCKET
fingerprints is not compared inside one task. Its members take an exact second way, whose groups are bounded by
nature: two fingerprints within two bits have a common point at most one bit away from either, and at most 65
fingerprints lie around a point, all of them linked with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.llm.common import LOWER, components, pieces, stored

WORDS, SEED, BITS, RADIUS = 3, 42, 64, 2
SEGMENTS = RADIUS // 2 + 1
BUCKET, FEW = 512, 12
SLICE_BYTES, HASHES = 4_000_000, 1 << 18
HEAVY_SHARE = 10_000  # a fingerprint is heavy with a share of 1 / HEAVY_SHARE of the rows; so at most as many are

_WIDTH = BITS // SEGMENTS
_OF_BIT = [min(bit // _WIDTH, SEGMENTS - 1) for bit in range(BITS)]
_SEGMENT = np.array([sum(1 << b for b in range(BITS) if _OF_BIT[b] == s) for s in range(SEGMENTS)], np.uint64)
_WILD = np.array([int(_SEGMENT[_OF_BIT[b]]) & ~(1 << b) for b in range(BITS)], np.uint64)
_LOWEST = np.array([_OF_BIT.index(_OF_BIT[b]) == b for b in range(BITS)])


def shingle_hashes(text: str, words: int = WORDS) -> bytes:
    """XXH64 of every shingle of `text`, 8 bytes each; fewer words are one shingle, no words none."""
    tokens = text.encode().translate(LOWER).split()
    if len(tokens) <= words:
        return xxhash.xxh64_digest(b" ".join(tokens), SEED) if tokens else b""
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate([[0], ends[:-words] + 1]).tolist()
    cuts = map(slice, starts, ends[words - 1:].tolist())
    return b"".join([xxhash.xxh64_digest(joined[cut], SEED) for cut in cuts])


def majority(hashes: list[bytes]) -> np.ndarray:
    """The fingerprint of each list of hashes: a bit is 1 if it is set in more than half of them."""
    sizes = np.array([len(h) // 8 for h in hashes], np.int64)
    owner = np.repeat(np.arange(len(hashes)), sizes)
    flat = np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8)
    ones = np.zeros((len(hashes), BITS), np.int64)
    for k in range(0, len(flat), HASHES):
        own = owner[k:k + HASHES]
        starts = np.concatenate([[0], 1 + np.flatnonzero(own[1:] != own[:-1])])
        ones[own[starts]] += np.add.reduceat(np.unpackbits(flat[k:k + HASHES], axis=1), starts, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > sizes[:, None], axis=1).view(">u8")[:, 0].astype(np.uint64)


def fingerprints(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """(id, fp) of every row; `fp` holds the 64 bits as a signed long. A text without words has fingerprint zero."""
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))

    def run(batches):
        for batch in pieces(batches, SLICE_BYTES, "text"):
            made = majority([shingle_hashes(t.as_py() or "") for t in batch.column("text")])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made.view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, "id long, fp long")


def accepted(x: np.ndarray, y: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Whether the pairs are linked and belong to the variant of `bit`: so each link counts under one variant only."""
    differ = x ^ y
    ok = np.bitwise_count(differ) <= RADIUS
    own = np.array(_OF_BIT)[bit]
    for s in range(SEGMENTS):  # an earlier segment with at most one differing bit takes the pair
        ok &= (own <= s) | (np.bitwise_count(differ & _SEGMENT[s]) > 1)
    inside = differ & _SEGMENT[own]
    return ok & np.where(inside == 0, _LOWEST[bit], inside == np.uint64(1) << bit.astype(np.uint64))


def forest(fps: np.ndarray, bit: int) -> list[tuple[int, int]]:
    """Links that join what the links of this variant join, by breadth-first search over its members."""
    found, left = [], np.ones(len(fps), bool)
    for root in range(len(fps)):
        if not left[root]:
            continue
        left[root], queue = False, [root]
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(left)
            near = rest[accepted(fps[at], fps[rest], np.full(len(rest), bit))]
            left[near] = False
            queue += near.tolist()
            found += [(at, k) for k in near.tolist()]
    return found


def links_of(bits: np.ndarray, fps: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Row pairs, as two arrays, that link the members of each variant; a variant is the rows from start to end."""
    sizes = ends - starts
    left, right = [], []
    small = sizes <= FEW
    for step in range(1, FEW):  # rows that are `step` apart in small variants
        some = small & (sizes > step)
        if not some.any():
            break
        count = sizes[some] - step
        first = np.repeat(starts[some] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        ok = accepted(fps[first], fps[first + step], bits[first])
        left.append(first[ok])
        right.append(first[ok] + step)
    for a, b in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
        pairs = np.array(forest(fps[a:b], int(bits[a])), np.int64).reshape(-1, 2)
        left.append(a + pairs[:, 0])
        right.append(a + pairs[:, 1])
    return [np.concatenate(side) if side else np.empty(0, np.int64) for side in (left, right)]


def candidates(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(a, b): links of fingerprints in variants of at most `bucket` members; (a, null): members of larger ones."""
    masks = F.array(*[F.lit(int(m)) for m in _WILD.view(np.int64)])
    bit = F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("bit")
    rows = distinct.select("fp", bit).withColumn("value", F.col("fp").bitwiseAND(F.element_at(masks, F.col("bit") + 1)))
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(parts, "bit", "value").sortWithinPartitions("bit", "value")

    def batch_of(a, b):
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b, pa.int64())], ["a", "b"])

    def run(batches):
        bits, fps, over = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            bits = np.concatenate([bits, batch.column("bit").to_numpy().astype(np.int64)])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
            yield from done(bits, fps, over, False)
            bits, fps, over = rest(bits, fps, over)
        yield from done(bits, fps, over, True)

    def cut(bits, fps):
        value = fps & _WILD[bits]
        starts = np.concatenate([[0], 1 + np.flatnonzero((bits[1:] != bits[:-1]) | (value[1:] != value[:-1]))])
        return starts, np.append(starts[1:], len(fps)), value

    def rest(bits, fps, over):
        """What is kept for the next batch: the last variant, or only its name once it is too large."""
        if not len(fps):
            return bits, fps, over
        starts, _, value = cut(bits, fps)
        last = (int(bits[-1]), int(value[-1]))
        if over == last or len(fps) - starts[-1] > bucket:
            return bits[:0], fps[:0], last
        return bits[starts[-1]:], fps[starts[-1]:], None

    def done(bits, fps, over, end):
        if not len(fps):
            return
        starts, ends, value = cut(bits, fps)
        large = ends - starts > bucket
        large[0] |= over == (int(bits[0]), int(value[0]))
        whole = ~large
        whole[-1] &= end
        spilled = np.repeat(large, ends - starts)
        if spilled.any():
            yield batch_of(fps[spilled], [None] * int(spilled.sum()))
        some = whole & (ends - starts > 1)
        if some.any():
            x, y = links_of(bits, fps, starts[some], ends[some])
            if len(x):
                yield batch_of(np.minimum(fps[x].view(np.int64), fps[y].view(np.int64)),
                               np.maximum(fps[x].view(np.int64), fps[y].view(np.int64)))

    return dealt.select("bit", "fp").mapInArrow(run, "a long, b long")


def around_points(members: DataFrame) -> DataFrame:
    """(a, b): links among `members` (fp), by the points at most one bit away; all around a point are linked."""
    moves = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(BITS)])
    near = members.select("fp", F.explode(moves).alias("move")).select("fp", F.col("fp").bitwiseXOR(F.col("move")).alias("point"))
    least = F.min("fp").over(Window.partitionBy("point"))
    return near.withColumn("a", least).filter("fp <> a").select("a", F.col("fp").alias("b"))


def links(distinct: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Distinct links (a, b) between fingerprints that join exactly what all links within RADIUS bits join."""
    found = stored(candidates(distinct, bucket), "candidates")
    large = found.filter("b is null").select(F.col("a").alias("fp")).distinct()
    return found.filter("b is not null").union(around_points(large)).distinct()


def cluster(docs: DataFrame, id_column: str = "doc_id", text: str = "text", bucket: int = BUCKET) -> DataFrame:
    """`id_column`, fingerprint (16 hex digits) and component_id (smallest id reachable by links) of every row.

    A missing text, one without words and an empty one have fingerprint zero and are linked like any other. Fewer than
    three words are one shingle. Repeated rows are kept one by one; rows that share an id are linked by their
    fingerprints only. A row without id is kept, links others, and names no component; a component of such rows only
    has component_id null. Other columns are left behind, so their names cannot clash. An empty table gives an empty
    result.
    """
    kind = docs.schema[id_column].dataType
    rows = stored(fingerprints(docs, id_column, text), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")), "distinct")
    labels = components(links(distinct, bucket)).withColumnRenamed("node", "fp")
    tagged = distinct.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = tagged.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stored(tagged.join(least, "component").select("fp", "rows", "component_id"), "named")
    total = rows.count()
    heavy = named.filter(F.col("rows") * HEAVY_SHARE >= total).select("fp", F.struct("component_id").alias("known"))
    spread = rows.join(F.broadcast(heavy), "fp", "left")  # HEAVY_SHARE rows at most; no key of the shuffle is heavy
    known = spread.filter("known is not null").select("id", "fp", "known.component_id")
    others = spread.filter("known is null").select("id", "fp").join(named.select("fp", "component_id"), "fp")
    return known.unionByName(others).select(
        F.col("id").cast(kind).alias(id_column), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component_id").cast(kind).alias("component_id"))

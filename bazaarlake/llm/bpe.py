"""Byte-level BPE encoding and decoding.

A pre-token is looked up in two tiers. A minimal perfect hash (hash and displace) over the vocabulary finds pre-tokens
that are tokens themselves with one probe and one comparison. A miss is merged: its bytes form a linked list and a heap
holds the mergeable neighbours by (rank, place), so a long pre-token costs n log n, not n squared.

The vocabulary is a parameter, has a fixed size and is broadcast once; texts never leave their partition.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import loaded, pieces, share, texts_of, with_text

CACHED_PRETOKENS = 300_000
SLICE_BYTES = 4_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}


class PerfectHash:
    """Minimal perfect hash from keys to values: as many slots as keys, each key in a slot of its own."""

    def __init__(self, table: dict[bytes, int], per_bucket: int = 4):
        self.size = len(table)
        self.buckets = max(1, self.size // per_bucket)
        self.shift = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * self.size
        self.values = [-1] * self.size
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(self.buckets)]
        for key in table:
            code = xxhash.xxh64_intdigest(key)
            buckets[code % self.buckets].append((code, key))
        free = None
        for number in sorted(range(self.buckets), key=lambda b: -len(buckets[b])):
            members = buckets[number]
            if len(members) == 1:  # the rest: any free slot will do, named directly
                free = free or [slot for slot in range(self.size) if self.keys[slot] is None]
                slot = free.pop()
                self.shift[number] = -slot - 1
                self._put(slot, members[0][1], table)
                continue
            shift = 0
            while members:
                slots = [self._slot(code, shift) for code, _ in members]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    for slot, (_, key) in zip(slots, members, strict=True):
                        self._put(slot, key, table)
                    self.shift[number] = shift
                    break
                shift += 1

    def _slot(self, code: int, shift: int) -> int:
        mixed = ((code >> 17) ^ (shift * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF
        return (mixed * 0xD6E8FEB86659FD93 >> 32 & 0xFFFFFFFF) % self.size

    def _put(self, slot: int, key: bytes, table: dict[bytes, int]) -> None:
        self.keys[slot], self.values[slot] = key, table[key]

    def get(self, key: bytes) -> int:
        """The value of `key`, or -1."""
        if not self.size:
            return -1
        code = xxhash.xxh64_intdigest(key)
        shift = self.shift[code % self.buckets]
        slot = -shift - 1 if shift < 0 else self._slot(code, shift)
        return self.values[slot] if self.keys[slot] == key else -1


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pre-token by repeated merges of the neighbours of lowest rank, the leftmost first."""
    n = len(piece)
    end = list(range(1, n + 1))  # a part starts at i and ends at end[i]; an absorbed part has end -1
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if middle < 0 or middle >= n or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[i], end[middle] = stop, -1
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i:end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:end[i]]])
        i = end[i]
    return ids


class Coder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.whole = PerfectHash(ranks)
        self.split = regex.compile(pattern).findall
        self.text = {rank: str(rank) for rank in ranks.values()}
        self.token = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.split.__self__.pattern, "whole": self.whole}

    def __setstate__(self, state):
        self.ranks, self.whole = state["ranks"], state["whole"]
        self.split = regex.compile(state["pattern"]).findall
        self.text = {rank: str(rank) for rank in self.ranks.values()}
        self.token = {rank: token for token, rank in self.ranks.items()}
        self.known = {}

    def lookup(self, pretoken: str) -> tuple[int, ...]:
        piece = pretoken.encode()
        found = self.whole.get(piece)
        return (found,) if found >= 0 else tuple(merge_bytes(piece, self.ranks))

    def encode(self, text: str) -> list[int]:
        pretokens, known = self.split(text), self.known
        for pretoken in set(pretokens).difference(known):
            known[pretoken] = self.lookup(pretoken)
        ids = list(chain.from_iterable(map(known.__getitem__, pretokens)))
        if len(known) > CACHED_PRETOKENS:
            known.clear()
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


def _batches(column: pa.ChunkedArray | pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids",
           digest: str = "ids_sha256", decoded: str | None = None) -> DataFrame:
    """Add `ids`, the token ids of `text`, and `digest`, the SHA-256 of the decimal ids joined by one space.

    A missing or empty text has no ids; its digest is that of the empty string. Every byte must be a token of `ranks`,
    so every text can be encoded. With `decoded` the ids are decoded again in the same step, into a column of that name
    (a second step would start a second Python worker for each task). Other columns pass through; the added columns
    replace columns of their names.
    """
    spark = df.sparkSession
    shared = share(spark, Coder(ranks, pattern))
    added = [ids, digest, *([decoded] if decoded else [])]
    rest = [c for c in df.columns if c not in added]
    packed = with_text(df, rest, text)

    def run(batches):
        coder = loaded(shared)
        for batch in pieces(texts_of(batches, text), SLICE_BYTES, "text"):
            digests, sizes, flat, raw = [], [0], [], []
            for value in _batches(batch.column(1)):
                own = coder.encode(value)
                if decoded:
                    raw.append(coder.decode(own))
                digests.append(hashlib.sha256(" ".join(map(coder.text.__getitem__, own)).encode()).hexdigest())
                sizes.append(sizes[-1] + len(own))
                flat.append(np.array(own, dtype=np.int32))
            values = np.concatenate(flat) if flat else np.empty(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values))
            extra = [pa.array(raw, pa.binary())] if decoded else []
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(digests, pa.string()), *extra], ["_rest", *added])

    schema = packed.select("_rest", F.expr("cast(null as array<int>)").alias(ids), F.lit("").alias(digest),
                           *([F.expr("cast('' as binary)").alias(decoded)] if decoded else [])).schema
    return packed.mapInArrow(run, schema).select(*[F.col("_rest")[c].alias(c) for c in rest], *added)


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `out`, the bytes of the token ids in column `ids`. Missing ids give empty bytes; an unknown id raises."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    rest = [c for c in df.columns if c not in (out, ids)]
    packed = df.select(F.col(ids).alias("_ids"), F.struct(*rest, ids).alias("_rest"))

    def run(batches):
        token = shared.value.__getitem__
        for batch in batches:
            column = batch.column(0)
            flat = column.values.to_numpy(zero_copy_only=False)
            ends = column.offsets.to_numpy()
            made = [b"".join(map(token, flat[a:b].tolist())) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(made, pa.binary())], ["_rest", out])

    schema = packed.select("_rest", F.expr("cast('' as binary)").alias(out)).schema
    return packed.mapInArrow(run, schema).select("_rest.*", out)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document: encoded, then decoded from the ids."""
    encoded = encode(docs.select("doc_id", "text"), ranks, pattern, decoded="decoded")
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids_sha256",
                          F.sha2("decoded", 256).alias("decoded_sha256"))

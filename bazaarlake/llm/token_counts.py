"""Token counts without ids.

Documents are cut into pre-tokens once. A chunk of documents keeps, as one compressed row, how often each of its
distinct pre-tokens occurs in each document; its distinct pre-tokens leave as one packed row per hash bucket. A bucket
sees all occurrences of its pre-tokens, so each distinct pre-token of the corpus is run through the model once. The
piece counts return to their chunk, where count times frequency is summed per document. What is shuffled grows with
the distinct pre-tokens of the chunks, not with the tokens, and a very common pre-token has one entry per chunk. There
are as many buckets as shuffle partitions; what a task remembers is the distinct pre-tokens of one bucket.
"""

from __future__ import annotations

import json
import os
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 12_000_000


def read_model(path: str) -> str:
    """The text of a tokenizer file (.json of the tokenizers library, byte-level pre-tokens)."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def special_strings(model: str) -> list[str]:
    """Added tokens, which the library cuts out of a text before anything else; longest first."""
    return sorted((t["content"] for t in json.loads(model).get("added_tokens", [])), key=len, reverse=True)


class Splitter:
    """Pre-tokens of a text; an added token is a pre-token of its own."""

    def __init__(self, pattern: str, special: list[str]):
        self.find = regex.compile(pattern).findall
        self.special = special
        self.around = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def __call__(self, text: str) -> list[str]:
        if self.around is None or not any(s in text for s in self.special):
            return self.find(text)
        parts = self.around.split(text)  # every second part is an added token
        return list(chain.from_iterable([part] if k % 2 else self.find(part) for k, part in enumerate(parts)))


def _chunk(rows: list[tuple[bytes, int, Counter]]) -> tuple[list[str], bytes]:
    """The distinct pre-tokens of a chunk, commonest first, and its documents' frequencies, packed."""
    total: Counter = Counter()
    for _, _, own in rows:
        total.update(own.keys())
    words = sorted(total, key=total.__getitem__, reverse=True)
    place = {w: k for k, w in enumerate(words)}
    sizes = np.array([len(own) for _, _, own in rows], np.int32)
    where, often = np.empty(sizes.sum(), np.int32), np.empty(sizes.sum(), np.int32)
    at = 0
    for size, (_, _, own) in zip(sizes, rows, strict=True):
        index = np.fromiter(map(place.__getitem__, own), np.int32, size)
        order = np.argsort(index, kind="stable")
        where[at:at + size] = np.diff(index[order], prepend=0)
        often[at:at + size] = np.fromiter(own.values(), np.int32, size)[order]
        at += size
    length = np.array([n for _, n, _ in rows], np.int64)
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in (where, often)]
    packed = zstandard.ZstdCompressor(level=3).compress(
        len(rows).to_bytes(8, "little") + sizes.tobytes() + length.tobytes() + b"".join(planes))
    return words, packed


def _unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(raw[:8], "little")
    sizes = np.frombuffer(raw, np.int32, n, 8)
    length = np.frombuffer(raw, np.int64, n, 8 + 4 * n)
    total = int(sizes.sum())
    at = 8 + 12 * n
    deltas, often = (np.ascontiguousarray(
        np.frombuffer(raw, np.uint8, 4 * total, at + k * 4 * total).reshape(4, total).T).view(np.int32)[:, 0]
        for k in range(2))
    return sizes, length, deltas, often


def _pack_words(words: list[str], places: np.ndarray) -> bytes:
    raw = [w.encode() for w in words]
    heads = [np.diff(places, prepend=0).astype(np.uint32), np.fromiter(map(len, raw), np.uint32, len(raw))]
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes() for x in heads]
    return zstandard.ZstdCompressor(level=3).compress(len(raw).to_bytes(8, "little") + b"".join([*planes, *raw]))


def _unpack_words(packed: bytes) -> tuple[list[str], np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(raw[:8], "little")
    gaps, sizes = (np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * n, 8 + k * 4 * n).reshape(4, n).T).view(np.uint32)[:, 0]
                   for k in range(2))
    ends = np.cumsum(sizes, dtype=np.int64) + 8 + 8 * n
    cuts = zip((ends - sizes).tolist(), ends.tolist(), strict=True)
    return [raw[a:b].decode() for a, b in cuts], np.cumsum(gaps, dtype=np.int64)


def count(docs: DataFrame, model: str, pattern: str, limit: int = 512, id_column: str = "doc_id",
          text: str = "text") -> DataFrame:
    """`id_column`, n_bytes, n_tokens and over_limit (n_tokens > `limit`) of every row.

    A missing text counts as empty: no bytes, no tokens. Repeated rows are counted one by one. Other columns are left
    behind. `model` is a byte-level file of the tokenizers library; `pattern` is its split into pre-tokens.
    """
    special = special_strings(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema[id_column].dataType
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"),
                         F.spark_partition_id().alias("part"))
    names = ["bucket", "chunk", "packed", "ids"]
    arrow = [pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64())]

    def rows_of(chunk, ids, rows):
        words, packed = _chunk(rows)
        made = [(chunk % buckets, chunk, packed, ids)]
        bucket = np.fromiter((xxhash.xxh32_intdigest(w) % buckets for w in words), np.int32, len(words))
        order = np.argsort(bucket, kind="stable")
        for own in np.split(order, 1 + np.flatnonzero(np.diff(bucket[order]))) if words else []:
            made.append((int(bucket[own[0]]), chunk, _pack_words([words[k] for k in own], own), None))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*made, strict=True), arrow, strict=True)], names)

    def cut(batches):
        split = Splitter(pattern, special)
        ids, rows, held, number, part = [], [], 0, 0, 0
        for batch in batches:
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                value = value.as_py() or ""
                size = len(value.encode())
                ids.append(key.as_py())
                rows.append((b"", size, Counter(split(value))))
                held += size + 200
                if held >= CHUNK_BYTES:
                    yield from rows_of((part << 32) + number, ids, rows)
                    ids, rows, held, number = [], [], 0, number + 1
        if rows:
            yield from rows_of((part << 32) + number, ids, rows)

    def pieces(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        made, known, last = Tokenizer.from_str(shared.value), {}, None
        for batch in batches:
            for at in range(batch.num_rows):
                bucket, chunk, packed, ids = (batch.column(k)[at].as_py() for k in range(4))
                if bucket != last:
                    known.clear()
                    last = bucket
                places = sizes = None
                if ids is None:
                    words, where = _unpack_words(packed)
                    fresh = [w for w in words if w not in known]
                    for a in range(0, len(fresh), 10_000):
                        part = fresh[a:a + 10_000]
                        known.update(zip(part, (len(e) for e in made.encode_batch(part, add_special_tokens=False)), strict=True))
                    sizes = np.fromiter(map(known.__getitem__, words), np.int32, len(words)).tobytes()
                    places, packed = where.astype(np.int32).tobytes(), None
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([places], pa.binary()), pa.array([sizes], pa.binary()),
                     pa.array([packed], pa.binary()), pa.array([ids], arrow[3])],
                    ["chunk", "places", "pieces", "packed", "ids"])

    def add(table: pa.Table) -> pa.Table:
        packed = table.filter(pc.is_valid(table["packed"]))
        words = table.filter(pc.is_null(table["packed"]))
        places = np.frombuffer(b"".join(words["places"].to_pylist()), np.int32)
        pieces_of = np.zeros(len(places), np.int64)
        pieces_of[places] = np.frombuffer(b"".join(words["pieces"].to_pylist()), np.int32)
        sizes, length, deltas, often = _unpack(packed["packed"][0].as_py())
        ends = np.cumsum(sizes, dtype=np.int64)
        starts = ends - sizes
        run = np.cumsum(deltas, dtype=np.int64)  # places restart in each document: take off what came before it
        base = np.where(starts > 0, run[np.maximum(starts - 1, 0)] if len(run) else 0, 0)
        sums = np.concatenate([[0], np.cumsum(pieces_of[run - np.repeat(base, sizes)] * often)]) if len(run) else \
            np.zeros(1, np.int64)
        return pa.table({"id": packed["ids"].combine_chunks().values, "n_bytes": pa.array(length),
                         "n_tokens": pa.array(sums[ends] - sums[starts])})

    cut_rows = source.mapInArrow(cut, "bucket int, chunk long, packed binary, ids array<long>")
    dealt = cut_rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    counted = dealt.mapInArrow(pieces, "chunk long, places binary, pieces binary, packed binary, ids array<long>")
    summed = counted.groupBy("chunk").applyInArrow(add, "id long, n_bytes long, n_tokens long")
    return summed.select(F.col("id").cast(kind).alias(id_column), "n_bytes", "n_tokens",
                         (F.col("n_tokens") > limit).alias("over_limit"))

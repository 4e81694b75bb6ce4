"""Alignment of two tokenizers over one text, with corpus-wide counts of linked token pairs.

Method, in Arrow columns: the ids of a slice of documents are one flattened list with parent indices; token lengths
become document ends by segmented cumulative sums; a full outer hash join on the document-end keys of both tokenizers
gives every boundary. Between two neighbouring boundaries lies exactly one token of each side, so the joined rows,
filled backwards, are the links, and the rows with both sides are the cuts into groups. Table.group_by counts links
per document and documents per pair and chunk.

Spark merges the partial counts per pair. A chunk of documents keeps one packed row (its documents, and how often each
holds which of the chunk's pairs); its pairs fetch their corpus-wide counts in one join and return to the chunk, where
they are summed per document. What is shuffled grows with the distinct pairs of the chunks. A frequent pair has one
row per chunk, so no key is hot; the best count of each A id is one row per id of the vocabulary.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.bpe import Coder
from bazaarlake.llm.common import loaded, pieces, share, stored

SLICE_BYTES, CHUNK_BYTES = 1_500_000, 8_000_000
LONG_PIECE = 5_000
# Letters that byte-level files write for bytes: printable Latin-1 stays, the others follow from U+0100 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in _PLAIN)}


@dataclass
class Pair:
    """Two tokenizer files: `a` byte-level (.json of the tokenizers library), `b` a sentencepiece model."""

    a: str
    b: bytes
    pattern: str

    @classmethod
    def read(cls, path_a: str, path_b: str, pattern: str) -> Pair:
        with open(path_a, encoding="utf-8") as a, open(path_b, "rb") as b:
            return cls(a.read(), b.read(), pattern)


class Encoder:
    """Both tokenizers of a `Pair`, with the bytes of every id as an Arrow column."""

    def __init__(self, pair: Pair):
        import sentencepiece
        import tiktoken

        model = json.loads(pair.a)["model"]
        added = {t["content"] for t in json.loads(pair.a).get("added_tokens", [])}
        ranks = {bytes(_BYTE_OF[c] for c in token): k for token, k in model["vocab"].items() if token not in added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(model["vocab"][x + y] != 256 + k for k, (x, y) in enumerate(merges)) or len(ranks) != 256 + len(merges):
            raise ValueError("the ids of the byte-level file must follow its merges")
        self.fast = tiktoken.Encoding("a", pat_str=pair.pattern, mergeable_ranks=ranks, special_tokens={})
        self.ranks, self.pattern, self.heap = ranks, pair.pattern, None
        self.long = regex.compile(rf"\S{{{LONG_PIECE}}}|\s{{{LONG_PIECE}}}").search
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pair.b)
        self.bytes_a = self._column({k: token for token, k in ranks.items()})
        self.bytes_b = self._column({k: self._piece(k) for k in range(self.b.get_piece_size())})
        self.text_a, self.text_b = (pa.array([str(k) for k in range(len(c))]) for c in (self.bytes_a, self.bytes_b))

    def _piece(self, k: int) -> bytes:
        piece = self.b.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(k) else piece.replace("▁", " ").encode()

    @staticmethod
    def _column(of: dict[int, bytes]) -> pa.Array:
        return pa.array([of.get(k, b"") for k in range(max(of) + 1)], pa.binary())

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """Ids of space + text by A, and of text by B. A piece of great length takes the heap, not the library."""
        a = [self.by_heap(t) if self.long(t) else self.fast.encode_ordinary(t) for t in (" " + t for t in texts)]
        return pa.array(a, pa.list_(pa.int32())), pa.array(self.b.encode(texts, num_threads=1), pa.list_(pa.int32()))

    def by_heap(self, text: str) -> list[int]:
        self.heap = self.heap or Coder(self.ranks, self.pattern)
        return self.heap.encode(text)


def token_ends(ids: pa.ListArray, sizes: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Flattened ids, the row of each, and where it ends within its row: a cumulative sum that restarts per row."""
    flat, parent = pc.list_flatten(ids), pc.list_parent_indices(ids)
    running = pc.cumulative_sum(pc.cast(pc.take(sizes, flat), pa.int64()))
    offsets = ids.offsets.to_numpy() - ids.offsets[0].as_py()
    base = pa.array(np.concatenate([[0], running.to_numpy()])[offsets[:-1]])
    return flat, parent, pc.subtract(running, pc.take(base, parent))


def same_bytes(ids: pa.ListArray, table: pa.Array, texts: list[bytes]) -> np.ndarray:
    """Whether the joined token bytes of each row are the bytes of its text."""
    joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, pc.take(table, ids.values)), b"")
    return pc.equal(joined, pa.array(texts, pa.binary())).to_numpy(zero_copy_only=False)


def _lists(ends: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values)


def align_slice(coder: Encoder, texts: list[str | None], groups: bool = True) -> tuple[dict[str, np.ndarray | pa.Array], pa.Table]:
    """n_a, n_b, n_groups, n_links and the groups as text for each text, and the links as a table (row, a, b).

    Rows without tokens (no text, or bytes that a tokenizer does not give back) have zeros and an empty text.
    """
    n = len(texts)
    given = np.array([bool(t) for t in texts], bool)
    rows = np.flatnonzero(given)
    a, b = coder.encode([texts[k] for k in rows])
    raw = [(" " + texts[k]).encode() for k in rows]
    whole = same_bytes(a, coder.bytes_a, raw) & same_bytes(b, coder.bytes_b, raw) if len(rows) else np.empty(0, bool)
    if not whole.all():
        a, b, rows = a.filter(pa.array(whole)), b.filter(pa.array(whole)), rows[whole]
        raw = [r for r, ok in zip(raw, whole, strict=True) if ok]
    out = {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_groups", "n_links")}
    text = np.full(n, "", object)
    if not len(rows):
        return {**out, "groups": pa.array(text, pa.string())}, pa.table({c: pa.array([], pa.int64()) for c in ("row", "a", "b")})
    doc_ends = np.cumsum([len(r) for r in raw])
    doc_starts = pa.array(np.concatenate([[0], doc_ends[:-1]]))
    sides = []
    for ids, table, name in ((a, coder.bytes_a, "a"), (b, coder.bytes_b, "b")):
        flat, parent, end = token_ends(ids, pc.binary_length(table))
        key = pc.add(pc.take(doc_starts, parent), end)  # a document and a byte of it, as one number
        sides.append(pa.table({"key": key, name: flat}))
        out[f"n_{name}"][rows] = np.diff(ids.offsets.to_numpy())
    joined = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).sort_by("key").combine_chunks()
    key = joined["key"].to_numpy()
    cut = pc.and_(pc.is_valid(joined["a"]), pc.is_valid(joined["b"])).to_numpy()
    owner = np.searchsorted(doc_ends, key)
    out["n_links"][rows] = np.bincount(owner, minlength=len(rows))
    out["n_groups"][rows] = np.bincount(owner[cut], minlength=len(rows))
    if groups:
        names = [pc.binary_join(_lists(np.searchsorted(side["key"].to_numpy(), key[cut], "right"), pc.take(strings, ids)), ",")
                 for side, ids, strings in ((sides[0], sides[0]["a"].combine_chunks(), coder.text_a),
                                            (sides[1], sides[1]["b"].combine_chunks(), coder.text_b))]
        both = pc.binary_join_element_wise(*names, "|")
        text[rows] = pc.binary_join(_lists(np.searchsorted(key[cut], doc_ends, "right"), both), ";").to_pylist()
    filled = {c: pc.fill_null_backward(joined[c].combine_chunks()) for c in "ab"}
    links = pa.table({"row": pa.array(rows[owner]), **{c: pc.cast(filled[c], pa.int64()) for c in "ab"}})
    return {**out, "groups": pa.array(text, pa.string())}, links


def align(docs: DataFrame, pair: Pair, text: str = "text") -> DataFrame:
    """Add `alignment`: n_a, n_b, n_groups, n_links and groups (`a1,a2|b1;a3|b2,b3`, ids in order) to every row.

    A missing or empty text, or one that a tokenizer does not give back byte for byte, has zeros and an empty string.
    Other columns pass through; a column named `alignment` is replaced. Repeated rows are kept; an empty table gives an
    empty result.
    """
    shared = share(docs.sparkSession, pair)
    rest = [c for c in docs.columns if c != "alignment"]
    packed = docs.select(F.struct(*rest).alias("_rest"), F.col(text).alias("_text"))
    fields = [*[pa.field(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], pa.field("groups", pa.string())]

    def run(batches):
        coder = _encoder(shared)
        for batch in pieces(batches, SLICE_BYTES, "_text"):
            made, _ = align_slice(coder, batch.column(1).to_pylist())
            made = pa.StructArray.from_arrays([pa.array(made[f.name], f.type) for f in fields], fields=fields)
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["_rest", "alignment"])

    kind = "struct<n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups:string>"
    schema = packed.select("_rest", F.expr(f"cast(null as {kind})").alias("alignment")).schema
    return packed.mapInArrow(run, schema).select("_rest.*", "alignment")


def _encoder(shared) -> Encoder:
    """The tokenizers, built once per Python worker."""
    if getattr(shared, "_coder", None) is None:
        shared._coder = Encoder(loaded(shared))
    return shared._coder


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(raw: bytes) -> pa.Table:
    return pa.ipc.open_stream(raw).read_all().combine_chunks()


def chunks(docs: DataFrame, pair: Pair, id_column: str, text: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of documents: one row (chunk, docs, held) each, and (chunk, place, pair, n) for each of its pairs.

    `n` is the number of the chunk's documents that hold the pair; `held` lists places and frequencies per document.
    """
    shared = share(docs.sparkSession, pair)
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"),
                         F.spark_partition_id().alias("part"))
    kinds = [("chunk", pa.int64()), ("docs", pa.binary()), ("held", pa.binary()), ("place", pa.int32()),
             ("pair", pa.int64()), ("n", pa.int64())]

    def batch_of(chunk, rows, **columns):
        whole = {"chunk": pa.array([chunk] * rows, pa.int64()), **columns}
        return pa.RecordBatch.from_arrays([whole.get(c, pa.nulls(rows, t)) for c, t in kinds], [c for c, _ in kinds])

    def chunk_rows(chunk, docs_of, held):
        held = pa.concat_tables(held)
        code = held["pair"].combine_chunks().dictionary_encode()
        partial = pa.table({"place": code.indices}).group_by("place", use_threads=False).aggregate([([], "count_all")])
        often = pa.table({"place": code.indices, "often": pc.cast(held["often"].combine_chunks(), pa.int32())})
        yield batch_of(chunk, 1, docs=pa.array([_packed(pa.concat_tables(docs_of))], pa.binary()),
                       held=pa.array([_packed(often)], pa.binary()))
        place = partial["place"].combine_chunks()
        yield batch_of(chunk, len(place), place=place, pair=pc.take(code.dictionary, place),
                       n=partial["count_all"].combine_chunks())

    def run(batches):
        coder = _encoder(shared)
        docs_of, held, size, number, part = [], [], 0, 0, 0
        for batch in pieces(batches, SLICE_BYTES, "text"):
            part = batch.column("part")[0].as_py()
            made, links = align_slice(coder, batch.column("text").to_pylist())
            pairs = pc.add(pc.shift_left(links["a"], 32), links["b"])
            own = pa.table({"row": links["row"], "pair": pairs}).group_by(["row", "pair"], use_threads=False).aggregate(
                [([], "count_all")]).sort_by([("row", "ascending"), ("pair", "ascending")])
            digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in made["groups"].to_pylist()]
            docs_of.append(pa.table({
                "id": batch.column("id"), **{c: pa.array(made[c]) for c in ("n_a", "n_b", "n_groups", "n_links")},
                "groups_sha256": pa.array(digests, pa.string()),
                "entries": pa.array(np.bincount(own["row"].to_numpy(), minlength=batch.num_rows).astype(np.int64))}))
            held.append(pa.table({"pair": own["pair"], "often": own["count_all"]}))
            size += sum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist())
            if size >= chunk_bytes:
                yield from chunk_rows((part << 32) + number, docs_of, held)
                docs_of, held, size, number = [], [], 0, number + 1
        if docs_of:
            yield from chunk_rows((part << 32) + number, docs_of, held)

    return source.mapInArrow(run, "chunk long, docs binary, held binary, place int, pair long, n long")


def pair_counts(chunked: DataFrame) -> DataFrame:
    """(pair, a, b, n, best): in how many documents a pair is linked, and whether that is the most of its A id."""
    counts = stored(chunked.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).select(
        "pair", F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).cast("int").alias("b"), "n"), "pairs")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))  # one row per id of A's vocabulary
    return counts.join(F.broadcast(most), "a").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def score(docs: DataFrame, pair: Pair, id_column: str = "doc_id", text: str = "text",
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """`id_column`, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    n_best counts the links whose pair has the highest corpus-wide count of its A id (ties included); count_sum adds the
    counts over the links. Rows without tokens (see `align`) have zeros and '' as digest. Repeated rows, and rows
    without id, count one by one. Other columns are left behind. An empty table gives an empty result.
    """
    kind = docs.schema[id_column].dataType
    made = stored(chunks(docs, pair, id_column, text, chunk_bytes), "chunks")
    fetched = made.filter("pair is not null").select("chunk", "place", "pair").join(
        pair_counts(made).select("pair", "n", "best"), "pair").select(F.col("chunk").alias("home"), "place", "n", "best")
    whole = made.filter("docs is not null").select("chunk", "docs", "held")

    def add(packed: pa.Table, counts: pa.Table) -> pa.Table:
        rows, held = _unpacked(packed["docs"][0].as_py()), _unpacked(packed["held"][0].as_py())
        n, best = np.zeros(counts.num_rows, np.int64), np.zeros(counts.num_rows, bool)
        at = counts["place"].to_numpy()
        n[at], best[at] = counts["n"].to_numpy(), counts["best"].to_numpy()
        place, often = held["place"].to_numpy(), held["often"].to_numpy().astype(np.int64)
        ends = np.cumsum(rows["entries"].to_numpy())
        starts = np.concatenate([[0], ends[:-1]])
        for name, value in (("n_best", best[place] * often), ("count_sum", n[place] * often)):
            running = np.concatenate([[0], np.cumsum(value)])
            rows = rows.append_column(name, pa.array(running[ends] - running[starts]))
        return rows.select(["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    schema = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    summed = whole.groupBy("chunk").cogroup(fetched.groupBy("home")).applyInArrow(add, schema)
    return summed.select(F.col("id").cast(kind).alias(id_column), "n_a", "n_b", "n_groups", "n_links", "n_best",
                         "count_sum", "groups_sha256")

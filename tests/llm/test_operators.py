"""Each operator against brute force or a public library, and on nulls, empty and long texts, ties, repeats, empty tables."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers as tokenizers_files
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bazaarlake.llm import (
    bpe, common, decontaminate, jaccard, language, neighbours, sharding, token_counts, toxicity, url_filter, warc,
)

RANKS = bpe.read_ranks(tokenizers_files.path("byte_bpe_50k.tiktoken"))
ODD = ["", "   ", "a", "hello  world\n\n  x", "naïve café — 東京 ½ ²", "it's we'll 'S  x", "<|endoftext|> in text",
       "x<|endoftext|><|endoftext|> y", "\x1c\x1f\x85 ᠎​ z", "aaaa" * 3000, "́é 🙂🙂", "12345 ٣٤ ⅷ", None]
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, lang="en"):
    return spark.createDataFrame([(k, t, lang, "s", 0) for k, t in enumerate(texts)], DOC)


def invented(seed, words, size=40):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdeèß") for _ in range(rng.randint(1, 7))) for _ in range(size)]
    return " ".join(rng.choice(stock) for _ in range(words))


def fuzzed(seed, n=60):
    rng = random.Random(seed)
    points = [*range(1, 0x250), *range(0x2000, 0x2070), 0x3000, 0xFEFF, 0x1F600, 0x0663, 0x216B, 0x0915]
    return "".join(chr(rng.choice(points)) for _ in range(n))


# Byte-level BPE.

def test_bpe_equals_library(spark):
    texts = ODD + [fuzzed(k) for k in range(200)]
    library = tiktoken.Encoding("own", pat_str=tokenizers_files.PATTERN, mergeable_ranks=RANKS, special_tokens={})
    got = {r["doc_id"]: r for r in bpe.round_trip(docs_of(spark, texts), RANKS, tokenizers_files.PATTERN).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        ids = library.encode_ordinary(text or "")
        assert got[k]["n_tokens"] == len(ids)
        assert got[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_clashing_columns_repeats_and_empty(spark):
    df = spark.createDataFrame([(1, "ab", "x"), (1, "ab", "x"), (None, None, None)], "doc_id long, text string, ids string")
    out = bpe.encode(df, RANKS, tokenizers_files.PATTERN)
    assert out.columns == ["doc_id", "text", "ids", "ids_sha256"] and out.count() == 3
    assert bpe.decode(out, RANKS).filter("doc_id is null").first()["decoded"] == b""
    assert bpe.encode(df.limit(0), RANKS, tokenizers_files.PATTERN).count() == 0


def test_perfect_hash_is_minimal():
    table = {str(k).encode(): k for k in range(5000)}
    made = bpe.PerfectHash(table)
    assert made.size == len(table) and sorted(made.values) == list(range(5000))
    assert all(made.get(k) == v for k, v in table.items())
    assert made.get(b"absent") == -1 and bpe.PerfectHash({}).get(b"a") == -1


# Token counts.

def test_counts_equal_library(spark):
    texts = ODD + [fuzzed(k) for k in range(200)] + [invented(3, 5000)]
    model = token_counts.read_model(tokenizers_files.path("byte_bpe_50k.json"))
    library = Tokenizer.from_str(model)
    rows = token_counts.count(docs_of(spark, texts).repartition(3), model, tokenizers_files.PATTERN).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        want = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (want, len(text.encode()), want > 512)


def test_counts_many_chunks_repeats_null_ids_empty(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "CHUNK_BYTES", 300)
    model = token_counts.read_model(tokenizers_files.path("byte_bpe_50k.json"))
    df = docs_of(spark, [invented(k, 30) for k in range(40)])
    df = df.union(df.limit(2)).union(spark.createDataFrame([(None, "a b", None, None, None)], DOC)).withColumn("n_tokens", F.lit(1))
    rows = token_counts.count(df, model, tokenizers_files.PATTERN).collect()
    assert len(rows) == 43 and [r["n_tokens"] for r in rows if r["doc_id"] is None] == [2]
    assert token_counts.count(df.limit(0), model, tokenizers_files.PATTERN).count() == 0


# Decontamination.

def brute_contamination(text, items, width=10):
    lower = {k: k + 32 for k in range(65, 91)}
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words, hit, who = word.findall((text or "").translate(lower)), set(), set()
    for item, body in items:
        own = word.findall((body or "").translate(lower))
        for k in range(max(1, len(own) - width + 1) if own else 0):
            window = own[k:k + width]
            for at in range(len(words) - len(window) + 1):
                if words[at:at + len(window)] == window:
                    hit.update(range(at, at + len(window)))
                    who.add(str(item))
    return len(words), len(hit), sorted(who)


@pytest.mark.parametrize("block", [1_000_000, 150])
def test_decontamination_equals_brute_force(spark, block):
    items = [(k, invented(k, n)) for k, n in enumerate([30, 12, 10, 3, 1])] + [(9, ""), (10, None), (2, "Ä,b É")]
    part = items[0][1].split()
    texts = [None, "", "!!", items[1][1].upper(), " ".join(part[3:20]) + " x " + " ".join(part[5:15]), invented(99, 400),
             "é " + ", ".join(items[2][1].split()) + "!", "ä B É", "Ä, b É", (items[0][1] + " y ") * 200]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of(spark, texts).withColumn("contamination", F.lit("old"))
    for r in decontaminate.scan(df, bench, block_bytes=block).collect():
        n, hit, who = brute_contamination(r["text"], items)
        c = r["contamination"]
        assert (c["n_words"], c["n_hit"], c["items"]) == (n, hit, who), r["doc_id"]
        inside = sum(len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r["text"][s["start"]:s["end"]])) for s in c["spans"])
        assert inside == hit
    none = decontaminate.report(docs_of(spark, texts), bench.limit(0))
    assert none.filter("contaminated").count() == 0 and none.count() == len(texts)
    assert decontaminate.report(docs_of(spark, []), bench).count() == 0


def test_items_without_id_and_repeated_documents(spark):
    bench = spark.createDataFrame([(None, "nameless item text"), ("b", None), ("c", "other words")], "item_id string, text string")
    docs = docs_of(spark, ["a nameless item text here", "other words and nameless item text", "clean", None])
    got = sorted(tuple(r)[:4] for r in decontaminate.report(docs.union(docs), bench).collect())
    assert got == sorted(2 * [(0, 5, 3, 0), (1, 6, 5, 1), (2, 1, 0, 0), (3, 0, 0, 0)])


# Toxicity.

def chain_by_force(texts, labels, asked, folds=3):
    """A chain of plain dense models with the same folds, features and steps, one row at a time."""
    names = sorted({c for ws in texts for w in ws for c in toxicity.features_of(w)})
    place = {c: k for k, c in enumerate(names)}
    size = 1 << toxicity.BITS

    def flat(ws):
        return [c for w in sorted(ws) for c in toxicity.features_of(w)]

    before, ahead = [[] for _ in texts], [[] for _ in asked]
    fold = [toxicity.xxhash.xxh32_intdigest(" ".join(sorted(ws))) % folds for ws in texts]
    for target in labels.T:
        def fitted(keep):
            rows = [r for k, i in enumerate(keep) for r in [k] * len(flat(texts[i]))]
            columns = [c for i in keep for c in flat(texts[i])]
            return toxicity.Linear().fit(np.array(rows), np.array(columns), np.array([before[i] for i in keep]).reshape(len(keep), -1),
                                         target[keep].astype(float))

        def chance(model, ws, dense):
            z = sum(model.weights[c] for c in flat(ws)) + sum(a * b for a, b in zip(model.dense, dense)) + model.bias
            return 1 / (1 + math.exp(-max(-30, min(30, z))))

        folded = [fitted([i for i in range(len(texts)) if fold[i] != f]) for f in range(folds)]
        whole = fitted(list(range(len(texts))))
        unseen = [chance(folded[fold[i]], texts[i], before[i]) for i in range(len(texts))]
        shown = [chance(whole, ws, dense) for ws, dense in zip(asked, ahead)]
        before, ahead = [[*b, u] for b, u in zip(before, unseen)], [[*b, s] for b, s in zip(ahead, shown)]
    return np.array(ahead), len(place) <= size


def test_chain_equals_plain_chain(monkeypatch):
    rng = random.Random(8)
    texts = [{f"w{rng.randint(0, 30)}" for _ in range(8)} | ({"vile"} if k % 3 == 0 else set()) for k in range(150)]
    texts += texts[:20]  # copies share a fold
    labels = np.array([[("vile" in t) and "w1" in t, ("vile" in t) and "w1" not in t, "vile" in t] for t in texts])
    asked = [{"vile", "w3"}, {"w1", "w2"}, {"vile", "w1"}, {"other"}]
    want, _ = chain_by_force(texts, labels, asked)
    chain = toxicity.Chain(texts, labels)
    by_text = {" ".join(sorted(a)): a for a in asked}
    monkeypatch.setattr(toxicity, "words_of", by_text.__getitem__)
    got = chain.predict(list(by_text))
    assert np.allclose(got, want, atol=1e-4)
    assert len(chain.models[-1].dense) == 2 and (chain.models[-1].dense != 0).any()


def test_toxicity_of_repeated_ids_long_texts_and_clashing_columns(spark):
    rows = [(k % 60, f"word{k % 7} common {'vile' if k % 4 == 0 else 'fine'}", "p") for k in range(240)]
    rows.append((900, "vile " + "common " * 200_000, "p"))
    df = spark.createDataFrame(rows, "doc_id long, text string, p_toxic string")
    marks = spark.createDataFrame([(k, k % 2, int(k % 4 == 0)) for k in range(60)] * 2, "doc_id long, quality int, toxic int")
    chain = toxicity.train(df, marks, toxicity.categories())
    got = toxicity.score(df, chain, list(toxicity.categories())).collect()
    assert len(got) == len(rows) and all(isinstance(r["p_toxic"], float) for r in got)
    assert {r["doc_id"] for r in got if r["toxic"]} == {k for k in range(60) if k % 4 == 0} | {900}


def test_toxicity_learns_and_handles_edges(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(900):
        bad = k % 6 == 0
        words = invented(k % 50, 40, 200).split() + (rng.sample(["vile", "rotten", "foul", "nasty"], 2) if bad else [])
        rng.shuffle(words)
        rows.append((k, " ".join(words), "en", "s", 0))
        if k < 600:
            labels.append((k, k % 2, int(bad)))
    rows += [(1000, None, None, None, None), (1001, "", "en", "s", 0), (1002, "123 !!", "en", "s", 0), (None, "vile", "en", "s", 0)]
    labels += [(None, 1, 1), (5000, 1, 1), (7, None, None)]
    df = spark.createDataFrame(rows, DOC)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.judge_documents(df, marks).collect()}
    assert len(got) == len(rows)
    assert all(got[k]["toxic"] == (k % 6 == 0) for k in range(600, 900))
    assert not any(got[k]["toxic"] or got[k]["p_toxic"] for k in (1000, 1001, 1002))
    odd = [got[k] for k in range(600, 900, 6)]
    assert all(0 <= r[c] <= 1 for r in odd for c in ("p_toxic", "p_toxic_low", "p_toxic_good"))
    assert toxicity.judge_documents(df, marks.limit(0)).filter("toxic").count() == 0
    assert toxicity.judge_documents(df.limit(0), marks).count() == 0


def test_chain_uses_out_of_fold_probabilities():
    texts = [{"a", f"w{k}"} if k % 2 else {"b", f"w{k}"} for k in range(90)]
    labels = np.array([[k % 2 == 1, k % 2 == 1] for k in range(90)])
    chain = toxicity.Chain(texts, labels)
    assert len(chain.models) == 2 and len(chain.models[1].dense) == 1 and chain.models[1].dense[0] > 0


# N-gram Jaccard join.

def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({k: k + 32 for k in range(65, 91)}))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in range(len(texts))}


def near_texts():
    texts, rng = [None, "", "  \t", "One two", "one  TWO", "one two three", invented(1, 6000, 900)], random.Random(3)
    long = texts[-1].split()
    long[17] = "changed"
    texts.append(" ".join(long))
    for seed, words in ((2, 60), (3, 200), (4, 9)):
        base = invented(seed, words, 300).split()
        for k in range(25):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, words // 40))):
                copy[rng.randrange(len(copy))] = f"x{k}"
            texts += [" ".join(copy)] * (1 + k % 2)
    common_line = invented(9, 12)
    texts += [common_line + " " + invented(100 + k, 20 + k % 30, 500) for k in range(120)]
    return texts


@pytest.mark.parametrize("block", [2_000, 7])
def test_jaccard_equals_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = near_texts()
    df = docs_of(spark, texts).withColumn("component_id", F.lit("old"))
    want = brute_components(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar(df).collect()}
    assert got == want and len(set(c for _, c in want.values())) < len(texts) - 60


def test_jaccard_edges(spark):
    rows = [(1, "a b c d e f", "", "", 0), (1, "a b c d e f", "", "", 0), (None, "a b c d e f", "", "", 0), (3, None, "", "", 0)]
    got = sorted(map(tuple, jaccard.report(spark.createDataFrame(rows, DOC)).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (3, 0, 3)], key=repr)
    assert jaccard.report(docs_of(spark, [])).count() == 0


def test_bounds_never_exclude_a_link():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 3000))
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = a[: max(1, int(n * rng.uniform(0.7, 1)))]
        a, b = np.unique(a), np.unique(b)
        for size in (jaccard.GROUPS, min(jaccard.fine_groups(len(a)), jaccard.fine_groups(len(b)))):
            x, y = (jaccard.fold(jaccard.unpack_counts(jaccard.pack_counts(s, jaccard.fine_groups(len(s)))), size) for s in (a, b))
            assert np.minimum(x, y).sum() >= len(np.intersect1d(a, b))


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (5, 5)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert {got[k] for k in range(41)} == {0} and {got[k] for k in (100, 101, 102)} == {100}


@pytest.mark.parametrize("order", ["shuffled", "smallest at the far end"])
def test_components_of_long_chains(spark, order):
    nodes = [*range(1, 300), 0]
    if order == "shuffled":
        random.Random(8).shuffle(nodes)
    edges = [*zip(nodes, nodes[1:]), (1000, 1001)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(nodes, 0), 1000: 1000, 1001: 1000}


# WARC revisits.

def test_revisits(spark):
    h = lambda **x: {k.replace("_", "-"): v for k, v in x.items()}
    rows = [
        ("a", "http://WWW.Ex.com:80/p/?utm_source=f&b=2&a=1#x", 10, 200, h(etag='"1"', content_length="9", date="d1")),
        ("b", "https://ex.com/p?a=1&b=2", 20, 304, h(etag='W/"1"', date="d2", content_length="0")),
        ("c", "https://ex.com/p?a=1&b=2", 20, 200, h(etag='"2"')),
        ("d", "https://ex.com/p?b=2&a=1", 30, 304, h(etag='"1"')),
        ("e", "https://ex.com/p?b=2&a=1", 30, 304, h(last_modified="m")),
        ("f", "https://ex.com/p", 30, 304, h(etag='"1"')),
        ("g", None, 30, 304, None), ("h", "https://ex.com/p", None, 304, h(etag="x")), ("i", "https://ex.com/p", 5, None, None),
        ("d", "https://ex.com/p?b=2&a=1", 30, 304, h(etag='"1"')),
    ]
    df = spark.createDataFrame(rows, "record_id string, url string, time long, status int, headers map<string,string>").withColumn(
        "outcome", F.lit("old"))
    out = warc.resolve(df)
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r["record_id"]].append(r)
    outcome = {k: v[0]["outcome"] for k, v in got.items()}
    assert outcome == {"a": "full", "b": "resolved", "c": "full", "d": "mismatch", "e": "unverified", "f": "orphan",
                       "g": "orphan", "h": "orphan", "i": "other"}
    b = got["b"][0]
    assert b["refers_to"] == "a" and b["merged_headers"] == {"etag": 'W/"1"', "content-length": "9", "date": "d2"}
    assert len(got["d"]) == 2 and b["canonical"] == "ex.com/p?a=1&b=2"
    assert warc.resolve(df.limit(0)).count() == 0
    bodies = warc.with_bodies(out.withColumn("body", F.when(F.col("status") == 200, "text")))
    assert bodies.filter("record_id = 'b'").first()["body"] == "text" and bodies.count() == len(rows)


def test_latest_before_over_many_partitions(spark):
    rng = random.Random(2)
    rows = [(k, "hot" if rng.random() < 0.7 else rng.choice("ab"), rng.randrange(200), rng.random() < 0.1) for k in range(1500)]
    df = spark.createDataFrame(rows, "id long, key string, t long, full boolean")
    got = {r["id"]: r["prev"] for r in warc.latest_before(df, "key", "t", "id", F.col("id"), F.col("full"), "prev").collect()}
    for k, key, t, _ in rows:
        old = [(u, i) for i, other, u, full in rows if full and other == key and u < t]
        assert got[k] == (max(old)[1] if old else None)


# Sharding.

def test_best_fit_decreasing_equals_single_items():
    rng = random.Random(1)
    for _ in range(30):
        sizes = [rng.randint(1, 40) for _ in range(rng.randint(1, 60))]
        left, want = [], []
        for size in sorted(sizes, reverse=True):
            fit = [(r, k) for k, r in enumerate(left) if r >= size]
            k = min(fit)[1] if fit else len(left)
            if not fit:
                left.append(50)
            left[k] -= size
            want.append((size, k))
        runs = sharding.best_fit_decreasing(dict(collections.Counter(sizes)), 50)
        got = [(r.size, r.shard) for r in runs for _ in range(r.last - r.first)]
        assert collections.Counter(got) == collections.Counter(want)


def test_sharding_keeps_groups_and_levels(spark):
    texts = [invented(k, 1 + k % 90) for k in range(300)] + ["same text"] * 200 + ["", "", None, None, "é" * 5000]
    rows = [(k, t, "en", "s", 0) for k, t in enumerate(texts)] + [(None, "x", "", "", 0), (3, texts[3], "", "", 0)]
    out = sharding.shard_documents(spark.createDataFrame(rows, DOC)).collect()
    assert len(out) == len(rows)
    slots, sums, place = collections.defaultdict(list), collections.Counter(), collections.defaultdict(set)
    for r in out:
        text = "x" if r["doc_id"] is None else texts[r["doc_id"]]
        assert r["size"] == len((text or "").encode()) + 1 and r["text_crc32"] == zlib.crc32((text or "").encode())
        slots[r["shard"]].append(r["slot"])
        sums[r["shard"]] += r["size"]
        place[text].add(r["shard"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(8))
    assert all(len(v) == 1 for v in place.values())
    others = sorted(sums.values())[:-1]  # the huge text has a shard of its own
    assert max(others) - min(others) <= 0.02 * max(others) + 200
    assert sharding.shard_documents(docs_of(spark, [])).count() == 0


def test_fixed_capacity(spark):
    groups = spark.createDataFrame([(k, 3 + k % 4) for k in range(100)], "g long, bytes long")
    out = sharding.pack(groups, "bytes", [F.col("g")], capacity=12).groupBy("shard").agg(F.sum("bytes").alias("b"))
    assert out.agg(F.max("b")).first()[0] <= 12 and out.count() <= math.ceil(450 / 12) + 2


def test_ranges_of_bins_equal_single_items():
    dice = random.Random(5)
    for _ in range(60):
        sizes = [dice.choice([1, 2, 3, 5, 8, 9, 21, 30, 70]) for _ in range(dice.randrange(1, 150))]
        bins = []
        for size in sorted(sizes, reverse=True):
            open_bins = [b for b in range(len(bins)) if bins[b] >= size]
            if open_bins:
                bins[min(open_bins, key=lambda b: (bins[b], b))] -= size
            else:
                bins.append(max(50, size) - size)
        counts = collections.Counter(sizes)
        loads, ranks = collections.Counter(), collections.defaultdict(set)
        for run in sharding.best_fit_decreasing(dict(counts), 50):
            loads[run.shard] += run.size * (run.last - run.first)
            ranks[run.size] |= set(range(run.first, run.last))
        assert ranks == {s: set(range(n)) for s, n in counts.items()}
        assert sorted(loads.values()) == sorted(max(50, loads[b]) - left for b, left in enumerate(bins))
    assert len(sharding.fill({7: 10**9, 3: 10**9}, 100)) < 20, "a billion groups, a few ranges"
    assert sharding.fill({7: 10**9, 3: 10**9}, 100, most=10**8 - 1) is None


def test_capacity_uses_exact_sizes(spark):
    """Four groups of 50,001 fill two shards of 100,002; clashing columns and missing sizes are kept."""
    groups = spark.createDataFrame(
        [(k, 50_001, "c", "r", k) for k in range(4)] + [(9, None, "c", "r", 5)], "g long, bytes long, _class string, _rank string, shard long")
    out = sharding.pack(groups, "bytes", [F.col("g")], capacity=100_002).collect()
    assert sorted(r["shard"] for r in out) == [0, 0, 1, 1, 2] and {(r["_class"], r["_rank"]) for r in out} == {("c", "r")}
    assert sharding.pack(groups.limit(0), "bytes", [F.col("g")], capacity=10).count() == 0


def test_positions_are_gapless(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("v"), "id")
    got = common.positions(df, [F.col("v"), F.col("id")], ["k"], "test", "at").collect()
    for k in range(3):
        own = sorted((r["at"], r["v"], r["id"]) for r in got if r["k"] == k)
        assert [a for a, _, _ in own] == list(range(len(own))) and own == sorted(own, key=lambda x: x[1:])


# URL filter.

def test_url_rules_and_model(spark):
    rows = [(k, f"http://good{k % 9}.site.com/de/{k}") for k in range(80)]
    rows += [(100 + k, f"http://x.example.com/en/{k}") for k in range(80)]
    rows += [(200 + k, f"http://casino{k % 9}.net/fr/{k}") for k in range(80)]
    rows += [(300, "http://good3.site.org/de/7"), (301, "http://casino4.org/fr/9"), (302, None), (303, "no scheme"), (304, ""),
             (305, "HTTP://A.B.COM:80?q"), (306, "http://www.example.com/en/x#y"), (307, "ftp://EXAMPLE.com/en/?a/b"), (305, "HTTP://A.B.COM:80?q")]
    out = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", F.lit(1)))
    got = collections.defaultdict(list)
    for r in out.collect():
        got[r["page_id"]].append(r)
    assert sum(map(len, got.values())) == len(rows) and len(got[305]) == 2
    assert got[0][0]["rule"] == "com/" and got[100][0]["rule"] == "example.com/en/" and got[306][0]["rule"] == "www.example.com/en/"
    assert got[200][0]["verdict"] == "block" and got[306][0]["path"] == "/en/x" and got[307][0]["host"] == "example.com"
    assert got[300][0]["verdict"] == "allow" and got[301][0]["verdict"] == "block"
    assert (got[302][0]["host"], got[302][0]["path"], got[302][0]["rule"]) == ("", "", None) == tuple(got[303][0][1:4])
    assert all(r["verdict"] in ("allow", "block") for v in got.values() for r in v)
    empty = url_filter.judge(spark.createDataFrame([], "page_id long, url string"))
    assert empty.count() == 0
    alone = url_filter.judge(spark.createDataFrame([(1, "http://a.org/x"), (None, "http://b.com/")], "page_id long, url string"))
    assert sorted(r["verdict"] for r in alone.collect()) == ["allow", "allow"]


def test_url_filter_runs_without_python(spark, plan):
    rows = spark.createDataFrame([(k, f"http://h{k}.org/{k}") for k in range(5)], "page_id long, url string")
    assert not re.search("Python|Arrow|Pandas", plan(url_filter.judge(spark.createDataFrame(rows.collect(), rows.schema))))


# Language identification.

def longest_match_phrases(text, sample):
    phrases, at = 0, 0
    while at < len(text):
        size = 0
        while at + size < len(text) and text[at:at + size + 1] in sample:
            size += 1
        phrases, at = phrases + 1, at + max(1, size)
    return phrases


def letters_only(text):
    return "".join(c if c.isalpha() else " " for c in re.sub(r"[^\W\d_]", lambda m: m[0].lower(), text))


@pytest.mark.parametrize("segment", [7, 100, 1024])
def test_phrases_are_those_of_one_greedy_parse(monkeypatch, segment):
    monkeypatch.setattr(language, "SEGMENT", segment)
    monkeypatch.setattr(language, "CHECKS", 0)
    rng = random.Random(segment)
    samples = {"x": ["".join(rng.choice("abc ") for _ in range(400))], "y": ["aaaaaaa" * 90], "z": ["привет мир " * 9, "日本語"]}
    parser = language.Parser(samples)
    texts = ["".join(rng.choice("abc qд語") for _ in range(rng.randint(1, 120))) for _ in range(40)]
    texts += ["".join(rng.choice("abc ") for _ in range(10_000)), "a" * 5_000, "aqaqaqa", "bzbzb", "привет " * 400,
              "".join(rng.choice("abcq") for _ in range(9_321)), "語" * 700, "x"]
    codes = [language.symbols(t) for t in texts]
    got = parser.phrases(codes)
    for k, name in enumerate(parser.names):
        own = b"\xff".join(language.symbols(p).tobytes() for p in samples[name]).decode("latin-1")
        assert got[:, k].tolist() == [longest_match_phrases(c.tobytes().decode("latin-1"), own) for c in codes], name
    assert parser.phrases([language.symbols("aqaqaqa")])[0, 0] == 7


def test_symbols_keep_every_letter():
    assert language.symbols("Ab, 12 Д-語!?").tobytes().decode() == "ab д 語 "
    assert language.symbols("").tobytes() == b"" and language.symbols("..").tobytes() == b" "


def test_three_scripts_stay_apart(spark):
    stock = {"en": "abcdefghij", "ru": "бгджзлпрст", "el": "αβγδεζηθικ", "ja": "日月火水木金土山川田", "uk": "бгґджзлпєї"}
    rng, rows = random.Random(2), []
    words = {lang: ["".join(rng.choice(cs) for _ in range(rng.randint(2, 6))) for _ in range(60)] for lang, cs in stock.items()}
    for k in range(300):
        lang = sorted(stock)[k % 5]
        rows.append((k, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(3, 400))), lang, "s", 0))
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict_documents(spark.createDataFrame(rows, DOC)).collect()}
    assert all(got[k] == sorted(stock)[k % 5] for k in range(300))


def test_language_edges_and_accuracy(spark):
    stock = {"en": 11, "de": 12, "fr": 13}
    rows = [(k, invented(stock[lang] * 1000 + 0, 300, 60)[k % 200:], lang, "s", 0) for k, lang in
            ((k, sorted(stock)[k % 3]) for k in range(240))]
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "123 ... !", "en", "s", 0), (903, "abc " * 20000, None, "s", 0),
             (None, "some text", "xx", "s", 0), (5, rows[5][1], "de", "s", 0)]
    df = spark.createDataFrame(rows, DOC).withColumn("score", F.lit("old"))
    got = language.predict_documents(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[k]["lang_pred"] for k in (900, 901, 902)] == ["und"] * 3 and by[903]["lang_pred"] in stock
    assert all(0 <= r["score"] <= 1 for r in got) and "xx" not in {r["lang_pred"] for r in got}
    assert all(by[k]["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k in range(240))
    fine = [by[k]["lang_pred"] == sorted(stock)[k % 3] for k in range(240) if by[k]["held_out"]]
    assert sum(fine) >= 0.95 * len(fine)
    nothing = language.identify(df, df.limit(0)).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    assert language.predict_documents(df.limit(0)).count() == 0


# Nearest neighbours.

def test_neighbours_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 3)
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", 50)
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.normal(size=8).astype(np.float32)], 0) for k in range(400)]
    rows += [(400 + k, rows[0][1], 0) for k in range(30)]  # ties
    rows += [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [1.0, None] * 4, 0), (1003, [math.nan] * 8, 0), (1004, [math.inf] * 8, 0),
             (1005, [], 0), (1100, [1.0, 2.0], 0), (1101, [1.5, 2.0], 0), (None, rows[1][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df.filter("vec_id % 100 = 0"), df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    fine = {k: np.array(v, np.float64) for k, v, _ in rows if k is not None and v and None not in v and np.isfinite(v).all() and any(v)}
    for query in (0, 100, 200, 300, 400, 1100):
        d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(fine[query], v))), k) for k, v in fine.items()
                   if k != query and len(v) == len(fine[query]))[:10]
        assert [(k, s) for _, k, s in got[query]] == [(k, s) for s, k in d]
        assert [r for r, _, _ in got[query]] == list(range(1, len(d) + 1))
    assert set(got) == {0, 100, 200, 300, 400, 1100}
    assert neighbours.nearest(df.limit(0), df).count() == 0


# Pipeline.

def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    base = [invented(k % 7, 80, 400) + f" tail{k}" for k in range(120)]
    item = invented(77, 25, 200)
    rows = [(k, t, "en", "s", len(t)) for k, t in enumerate(base)]
    rows += [(200, base[3], "en", "s", 1), (201, "123 !", "en", "s", 1), (202, item, "en", "s", 1), (203, None, None, "s", None)]
    spark.createDataFrame(rows, DOC).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(100)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES][2] == "ngram_jaccard_join" and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    want = {root for k, (_, root) in brute_components(base).items()}
    assert {r["doc_id"] for r in docs.collect()} == want
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in out.collect()} == want
    assert all(r["decoded_sha256"] == hashlib.sha256(base[r["doc_id"]].encode()).hexdigest() for r in out.collect())


def test_tiles_leave_out_what_lies_beyond_the_nearest_of_other_tiles():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(60, 8))
    vectors[30] = vectors[31]  # equal distances

    def packed(ids):
        own = vectors[ids]
        scale = np.abs(own).max(axis=1) / 127
        codes = np.rint(own / scale[:, None])
        return (np.array(ids), own, codes.astype(np.float32), scale, np.sqrt((own ** 2).sum(axis=1)),
                np.sqrt(((own - codes * scale[:, None]) ** 2).sum(axis=1)))

    queries, others = packed(list(range(10))), packed(list(range(5, 60)))
    plain = {q: (d.tolist(), o.tolist()) for q, d, o in neighbours.tile(queries, others, 4)}
    for q in range(10):
        apart = sorted((np.sqrt(sum((x - y) ** 2 for x, y in zip(vectors[q], vectors[o], strict=True))), o) for o in range(5, 60) if o != q)[:4]
        assert plain[q][1] == [o for _, o in apart] and np.allclose(plain[q][0], [d for d, _ in apart])
    reached = np.array([plain[q][0][1] for q in range(10)])
    near = {q: o.tolist() for q, _, o in neighbours.tile(queries, others, 4, reached)}
    assert all(near[q] == plain[q][1][:len(near[q])] and len(near[q]) >= 2 for q in range(10))
    assert sum(map(len, near.values())) < 40

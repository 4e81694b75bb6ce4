"""Tokenizer alignment, SimHash near-duplicates and periodic runs against brute force, and their edges."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as files
import pytest
import sentencepiece
import xxhash
from tokenizers import Tokenizer

from bazaarlake.llm import alignment, periodic, simhash

ODD = ["", "   ", "a", "hello  world\n\n  x", "naïve café — 東京 ½ ²", "it's we'll 'S  x", "<|endoftext|> <s> in </s> text<unk>",
       "\x1c\x1f\x85 ᠎​ z", "ﬁne ﬁ", "aaaa" * 3000, " lead  ▁ low", "́é 🙂🙂\x00", None, "the cat sat on the mat the cat"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# Tokenizer alignment.

def spans_of(tokens):
    ends = np.cumsum([len(t) for t in tokens]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def aligned_by_force(texts):
    a_model = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=files.path("piece_bpe_32k.model"))
    names = {k: t for t, k in a_model.get_vocab().items()}
    rows, held = [], collections.Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = a_model.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_model.encode(text) if text else []
        a_bytes = [bytes(alignment._BYTE_OF[c] for c in names[k]) for k in a]
        b_bytes = [bytes([int(b_model.id_to_piece(k)[3:5], 16)]) if b_model.is_byte(k)
                   else b_model.id_to_piece(k).replace("▁", " ").encode() for k in b]
        if not text or b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            rows.append(([], [], [], ""))
            continue
        sa, sb = spans_of(a_bytes), spans_of(b_bytes)
        links = [(x, y) for x, (p, q) in zip(a, sa) for y, (r, s) in zip(b, sb) if max(p, r) < min(q, s)]
        cuts = sorted({q for _, q in sa} & {s for _, s in sb})
        groups = ";".join(
            ",".join(str(k) for k, (p, q) in zip(a, sa) if low <= p and q <= high) + "|" +
            ",".join(str(k) for k, (p, q) in zip(b, sb) if low <= p and q <= high) for low, high in zip([0, *cuts], cuts))
        rows.append((a, b, links, groups))
        held.update(set(links))
    most = collections.defaultdict(int)
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    return [(len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(held[x] == most[x[0]] for x in links),
             sum(held[x] for x in links), hashlib.sha256(g.encode()).hexdigest() if g else "") for a, b, links, g in rows], \
        [g for *_, g in rows]


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair.read(files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model"), files.PATTERN)


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("limit", [1, 60, 8_000_000])
def test_alignment_equals_brute_force(spark, pair, limit):
    rng = random.Random(5)
    stock = ["wander", "über", "the", "naïve", "zqx", "counting", "of", "12", "don't", "東京", "\n", "la"]
    texts = [t if t is None or len(t) < 500 else t[:400] for t in ODD] + [
        " ".join(rng.choice(stock) for _ in range(rng.randint(1, 30))) for _ in range(40)]
    texts += texts[-5:]
    expected, groups = aligned_by_force(texts)
    df = frame(spark, texts)
    got = by_id(alignment.score(df, pair, chunk_bytes=limit))
    assert len(got) == len(texts)
    for k, row in enumerate(expected):
        assert tuple(got[k][c] for c in COLUMNS) == row, texts[k]
    if limit == 60:
        made = by_id(alignment.align(df.selectExpr("doc_id", "text", "1 as alignment", "text as _text", "2 as key"), pair))
        for k, row in enumerate(expected):
            assert tuple(made[k]["alignment"][c] for c in COLUMNS[:4]) == row[:4]
            assert made[k]["alignment"]["groups"] == groups[k]
            assert made[k]["key"] == 2 and made[k]["_text"] == texts[k]


def test_alignment_of_long_pieces_equals_the_libraries(spark, pair):
    texts = ["x" * 30_000, " " * 20_000 + "y", "ab" * 9_000 + " end"]
    model = Tokenizer.from_file(files.path("byte_bpe_50k.json"))
    got = by_id(alignment.score(frame(spark, texts), pair))
    for k, text in enumerate(texts):
        assert got[k]["n_a"] == len(model.encode(" " + text, add_special_tokens=False).ids)


def test_alignment_edges(spark, pair):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert alignment.score(empty, pair).count() == 0 and alignment.align(empty, pair).count() == 0
    twice = spark.createDataFrame([(None, "one two", 1), (3, None, 2), (3, None, 2), (3, "one two", 1)],
                                  "doc_id int, text string, n_a int")
    rows = sorted(map(tuple, alignment.score(twice, pair).select("doc_id", "n_a", "count_sum", "groups_sha256").collect()), key=repr)
    assert [r[0] for r in rows] == [3, 3, 3, None]
    assert rows[0][1:] == rows[1][1:] == (0, 0, "") or rows[1][1:] == rows[2][1:] == (0, 0, "")
    assert sorted(r[2] for r in rows) == [0, 0, 4, 4]  # two links, each in two documents
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r) for r in alignment.score(nothing, pair).collect()} == {(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2)}


# SimHash.

def fingerprint_by_force(text):
    words = (text or "").encode().translate(simhash.LOWER).split()
    shingles = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_force(ids, fps):
    label = {fp: fp for fp in fps}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    distinct = sorted(set(fps))
    for k, x in enumerate(distinct):
        for y in distinct[k + 1:]:
            if (x ^ y).bit_count() <= 2:
                label[root(x)] = root(y)
    least = {}
    for i, fp in zip(ids, fps):
        if i is not None:
            least[root(fp)] = min(i, least.get(root(fp), i))
    return [least.get(root(fp)) for fp in fps]


def near_copies(seed):
    rng = random.Random(seed)
    stock = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]
    texts = []
    for _ in range(12):
        words = [rng.choice(stock) for _ in range(rng.randint(4, 150))]
        texts.append(" ".join(words))
        for _ in range(14):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(stock)
            texts.append(("  " if rng.random() < .3 else " ").join(copy))
    return texts


@pytest.mark.parametrize("bucket", [1, 3, 40, 512])
def test_simhash_equals_brute_force(spark, bucket):
    texts = near_copies(bucket) + [t if t is None or len(t) < 500 else t[:90] for t in ODD] + ["A b C", "a B\tc", None]
    fps = [fingerprint_by_force(t) for t in texts]
    expected = components_by_force(range(len(texts)), fps)
    got = by_id(simhash.cluster(frame(spark, texts), bucket=bucket))
    assert [got[k]["fingerprint"] for k in range(len(texts))] == [f"{fp:016x}" for fp in fps]
    assert [got[k]["component_id"] for k in range(len(texts))] == expected
    assert len(set(expected)) < len(texts) - 30


def dense_ball(seed, n):
    rng = random.Random(seed)
    centre = rng.getrandbits(64)
    made = set()
    while len(made) < n:
        fp = centre
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            fp ^= 1 << bit
        made.add(fp)
    return [*made, *[rng.getrandbits(64) for _ in range(200)]]


@pytest.mark.parametrize("bucket", [4, 30, 512])
def test_links_of_dense_groups(spark, bucket):
    fps = dense_ball(bucket, 700)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bucket).collect()
    mask = (1 << 64) - 1
    assert all(((r["a"] & mask) ^ (r["b"] & mask)).bit_count() <= 2 for r in found)
    label = {fp: fp for fp in fps}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in found:
        label[root(r["a"] & mask)] = root(r["b"] & mask)
    groups = collections.defaultdict(set)
    for k, fp in zip(components_by_force(range(len(fps)), fps), fps):
        groups[k].add(root(fp))
    assert all(len(g) == 1 for g in groups.values()) and len({x for g in groups.values() for x in g}) == len(groups)


def test_links_are_few_in_a_dense_group(spark):
    fps = dense_ball(9, 600)
    signed = [fp - (1 << 64) if fp >> 63 else fp for fp in fps]
    found = simhash.candidates(spark.createDataFrame([(x,) for x in signed], "fp long"))
    assert found.count() <= 64 * len(fps)


def test_majority_over_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "HASHES", 7)
    texts = near_copies(3)[:20] + ["", "one"]
    got = simhash.majority([simhash.shingle_hashes(t) for t in texts])
    assert got.tolist() == [fingerprint_by_force(t) for t in texts]


def test_simhash_edges(spark):
    empty = spark.createDataFrame([], "doc_id int, text string, fp string")
    assert simhash.cluster(empty).count() == 0
    df = spark.createDataFrame([(None, "x y", "a"), (7, "x y", "b"), (7, "x y", "b"), (None, "lonely words here", "c"), (5, None, "d"),
                                (4, " ", "e")], "doc_id int, text string, fp string")
    got = sorted([(r["doc_id"], r["component_id"]) for r in simhash.cluster(df).collect()], key=repr)
    assert got == sorted([(None, 7), (7, 7), (7, 7), (None, None), (5, 4), (4, 4)], key=repr)


# Periodic runs.

def runs_by_force(words):
    found, n = [], len(words)
    for q in range(1, n // 4 + 1):
        k = 0
        while k + q < n:
            if words[k] != words[k + q]:
                k += 1
                continue
            start = k
            while k + q < n and words[k] == words[k + q]:
                k += 1
            length = k - start + q
            if length >= max(6, 4 * q) and not any(
                    all(words[start + j] == words[start + j + p] for j in range(length - p)) for p in range(1, q)):
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_by_force(words, runs):
    gone = {k for start, length, q in runs for k in range(start + q, start + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def repeating(seed):
    rng = random.Random(seed)
    words = []
    for _ in range(rng.randint(0, 6)):
        part = [rng.choice("abc"[:rng.randint(1, 3)]) for _ in range(rng.randint(1, 9))]
        if rng.random() < .4:
            part = part * rng.randint(1, 4) + [rng.choice("abx")]
        words += part * rng.randint(1, 7) + part[:rng.randint(0, len(part))]
    return words


def test_runs_equal_brute_force():
    texts = [repeating(k) for k in range(400)]
    got = periodic.runs_of([[w.encode() for w in t] for t in texts])
    for text, own in zip(texts, got):
        assert [tuple(r) for r in own.tolist()] == runs_by_force(text), text
        assert periodic.collapsed([w.encode() for w in text], own).decode() == collapsed_by_force(text, runs_by_force(text))
    assert sum(map(len, got)) > 400


def test_long_periodic_texts_take_little_work():
    rng = random.Random(1)
    block = [b"w%d" % rng.randrange(50) for _ in range(700)]
    found = periodic.runs_of([[b"a"] * 60_000, block * 60, [b"x%d" % (k % 9_000) for k in range(45_000)],
                              [w for k in range(8_000) for w in (b"v%d" % k, b"p", b"q", b"r", b"s", b"t")]])
    assert [r.tolist() for r in found] == [[[0, 60_000, 1]], [[0, 42_000, 700]], [[0, 45_000, 9_000]], []]


def planted(doc_id, text):
    words = (text or "").split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_report_equals_brute_force(spark):
    rng = random.Random(4)
    texts = [" ".join(repeating(k)) for k in range(120)] + ["", None, "  ", "a A a A a A a A", "x y " * 9] + [
        " \n".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    got = by_id(periodic.report(frame(spark, texts)))
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        words = planted(k, text)
        runs = runs_by_force(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert tuple(got[k])[1:] == (
            len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(collapsed_by_force(words, runs).encode()).hexdigest()), text


def test_runs_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert periodic.report(empty).count() == 0
    df = spark.createDataFrame([(None, "a b a b a b a b", "x", 1), (1, None, None, 2), (1, None, None, 2)],
                               "doc_id long, text string, runs string, _text int")
    rows = sorted(map(tuple, periodic.find(df).collect()), key=repr)
    assert [r[:2] for r in rows] == [(1, None), (1, None), (None, "a b a b a b a b")]
    assert rows[2][2:] == (1, 8, [(0, 8, 2)], "a b") and rows[0][2:] == (2, 0, [], "")
    clash = spark.createDataFrame([("z z z z z z z", 5)], "collapsed string, n_words int")
    assert tuple(periodic.find(clash, "collapsed").collect()[0]) == (7, [(0, 7, 1)], "z")

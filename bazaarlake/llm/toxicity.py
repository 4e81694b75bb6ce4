"""Toxicity by a classifier chain of linear models.

Categories are predicted one after the other: the model of a category sees the words of a text and the probabilities
of all categories before it. For training these probabilities are out of fold: each row's come from models that have
not seen the row, so a later model learns how good the earlier ones are on new text.

The models are logistic regressions over words and word beginnings, fitted on a bounded sample: at most SAMPLE_ROWS
labelled rows, one for each bucket of a hash over all labelled ids. Only sampled ids are broadcast (a bounded number),
so the other texts are not moved. The fitted chain is broadcast and scores every whole text in place.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import loaded, pieces, share, stored, texts_of, with_text

SAMPLE_ROWS = 12_000
FOLDS = 3
BITS = 18
BEGINNING = 5
CACHED_WORDS = 200_000
SLICE_BYTES = 4_000_000
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features_of(word: str) -> tuple[int, int]:
    """A word counts as itself and as its beginning."""
    mask = (1 << BITS) - 1
    return xxhash.xxh32_intdigest(word) & mask, xxhash.xxh32_intdigest("^" + word[:BEGINNING]) & mask


class Linear:
    """L2-regularised logistic regression on 0/1 word features and some dense ones."""

    def __init__(self, kept: int = 2_500, steps: int = 80, penalty: float = 0.3):
        self.kept, self.steps, self.penalty = kept, steps, penalty

    def fit(self, rows: np.ndarray, columns: np.ndarray, dense: np.ndarray, target: np.ndarray):
        """`rows`, `columns`: one entry per word feature of a text; only the most telling `kept` of them are used."""
        size, n, good = 1 << BITS, len(target), target.sum()
        self.weights, self.dense, self.bias = np.zeros(size), np.zeros(dense.shape[1]), 0.0
        if good == 0 or good == n:  # nothing to tell apart
            self.bias = 12.0 if good and n else -12.0
            return self
        seen = np.bincount(columns, minlength=size)
        hit = np.bincount(columns, target[rows], minlength=size)
        gap = (hit + 1) / (good + 2) - (seen - hit + 1) / (n - good + 2)
        worth = np.where(seen >= 3, np.abs(gap) / np.sqrt((seen + 1) / n), 0)
        chosen = np.sort(np.argsort(-worth, kind="stable")[:self.kept])
        place = np.full(size, -1, np.int64)
        place[chosen] = np.arange(len(chosen))
        use = place[columns] >= 0
        rows, columns = rows[use], place[columns[use]]
        w, d, b = np.zeros(len(chosen)), np.zeros(dense.shape[1]), np.log(good / (n - good))
        first, second = [np.zeros_like(x) for x in (w, d, np.zeros(1))], [np.zeros_like(x) for x in (w, d, np.zeros(1))]
        for step in range(1, self.steps + 1):
            z = np.bincount(rows, w[columns], minlength=n) + dense @ d + b
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
            slopes = (np.bincount(columns, error[rows], minlength=len(w)) + self.penalty * w,
                      dense.T @ error + self.penalty * d, np.array([error.sum()]))
            moves = []
            for k, slope in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.99 * second[k] + 0.01 * slope ** 2
                moves.append(0.1 * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-9))
            w, d, b = w - moves[0], d - moves[1], b - moves[2][0]
        self.weights[chosen], self.dense, self.bias = w, d, float(b)
        return self

    def chance(self, word_sum: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(word_sum + dense @ self.dense + self.bias, -30, 30)))


class Chain:
    """Linear models in the order of their categories, and the threshold of the last one, which decides."""

    def __init__(self, texts: Iterable[set[str]], labels: np.ndarray, folds: int = FOLDS):
        """Each text is turned into numbers as it comes, so that the words of only one text are held."""
        known, number, size, fold = {}, [], [], []
        for ws in texts:
            words = sorted(ws)
            number.append(np.array([known.setdefault(w, len(known)) for w in words], np.int32))
            size.append(2 * len(words))
            fold.append(xxhash.xxh32_intdigest(" ".join(words)) % folds)  # copies together
        pair = np.array([features_of(w) for w in known], np.int64).reshape(-1, 2)
        del known
        columns = pair[np.concatenate(number)].ravel() if number else pair.ravel()
        del number
        rows, fold = np.repeat(np.arange(len(size)), size), np.array(fold, np.int64)
        before = np.zeros((len(size), 0))
        self.models = []
        for target in labels.T.astype(np.float64):
            unseen = np.zeros(len(size))
            for k in range(folds):
                held = fold == k
                part = ~held
                renumber = np.cumsum(part) - 1
                inside = part[rows]
                model = Linear().fit(renumber[rows[inside]], columns[inside], before[part], target[part])
                sums = np.bincount(rows, model.weights[columns], minlength=len(size))
                unseen[held] = model.chance(sums, before)[held]
            self.models.append(Linear().fit(rows, columns, before, target))
            before = np.column_stack([before, unseen])
        self.threshold = self._best(before[:, -1], labels[:, -1]) if size else 1.0
        self.weights = np.column_stack([m.weights for m in self.models]).astype(np.float32)
        for model in self.models:
            del model.weights

    @staticmethod
    def _best(chance: np.ndarray, target: np.ndarray) -> float:
        """The threshold of the best F1 on out-of-fold probabilities, in the middle of the gap it falls into."""
        order = np.argsort(-chance, kind="stable")
        ordered, good = chance[order], np.cumsum(target[order])
        ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True))
        f1 = 2 * good[ends] / (ends + 1 + target.sum() + 1e-9)
        best = ends[int(np.argmax(f1))]
        below = ordered[best + 1] if best + 1 < len(ordered) else 0.0
        return float(np.clip((ordered[best] + below) / 2, 0.05, 0.95))

    def predict(self, texts: list[str]) -> np.ndarray:
        sums = np.zeros((len(texts), len(self.models)))
        known = self.__dict__.setdefault("known", {})
        for k, text in enumerate(texts):
            words = words_of(text)
            for word in words.difference(known):
                a, b = features_of(word)
                known[word] = None if not (self.weights[a].any() or self.weights[b].any()) else (a, b)
            told = [x for x in map(known.__getitem__, words) if x is not None]
            if told:
                sums[k] = self.weights[np.array(told).ravel()].sum(axis=0, dtype=np.float64)
            if len(known) > CACHED_WORDS:
                known.clear()
        before = np.zeros((len(texts), 0))
        for k, model in enumerate(self.models):
            before = np.column_stack([before, model.chance(sums[:, k], before)])
        return before


def sampled_ids(labels: DataFrame, id_column: str, categories: dict[str, Column]) -> DataFrame:
    """At most SAMPLE_ROWS labelled rows: of each hash bucket the id with the smallest hash."""
    code = F.xxhash64(id_column)
    rows = labels.select(F.col(id_column), *[F.coalesce(c, F.lit(False)).alias(n) for n, c in categories.items()]).filter(
        F.col(id_column).isNotNull())
    return rows.groupBy(F.pmod(code, F.lit(SAMPLE_ROWS)).alias("_bucket")).agg(
        F.min(F.struct(code.alias("_code"), F.struct(id_column, *categories).alias("_row"))).alias("_least")
    ).select("_least._row.*")


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, Column], id_column: str = "doc_id",
          text: str = "text") -> Chain:
    """A chain over `categories` (name to a condition on `labels`), from the labelled rows of `docs`.

    The last category decides, with what the models before it say. Missing texts teach nothing; rows that share an id
    teach once.
    """
    picked = stored(sampled_ids(labels, id_column, categories), "sample")
    rows = docs.select(id_column, F.col(text).alias("_text")).filter(F.col("_text").isNotNull()).join(
        F.broadcast(picked), id_column)  # at most SAMPLE_ROWS rows of numbers

    names = list(categories)

    def words(batches):
        for batch in pieces(batches, SLICE_BYTES, "_text"):
            made = ["\n".join(sorted(words_of(t))) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_key"), pa.array(made, pa.string()), *[batch.column(n) for n in names]],
                ["_key", "words", *names])

    kinds = ", ".join(f"{n} boolean" for n in names)
    distinct = rows.select(F.xxhash64(id_column).alias("_key"), "_text", *names).mapInArrow(
        words, f"_key long, words string, {kinds}")

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_key", "ascending"), ("words", "ascending")])
        labelled = np.column_stack([table[n].to_numpy(zero_copy_only=False) for n in names])
        chain = Chain((set(w.as_py().split("\n")) - {""} for w in table["words"]), labelled)
        return pa.table({"chain": pa.array([cloudpickle.dumps(chain)], pa.binary())})

    once = distinct.groupBy("_key").agg(F.min(F.struct("words", *names)).alias("_row")).select("_key", "_row.*")
    fitted = once.groupBy(F.lit("all").alias("_all")).applyInArrow(fit, "chain binary").collect()  # the sample is one bounded group
    return pickle.loads(fitted[0][0]) if fitted else Chain([], np.zeros((0, len(names)), bool))


def score(docs: DataFrame, chain: Chain, categories: list[str], text: str = "text", decision: str = "toxic") -> DataFrame:
    """Add a probability `p_<category>` per category and `decision`, whether the last reaches the threshold.

    A missing or empty text has no words: its probability 0 and it is not toxic. Without labelled rows nothing is
    toxic. Other columns pass through; columns with the added names are replaced.
    """
    shared = share(docs.sparkSession, chain)
    added = [f"p_{c}" for c in categories]
    rest = [c for c in docs.columns if c not in (*added, decision)]
    packed = with_text(docs, rest, text)

    def run(batches):
        made = loaded(shared)
        for batch in pieces(texts_of(batches, text), SLICE_BYTES, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            chances = made.predict(texts)
            chances[[_WORD.search(t) is None for t in texts]] = 0.0
            chances = np.round(chances, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c) for c in chances.T], pa.array(chances[:, -1] >= made.threshold)],
                ["_rest", *added, decision])

    schema = packed.select("_rest", *[F.lit(0.0).alias(a) for a in added], F.lit(True).alias(decision)).schema
    return packed.mapInArrow(run, schema).select(*[F.col("_rest")[c].alias(c) for c in rest], *added, decision)


def categories() -> dict[str, Column]:
    """Toxic in a text of low quality, toxic in an otherwise good text, and toxic at all, which comes last and decides."""
    toxic, good = F.col("toxic") == 1, F.col("quality") == 1
    return {"toxic_low": toxic & ~good, "toxic_good": toxic & good, "toxic": toxic}


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the probability of each category and `toxic` for every document."""
    named = categories()
    chain = train(docs, labels, named)
    return score(docs.select("doc_id", "text"), chain, list(named)).drop("text")

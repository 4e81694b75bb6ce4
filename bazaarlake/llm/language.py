"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text answers what the longest match of the coming text is. A text is
cut greedily into such matches (phrases; a symbol that the language lacks is a phrase of its own); the language whose
automaton needs the fewest phrases, in relation to what it needs for its own language, wins.

Symbols are the UTF-8 bytes of lower-case letters, with every run of other characters as one space. So any script has
its own symbols, no letter is merged with another, and an automaton is a table of its states and of the bytes that its
language uses. Texts are parsed whole, in lanes of SEGMENT bytes that advance together, one array operation a step. A
lane of a long text starts as if a phrase began there; afterwards the phrase that crosses the border is carried over it
until both parses begin a phrase at the same place, from where they agree. So the count is that of one parse.

The automata are fitted on a bounded sample: PASSAGES labelled texts for each of at most LANGUAGES languages, chosen by
hash, each whole or, if longer, a passage of PASSAGE_CHARS characters at a place that the hash chooses.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import loaded, pieces, share, texts_of, with_text

PASSAGES, CHECKS = 60, 12  # CHECKS of the passages calibrate a language, the others teach it
PASSAGE_CHARS, MODEL_CHARS, LANGUAGES = 1_000, 250_000, 100
SEGMENT = 1_024
SLICE_BYTES = 4_000_000
_BETWEEN = 0xFF  # between passages; no byte of UTF-8

_letters: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """Bytes of the letters of `text` in lower case; every run of other characters is one space."""
    if not _letters:  # one table per process
        _letters.append(np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000))
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters[0][points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    if len(keep):
        keep[0] = True
    made = np.where(letter, points, 32).astype("<u4")[keep]
    return np.frombuffer(made.tobytes().decode("utf-32-le").encode(), np.uint8)


def automaton(passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The suffix automaton of the passages: the column of each byte, and a flat table of rows times columns.

    row * width + column gives the next row * width, or 0 where nothing follows; column 0 is for bytes never seen.
    """
    used = np.unique(np.concatenate([*passages, np.array([_BETWEEN], np.uint8)]))
    column = np.zeros(256, np.uint8)
    column[used] = np.arange(1, len(used) + 1)
    width = len(used) + 1
    total = sum(map(len, passages)) + len(passages)
    table = np.zeros((2 * total + 2, width), np.int32)
    link, length = [-1], [0]
    last = 0
    for symbol in (int(s) for p in passages for s in (*column[p], column[_BETWEEN])):
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and not table[at, symbol]:
            table[at, symbol] = new
            at = link[at]
        if at >= 0:
            follow = int(table[at, symbol])
            if length[at] + 1 == length[follow]:
                link[new] = follow
            else:
                twin = len(link)
                link.append(link[follow])
                length.append(length[at] + 1)
                table[twin] = table[follow]
                while at >= 0 and table[at, symbol] == follow:
                    table[at, symbol] = twin
                    at = link[at]
                link[follow] = link[new] = twin
        last = new
    return column, (table[:len(link)] * width).ravel()


class Lanes:
    """Texts in lanes of SEGMENT bytes, side by side, the longest first."""

    def __init__(self, texts: list[np.ndarray]):
        pieces_of = [-(-len(t) // SEGMENT) for t in texts]
        owner = np.repeat(np.arange(len(texts)), pieces_of)
        first = np.concatenate([[0], np.cumsum(pieces_of)[:-1]]).astype(np.int64)
        part = np.arange(len(owner)) - np.repeat(first, pieces_of)
        size = np.minimum(SEGMENT, np.repeat([len(t) for t in texts], pieces_of).astype(np.int64) - part * SEGMENT)
        order = np.argsort(-size, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.size, self.owner, self.count = size[order], owner[order], len(texts)
        follows = np.flatnonzero(part > 0)
        self.after = np.full(len(order), -1, np.int64)  # the lane that goes on with the text
        self.after[place[follows - 1]] = place[follows]
        self.steps = int(size.max()) if len(size) else 0
        block = np.zeros((len(order), SEGMENT), np.uint8)
        for k, text in enumerate(texts):
            for j in range(pieces_of[k]):
                cut = text[j * SEGMENT:(j + 1) * SEGMENT]
                block[place[first[k] + j], :len(cut)] = cut
        self.block = np.ascontiguousarray(block.T[:self.steps])
        self.active = np.searchsorted(-self.size, -np.arange(self.steps), "left")  # lanes longer than a step

    def phrases(self, column: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The number of phrases of each text."""
        codes = column[self.block]
        state = np.zeros(len(self.size), np.int32)
        starts = np.zeros(self.block.shape, bool)  # where a phrase begins
        for t in range(self.steps):
            m = self.active[t]
            code = codes[t, :m]
            follow = table[state[:m] + code]
            missed = follow == 0
            starts[t, :m] = missed | (state[:m] == 0)
            follow[missed] = table[code[missed]]
            state[:m] = follow
        self._carry(codes, state, starts, table)
        return np.bincount(self.owner, starts.sum(axis=0), self.count).astype(np.int64)

    def _carry(self, codes: np.ndarray, state: np.ndarray, starts: np.ndarray, table: np.ndarray) -> None:
        """Take phrases over the borders of lanes, until every lane goes on from the true end of the one before."""
        before = np.flatnonzero((self.after >= 0) & (state != 0))
        while len(before):
            lane, now = self.after[before], state[before]
            changed = []
            for t in range(self.steps):
                ended = self.size[lane] <= t
                if ended.any():  # the lane ended inside the phrase that was carried into it
                    end, value = lane[ended], now[ended]
                    new = state[end] != value
                    state[end] = value
                    changed.append(end[new])
                    lane, now = lane[~ended], now[~ended]
                if not len(lane):
                    break
                code = codes[t, lane]
                follow = table[now + code]
                begins = (follow == 0) | (now == 0)
                agreed = begins & starts[t, lane]
                starts[t, lane] = begins
                follow[follow == 0] = table[code[follow == 0]]
                lane, now = lane[~agreed], follow[~agreed]
            else:
                new = state[lane] != now
                state[lane] = now
                changed.append(lane[new])
            moved = np.concatenate(changed) if changed else np.empty(0, np.int64)
            before = moved[self.after[moved] >= 0]


class Parser:
    def __init__(self, samples: dict[str, list[str]]):
        self.names = sorted(samples)
        coded = {n: [symbols(p) for p in samples[n]] for n in self.names}
        taught = {n: ps[:max(1, len(ps) - CHECKS)] for n, ps in coded.items()}
        self.automata = [automaton(taught[n]) for n in self.names]
        self.base = np.ones(len(self.names))
        for k, name in enumerate(self.names):
            check = coded[name][len(taught[name]):] or coded[name]
            phrases = Lanes(check).phrases(*self.automata[k]).sum()
            self.base[k] = max(phrases, 1) / max(1, sum(map(len, check)))

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text by each language."""
        lanes = Lanes(texts)
        return np.column_stack([lanes.phrases(*own) for own in self.automata])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        coded = [symbols(t or "") for t in texts]
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [k for k, c in enumerate(coded) if (c != 32).any()]
        if not known or not self.names:
            return names, scores
        rates = self.phrases([coded[k] for k in known]) / self.base
        order = np.argsort(rates, axis=1, kind="stable")
        rows = np.arange(len(known))
        best = rates[rows, order[:, 0]]
        second = rates[rows, order[:, 1]] if len(self.names) > 1 else np.full(len(known), np.inf)
        for k, name, a, b in zip(known, order[:, 0], best, second, strict=True):
            names[k], scores[k] = self.names[name], float(1 - a / b)
        return names, scores


def sample(labelled: DataFrame, text: str, lang: str) -> dict[str, list[str]]:
    """At most PASSAGES passages of distinct texts for each language; of more than LANGUAGES the commonest."""
    common = labelled.groupBy(lang).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), lang).limit(LANGUAGES)
    languages = [r[0] for r in common.collect()]
    size = max(1, min(PASSAGE_CHARS, MODEL_CHARS // (PASSAGES * max(1, len(languages)))))
    labelled = labelled.filter(F.col(lang).isin(languages))
    code = F.xxhash64(text)
    start = F.pmod(code, F.greatest(F.length(text) - size, F.lit(0)) + 1) + 1
    picked = labelled.select(
        F.col(lang).alias("lang"), F.pmod(F.shiftright(code, 8), F.lit(PASSAGES)).alias("slot"),
        F.struct(code.alias("code"), F.substring(F.col(text), start, F.lit(size)).alias("passage")).alias("row"),
    ).groupBy("lang", "slot").agg(F.min("row").alias("row"))
    samples: dict[str, list[str]] = {}
    for row in picked.orderBy("lang", "slot").collect():
        samples.setdefault(row["lang"], []).append(row["row"]["passage"])
    return samples


def identify(docs: DataFrame, labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Add `lang_pred` and `score` (0 to 1, how far the runner-up is behind) to `docs`, learnt from `labelled`.

    A text that is missing or has no letter, and any text when there is nothing to learn from, is `und` with score 0.
    A tie goes to the language that sorts first. With a single language the score is 1. Labelled rows without text or
    language teach nothing. Other columns pass through; columns with the two names are replaced.
    """
    usable = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    parser = Parser(sample(usable, text, lang))
    shared = share(docs.sparkSession, parser)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    packed = with_text(docs, rest, text)

    def run(batches):
        parser = loaded(shared)
        for batch in pieces(texts_of(batches, text), SLICE_BYTES, "text"):
            names, scores = parser.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["_rest", "lang_pred", "score"])

    schema = packed.select("_rest", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return packed.mapInArrow(run, schema).select(*[F.col("_rest")[c].alias(c) for c in rest], "lang_pred", "score")


def held_out(doc_id: str = "doc_id"):
    """Rows that never teach: crc32 of the id as text leaves 2 when divided by 4. A missing id does not teach either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    rows = docs.select("doc_id", "text", "lang", held_out().alias("held_out"))
    teachers = rows.filter(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    return identify(rows.select("doc_id", "text", "held_out"), teachers).select(
        "doc_id", "held_out", "lang_pred", "score")

"""Toxicity by a weighted lexicon.

Texts are folded (lower case, accents off, homoglyphs and digit substitutions undone), the lexicon is
matched with one Aho-Corasick automaton, hits inside an exception phrase are void, and the summed
weights are normalised by length before a logistic curve turns them into a score from 0 to 1.

The lexicon holds word beginnings and whole words: all whose share among toxic texts is above that among
clean ones by SURE standard errors of the log odds and a factor of exp(ODDS) at least. Exception phrases
are words, alone or with the word before or after, that hold a lexicon entry and yet are found more often
in clean texts. Weights, phrases and the curve are learned from a bounded sample of labelled rows
(SAMPLE_TOXIC and SAMPLE_CLEAN rows, lowest hash of the id first), all of whose words count; without
usable labels every text has one and the same score, below the threshold. Labels, language, source and
id never enter a score.

Defined results: a null text scores as the empty one; equal texts score equally; labels that disagree
on a doc_id count as toxic; a document without words has no hits; a very long text is one value, matched
in one pass; an empty table gives an empty result; other columns are kept, but one of the name of the
new column is replaced (score() takes another name for it).
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidebook.llm.common import fold, materialize

SAMPLE_TOXIC = 4000
SAMPLE_CLEAN = 8000
PREFIX = range(3, 9)  # lengths of word beginnings that may enter the lexicon
SURE = 2.5  # standard errors of its log odds that an entry stands out by
ODDS = 1.5  # log odds that an entry has at least
SEEN = 3  # clean texts that an exception phrase is found in at least
THRESHOLD = 0.3
BATCH = 2000  # rows a step of a Python worker
COUNTED = 100_000  # entries that a worker counts before it passes them on

# Letters of other scripts and signs that stand for a Latin letter.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j",
    "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe",
}
# Digits and signs read as letters; the signs only between letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l"}
_SIGN = re.compile(r"(?<=[^\W\d_])[@$!|](?=[^\W\d_])")


class _Fold(dict):
    """Translation table filled on demand: letters to folded letters, all else to a space."""

    def __missing__(self, code: int) -> str:
        ch = chr(code).lower()
        base = unicodedata.normalize("NFKD", ch)
        out = "".join(DIGITS.get(c, HOMOGLYPHS.get(c, c)) for c in base if not unicodedata.combining(c))
        out = "".join(c if c.isalpha() else " " for c in out) if out else ("" if base else " ")
        self[code] = out
        return out


_TABLE = _Fold()


def fold_text(text: str | None) -> str:
    """A text as folded words between single or repeated spaces."""
    text = text or ""
    if _SIGN.search(text):
        text = _SIGN.sub(lambda m: SIGNS[m.group()], text)
    return f" {text.translate(_TABLE)} "


@dataclass
class Model:
    """What a score needs: entries with weights, exception phrases, and the curve's coefficients."""

    lexicon: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-3.0, 1.5, 1.0)

    def automaton(self):
        out = ahocorasick.Automaton()
        for word, weight in self.lexicon.items():
            out.add_word(word, (len(word), word, weight))
        for phrase in self.exceptions:
            out.add_word(phrase, (len(phrase), None, 0.0))
        if len(out):
            out.make_automaton()
        return out


def spots(automaton, folded: str) -> list[tuple[int, int, str, float]]:
    """(start, end, entry, weight) of every lexicon match that no exception phrase covers."""
    if not len(automaton):
        return []
    found, void = [], []
    for end, (size, word, weight) in automaton.iter(folded):
        if word is None:
            void.append((end - size, end))
        else:
            found.append((end - size, end, word, weight))
    if void:
        void.sort()
        starts = [a for a, _ in void]
        reach = list(accumulate((b for _, b in void), max))
        found = [h for h in found if not (k := bisect_right(starts, h[0])) or reach[k - 1] < h[1]]
    return found


def hits(automaton, folded: str) -> list[tuple[str, float]]:
    """(entry, weight) of every lexicon match that no exception phrase covers."""
    return [(w, x) for _, _, w, x in spots(automaton, folded)]


def measures(found: list[tuple[str, float]], n_words: int) -> tuple[float, float]:
    """Weight of the distinct entries, and weight of all hits for each hundred words, both damped."""
    once = sum(dict(found).values())
    every = sum(x for _, x in found)
    return math.log1p(max(0.0, once)), math.log1p(100.0 * max(0.0, every) / max(1, n_words))


def _logistic(times, back, size: float, columns: int, y: np.ndarray, w: np.ndarray, l2: float, steps: int) -> np.ndarray:
    """Weighted logistic regression by accelerated gradient steps; weights are not negative, the last is the free intercept.

    times(beta) and back(residual) are products with the matrix, size the largest squared norm of its rows.
    """
    beta = np.zeros(columns, dtype=np.float64)
    look, t = beta.copy(), 1.0
    total = w.sum()
    rate = 4.0 / (size + l2)
    ridge = np.full(columns, l2 / total)
    ridge[-1] = 0.0
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(times(look), -30, 30)))
        step = look - rate * (back(w * (p - y)) / total + ridge * look)
        step[:-1] = np.maximum(step[:-1], 0.0)
        t_next = (1 + math.sqrt(1 + 4 * t * t)) / 2
        look = step + (t - 1) / t_next * (step - beta)
        beta, t = step, t_next
    return beta


def _phrases(folded: str, start: int, end: int) -> list[str]:
    """The word around a match, alone, with the word before it and with the one after it."""
    lo, hi = folded.rfind(" ", 0, start + 2) + 1, folded.find(" ", max(end, start + 2))
    word = folded[lo:hi]
    before, after = folded[:lo].rstrip(" "), folded[hi:].lstrip(" ")
    left = before[before.rfind(" ") + 1 :]
    right = after[: after.find(" ")]
    return [f" {word} ", *([f" {left} {word} "] if left else []), *([f" {word} {right} "] if right else [])]


def train(docs: DataFrame, labels: DataFrame, keep, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn a Model from the labelled rows for which the column keep (over doc_id) holds."""
    marked = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & keep)
        .groupBy("doc_id").agg(F.max("y").alias("y"))
    )
    counts = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return Model()

    def sample(y: int, n: int) -> DataFrame:
        return marked.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    # At most SAMPLE_TOXIC + SAMPLE_CLEAN rows of two numbers.
    chosen = F.broadcast(materialize(sample(1, SAMPLE_TOXIC).union(sample(0, SAMPLE_CLEAN)), "toxic-sample"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(chosen, "doc_id")
    rows = rows.groupBy(F.xxhash64("text").alias("h")).agg(F.max_by("text", "doc_id").alias("text"), F.max("y").alias("y"))
    rows = materialize(rows.select("text", "y"), "toxic-texts")

    def features(batches):
        def of(text):
            found = set()
            for word in set(fold_text(text).split()):
                found.add(f" {word} ")
                found.update(" " + word[:k] for k in PREFIX if k <= len(word))
            return found

        return _tally(batches, of)

    summed = lambda df: df.groupBy("f").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    counted = summed(rows.mapInArrow(features, "f string, neg bigint, pos bigint"))
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    odds = F.log((F.col("pos") + 0.5) / (n1 + 1.0)) - F.log((F.col("neg") + 0.5) / (n0 + 1.0))
    error = F.sqrt(1.0 / (F.col("pos") + 0.5) + 1.0 / (F.col("neg") + 0.5))
    # The sample is bounded, and so are the words of it that stand out.
    top = counted.withColumn("odds", odds).filter((F.col("odds") > ODDS) & (F.col("odds") > SURE * error)).orderBy("f").collect()
    known = {r["f"]: r for r in top}
    # A beginning already says what its longer forms say unless those are cleaner.
    names = [f for f, r in known.items() if not any((s := known.get(f[:k])) is not None and s["neg"] <= r["neg"] for k in range(4, len(f)))]
    if not names:
        return Model()
    bare = Model({x: 1.0 for x in names})

    def phrases(batches):
        auto = bare.automaton()

        def of(text):
            folded = fold_text(text)
            return {p for lo, hi, _, _ in spots(auto, folded) for p in _phrases(folded, lo, hi)}

        return _tally(batches, of)

    around = summed(rows.mapInArrow(phrases, "f string, neg bigint, pos bigint")).withColumn("odds", odds)
    exceptions = tuple(r["f"] for r in around.filter((F.col("odds") < 0) & (F.col("neg") >= SEEN)).orderBy("f").collect())
    plain = Model(bare.lexicon, exceptions)
    at = {x: i for i, x in enumerate(names)}

    def matched(batches):
        auto = plain.automaton()
        for b in batches:
            found, size = [], []
            for text in b.column(0).to_pylist():
                folded = fold_text(text)
                got: dict[int, int] = {}
                for w, _ in hits(auto, folded):
                    got[at[w]] = got.get(at[w], 0) + 1
                found.append([v for kv in sorted(got.items()) for v in kv])
                size.append(len(folded.split()))
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.list_(pa.int32())), pa.array(size, pa.int64())], names=["y", "found", "n"])

    sample_rows = rows.select("text", "y").mapInArrow(matched, "y int, found array<int>, n bigint").collect()  # SAMPLE_* rows of small numbers
    y = np.array([r["y"] for r in sample_rows], dtype=np.float64)
    weight = np.where(y == 1, counts[1] / max(1, n1), counts[0] / max(1, n0))
    # The matrix has a one for each entry found in a text, and one for the intercept.
    found = [np.array([*r["found"][::2], len(names)], dtype=np.int64) for r in sample_rows]
    col, row = np.concatenate(found), np.repeat(np.arange(len(y)), [len(f) for f in found])
    times = lambda beta: np.bincount(row, beta[col], minlength=len(y))
    back = lambda rest: np.bincount(col, rest[row], minlength=len(names) + 1)
    beta = _logistic(times, back, max(map(len, found)), len(names) + 1, y, weight, 1.0, 300)
    lexicon = {w: float(round(b, 6)) for w, b in zip(names, beta) if b > 0.05}
    if not lexicon:
        return Model()
    z = np.ones((len(y), 3))
    for i, r in enumerate(sample_rows):
        pairs = [(names[k], lexicon[names[k]], c) for k, c in zip(r["found"][::2], r["found"][1::2]) if names[k] in lexicon]
        z[i, :2] = measures([(w, x) for w, x, c in pairs for _ in range(c)], r["n"])
    curve = _logistic(lambda beta: z @ beta, lambda rest: z.T @ rest, float(np.max(np.einsum("ij,ij->i", z, z))), 3, y, weight, 1e-3, 4000)
    return Model(lexicon, exceptions, (float(curve[2]), float(curve[0]), float(curve[1])))


def _tally(batches, entries):
    """Counts of the entries of each text by label, in parts of COUNTED entries and one text's more; an entry can be in several parts."""
    seen: dict[str, list[int]] = {}
    for b in batches:
        for text, y in zip(b.column(0), b.column(1).to_pylist()):
            for f in entries(text.as_py()):
                seen.setdefault(f, [0, 0])[y] += 1
            if len(seen) > COUNTED:
                yield _counted(seen)
                seen = {}
    yield _counted(seen)


def _counted(seen: dict[str, list[int]]):
    return pa.RecordBatch.from_arrays(
        [pa.array(list(seen)), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], names=["f", "neg", "pos"]
    )


def score_text(model: Model, automaton, text: str | None) -> float:
    """The score of one text."""
    folded = fold_text(text)
    once, dense = measures(hits(automaton, folded), len(folded.split()))
    a, b, c = model.curve
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * once + c * dense))))


def score(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """docs with a column into, in place of one of that name; the model, bounded by the labelled sample, travels with the task."""
    docs = docs.drop(into)
    schema = StructType([*docs.schema.fields, StructField(into, DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches):
        auto = model.automaton()
        for b in batches:
            for lo in range(0, b.num_rows, BATCH):
                part = b.slice(lo, BATCH)
                s = pa.array([score_text(model, auto, t) for t in part.column(at).to_pylist()], pa.float64())
                yield pa.RecordBatch.from_arrays([*part.columns, s], names=[*part.schema.names, into])

    return docs.mapInArrow(run, schema)


def below(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of docs that score below the threshold, all columns kept whatever their names."""
    name = "score"
    while name in docs.columns:
        name += "_"
    return score(docs, model, text_col, name).filter(F.col(name) < THRESHOLD).select(*docs.columns)


def held_out(id_col: str = "doc_id"):
    """True for the quarter of ids that labels are never learned from."""
    return fold(id_col, 4) == 2

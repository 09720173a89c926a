"""Toxicity by class-conditional Kneser-Ney models of expressions with shared backoff counts."""
from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faremeter.llm.common import as_row, held_out_column, text_of, utf8

#: Most labelled documents of a class that the models are fitted on, chosen by a hash of the id.
MOST_PER_CLASS = 2500
#: Symbols of an n-gram: a symbol and up to seven before it in its expression.
ORDER = 8
#: Taken from an n-gram's count in a class, and from a shared continuation count.
CLASS_DISCOUNT = 2.0
SHARED_DISCOUNT = 0.75
#: Probability of a symbol that the sample never shows.
_UNSEEN = 1e-4
#: A difference counts up to this size, so that sums of its exponential stay finite.
_MOST_DIFFERENCE = 500.0
#: Expressions whose likelihood ratio a task remembers.
_REMEMBERED = 100_000
#: Slope and shift when the sample cannot tell the classes apart.
_UNDECIDED = (0.0, -math.inf)
_FOLD = 5
_PUNCTUATION = bytes(c for c in range(128) if not (48 <= c < 58 or 65 <= c < 91 or 97 <= c < 123 or c == 39))
#: A-Z to a-z, ASCII punctuation and control characters to a space.
_PLAIN = bytes(32 if c in _PUNCTUATION else c for c in range(256)).lower()


def tokens(text: bytes) -> list[bytes]:
    """The expressions of a text: its words in lower case without ASCII punctuation."""
    return text.translate(_PLAIN).split()


def grams(word: bytes, order: int = ORDER) -> list[str]:
    """For each symbol of a word and for its end, the symbol with those before it; ^ and $ are the ends."""
    s = f"^{word.decode('utf-8', 'replace')}$"
    return [s[max(0, j - order + 1) : j + 1] for j in range(1, len(s))]


@dataclass
class Models:
    """What both classes' models say, as differences of log-likelihoods, toxic minus ordinary.

    `seen` has them for n-grams of the sample. For other n-grams both classes leave the symbol to the shared counts, so
    only the weights that the context leaves to them differ: `left`, by context. slope and shift turn a text's evidence
    into a score.
    """

    seen: dict[str, float]
    left: dict[str, float]
    slope: float = 1.0
    shift: float = 0.0
    remembered: dict[bytes, float] = field(default_factory=dict)

    def plain(self) -> tuple:
        """What a broadcast holds: built-in types, which need no import of this class."""
        return self.seen, self.left, self.slope, self.shift

    def difference(self, word: bytes) -> float:
        """Log-likelihood of an expression in the toxic class less that in the ordinary class."""
        out = 0.0
        for gram in grams(word):
            d = self.seen.get(gram)
            out += self.left.get(gram[:-1], 0.0) if d is None else d
        return out

    def ratio(self, word: bytes) -> float:
        """Likelihood of an expression in the toxic class divided by that in the ordinary class."""
        out = self.remembered.get(word)
        if out is None:
            out = math.exp(max(-_MOST_DIFFERENCE, min(_MOST_DIFFERENCE, self.difference(word))))
            if len(self.remembered) >= _REMEMBERED:
                self.remembered.clear()
            self.remembered[word] = out
        return out

    def evidence(self, texts: list[bytes]) -> np.ndarray:
        """The logarithm of the mean likelihood ratio of all distinct expressions of each text; 0 without expressions.

        It is the log-likelihood ratio of a text in which any one expression, equally likely each, comes from the toxic
        class. Every expression counts, once as in the fit, and since their number divides, a longer text of the same kind
        has no more of it.
        """
        out, get = np.zeros(len(texts)), self.remembered.get
        for i, text in enumerate(texts):
            words = dict.fromkeys(tokens(text))  # in the order of the text, so that sums come out the same
            if words:
                out[i] = math.log(sum([r if (r := get(w)) is not None else self.ratio(w) for w in words]) / len(words))
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.evidence(texts) + self.shift, -500, 500)))


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, gram, n): n-grams of each batch by the number of documents whose words have them, word by word."""
    for batch in batches:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for toxic, text in zip(batch["toxic"].to_pylist(), utf8(batch["text"]), strict=True):
            found[toxic].update(set(tokens(text)))
        for toxic, words in found.items():
            counts: Counter = Counter()
            for word, n in words.items():
                for gram in grams(word):
                    counts[gram] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([toxic] * len(counts), pa.int32()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["toxic", "gram", "n"],
            )


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, toxic, text, part) of at most `most` labelled documents of each class outside the held-out fifth.

    They are the ones with the smallest hashes of their ids. Of several labels of a document the largest counts; labels of
    ids that no document has do not count. part 0, a quarter of each class and at least one of it, is for the scale of the
    scores, the rest for counts, so that both parts have each class that has two labelled documents.
    """
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out_column("doc_id", _FOLD, 0))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    picked = [
        known.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k in (0, 1)
    ]
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id"))
    dealt = picked[0].union(picked[1]).withColumn("part", ((place - 1) % 4).cast("int"))
    chosen = F.broadcast(dealt)  # at most 2 * most rows of three numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().cast("binary").alias("text"))
    return texts.join(chosen, "doc_id")


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_PER_CLASS) -> Models:
    """Count n-grams of both classes in Spark over the bounded sample, then derive the models from the counts.

    p(s | h) = max(c(h, s) - D, 0) / c(h) + freed(h) / c(h) * shared(s | h without its first symbol), c being a class's
    own counts. `shared` is the same for both classes: Kneser-Ney over continuation counts of the n-grams of both
    together. A rare expression therefore gets nearly the same probability in both. What is collected is bounded by the
    sample; a quarter of it is kept from counting and scales the scores.

    Where the sample cannot tell the classes apart every score is 0, below one half: a class has fewer than two labelled
    documents, or no expressions in one of the parts, or more evidence does not mean toxic in the part for the scale.
    """
    sample = labelled_sample(docs, labels, most).persist()
    try:
        counted = sample.filter("part <> 0").select("toxic", "text").mapInArrow(_count_grams, "toxic int, gram string, n long")
        one = lambda k: F.sum(F.when(F.col("toxic") == k, F.col("n")).otherwise(0))
        counts = counted.groupBy("gram").agg(one(0).alias("c0"), one(1).alias("c1")).toArrow()
        if not all(pc.sum(counts[c]).as_py() for c in ("c0", "c1")):
            return Models({}, {}, *_UNDECIDED)
        models = from_counts(counts["gram"].to_pylist(), counts["c0"].to_pylist(), counts["c1"].to_pylist())
        return _scaled(models, sample)
    finally:
        sample.unpersist()


def shared_probability(names: list[str]):
    """Kneser-Ney over the distinct n-grams of both classes: a function of an n-gram below the highest order."""
    continued: Counter = Counter()
    front = names
    while front:
        shorter = Counter(g[1:] for g in front if len(g) > 1)
        front = [g for g in shorter if g not in continued]
        continued.update(shorter)
    total: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for gram, n in continued.items():
        entry = total[gram[:-1]]
        entry[0] += n
        entry[1] += 1

    def p(gram: str) -> float:
        below = p(gram[1:]) if len(gram) > 1 else _UNSEEN
        entry = total.get(gram[:-1])
        if entry is None:
            return below
        own = max(continued.get(gram, 0) - SHARED_DISCOUNT, 0) / entry[0]
        return own + SHARED_DISCOUNT * entry[1] / entry[0] * below

    return p


def from_counts(names: list[str], ordinary: list[int], toxic: list[int]) -> Models:
    """The models from n-grams and their counts in both classes."""
    # by context: counts of both classes, then what the discount frees of them
    contexts: dict[str, list[float]] = defaultdict(lambda: [0.0, 0.0, 0.0, 0.0])
    for gram, *pair in zip(names, ordinary, toxic, strict=True):
        entry = contexts[gram[:-1]]
        for k in (0, 1):
            entry[k] += pair[k]
            entry[k + 2] += min(pair[k], CLASS_DISCOUNT)
    shared, seen = shared_probability(names), {}
    for gram, *pair in zip(names, ordinary, toxic, strict=True):
        entry, below, p = contexts[gram[:-1]], shared(gram[1:]) if len(gram) > 1 else _UNSEEN, [0.0, 0.0]
        for k in (0, 1):
            c = entry[k]
            p[k] = max(pair[k] - CLASS_DISCOUNT, 0) / c + entry[k + 2] / c * below if c else below
        seen[gram] = math.log(p[1] / p[0])
    weight = lambda entry, k: entry[k + 2] / entry[k] if entry[k] else 1.0
    left = {h: d for h, e in contexts.items() if (d := math.log(weight(e, 1) / weight(e, 0)))}
    return Models(seen, left)


def _scaled(models: Models, sample: DataFrame) -> Models:
    """Logistic regression of the label on the evidence, over the part of the sample that was not counted."""
    shipped = sample.sparkSession.sparkContext.broadcast(models.plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Models(*shipped.value)
        for batch in batches:
            evidence = own.evidence(utf8(batch["text"]))
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(evidence)], names=["toxic", "evidence"])

    rows = sample.filter("part = 0").select("toxic", "text").mapInArrow(run, "toxic int, evidence double").toPandas()
    slope, shift = logistic(rows["evidence"].to_numpy(float), rows["toxic"].to_numpy(float))
    if rows["toxic"].nunique() < 2 or slope <= 0:
        slope, shift = _UNDECIDED
    return replace(models, slope=slope, shift=shift)


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> tuple[float, float]:
    """Slope and shift by Newton's method, classes weighted alike and a small penalty on the slope.

    With fewer than two classes the score stays at one half for equal likelihoods: slope 1, shift 0.
    """
    if len(y) == 0 or y.min() == y.max():
        return 1.0, 0.0
    scale = max(float(x.std()), 1e-9)
    a = np.stack([x / scale, np.ones(len(x))], axis=1)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    ridge = np.diag([penalty, 1e-9])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        step = np.linalg.solve((a * (weight * p * (1 - p))[:, None]).T @ a + ridge, a.T @ (weight * (p - y)) + ridge @ beta)
        beta = beta - step
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def score(docs: DataFrame, models: Models) -> DataFrame:
    """`row` (a struct of all columns of docs) and score, 0 to 1, of each whole text.

    Only the text is an input, all of it however long. Null and empty text have no expression: evidence 0. Equal texts have
    equal scores, so ties and repeated rows come out as they go in. Other columns are kept in `row`, so their names cannot
    clash. No rows give no rows. The models are broadcast; their size is bounded by the sample they were fitted on.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(models.plain())

    @F.pandas_udf("double")
    def of_text(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Models(*shipped.value)
        for column in columns:
            yield pd.Series(own.scores(list(column)))

    return docs.select(as_row(docs), of_text(text_of().cast("binary")).alias("score"))


def not_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the models do not call toxic (score below one half), with the columns of docs.

    All documents stay if the labels cannot tell the classes apart, as `fit` says.
    """
    return score(docs, fit(docs, labels)).filter("score < 0.5").select("row.*")

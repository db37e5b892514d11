"""Toxicity severity by cumulative-link ordinal regression.

P(grade >= k) = sigmoid(x . w - theta_k) with theta_1 <= theta_2 <= ...: the thresholds share the
weights w.  x counts the distinct words of a text that have a feature: the word itself, or one of
its starts of ``STARTS`` letters.  The expected severity is the sum of P(grade >= k) over k.

The model is fitted on a bounded sample of labelled rows, ``SAMPLE``; features are counted, chosen by their likelihood ratio alone and
looked up by the executors, and the driver gets only the rows of chosen features of that sample.  The probability
from which a row is graded comes from models of parts of the sample, each on the rows that it was not fitted on.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from malgeul.llm.common import discard, materialize, require

STARTS = (4, 5, 6, 7)
#: Labelled rows that a model is fitted on, about; and folds that tell from which probability on a row is graded.
SAMPLE, FOLDS = 20_000, 3
#: Penalty of a squared weight for each feature that a row has on average, so that the scores of rows spread alike
#: whether few features or many are chosen.
RIDGE = 1e-4
_MEMO = 100_000
_LETTERS = regex.compile(r"\p{L}+")


def words(text: str | None) -> set[str]:
    return set(_LETTERS.findall((text or "").lower()))


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:k]}-" for k in STARTS if len(word) > k)]


@dataclass
class Model:
    """Weights by feature, ascending thresholds, and P(grade >= k) over which a row has grade k."""

    weights: dict[str, float]
    thresholds: list[float]
    cut: float = 0.5

    def scorer(self):
        memo: dict[str, float] = {}
        weight = self.weights.get
        # every feature of a word begins as the word does
        heads = {f[: STARTS[0]] for f in self.weights}

        def score(text: str | None) -> float:
            total = 0.0
            for word in sorted(w for w in words(text) if w[: STARTS[0]] in heads):
                value = memo.get(word)
                if value is None:
                    if len(memo) >= _MEMO:
                        memo.clear()
                    value = memo[word] = sum(weight(f, 0.0) for f in features_of(word))
                total += value
            return total

        return score

    def above(self, score: float) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        return [1 / (1 + math.exp(min(700.0, max(-700.0, t - score)))) for t in self.thresholds]


#: Rows as arrays: where the pairs of each row begin, and the features and counts of all pairs.
Design = tuple[np.ndarray, np.ndarray, np.ndarray]


def design_of(rows: list[list[tuple[int, int]]]) -> Design:
    pairs = np.array([p for r in rows for p in r], np.int64).reshape(-1, 2)
    return np.cumsum([0, *map(len, rows)]), pairs[:, 0], pairs[:, 1].astype(float)


def rows_of(design: Design, some: np.ndarray) -> Design:
    at, what, count = design
    use = np.repeat(some, np.diff(at))
    return np.concatenate([[0], np.cumsum(np.diff(at)[some])]), what[use], count[use]


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of runs of values, some of them empty."""
    out = np.zeros(len(at) - 1)
    full = np.diff(at) > 0
    if full.any():
        out[full] = np.add.reduceat(values, at[:-1][full])
    return out


def fit(design: Design, grades: list[int] | np.ndarray, names: list[str], steps: int = 150, ridge: float = RIDGE, rate: float = 0.1) -> Model:
    """The weights and thresholds of greatest penalised likelihood, by Adam steps."""
    y = np.array(grades, np.int64)
    k, n = max(1, int(y.max(initial=1))), len(y)
    if len(set(y.tolist())) < 2:
        level = 30.0 if not n or not y[0] else -30.0
        return Model({}, [level] * k)
    starts, what, x = design
    ridge *= max(1.0, len(what) / n)
    # the same pairs by feature
    order = np.argsort(what, kind="stable")
    who_by, x_by = np.repeat(np.arange(n), np.diff(starts))[order], x[order]
    starts_by = np.concatenate([[0], np.cumsum(np.bincount(what, minlength=len(names)))])
    w, first, gaps = np.zeros(len(names)), np.zeros(1), np.full(k - 1, 0.5)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (w, first, gaps)]
    at = np.arange(n)
    for step in range(1, steps + 1):
        theta = first[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
        s = _sums(x * w[what], starts)
        up = 1 / (1 + np.exp(np.clip(theta[None, :] - s[:, None], -50, 50)))
        full = np.hstack([np.ones((n, 1)), up, np.zeros((n, 1))])  # P(grade >= 0), ..., P(grade > k)
        slope = full * (1 - full)
        p = np.maximum(full[at, y] - full[at, y + 1], 1e-12)
        d_s = -(slope[at, y] - slope[at, y + 1]) / p / n
        d_theta = np.array([(np.where(y == j, slope[:, j], 0) / p - np.where(y == j - 1, slope[:, j], 0) / p).sum() / n for j in range(1, k + 1)])
        d_w = _sums(x_by * d_s[who_by], starts_by) + ridge * w
        d_gaps = np.array([d_theta[j:].sum() * math.exp(gaps[j - 1]) for j in range(1, k)])
        for param, grad, (m, v) in zip((w, first, gaps), (d_w, np.array([d_theta.sum()]), d_gaps), state, strict=True):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            param -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    theta = first[0] + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    return Model({f: float(v) for f, v in zip(names, w, strict=True) if abs(v) > 1e-6}, theta.tolist())


# ---- sample and features ----


def sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE) -> DataFrame:
    """``doc_id, text, label`` of about ``most`` labelled rows at most, picked by a hash of doc_id.  Rows
    without a label or doc_id are left out; of contradicting labels the greatest counts, and of texts with one doc_id the one that sorts first."""
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label is not null")
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    total = own.count()
    if total > most:
        own = own.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * most / total))
    met = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")  # about ``most`` rows
    return materialize(met.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled")


def choose_features(rows: DataFrame) -> list[str]:
    """The features that tell label 0 from others: those by which the log likelihood of the labels gains more than a parameter costs by
    the Bayesian information criterion, half the logarithm of the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"].to_pylist(), strict=True):
                seen[label > 0].update({f for w in words(text.as_py()) for f in features_of(w)})
        names = sorted(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([s[f] for f in names], pa.int64()) for s in seen)], ["feature", "clean", "graded"])

    counts = rows.select("text", "label").mapInArrow(run, "feature string, clean long, graded long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("graded").alias("graded"))
    total = rows.agg(F.count(F.when(F.col("label") == 0, 1)), F.count(F.when(F.col("label") > 0, 1))).first()
    if not total[0] or not total[1]:
        return []
    a, b = F.col("clean").cast("double"), F.col("graded").cast("double")
    term = lambda x, n: F.when(x > 0, x * F.log(x / n)).otherwise(0.0) + F.when(x < n, (n - x) * F.log((n - x) / n)).otherwise(0.0)
    gain = term(a, F.lit(float(total[0]))) + term(b, F.lit(float(total[1]))) - term(a + b, F.lit(float(total[0] + total[1])))
    best = counts.withColumn("gain", gain).filter(F.col("gain") > math.log(sum(total)) / 2)
    return sorted(r["feature"] for r in best.select("feature").collect())  # of a bounded sample


def _design(rows: DataFrame, names: list[str]) -> tuple[list, np.ndarray, np.ndarray, Design]:
    """(doc_ids, labels, numbers of words, design) of the sample, in order of doc_id."""
    place = {f: i for i, f in enumerate(names)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text in batch["text"]:
                own = words(text.as_py())
                counts = Counter(place[f] for w in own for f in features_of(w) if f in place)
                sizes.append(len(own))
                found.append([v for pair in sorted(counts.items()) for v in pair])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(sizes, pa.int32()), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "label", "words", "found"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    made = rows.select("doc_id", "label", "text").mapInArrow(run, f"doc_id {kind}, label int, words int, found array<int>").toArrow().sort_by("doc_id").combine_chunks()
    at = np.concatenate([[0], np.cumsum(made["found"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64) // 2
    pairs = made["found"].combine_chunks().flatten().to_numpy().reshape(-1, 2)
    return made["doc_id"].to_pylist(), made["label"].to_numpy(), made["words"].to_numpy(), (at, pairs[:, 0].astype(np.int64), pairs[:, 1].astype(float))


def grade(labels: np.ndarray, sizes: np.ndarray, design: Design, features: int) -> np.ndarray:
    """Grades for rows labelled 0 or 1: 0 stays; a 1 is grade 2 if its share of words with
    features that are commoner in such rows is the median of theirs or more, else grade 1."""
    at, what, count = design
    graded = labels > 0
    clean, hit = (np.bincount(rows_of(design, some)[1], minlength=features) for some in (~graded, graded))
    marked = hit * max(1, int((~graded).sum())) > 3 * clean * max(1, int(graded.sum()))
    share = _sums(np.where(marked[what], count, 0.0), at) / np.maximum(1, sizes)
    own = np.sort(share[graded & (share > 0)])
    middle = own[len(own) // 2] if len(own) else math.inf
    return np.where(~graded, 0, np.where(share >= middle, 2, 1))


def best_cut(scores: list[tuple[float, bool]]) -> float:
    """The probability that parts graded rows from others best, by F1, of (probability, graded) pairs that are not fitted on; between two
    that part them equally well, the middle of the widest gap."""
    order = sorted(scores, reverse=True)
    graded, hit, best = sum(g for _, g in order), 0, (0.0, 0.0, 0.5)
    for i, (p, g) in enumerate(order):
        hit += g
        after = order[i + 1][0] if i + 1 < len(order) else 0.0
        if after < p:
            f1 = 2 * hit / (i + 1 + graded) if graded else 0.0
            best = max(best, (round(f1, 9), math.log(p + 1e-9) - math.log(after + 1e-9), math.sqrt((p + 1e-9) * (after + 1e-9))))
    return best[2]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE) -> Model:
    """A model from 0/1 labels, graded by ``grade``; without both kinds of labels, or so few that none can be held out from a fit to both, everything is clean.

    Rows of ``docs`` without a label are not used; null and empty texts have no features; repeated rows count once; other columns are
    ignored; either table may be empty."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", label)
    rows = sample(docs, labels, label, most)
    names = choose_features(rows)
    if not names:
        discard(rows)
        return Model({}, [30.0, 30.0])
    ids, told, sizes, design = _design(rows, names)
    discard(rows)
    grades = grade(told, sizes, design, len(names))
    folds, scores = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in ids]), []
    for k in range(FOLDS):
        if len(set((grades[folds != k] > 0).tolist())) < 2:
            continue  # fitted on one kind of rows, it tells nothing of the others
        part = fit(rows_of(design, folds != k), grades[folds != k], names)
        weights = np.array([part.weights.get(f, 0.0) for f in names])
        at, what, count = rows_of(design, folds == k)
        scores += [(part.above(s)[0], bool(g > 0)) for s, g in zip(_sums(count * weights[what], at).tolist(), grades[folds == k], strict=True)]
    if not scores:  # nothing tells from where on a row is graded
        return Model({}, [30.0, 30.0])
    model = fit(design, grades, names)
    model.cut = best_cut(scores)
    return model


def score(docs: DataFrame, model: Model | Broadcast) -> DataFrame:
    """``docs`` with ``expected_severity`` and ``grade``, the greatest k for which P(grade >= k) is over the model's ``cut``.

    Null, empty and wordless texts have no features: the thresholds alone speak.  Every row is scored by
    itself; columns of these two names are replaced.
    """
    require(docs, "text")
    shared = model if isinstance(model, Broadcast) else docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("expected_severity", "grade")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        of = own.scorer()
        for batch in batches:
            above = [own.above(of(t.as_py())) for t in batch["text"]]
            made = [pa.array([round(sum(a), 6) for a in above], pa.float64()), pa.array([sum(p > own.cut for p in a) for a in above], pa.int32())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(batch.num_columns)), *made], [*batch.schema.names, "expected_severity", "grade"])

    schema = StructType([*docs.schema.fields, StructField("expected_severity", DoubleType()), StructField("grade", IntegerType())])
    return docs.mapInArrow(run, schema)

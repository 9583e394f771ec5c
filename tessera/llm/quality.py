"""Quality classifier: regularised quadratic discriminant on document statistics.

Each whole text becomes a short vector of transformed statistics.  Spark sums
counts, first and second moments per class over the labelled rows; the driver
gets these sums only (two classes by about a hundred numbers).  Each class
covariance is shrunk towards its own scaled identity and towards the pooled
covariance, its Cholesky factor is computed once, and a score is the logistic of
the difference of the two Gaussian log densities plus the log prior ratio.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tessera.llm.common import text_or_empty, written

STATS = ("length", "word_len", "repeats", "variety", "upper", "marks", "odd", "digits", "bars", "wide", "lines")
THRESHOLD = 0.7

_CLASS = np.zeros(256, np.int64)  # 0 other, by byte of the UTF-8 text
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
for _c in b".,;:?'\"()-":
    _CLASS[_c] = 4
for _c in b"!#$%&*+/<=>@[\\]^_`{}~":
    _CLASS[_c] = 5
_CLASS[ord("|")] = 6
_CLASS[0x80:] = 7
_CLASS[list(b" \t\r\n\x0b\x0c")] = 8


#: Added to the denominator of every share of words and characters: one odd word says little in a short text.
FEW_WORDS, FEW_CHARS = 30, 150


def _share(part: float, whole: float, few: float = 0.0) -> float:
    """Arcsine root of a share: steadies the variance of small shares."""
    return float(np.arcsin(np.sqrt(min(1.0, part / (whole + few))))) if whole > 0 else 0.0


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one whole text; zeros for an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATS)
    by = np.bincount(_CLASS, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=9)
    solid = float(by[:8].sum())
    letters = float(by[1] + by[2])
    distinct = len(set(words))
    same = sum(map(operator.eq, words, islice(words, 1, None)))
    lines = [x for x in text.split("\n") if x]
    return [
        float(np.log1p(n)),
        float(np.log(solid / n)),
        _share(same, n, FEW_WORDS),
        float(np.log(n / distinct) / np.log1p(n + FEW_WORDS)),
        _share(float(by[2]), letters, FEW_CHARS),
        _share(float(by[4]), solid, FEW_CHARS),
        _share(float(by[5]), solid, FEW_CHARS),
        _share(float(by[3]), solid, FEW_CHARS),
        _share(float(by[6]), solid, FEW_CHARS),
        _share(float(by[7] + by[0]), solid),
        _share(len(lines) - len(set(lines)), len(lines)),
    ]


def statistics_column(col):
    @pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return stats(col)


@dataclass
class Qda:
    """Means, Cholesky factors and log priors of the two classes (index 0 and 1)."""

    means: np.ndarray
    factors: np.ndarray
    priors: np.ndarray
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        dens = []
        for k in (0, 1):
            z = np.linalg.solve(self.factors[k], (x - self.means[k]).T)
            dens.append(self.priors[k] - 0.5 * (z * z).sum(0) - np.log(np.diag(self.factors[k])).sum())
        return 1.0 / (1.0 + np.exp(np.clip(dens[0] - dens[1], -700, 700)))


def fit_qda(rows: DataFrame, own: float = 0.005, pooled: float = 0.005, few: float = 0.5, floor: float = 1e-4) -> Qda:
    """(x array<double>, y 0/1) -> the fitted model.

    ``pooled`` shrinks each class covariance to the pooled one, ``own`` to the identity
    scaled by its mean variance; both grow by ``few`` times the number of statistics over the
    class's rows, as small classes need more.  ``floor`` is added to every variance.  A class with fewer
    than two rows leaves nothing to tell apart: the model then scores every text with the
    share of class 1 among the labelled rows (0.5 without any).
    """
    d = len(STATS)
    sums = [F.count(F.lit(1)).alias("n")] + [F.sum(F.col("x")[i]).alias(f"s{i}") for i in range(d)]
    sums += [F.sum(F.col("x")[i] * F.col("x")[j]).alias(f"m{i}_{j}") for i in range(d) for j in range(i, d)]
    got = {r["y"]: r for r in rows.groupBy("y").agg(*sums).collect()}  # two rows at most
    n = np.array([got[k]["n"] if k in got else 0 for k in (0, 1)], float)
    if n.min() < 2:
        return Qda(np.zeros((2, d)), np.stack([np.eye(d)] * 2), np.zeros(2), float(n[1] / n.sum()) if n.sum() else 0.5)
    means, covs = np.zeros((2, d)), np.zeros((2, d, d))
    for k in (0, 1):
        r = got[k]
        means[k] = [r[f"s{i}"] / n[k] for i in range(d)]
        second = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                second[i, j] = second[j, i] = r[f"m{i}_{j}"] / n[k]
        covs[k] = second - np.outer(means[k], means[k])
    both = (covs[0] * n[0] + covs[1] * n[1]) / n.sum()
    factors = []
    for k in (0, 1):
        more = few * d / n[k]
        to_both, to_own = min(0.9, pooled + more), min(0.9, own + more)
        c = (1 - to_both) * covs[k] + to_both * both
        c = (1 - to_own) * c + to_own * np.trace(c) / d * np.eye(d)
        factors.append(np.linalg.cholesky(c + floor * np.eye(d)))
    return Qda(means, np.stack(factors), np.log(n / n.sum()))


def held_out(col: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 4 == 2, F.lit(False))


def train(stats: DataFrame, labels: DataFrame) -> Qda:
    """(doc_id, x) and (doc_id, quality): learns from all labelled rows outside the fold."""
    known = labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("y")).filter("y IN (0, 1)").filter(~held_out())
    return fit_qda(stats.join(known, "doc_id").select("x", "y"))


def score_column(model: Qda, col):
    @pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(xs.to_numpy())) if len(xs) else np.zeros(0))

    return score(col)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """documents, labels -> doc_id, held_out, score, predicted; one row a document row.

    Null texts count as empty; empty texts get the score of the zero vector.  Rows with a
    null doc_id are scored, not learned from.  Labels other than 0 and 1 are ignored, and
    several labels of one id all count.
    """
    stats = written(docs.select("doc_id", statistics_column(text_or_empty()).alias("x")), "quality-stats")
    model = train(stats, labels)
    scored = stats.select("doc_id", held_out().alias("held_out"), score_column(model, F.col("x")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored at or above ``threshold``, with the columns of ``docs``."""
    ids = labels.select("doc_id").distinct()
    stats = written(docs.select("doc_id", statistics_column(text_or_empty()).alias("x")).join(ids, "doc_id", "left_semi"), "quality-labelled")
    model = train(stats, labels)
    good = score_column(model, statistics_column(text_or_empty())) >= threshold
    return docs.filter(good)

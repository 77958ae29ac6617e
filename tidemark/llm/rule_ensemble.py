"""Quality classifier by a sparse rule ensemble.

Statistics of whole texts feed shallow boosted trees; every path from a root is a conjunctive rule; a lasso
logistic fit keeps a sparse set of weighted rules, which are compiled into one Spark column expression.

Only the fit is driver-side, on at most `sample` labelled rows (those with the smallest hash of their id):
their statistics are collected, not their texts. Everything is scored.

Defined results: null and empty texts have zero statistics and get a score; ids labelled both ways take no
part in the fit; without labels of both kinds the score is the smoothed share of label 1 (0.5 with none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import batches, inner, small_batches

SAMPLE = 20_000
TREES, DEPTH, BINS = 24, 3, 48
L1 = 1.5e-3

STATISTICS = (
    "n_words", "word_length", "upper", "digits", "exclaims", "symbols", "bars", "stops", "line_words",
    "lines_short", "lines_repeated", "distinct", "same_as_last", "top_word", "shingles_repeated", "longest", "with_symbol",
)

_CLASSES = np.zeros((256, 6))
for _i, _set in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!", b"#$%&*+<=>@[\\]^_`{}~", b"|", b".,;:")):
    _CLASSES[list(_set), _i] = 1
_SYMBOLS = bytes(0x23 if _CLASSES[i, 3] or _CLASSES[i, 2] else (0x20 if i < 33 else 0x61) for i in range(256))


def statistics(text: str | None) -> tuple:
    """The STATISTICS of a whole text."""
    if not text:
        return (0.0,) * len(STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    upper, digits, exclaims, symbols, bars, stops = (np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASSES).tolist()
    words = raw.lower().split()
    n, size = len(words), len(raw)
    if not n:
        return (0.0,) * len(STATISTICS)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    same = sum(a == b for a, b in zip(words, words[1:]))
    shingles = len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    marked = sum(b"#" in w for w in raw.translate(_SYMBOLS).split())
    return (
        float(n), sum(map(len, words)) / n, upper / size, digits / size, exclaims / n, symbols / n, bars / n, stops / n, n / len(lines),
        sum(len(x) < 40 for x in lines) / len(lines), 1 - len(set(lines)) / len(lines), len(counts) / n, same / n, max(counts.values()) / n,
        1 - shingles / (n - 2) if n > 2 else 0.0, float(max(map(len, words))), marked / n,
    )


@F.pandas_udf(T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS]))
def _statistics(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS), dtype="float64")


@dataclass(frozen=True)
class Rule:
    """Conjunction of (statistic, above, threshold): value > threshold if above, else <=."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self, of) -> Column:
        out = F.lit(True)
        for name, above, threshold in self.parts:
            out = out & ((of(name) > threshold) if above else (of(name) <= threshold))
        return out

    def on(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for name, above, threshold in self.parts:
            v = x[:, STATISTICS.index(name)]
            out &= (v > threshold) if above else (v <= threshold)
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[float, Rule], ...]

    def column(self, of) -> Column:
        """Probability of label 1. of: name of a statistic to its column."""
        total = F.lit(float(self.intercept))
        for weight, rule in self.rules:
            total = total + F.when(rule.column(of), float(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _grow(x: np.ndarray, binned: np.ndarray, edges: list, g: np.ndarray, h: np.ndarray, rows: np.ndarray, path: tuple, depth: int, found: list, step: np.ndarray):
    """One tree by second-order gain; every node's path is noted."""
    total_g, total_h = g[rows].sum(), h[rows].sum()
    best = (1e-3, None, None)
    if depth and len(rows) >= 20:
        for f in range(x.shape[1]):
            size = len(edges[f]) + 1
            sums = np.cumsum(np.bincount(binned[rows, f], g[rows], size))[:-1]
            weights = np.cumsum(np.bincount(binned[rows, f], h[rows], size))[:-1]
            fine = (weights > 1e-2) & (total_h - weights > 1e-2)
            gain = np.where(fine, sums**2 / (weights + 1) + (total_g - sums) ** 2 / (total_h - weights + 1) - total_g**2 / (total_h + 1), 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), f, int(gain.argmax()))
    if best[1] is None:
        step[rows] = total_g / (total_h + 1)
        return
    _, f, b = best
    low = binned[rows, f] <= b
    for above, part in ((False, rows[low]), (True, rows[~low])):
        own = (*path, (STATISTICS[f], above, float(edges[f][b])))
        found.append(own)
        _grow(x, binned, edges, g, h, part, own, depth - 1, found, step)


def tree_rules(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> list[Rule]:
    """Distinct paths of boosted trees."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    share = y.mean()
    margin = np.full(len(y), np.log(share / (1 - share)))
    paths: list[tuple] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        _grow(x, binned, edges, y - p, p * (1 - p), np.arange(len(y)), (), depth, paths, step)
        margin += 0.3 * step
    return [Rule(p) for p in dict.fromkeys(tuple(sorted(set(p))) for p in paths)]


def lasso_logistic(r: np.ndarray, y: np.ndarray, l1: float = L1, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps."""
    n, m = r.shape
    r = np.concatenate([np.ones((n, 1)), r], axis=1)
    v = np.ones(m + 1)
    for _ in range(20):
        v = r.T @ (r @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / max(float(v @ (r.T @ (r @ v))), 1e-9)
    w = z = np.zeros(m + 1)
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(r @ z, -40, 40)))
        new = z - rate * (r.T @ (p - y)) / n
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - rate * l1, 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


def fit(x: np.ndarray, y: np.ndarray) -> RuleModel:
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return RuleModel(float(np.log(share / (1 - share))), ())
    rules = tree_rules(x, y)
    if not rules:
        return RuleModel(float(np.log(y.mean() / (1 - y.mean()))), ())
    intercept, weights = lasso_logistic(np.stack([r.on(x) for r in rules], axis=1).astype(np.float64), y)
    return RuleModel(intercept, tuple((float(w), r) for w, r in zip(weights, rules) if abs(w) > 1e-6))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label") -> RuleModel:
    """Fit on at most `sample` of the labelled documents. labels: id and label (0 or 1), whatever rows the fit may see."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(label_col).alias("_y"), F.max(label_col).alias("_z"))
    known = known.where("_y = _z").select(F.col(id_col).alias("_id"), "_y")
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    at = F.xxhash64(F.col("_id"), F.col("_text"))
    rows = texts.select("_y", "_id", at.alias("_at"), _statistics("_text").alias("s")).select("_y", "_id", "_at", "s.*")
    with batches(docs.sparkSession):
        rows = rows.orderBy("_at", "_id", *STATISTICS).limit(2 * sample).toArrow().to_pandas()  # an id may have several texts
    return fit(rows[list(STATISTICS)].to_numpy(np.float64), rows["_y"].to_numpy(np.float64))


def score(docs: DataFrame, model: RuleModel, out: str = "score", text_col: str = "text") -> DataFrame:
    """docs with the model's probability of label 1 for every whole text."""
    small_batches(docs.sparkSession)
    own = inner("statistics")
    rows = docs.withColumn(own, _statistics(F.col(text_col)))
    return rows.withColumn(out, model.column(lambda s: F.col(f"{own}.{s}"))).drop(own)

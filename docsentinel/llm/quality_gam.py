"""Quality classifier: a generalised additive model with pairwise interactions.

Features are read from the whole text. Each feature, and each chosen pair of features,
has a lookup table over bins, learnt by cyclic boosting of shallow trees; a score is the
logistic of the sum of the table entries.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.llm.common import give_back, held_out, map_rows, slices, table, utf8

FEATURES = (
    "log_words", "mean_word", "symbols", "punctuation", "upper", "digits", "other_bytes", "entropy",
    "repeated_next", "distinct_share", "top_share", "short_words", "symbol_words", "line_words",
    "repeated_lines", "upper_words",
)
_CLASS = np.zeros(256, np.int64)  # 0 letters and rest, 1 symbol, 2 punctuation, 3 upper, 4 digit, 5 not ASCII, 6 space
_CLASS[33:127] = 1
_CLASS[[ord(c) for c in ".,;:'\"?!-()"]] = 2
_CLASS[65:91] = 3
_CLASS[97:123] = 0
_CLASS[48:58] = 4
_CLASS[128:] = 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 6


def text_features(data: bytes) -> list[float]:
    """The values of ``FEATURES``; zeros for a text without words."""
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    kinds = np.bincount(_CLASS, weights=counts, minlength=7)
    solid = max(1.0, len(data) - kinds[6])
    share = counts[counts > 0] / len(data)
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = [x for x in data.split(b"\n") if x.strip()]
    distinct_lines = set(lines)
    letters = kinds[0] + kinds[3]
    return [
        float(np.log1p(n)),
        solid / n,
        kinds[1] / solid,
        kinds[2] / solid,
        kinds[3] / max(1.0, letters),
        kinds[4] / solid,
        kinds[5] / solid,
        float(-(share * np.log2(share)).sum()),
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(seen) / n,
        max(seen.values()) / n,
        sum(map(seen.__getitem__, (w for w in seen if len(w) <= 3))) / n,
        sum(map(seen.__getitem__, (w for w in seen if not w.isalnum() and w[0] < 128 and _CLASS[w[-1]] == 1))) / n,
        float(np.log1p(n / len(lines))),
        1.0 - sum(map(len, distinct_lines)) / sum(map(len, lines)),
        sum(map(seen.__getitem__, (w for w in seen if w.isupper()))) / n,
    ]


def _best_cuts(grad: np.ndarray, hess: np.ndarray, splits: int, ridge: float) -> list[int]:
    """Greedy cuts of a row of bins that gain most: a shallow tree over one feature."""
    g, h = np.concatenate([[0], np.cumsum(grad)]), np.concatenate([[0], np.cumsum(hess)])

    def worth(a, b):
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + ridge)

    cuts = [0, len(grad)]
    for _ in range(splits):
        best = (1e-9, 0)
        for a, b in zip(cuts, cuts[1:]):
            mid = np.arange(a + 1, b)
            if len(mid):
                gain = worth(a, mid) + worth(mid, b) - worth(a, b)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), int(mid[k])))
        if not best[1]:
            break
        cuts = sorted([*cuts, best[1]])
    return cuts


def _leaf_table(grad, hess, cuts, ridge) -> np.ndarray:
    out = np.empty(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = grad[a:b].sum() / (hess[a:b].sum() + ridge)
    return out


@dataclass
class PairwiseGam:
    """Lookup tables over feature bins: ``main`` by feature, ``pairs`` by two coarser bins."""

    bias: float
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    main: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    @staticmethod
    def fit(
        x: np.ndarray, y: np.ndarray, bins: int = 48, pair_bins: int = 10, rounds: int = 250, n_pairs: int = 8,
        pair_rounds: int = 80, rate: float = 0.15, splits: int = 3, ridge: float = 5.0,
    ) -> PairwiseGam:
        """Cyclic boosting: every round gives each feature (then each pair) one small tree."""
        share = (y.sum() + 1.0) / (len(y) + 2.0) if len(y) else 0.5
        bias = float(np.log(share / (1 - share)))
        d = x.shape[1]

        def cut(n):
            return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n + 1)[1:-1])) if len(x) else np.empty(0) for j in range(d)]

        edges, coarse = cut(bins), cut(pair_bins)
        main = [np.zeros(len(e) + 1) for e in edges]
        model = PairwiseGam(bias, edges, coarse, main, {})
        if not len(y) or y.min() == y.max():
            return model
        at = [np.searchsorted(edges[j], x[:, j], side="right") for j in range(d)]
        small = [np.searchsorted(coarse[j], x[:, j], side="right") for j in range(d)]
        margin = np.full(len(y), bias)

        def slopes():
            p = 1 / (1 + np.exp(-margin))
            return y - p, p * (1 - p)

        for _ in range(rounds):
            for j in range(d):
                g, h = slopes()
                size = len(main[j])
                grad, hess = np.bincount(at[j], g, size), np.bincount(at[j], h, size)
                step = rate * _leaf_table(grad, hess, _best_cuts(grad, hess, splits, ridge), ridge)
                main[j] += step
                margin += step[at[j]]

        def grid(a, b, g, h):
            shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
            cell = small[a] * shape[1] + small[b]
            size = shape[0] * shape[1]
            return cell, np.bincount(cell, g, size).reshape(shape), np.bincount(cell, h, size).reshape(shape)

        def quarter(grad, hess):
            """The best tree with one cut on each side: (gain, row cut, column cut)."""
            g = np.pad(grad.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
            h = np.pad(hess.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
            gi, hi, gj, hj = g[1:-1, -1:], h[1:-1, -1:], g[-1:, 1:-1], h[-1:, 1:-1]
            gc, hc, ga, ha = g[1:-1, 1:-1], h[1:-1, 1:-1], g[-1, -1], h[-1, -1]
            if not gc.size:
                return 0.0, 0, 0
            worth = sum(a * a / (b + ridge) for a, b in (
                (gc, hc), (gi - gc, hi - hc), (gj - gc, hj - hc), (ga - gi - gj + gc, ha - hi - hj + hc)
            ))
            k = np.unravel_index(int(worth.argmax()), worth.shape)
            return float(worth[k]), int(k[0]) + 1, int(k[1]) + 1

        g, h = slopes()
        ranked = sorted(combinations(range(d), 2), key=lambda p: -quarter(*grid(*p, g, h)[1:])[0])[:n_pairs]
        for p in ranked:
            model.pairs[p] = np.zeros((len(coarse[p[0]]) + 1, len(coarse[p[1]]) + 1))
        for _ in range(pair_rounds):
            for p in ranked:
                cell, grad, hess = grid(*p, *slopes())
                _, i, j = quarter(grad, hess)
                if not i:
                    continue
                step = np.zeros_like(grad)
                for rows in (slice(0, i), slice(i, None)):
                    for cols in (slice(0, j), slice(j, None)):
                        step[rows, cols] = rate * grad[rows, cols].sum() / (hess[rows, cols].sum() + ridge)
                model.pairs[p] += step
                margin += step.ravel()[cell]
        return model

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1: sums of table entries found by bin."""
        margin = np.full(len(x), self.bias)
        for j, t in enumerate(self.main):
            margin += t[np.searchsorted(self.edges[j], x[:, j], side="right")]
        for (a, b), t in self.pairs.items():
            i = np.searchsorted(self.coarse[a], x[:, a], side="right")
            j = np.searchsorted(self.coarse[b], x[:, b], side="right")
            margin += t[i, j]
        return 1 / (1 + np.exp(-margin))


def sample_labels(labels: DataFrame, label: str, folds: int, out: int, most: int, key: str = "doc_id") -> DataFrame:
    """(``doc_id``, ``y``): one row for each labelled key outside the held-out fold, at most
    ``most`` of them, the first by key hash. Several labels of a key count as their largest."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key, folds, out))
    one = known.groupBy(F.col(key).cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    out: int = 1,
    max_train_rows: int = 20_000,
    key: str = "doc_id",
    text: str = "text",
) -> PairwiseGam:
    """The model of at most ``max_train_rows`` labelled rows outside the held-out fold, fit on the driver."""
    chosen = F.broadcast(sample_labels(labels, "quality", folds, out, max_train_rows, key))  # bounded by the sample
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), utf8(text).alias("data")).join(chosen, "doc_id")

    def make():
        return lambda cols: {"doc_id": cols[0], "y": cols[2], "features": [text_features(x) for x in cols[1]]}

    seen = map_rows(rows.select("doc_id", "data", "y"), "doc_id long, y int, features array<double>", make)
    # One row a labelled key, however often it comes: at most ``max_train_rows`` reach the driver.
    one = seen.groupBy("doc_id").agg(F.min(F.struct("features", "y")).alias("r")).select("doc_id", "r.features", "r.y")
    train = sorted(map(tuple, one.collect()))
    x = np.array([r[1] for r in train], float).reshape(-1, len(FEATURES))
    return PairwiseGam.fit(x, np.array([r[2] for r in train], float))


def keep_good(docs: DataFrame, model: PairwiseGam, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose whole text scores at least ``threshold``."""
    hidden = "_data"
    while hidden in docs.columns:
        hidden += "_"

    def run(batches):
        for batch in batches:
            for part in slices(batch, 512):
                texts = [x.as_py() for x in part.column(hidden)]
                x = np.array([text_features(t) for t in texts], float).reshape(-1, len(FEATURES))
                good = part.filter(pa.array(model.score(x) >= threshold))
                yield good.drop_columns([hidden])
        give_back()

    return docs.withColumn(hidden, utf8(text)).mapInArrow(run, docs.schema)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 3,
    out: int = 1,
    max_train_rows: int = 20_000,
    threshold: float = 0.5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(``doc_id``, ``held_out``, ``score``, ``predicted``) of every whole text.

    Only text features enter a score. Null and blank texts score as texts without words;
    without usable labels every score is the same. Repeated rows are scored one by one;
    an empty table gives none; extra columns are ignored.
    """
    model = fit_quality(docs, labels, folds, out, max_train_rows, key, text)

    def make():
        def batch(cols):
            p = model.score(np.array([text_features(x) for x in cols[1]], float).reshape(-1, len(FEATURES)))
            return {"doc_id": cols[0], "held_out": cols[2], "score": p, "predicted": (p >= threshold).astype(np.int32)}

        return batch

    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), utf8(text).alias("data"), held_out(key, folds, out).alias("held_out")
    )
    return map_rows(rows, "doc_id long, held_out boolean, score double, predicted int", make)


def op5_quality(spark, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

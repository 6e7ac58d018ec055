"""Logistic regressions of many candidates and folds, fitted and scored in shared passes over the data.

The objective is that of ``pyspark.ml``'s LogisticRegression: mean log loss plus ``regParam`` times the elastic net of the
weights of scaled (not centred) features, no penalty on the intercept.  All (candidate, fold) models take their Newton steps together: one pass
adds up, for each, loss, gradient and Hessian over the rows of the other folds (matrix products of row blocks inside the tasks, sums in
Spark), and the driver solves the small penalised quadratic problems by coordinate descent.  A pass costs one job however many candidates and
folds there are.  What reaches the driver is (features + 1) ** 2 numbers per model: up to ``MAX_FEATURES`` features.

Scores are exact ROC AUCs of every model on its own fold, all in one job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurekit.plans import evaluate as ev

MAX_FEATURES = 200
STEPS, TOLERANCE = 50, 1e-9
_STRETCH = 4096


def _rows(batch: pa.RecordBatch, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, p)
    return x, batch.column(1).to_numpy(zero_copy_only=False).astype(float), batch.column(2).to_numpy(zero_copy_only=False).astype(int)


def _sum_arrays(df: DataFrame, by: str) -> DataFrame:
    """The sum of the arrays ``v`` of each group, element by element (inside the tasks first)."""
    return (df.select(by, F.posexplode("v").alias("k", "v")).groupBy(by, "k").agg(F.sum("v").alias("v"))
            .groupBy(by).agg(F.array_sort(F.collect_list(F.struct("k", "v"))).alias("v")).select(by, F.transform("v", lambda x: x["v"]).alias("v")))


def _scales(rows: DataFrame, p: int, folds: int) -> tuple[np.ndarray, np.ndarray]:
    """Standard deviation (sample) of each feature over the rows outside each fold, and their number."""
    aggs = [F.count(F.lit(1)).alias("n")] + [f.alias(f"{a}{j}") for j in range(p) for f, a in ((F.sum(F.get("x", F.lit(j))), "s"), (F.var_samp(F.get("x", F.lit(j))), "v"))]
    got = {r["fold"]: r for r in rows.groupBy("fold").agg(*aggs).collect()}      # a row per fold
    std, count = np.zeros((folds, p)), np.zeros(folds)
    for f in range(folds):
        parts = [r for k, r in got.items() if k != f]
        n = np.array([r["n"] for r in parts], float)
        count[f] = n.sum()
        for j in range(p):
            mean = np.array([r[f"s{j}"] for r in parts]) / n
            var = np.array([r[f"v{j}"] or 0.0 for r in parts])
            total = (n @ mean) / n.sum()
            std[f, j] = np.sqrt((((n - 1) * var).sum() + (n * (mean - total) ** 2).sum()) / max(n.sum() - 1, 1))
    return std, count


def _step(b: np.ndarray, g: np.ndarray, h: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Minimises the quadratic at ``b`` plus the elastic net of all but the last weight, by coordinate descent."""
    w, r = b.copy(), g.copy()                                   # r: gradient of the quadratic at w
    for _ in range(1000):
        most = 0.0
        for j in range(len(b)):
            a = h[j, j] + 1e-12
            z = a * w[j] - r[j]
            new = z / a if j == len(b) - 1 else np.sign(z) * max(abs(z) - l1, 0.0) / (a + l2)
            if new != w[j]:
                r += h[:, j] * (new - w[j])
                most = max(most, abs(new - w[j]))
                w[j] = new
        if most < 1e-12:
            break
    return w


def fit_logistic(rows: DataFrame, candidates: list[dict], p: int, folds: int) -> np.ndarray:
    """Weights (candidate, fold, feature and intercept) of ``rows``: ``x`` (array), ``y`` (0 or 1), ``fold``.  Candidates have ``regParam``, ``elasticNetParam``."""
    if p > MAX_FEATURES:
        raise ValueError(f"fit_logistic: {p} features, at most {MAX_FEATURES}")
    std, count = _scales(rows, p, folds)
    scale = np.where(std > 0, 1 / np.where(std > 0, std, 1), 0.0)               # constant features weigh nothing
    models = len(candidates) * folds
    fold = np.tile(np.arange(folds), len(candidates))
    reg = np.repeat([c.get("regParam") or 0.0 for c in candidates], folds)
    net = np.repeat([c.get("elasticNetParam") or 0.0 for c in candidates], folds)
    l1, l2 = reg * net, reg * (1 - net)
    size = p + 1

    def passed(weights: np.ndarray, live: np.ndarray) -> dict[int, np.ndarray]:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(live), 1 + size + size * size))
            for batch in batches:
                x, y, own = _rows(batch, p)
                for a in range(0, len(x), _STRETCH):
                    for k, m in enumerate(live):
                        use = own[a:a + _STRETCH] != fold[m]
                        z = np.column_stack([x[a:a + _STRETCH][use] * scale[fold[m]], np.ones(use.sum())])
                        eta = np.clip(z @ weights[m], -500, 500)
                        at = 1 / (1 + np.exp(-eta))
                        t = y[a:a + _STRETCH][use]
                        out[k, 0] += (np.logaddexp(0, eta) - t * eta).sum()
                        out[k, 1:1 + size] += z.T @ (at - t)
                        out[k, 1 + size:] += ((z * (at * (1 - at))[:, None]).T @ z).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(live.astype(np.int32)), pa.array(list(out), pa.list_(pa.float64()))], ["model", "v"])

        found = _sum_arrays(rows.mapInArrow(sums, "model int, v array<double>"), "model").collect()
        return {r["model"]: np.array(r["v"]) / count[fold[r["model"]]] for r in found}

    def penalty(m: int, w: np.ndarray) -> float:
        return l1[m] * np.abs(w[:-1]).sum() + l2[m] / 2 * (w[:-1] ** 2).sum()

    now, best = np.zeros((models, size)), [None] * models       # best: (objective, weights, gradient, Hessian)
    live = np.arange(models)
    for _ in range(STEPS):
        found = passed(now, live)
        going = []
        for m in live:
            v = found[m]
            value = v[0] + penalty(m, now[m])
            if best[m] is not None and value > best[m][0] + 1e-13:
                now[m] = (now[m] + best[m][1]) / 2              # too far: half of the step
                if np.abs(now[m] - best[m][1]).max() > TOLERANCE:
                    going.append(m)
                else:
                    now[m] = best[m][1]
                continue
            gained = np.inf if best[m] is None else best[m][0] - value
            best[m] = (value, now[m].copy())
            if gained < 1e-14:
                continue
            to = _step(now[m], v[1:1 + size], v[1 + size:].reshape(size, size), l1[m], l2[m])
            if np.abs(to - now[m]).max() > TOLERANCE:
                now[m] = to
                going.append(m)
        live = np.array(going, int)
        if not len(live):
            break
    weights = np.array([b[1] for b in best])
    weights[:, :-1] *= scale[fold]
    return weights.reshape(len(candidates), folds, size)


def fold_aucs(rows: DataFrame, weights: np.ndarray) -> dict[int, list[float]]:
    """ROC AUC of every candidate on every fold, of the model fitted without it."""
    n, folds, size = weights.shape

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, own = _rows(batch, size - 1)
            z = np.column_stack([x, np.ones(len(x))])
            for c in range(n):
                eta = (z * weights[c][own]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), c, np.int32)), pa.array(own.astype(np.int32)), pa.array(y.astype(np.int32)), pa.array(eta)],
                                                 ["candidate", "fold", "y", "score"])

    found = ev.roc_auc(rows.mapInArrow(scores, "candidate int, fold int, y int, score double"), "y", "score", ["candidate", "fold"]).collect()
    out: dict[int, list] = {c: [None] * folds for c in range(n)}
    for r in found:
        out[r["candidate"]][r["fold"]] = r["auc"]
    return out

"""Cross products of a whole design matrix, and the linear models that need nothing else.

``grams`` makes one matrix of [1, dense columns, one-hot slots, target] per fold in
one pass: a task adds its rows up in numpy (a one-hot part costs a few additions per
row, whatever its width), hands its matrices on as blocks of rows, of which only the
cells that aren't zero where those are few (a one-hot part is mostly zeros, and a task's
matrices must not grow the shuffle by folds x width^2 each), and blocks are
summed in two rounds, salted ones first, so no task meets the partial sums of all
others.  The driver gets folds x width^2 numbers; ``MAX_WIDTH`` is checked before.

Training moments of a fold are the total less the fold's, so ridge fits on any subset
of columns with any penalty (M2), their cross-validated errors, the register of
meta-models (E8, M12, B10) and the refit on all rows are matrix work on the driver:
no candidate needs another scan.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_WIDTH = 2500
BLOCK_ROWS = 128
BLOCKS = "fold int, block int, at binary, data binary"  # ``at``: the cells that ``data`` has; null: all


def _add(total: np.ndarray, z: np.ndarray, slots: np.ndarray) -> None:
    """Add the cross products of rows z = [1, dense, y] and their slots (-1: none) to a matrix."""
    d = z.shape[1] - 1  # 1 and the dense columns; y is the last of the matrix
    at = np.r_[0:d, len(total) - 1]
    total[np.ix_(at, at)] += z.T @ z
    for t in range(slots.shape[1]):
        has = slots[:, t] >= 0
        s = slots[has, t] + d
        part = np.zeros((len(total) - d - 1, z.shape[1]))
        np.add.at(part, s - d, z[has])
        total[d:-1, at] += part
        total[np.ix_(at, range(d, len(total) - 1))] += part.T
        for u in range(slots.shape[1]):
            both = has & (slots[:, u] >= 0)
            np.add.at(total, (slots[both, t] + d, slots[both, u] + d), 1.0)


def _packed(fold: int, block: int, x: np.ndarray) -> pa.RecordBatch:
    """A block of a matrix, without its zeros where that is shorter."""
    at = np.flatnonzero(x)
    few = 2 * len(at) < len(x)
    return pa.RecordBatch.from_arrays(
        [pa.array([fold], pa.int32()), pa.array([block], pa.int32()), pa.array([at.astype(np.int64).tobytes() if few else None], pa.binary()),
         pa.array([(x[at] if few else x).tobytes()], pa.binary())], names=["fold", "block", "at", "data"])


def _add_packed(total: np.ndarray, at: bytes | None, data: bytes) -> None:
    """Add a packed block to the flat block ``total``."""
    x = np.frombuffer(data, np.float64)
    if at is None:
        total += x
    else:
        total[np.frombuffer(at, np.int64)] += x


def _blocks(totals: Mapping[int, np.ndarray]):
    for fold, g in totals.items():
        for b in range(0, len(g), BLOCK_ROWS):
            yield _packed(fold, b // BLOCK_ROWS, g[b:b + BLOCK_ROWS].ravel())


def _summed(batches, size: int):
    """Blocks of one place added up, of matrices of ``size`` columns."""
    held: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for fold, block, at, data in zip(*[c.to_pylist() for c in batch.columns]):
            if (fold, block) not in held:
                held[fold, block] = np.zeros(min(BLOCK_ROWS, size - block * BLOCK_ROWS) * size)
            _add_packed(held[fold, block], at, data)
    for (fold, block), x in held.items():
        yield _packed(fold, block, x)


@dataclass
class Grams:
    """Matrices by fold over ``names`` = 1, dense columns, slots, target; values less ``center``."""

    names: list[str]
    folds: dict[int, np.ndarray]
    center: dict[str, float]

    def total(self) -> np.ndarray:
        return sum(self.folds.values())

    def training(self, fold: int) -> np.ndarray:
        return self.total() - self.folds[fold]


def grams(df: DataFrame, y: str, dense: Sequence[str], fold: str | None = None, slots: str | None = None, width: int = 0,
          columns: int = 0, center: bool = True) -> Grams:
    """Cross products per fold (one fold 0 where ``fold`` is None).

    ``slots`` is an array column with the one-hot position of each of ``columns`` nominal columns in
    0..width-1, or -1.  Rows without a target are passed over; a null or NaN in a dense column raises."""
    dense = list(dense)
    if (size := 2 + len(dense) + width) > MAX_WIDTH:
        raise ValueError(f"a design of {size} columns is wider than {MAX_WIDTH}")
    rows = df.filter(F.col(y).isNotNull())
    means = rows.agg(*[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate([*dense, y])]).first() if center else None
    shift = {c: (means[i] or 0.0) if means is not None else 0.0 for i, c in enumerate([*dense, y])}
    z = F.array(F.lit(1.0), *[F.col(f"`{c}`").cast("double") - F.lit(float(shift[c])) for c in [*dense, y]])
    picked = rows.select((F.col(fold).cast("int") if fold else F.lit(0)).alias("f"), z.alias("z"),
                         (F.col(slots) if slots else F.array().cast("array<int>")).alias("s"))
    n_z = 2 + len(dense)

    def run(batches):
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            f = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n_z)
            if np.isnan(x).any():
                raise ValueError("the design has a missing value")
            s = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, columns)
            for k in np.unique(f).tolist():
                totals.setdefault(k, np.zeros((size, size)))
                _add(totals[k], x[f == k], s[f == k])
        yield from _blocks(totals)

    partial = picked.mapInArrow(run, BLOCKS)
    spread = max(1, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = partial.withColumn("salt", F.spark_partition_id() % spread).repartition("fold", "block", "salt").drop("salt")
    added = lambda batches: _summed(batches, size)
    found = salted.mapInArrow(added, BLOCKS).repartition("fold", "block").mapInArrow(added, BLOCKS).collect()
    folds: dict[int, np.ndarray] = {}
    for r in found:
        g = folds.setdefault(r["fold"], np.zeros((size, size)))
        _add_packed(g.ravel()[r["block"] * BLOCK_ROWS * size:(r["block"] + 1) * BLOCK_ROWS * size], r["at"], r["data"])
    names = ["1", *dense, *[f"slot{i}" for i in range(width)], y]
    return Grams(names, folds, {"1": 0.0, **shift})


def ridge(g: np.ndarray, columns: Sequence[int], alpha: float) -> np.ndarray:
    """[intercept, coefficients] of the columns, the intercept free; Cholesky, or least norm where singular."""
    n = g[0, 0]
    if n <= 0:
        raise ValueError("no rows to fit")
    c, y = list(columns), len(g) - 1
    mean, my = g[0, c] / n, g[0, y] / n
    a = g[np.ix_(c, c)] - n * np.outer(mean, mean) + alpha * np.eye(len(c))
    b = g[c, y] - n * mean * my
    try:
        low = np.linalg.cholesky(a)
        beta = np.linalg.solve(low.T, np.linalg.solve(low, b))
    except np.linalg.LinAlgError:
        beta = np.linalg.lstsq(a, b, rcond=None)[0]
    return np.r_[my - mean @ beta, beta]


def sse(g: np.ndarray, columns: Sequence[int], beta: np.ndarray) -> float:
    """Squared error over a matrix's rows of the fit ``beta`` of the columns."""
    at, y = [0, *columns], len(g) - 1
    return float(max(0.0, g[y, y] - 2 * beta @ g[at, y] + beta @ g[np.ix_(at, at)] @ beta))


def _uncentred(gs: Grams, columns: Sequence[int], beta: np.ndarray) -> np.ndarray:
    """The coefficients for columns and target as they are."""
    shift = np.array([gs.center.get(gs.names[c], 0.0) for c in columns])
    return np.r_[beta[0] - beta[1:] @ shift + gs.center.get(gs.names[-1], 0.0), beta[1:]]


def ridge_design_oof(df: DataFrame, key: str, y: str, dense: Sequence[str], fold: str, slots: str | None = None, width: int = 0,
                     columns: int = 0, alpha: float = 10.0, out: str = "pred") -> DataFrame:
    """M2 + E4: every row scored by the ridge fit of the other folds on the whole design."""
    dense = list(dense)
    gs = grams(df, y, dense, fold, slots, width, columns)
    every = range(1, 1 + len(dense) + width)
    rows = [(k, _uncentred(gs, every, ridge(gs.training(k), every, alpha)).tolist()) for k in sorted(gs.folds)]
    # k rows of bounded width
    coefs = df.sparkSession.createDataFrame(rows, "__fold int, __b array<double>")
    j = df.join(F.broadcast(coefs), F.col(fold) == F.col("__fold"))
    return j.select(key, fold, y, design_score(dense, F.col("__b"), slots).alias(out))


def design_score(dense: Sequence[str], b: Column, slots: str | None = None) -> Column:
    """Intercept plus coefficients (array ``b``) times dense columns and one-hot slots."""
    score = F.get(b, 0)
    for i, c in enumerate(dense):
        score = score + F.get(b, i + 1) * F.col(f"`{c}`").cast("double")
    if slots is None:
        return score
    return score + F.aggregate(F.col(slots), F.lit(0.0), lambda acc, s: acc + F.when(s >= 0, F.get(b, s + len(dense) + 1)).otherwise(0.0))


def nominal_slots(df: DataFrame, dictionary: DataFrame, cols: Sequence[str], out: str = "slots") -> tuple[DataFrame, int]:
    """J7 for several nominal columns: an array of positions in one row of one-hot columns, and its width."""
    from .prep import onehot_slots
    sizes = {r.feature: r.n for r in dictionary.groupBy("feature").agg((F.max("slot") + 1).alias("n")).collect()}
    cur, parts, offset = df, [], 0
    for i, c in enumerate(cols):
        cur = onehot_slots(cur, dictionary, c).drop("n_slots").withColumnRenamed("slot", f"__s{i}")
        parts.append(F.when(F.col(f"__s{i}") >= 0, F.col(f"__s{i}") + offset).otherwise(-1).cast("int"))
        offset += sizes.get(c, 0)
    return cur.withColumn(out, F.array(*parts)).drop(*[f"__s{i}" for i in range(len(cols))]), offset


# ------------------------------------------------------------------ register of meta-models

def stack_register(oof: DataFrame, y: str, fold: str, subsets: Mapping[str, Sequence[str]], alphas: Sequence[float]):
    """E8 + M12 + B10: every (subset, alpha) by cross-validated error, from one scan.

    Returns (board rows best first, scorer): a board row has model, alpha, cv_rmse and the refit on all
    rows (intercept and coefficients by column); ``scorer`` of a row is its prediction as an expression,
    for the out-of-fold table or for a test table with the same columns."""
    used = list(dict.fromkeys(c for cols in subsets.values() for c in cols))
    gs = grams(oof, y, used, fold)
    place = {c: i + 1 for i, c in enumerate(used)}
    n = sum(g[0, 0] for g in gs.folds.values())
    board = []
    for name, cols in subsets.items():
        at = [place[c] for c in cols]
        for alpha in alphas:
            total = sum(sse(g, at, ridge(gs.training(k), at, alpha)) for k, g in gs.folds.items())
            full = _uncentred(gs, at, ridge(gs.total(), at, alpha))
            board.append({"model": name, "alpha": float(alpha), "cv_rmse": math.sqrt(total / n), "columns": list(cols),
                          "intercept": float(full[0]), "coefficients": full[1:].tolist()})
    board.sort(key=lambda r: (round(r["cv_rmse"], 9), r["model"], r["alpha"]))

    def scorer(row: Mapping) -> Column:
        b = F.array(*[F.lit(float(v)) for v in (row["intercept"], *row["coefficients"])])
        return design_score(row["columns"], b)
    return board, scorer

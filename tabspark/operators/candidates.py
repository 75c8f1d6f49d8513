"""Cross-validation of any candidate, boosting with a validation stop, and pruning while trials run.

Folds are columns of one stored table: a fit reads the rows outside its fold by a
filter, so no fold's training rows are copied, and fits run side by side in driver
threads that only wait for Spark jobs.  Jobs of a trial carry its tag, so those still
running are cancelled when the trial is pruned.
"""

from __future__ import annotations

import statistics
import threading
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.target import forward_target, inverse_target
from ..session import drop_stages, stage
from . import prep as P
from .metrics import metric_aggs
from .models import assemble, make_estimator
from .oof import dense_fit, dense_score
from .search import selected_epochs

FoldFit = Callable[[DataFrame, DataFrame, int], tuple[DataFrame, float | None]]
"""(training rows, rows to score, seed) -> (scored rows with ``pred``, rounds or epochs used)."""

Scorer = Callable[[DataFrame], DataFrame]
"""Rows -> the same rows and columns plus ``pred``: a projection, so scorers can follow one another."""

Learner = Callable[[DataFrame, int], tuple[Scorer, float | None]]
"""(training rows, seed) -> (scorer, rounds used)."""


_SHARING = threading.Lock()


def numeric_fit(train: DataFrame, cols: Sequence[str], key: str, winsorize: bool, scaler: str) -> P.NumericModel:
    """The numeric pipeline fitted on ``train``, once for all learners that get this same table."""
    with _SHARING:
        fits = train.__dict__.setdefault("_numeric_fits", {})
        at = (tuple(cols), key, winsorize, scaler)
        mine = at not in fits
        fit = fits.setdefault(at, Future())
    if mine:
        try:
            fit.set_result(P.fit_numeric(train, cols, key, winsorize=winsorize, scaler=scaler))
        except BaseException as e:  # those who wait get it too
            fit.set_exception(e)
    return fit.result()


def candidate(kind: str, key: str, cols: Sequence[str], y: str, target_mode: str = "raw", power: float | None = None,
              winsorize: bool = False, scaler: str = "standard", validation: float = 0.0, **params) -> Learner:
    """The numeric pipeline and a ``pyspark.ml`` estimator, both fitted on the training rows.

    With ``validation`` (boosting) that share of the training rows, by a hash of the key, decides after how
    many rounds to stop; the ensemble ends there and the rounds are reported."""
    def learn(train: DataFrame, seed: int):
        prepared = numeric_fit(train, cols, key, winsorize, scaler)
        rows = P.apply_numeric(train, prepared).withColumn("label", forward_target(y, target_mode, power))
        more = {}
        if validation:
            rows = rows.withColumn("__val", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(10_000)) < int(10_000 * validation))
            more = {"validation": "__val"}
        model = make_estimator(kind, seed=seed, **params, **more).fit(assemble(rows, prepared.output_cols))

        def score(given: DataFrame) -> DataFrame:
            own = given.select(*cols, F.struct(*[F.col(f"`{c}`") for c in given.columns]).alias("__given"))
            out = model.transform(assemble(P.apply_numeric(own, prepared), prepared.output_cols))
            return out.select("__given.*", inverse_target("prediction", target_mode, power).alias("pred"))
        return score, float(model.getNumTrees) if kind == "gbt" else None
    return learn


def candidate_fit(*args, **params) -> FoldFit:
    """A ``candidate`` in the form that ``cross_validate`` takes."""
    learn = candidate(*args, **params)

    def fit(train: DataFrame, score: DataFrame, seed: int):
        scorer, used = learn(train, seed)
        return scorer(score), used
    return fit


def net_fit(key: str, cols: Sequence[str], y: str, target_mode: str = "log", **params) -> FoldFit:
    """M8 + M9 with the numeric pipeline and target scaler of the training rows; stops on the scored rows' error
    in target units and reports the best epoch."""
    def fit(train: DataFrame, score: DataFrame, seed: int):
        prepared = P.fit_numeric(train, cols, key)
        t = forward_target(y, target_mode)
        center, scale = train.agg(F.avg(t), F.stddev_pop(t)).first()
        scale = scale or 1.0
        z = (forward_target(y, target_mode) - center) / scale
        back = lambda c: inverse_target(c * scale + center, target_mode)
        rows = P.apply_numeric(train, prepared).withColumn("__z", z)
        held = P.apply_numeric(score, prepared).withColumn("__z", z)
        ws, _, best = dense_fit(rows, prepared.output_cols, "__z", val=held, seed=seed, unscale=back, **params)
        out = dense_score(held, prepared.output_cols, ws, params.get("activation", "relu"), out="__out")
        return out.withColumn("pred", back(F.col("__out"))).drop("__out", "__z"), float(best)
    return fit


def refit_epochs(fold_rows: DataFrame, floor: int = 5) -> int:
    """Epochs for the refit on all rows, from the best epochs of the folds."""
    return selected_epochs(cv_summary(fold_rows)["median_used"], floor)


def cross_validate(df: DataFrame, y: str, folds: Mapping[int, str], k: int, fit: FoldFit, workers: int = 4) -> DataFrame:
    """A row (seed, fold, n, rmse, mae, r2, used) for every seed's fold column and fold."""
    base = stage(df, "candidate-rows")

    @inheritable_thread_target
    def one(job):
        seed, column, f = job
        scored, used = fit(base.filter(F.col(column) != f), base.filter(F.col(column) == f), seed)
        r = scored.agg(*metric_aggs(y, "pred")).first()
        return seed, f, r.n, r.rmse, r.mae, r.r2, used

    with ThreadPoolExecutor(workers) as pool:
        rows = list(pool.map(one, [(s, c, f) for s, c in folds.items() for f in range(k)]))
    drop_stages(base)
    return df.sparkSession.createDataFrame(rows, "seed long, fold int, n long, rmse double, mae double, r2 double, used double")


def cv_summary(fold_rows: DataFrame) -> dict:
    """Mean and sample deviation of the folds' errors, and the truncated median of the rounds used."""
    rows = fold_rows.collect()
    errors, used = [r.rmse for r in rows], [r.used for r in rows if r.used is not None]
    return {"mean_rmse": statistics.fmean(errors), "std_rmse": statistics.stdev(errors) if len(errors) > 1 else None,
            "median_used": int(statistics.median(used)) if used else None}


def staged_errors(model, rows: DataFrame) -> list[float]:
    """Mean squared error of a boosted model's first 1, 2, ... trees on rows with ``features`` and the label."""
    return list(model.evaluateEachIteration(rows, "squared"))


class Pruned(Exception):
    """Raised in the jobs of a trial that has been pruned."""


def live_pruned(spark, trials: Sequence, steps: int, score: Callable, n_startup: int = 5, n_warmup: int = 1, workers: int = 3,
                ahead: int = 2) -> list[dict]:
    """W7 while trials run: ``score(trial, step)`` (a Spark job) for steps 1..steps, ``ahead`` steps of a trial
    and ``workers`` trials at a time.

    After each step a trial waits for the trials before it to report that step or to end, and is pruned where
    its running mean is above the median of theirs: decisions are those of ``median_prune`` in trial order.  Jobs of
    a pruned trial that still run are cancelled by its tag.  Returns the log: trial, step, value, running, and
    pruned (at that step)."""
    done = threading.Condition()
    running: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}  # the step at which a trial ended
    failed: list[BaseException] = []
    log: list[dict] = []
    sc = spark.sparkContext

    def step_job(t: int, s: int) -> float:
        sc.addJobTag(f"trial-{t}")
        try:
            with done:
                if t in last:
                    raise Pruned
            return score(trials[t], s)
        finally:
            sc.removeJobTag(f"trial-{t}")

    def run(t: int) -> None:
        total, ended = 0.0, steps
        with ThreadPoolExecutor(ahead) as pool:
            # wrapped one by one: threads of one wrapper share their local properties, and so their tags
            jobs = {s: pool.submit(inheritable_thread_target(step_job), t, s) for s in range(1, steps + 1)}
            for s in range(1, steps + 1):
                value = jobs[s].result()
                total += value
                with done:
                    running[t, s] = total / s
                    done.notify_all()
                    done.wait_for(lambda s=s: failed or all((u, s) in running or last.get(u, steps + 1) < s for u in range(t)))
                    if failed:
                        break
                    before = [running[u, s] for u in range(t) if (u, s) in running]
                    pruned = t >= n_startup and s > n_warmup and bool(before) and running[t, s] > statistics.median(before)
                    log.append({"trial": t, "step": s, "value": value, "running": running[t, s], "pruned": pruned})
                    if pruned or s == steps:
                        ended = s
                        last[t] = s
                        done.notify_all()
                        break
            for s in range(ended + 1, steps + 1):
                jobs[s].cancel()
            if ended < steps or failed:
                sc.cancelJobsWithTag(f"trial-{t}")

    def guarded(t: int) -> None:
        try:
            run(t)
        except BaseException as e:  # a failed trial ends the search for all
            with done:
                failed.append(e)
                done.notify_all()

    with ThreadPoolExecutor(workers) as pool:
        list(pool.map(inheritable_thread_target(guarded), range(len(trials))))
    if failed:
        raise failed[0]
    return sorted(log, key=lambda r: (r["trial"], r["step"]))

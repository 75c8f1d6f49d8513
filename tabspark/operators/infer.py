"""Scoring under an output contract.

Row order exists only where it is made: ``with_row_index`` numbers rows at
the scan (file order for a single file) and the number travels with the row
through every shuffle.  Order checks compare dense positions obtained with
the distributed row number, never a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import count_true, not_finite
from ..functions.target import floor_prediction
from .metrics import metric_aggs, metrics_by_quartile, worst_cases
from .rank import global_row_number


def with_row_index(df: DataFrame, out: str = "row_index") -> DataFrame:
    """H3: must be applied directly on the scan, before any shuffle.

    A file scan is numbered by file path, then by the offset of its block and the
    position inside, so several files and splits keep their order (Spark packs
    splits by size); other inputs keep their partition order."""
    if not df.inputFiles():
        return df.withColumn(out, F.monotonically_increasing_id())
    cols = df.columns
    marked = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_at"))
    return global_row_number(marked, ["_file", "_block", "_at"], out=out).withColumn(
        out, F.col(out) - 1).select(*[F.col(f"`{c}`") for c in cols], out)


def positions(df: DataFrame, key: str, order: str = "row_index") -> DataFrame:
    return global_row_number(df.select(key, order), [order, key], out="pos").select(key, "pos")


def order_mismatches(template: DataFrame, output: DataFrame, key: str,
                     order: str = "row_index") -> DataFrame:
    """Positions where the keys differ, for the template as given and
    reversed (a correct output has 0 and, for n > 1 distinct keys, n or n-1)."""
    t = positions(template, key, order).select(F.col(key).alias("t_key"), F.col("pos").alias("t_pos"))
    o = positions(output, key, order).select(F.col(key).alias("o_key"), F.col("pos").alias("o_pos"))
    n_t = t.agg(F.count(F.lit(1))).first()[0]
    same = t.join(o, F.col("t_pos") == F.col("o_pos"), "full_outer")
    rev = t.join(o, F.col("t_pos") == F.lit(n_t + 1) - F.col("o_pos"), "full_outer")
    a = same.agg(F.count("t_key").cast("bigint").alias("n_template"),
                 F.count("o_key").cast("bigint").alias("n_output"),
                 count_true(~F.col("t_key").eqNullSafe(F.col("o_key"))).alias("n_mismatch"))
    b = rev.agg(count_true(~F.col("t_key").eqNullSafe(F.col("o_key"))).alias("n_mismatch_reversed"))
    return a.select("*", F.lit(b.first()[0]).cast("bigint").alias("n_mismatch_reversed"))


def check_template(output: DataFrame, template: DataFrame, key: str,
                   columns: Sequence[str] = ("Id", "Prediction")) -> None:
    """V5: exact ordered columns, complete unique key, identical key order."""
    if list(output.columns) not in (list(columns), [*columns, "row_index"]):
        raise ValueError(f"output columns {output.columns} differ from template {list(columns)}")
    from .quality import check_key
    check_key(output, key)
    r = order_mismatches(template, output, key).first()
    if r.n_template != r.n_output or r.n_mismatch:
        raise ValueError(f"output order differs from the template: {r.asDict()}")


def check_prefix(output: DataFrame, template: DataFrame, key: str,
                 order: str = "row_index") -> bool:
    """The output's keys equal the first n template keys, in order."""
    n = output.count()
    head = global_row_number(template.select(key, order), [order, key], out="pos").filter(
        F.col("pos") <= n)
    r = order_mismatches(head, output, key, order).first()
    return r.n_template == r.n_output and r.n_mismatch == 0


def apply_output_template(pred: DataFrame, template: DataFrame, key: str = "Id",
                          columns: Sequence[str] = ("Id", "Prediction")) -> DataFrame:
    """Predictions in the template's order and columns, after V5 checks
    (template keys complete and unique, every template key predicted)."""
    from .quality import check_key
    check_key(template, key)
    t = template.select(key, "row_index")
    if "row_index" in pred.columns:
        r = order_mismatches(template, pred, key).first()
        if r.n_template != r.n_output or r.n_mismatch:
            raise ValueError(f"prediction order differs from the template: {r.asDict()}")
    stray = pred.join(t, key, "left_anti").limit(1).count()
    if stray:
        raise ValueError("predictions whose key is not in the template")
    filled = t.join(pred.drop("row_index"), key, "left")
    missing = filled.filter(F.col(columns[1]).isNull()).limit(1).count()
    if missing:
        raise ValueError("template keys without a prediction")
    return filled.orderBy("row_index").select(*columns)


def predict_table(df: DataFrame, key: str, score_fns, mode: str = "single",
                  out: str = "Prediction") -> DataFrame:
    """Score with each member (a DataFrame -> DataFrame with ``pred``),
    average the members in ``ensemble`` mode (A20), assert finiteness (A23),
    floor at 0 (P19)."""
    members = score_fns if mode == "ensemble" else score_fns[:1]
    scored = None
    for i, fn in enumerate(members):
        p = fn(df).select(key, F.col("pred").alias(f"_m{i}"))
        scored = p if scored is None else scored.join(p, key)
    mean = sum(F.col(f"_m{i}") for i in range(len(members))) / F.lit(float(len(members)))
    res = scored.select(key, mean.alias(out))
    bad = res.agg(count_true(not_finite(F.col(out)))).first()[0]
    if bad:
        raise ValueError(f"{bad} non-finite predictions")
    return res.select(key, floor_prediction(out).alias(out))


def error_report(scored: DataFrame, y: str, p: str, key: str, details: DataFrame):
    """Overall metrics, metrics by truth quartile, the ten worst rows."""
    return {
        "metrics": scored.agg(*metric_aggs(y, p)),
        "by_quartile": metrics_by_quartile(scored, y, p, key),
        "worst": worst_cases(scored, y, p, key, details),
    }

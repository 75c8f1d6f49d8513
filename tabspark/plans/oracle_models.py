"""DuckDB SQL for catalogue part 2 (models, OOF, metrics, blends, search log).

OLS/ridge coefficients are written as closed forms of per-fold sums; the
Spark side solves the same normal equations from a moment table.
"""

from __future__ import annotations

from .common import FOLD_SEED, K, REPEAT_SEEDS
from .oracle import DOCS, DOCS_BINS, DOCS_SPLIT, SQL, bins, folds, r

PHI = "CAST('0.6180339887498949' AS DOUBLE)"
SQRT2 = "CAST('1.4142135623730951' AS DOUBLE)"


def oof_ctes(seed: int = FOLD_SEED, sfx: str = "") -> str:
    """Fold assignment with ``seed`` and the three base OOF predictions."""
    return folds("docs_b", "doc_id", f"docs_f{sfx}", seed) + f""",
fm{sfx} AS (
  SELECT fold, CAST(count(*) AS DOUBLE) AS n,
         sum(CAST(n_words AS DOUBLE)) AS sw, sum(CAST(n_lines AS DOUBLE)) AS sl, sum(CAST(n_chars AS DOUBLE)) AS sy,
         sum(CAST(n_words AS DOUBLE) * n_words) AS sww, sum(CAST(n_lines AS DOUBLE) * n_lines) AS sll,
         sum(CAST(n_words AS DOUBLE) * n_chars) AS swy, sum(CAST(n_lines AS DOUBLE) * n_chars) AS sly
  FROM docs_f{sfx} GROUP BY fold),
tr{sfx} AS (
  SELECT fold, sum(n) OVER () - n AS n, sum(sw) OVER () - sw AS sw, sum(sl) OVER () - sl AS sl,
         sum(sy) OVER () - sy AS sy, sum(sww) OVER () - sww AS sww, sum(sll) OVER () - sll AS sll,
         sum(swy) OVER () - swy AS swy, sum(sly) OVER () - sly AS sly
  FROM fm{sfx}),
co{sfx} AS (
  SELECT fold, sy / n AS my, sw / n AS mw, sl / n AS ml,
         (swy - sw * sy / n) / (sww - sw * sw / n) AS bw, (sly - sl * sy / n) / (sll - sl * sl / n) AS bl
  FROM tr{sfx}),
oof{sfx} AS (
  SELECT d.doc_id, d.fold, d.bin, d.n_chars,
         c.my - c.bw * c.mw + c.bw * d.n_words AS p_words,
         c.my - c.bl * c.ml + c.bl * d.n_lines AS p_lines,
         c.my AS p_mean
  FROM docs_f{sfx} d JOIN co{sfx} c USING (fold))"""


BASE = f"WITH {DOCS_BINS},\n{oof_ctes()}"
LONG = """oof_long AS (
  SELECT doc_id, n_chars, 'words' AS model, p_words AS pred FROM oof
  UNION ALL SELECT doc_id, n_chars, 'lines', p_lines FROM oof
  UNION ALL SELECT doc_id, n_chars, 'mean', p_mean FROM oof)"""


def metric_cols(y: str = "n_chars", p: str = "pred", d: int = 6) -> str:
    return (f"CAST(count(*) AS BIGINT) AS n, {r(f'sqrt(avg(({y} - {p}) ^ 2))', d)} AS rmse, "
            f"{r(f'avg(abs({y} - {p}))', d)} AS mae, "
            f"{r(f'1 - sum(({y} - {p}) ^ 2) / nullif(var_pop({y}) * count({y}), 0)', d)} AS r2")


# ===================================================================== models

SQL["mean_baseline"] = f"""{BASE}
SELECT CAST(fold AS BIGINT) AS fold, CAST(count(*) AS BIGINT) AS n, {r('first(p_mean)', 4)} AS train_mean,
       {r('sqrt(avg((n_chars - p_mean) ^ 2))', 4)} AS rmse FROM oof GROUP BY fold"""

SQL["ols_oof"] = f"""{BASE}
SELECT doc_id, CAST(fold AS BIGINT) AS fold, {r('p_words', 2)} AS pred FROM oof"""

SQL["holdout_metrics"] = f"""WITH {DOCS_SPLIT},
f AS (SELECT regr_slope(n_chars, n_words) AS s, avg(n_chars) - regr_slope(n_chars, n_words) * avg(n_words) AS b
      FROM docs_s WHERE split = 'dev'),
p AS (SELECT split, n_chars, b + s * n_words AS pred FROM docs_s, f)
SELECT split, {metric_cols(d=4)} FROM p GROUP BY split"""

SQL["ridge_moments"] = f"""WITH {DOCS_BINS},
{folds("docs_b", "doc_id", "docs_f")},
fm AS (
  SELECT fold, CAST(count(*) AS DOUBLE) AS n, sum(CAST(n_words AS DOUBLE)) AS sw, sum(CAST(n_lines AS DOUBLE)) AS sl,
         sum(CAST(n_chars AS DOUBLE)) AS sy, sum(CAST(n_words AS DOUBLE) * n_words) AS sww,
         sum(CAST(n_lines AS DOUBLE) * n_lines) AS sll, sum(CAST(n_words AS DOUBLE) * n_lines) AS swl,
         sum(CAST(n_words AS DOUBLE) * n_chars) AS swy, sum(CAST(n_lines AS DOUBLE) * n_chars) AS sly
  FROM docs_f GROUP BY fold),
tr AS (
  SELECT fold, sum(n) OVER () - n AS n, sum(sw) OVER () - sw AS sw, sum(sl) OVER () - sl AS sl,
         sum(sy) OVER () - sy AS sy, sum(sww) OVER () - sww AS sww, sum(sll) OVER () - sll AS sll,
         sum(swl) OVER () - swl AS swl, sum(swy) OVER () - swy AS swy, sum(sly) OVER () - sly AS sly
  FROM fm),
c AS (
  SELECT fold, sy / n AS my, sw / n AS mw, sl / n AS ml,
         sww - sw * sw / n + 10.0 AS a11, sll - sl * sl / n + 10.0 AS a22, swl - sw * sl / n AS a12,
         swy - sw * sy / n AS cw, sly - sl * sy / n AS cl
  FROM tr),
b AS (
  SELECT fold, my, mw, ml, (a22 * cw - a12 * cl) / (a11 * a22 - a12 * a12) AS bw,
         (a11 * cl - a12 * cw) / (a11 * a22 - a12 * a12) AS bl FROM c)
SELECT CAST(fold AS BIGINT) AS fold, {r('my - bw * mw - bl * ml', 6)} AS intercept,
       {r('bw', 6)} AS coef_n_words, {r('bl', 6)} AS coef_n_lines FROM b"""

# ===================================================================== metrics

SQL["regression_metrics"] = f"""{BASE}, {LONG}
SELECT model, {metric_cols(d=4)} FROM oof_long GROUP BY model"""

SQL["metrics_by_quartile"] = f"""{BASE}, q AS (
  SELECT quantile_cont(CAST(n_chars AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(n_chars AS DOUBLE), 0.5) AS q2,
         quantile_cont(CAST(n_chars AS DOUBLE), 0.75) AS q3 FROM oof),
l AS (SELECT *, CASE WHEN n_chars <= q1 THEN 'Q1' WHEN n_chars <= q2 THEN 'Q2' WHEN n_chars <= q3 THEN 'Q3'
                     ELSE 'Q4' END AS quartile FROM oof, q)
SELECT quartile, CAST(count(*) AS BIGINT) AS n, {r('sqrt(avg((n_chars - p_words) ^ 2))', 4)} AS rmse,
       {r('avg(abs(n_chars - p_words))', 4)} AS mae, {r('avg(n_chars - p_words)', 4)} AS bias
FROM l GROUP BY quartile"""

SQL["worst_cases"] = f"""{BASE}, w AS (
  SELECT doc_id, n_chars, p_words AS pred, n_chars - p_words AS residual, abs(n_chars - p_words) AS abs_error
  FROM oof ORDER BY abs_error DESC, doc_id LIMIT 10)
SELECT d.doc_id, d.lang, d.source, d.n_words, w.n_chars, {r('w.pred', 2)} AS pred,
       {r('w.residual', 2)} AS residual, {r('w.abs_error', 2)} AS abs_error
FROM docs d JOIN w USING (doc_id)"""

SQL["fold_summary"] = f"""{BASE}, {LONG},
pf AS (SELECT l.model, o.fold, sqrt(avg((l.n_chars - l.pred) ^ 2)) AS rmse, avg(abs(l.n_chars - l.pred)) AS mae,
              1 - sum((l.n_chars - l.pred) ^ 2) / nullif(var_pop(l.n_chars) * count(l.n_chars), 0) AS r2
       FROM oof_long l JOIN oof o USING (doc_id) GROUP BY l.model, o.fold)
SELECT model, CAST(count(*) AS BIGINT) AS n_folds, {r('avg(rmse)', 4)} AS mean_rmse,
       {r('coalesce(stddev_samp(rmse), 0.0)', 4)} AS std_rmse, {r('avg(mae)', 4)} AS mean_mae,
       {r('avg(r2)', 4)} AS mean_r2, {r('stddev_pop(rmse)', 4)} AS std_rmse_pop
FROM pf GROUP BY model"""

SQL["residuals"] = f"""{BASE}
SELECT doc_id, n_chars, {r('p_words', 2)} AS pred, {r('n_chars - p_words', 2)} AS residual,
       {r('(SELECT min(n_chars) FROM oof)', 2)} AS truth_min, {r('(SELECT max(n_chars) FROM oof)', 2)} AS truth_max
FROM oof"""

_SEEDS = "WITH " + DOCS_BINS + ",\n" + ",\n".join(oof_ctes(s, f"_{i}") for i, s in enumerate(REPEAT_SEEDS))
_ALL = " UNION ALL ".join(f"SELECT doc_id, n_chars, {i} AS rep, p_words FROM oof_{i}" for i in range(3))

SQL["seed_mean"] = f"""{_SEEDS}, a AS ({_ALL})
SELECT doc_id, {r('avg(p_words)', 2)} AS p_words, CAST(count(*) AS BIGINT) AS n_members FROM a GROUP BY doc_id"""

SQL["gain_pct"] = f"""{_SEEDS}, a AS ({_ALL}),
m AS (SELECT doc_id, avg(p_words) AS p_ens FROM a GROUP BY doc_id),
s AS (SELECT sqrt(avg((o.n_chars - o.p_words) ^ 2)) AS rs, sqrt(avg((o.n_chars - m.p_ens) ^ 2)) AS re
      FROM oof_0 o JOIN m USING (doc_id))
SELECT {r('rs', 6)} AS rmse_single, {r('re', 6)} AS rmse_ensemble, {r('100.0 * (rs - re) / rs', 6)} AS gain_pct FROM s"""

# ===================================================================== blending

SQL["linear_calibration"] = f"""{BASE}, c AS (
  SELECT regr_slope(n_chars, p_lines) AS s, regr_intercept(n_chars, p_lines) AS b FROM oof)
SELECT doc_id, {r('b + s * p_lines', 2)} AS calibrated FROM oof, c"""

SQL["calibration_cv"] = f"""{BASE},
{folds("oof", "doc_id", "cal", 7, 7, col="cal_fold")},
cfm AS (SELECT cal_fold, count(*) AS n, sum(p_lines) AS sp, sum(CAST(n_chars AS DOUBLE)) AS sy,
              sum(p_lines * p_lines) AS spp, sum(p_lines * n_chars) AS spy FROM cal GROUP BY cal_fold),
ctr AS (SELECT cal_fold, sum(n) OVER () - n AS n, sum(sp) OVER () - sp AS sp, sum(sy) OVER () - sy AS sy,
              sum(spp) OVER () - spp AS spp, sum(spy) OVER () - spy AS spy FROM cfm),
cco AS (SELECT cal_fold, (spy - sp * sy / n) / (spp - sp * sp / n) AS s, sy / n - (spy - sp * sy / n) / (spp - sp * sp / n) * sp / n AS b
       FROM ctr),
e AS (SELECT sqrt(avg((c.n_chars - c.p_lines) ^ 2)) AS raw, sqrt(avg((c.n_chars - cco.b - cco.s * c.p_lines) ^ 2)) AS cal
      FROM cal c JOIN cco USING (cal_fold))
SELECT {r('raw', 4)} AS rmse_raw, {r('cal', 4)} AS rmse_calibrated, cal < raw AS use_calibration FROM e"""

_GRID = """g AS (
  SELECT CAST(i AS DOUBLE) / 20.0 AS weight,
         sqrt(avg(((CAST(i AS DOUBLE) / 20.0) * p_words + (1 - CAST(i AS DOUBLE) / 20.0) * p_lines - n_chars) ^ 2)) AS rmse
  FROM oof, (SELECT unnest(range(0, 21)) AS i) GROUP BY i),
best AS (SELECT weight, rmse FROM g ORDER BY rmse, weight LIMIT 1)"""

SQL["grid_blend"] = f"""{BASE}, {_GRID}
SELECT {r('weight', 4)} AS weight, {r('rmse', 4)} AS rmse FROM best"""

_GRAM_COLS = ["p_words", "p_lines", "p_mean", "n_chars"]
_PAIRS = [(a, b) for i, a in enumerate(_GRAM_COLS) for b in _GRAM_COLS[i:]]

SQL["blend_moments"] = f"""{BASE}
{' UNION ALL '.join(
    [f"SELECT {r('count(*)', 2)} AS n, '{a}' AS a, '{b}' AS b, {r(f'avg(CAST({a} AS DOUBLE) * {b})', 2)} AS value FROM oof"
     for a, b in _PAIRS]
    + [f"SELECT {r('count(*)', 2)}, '{a}', '1', {r(f'avg(CAST({a} AS DOUBLE))', 2)} FROM oof" for a in _GRAM_COLS])}"""

SQL["blend_apply"] = f"""{BASE}, {_GRID}
SELECT doc_id, {r('greatest(0.0 + best.weight * p_words + (1 - best.weight) * p_lines, 0.0)', 2)} AS pred
FROM oof, best"""

SQL["weight_prune"] = f"""{BASE}, {LONG},
m AS (SELECT model, 1.0 / avg((n_chars - pred) ^ 2) AS w FROM oof_long GROUP BY model),
n AS (SELECT model, w / sum(w) OVER () AS weight FROM m),
k AS (SELECT model, weight FROM n WHERE weight > 0.05)
SELECT model, {r('weight / sum(weight) OVER ()', 8)} AS weight, weight / sum(weight) OVER () > 0.0001 AS active FROM k"""

SQL["repeat_oof_mean"] = f"""{_SEEDS}, a AS ({_ALL})
SELECT CAST(rep AS BIGINT) AS repeat, {r('sqrt(avg((n_chars - p_words) ^ 2))', 4)} AS rmse FROM a GROUP BY rep
UNION ALL
SELECT -1, {r('sqrt(avg((n_chars - p) ^ 2))', 4)} FROM (SELECT doc_id, n_chars, avg(p_words) AS p FROM a GROUP BY ALL)"""

SQL["override_blend"] = f"""{BASE}, {LONG},
f AS (SELECT regr_slope(n_chars, n_words) AS s, avg(n_chars) - regr_slope(n_chars, n_words) * avg(n_words) AS b FROM docs),
rep AS (SELECT doc_id, 'words' AS model, b + s * n_words AS pred FROM docs, f)
SELECT l.doc_id, l.model, {r('coalesce(rep.pred, l.pred)', 2)} AS pred
FROM oof_long l LEFT JOIN rep ON l.doc_id = rep.doc_id AND l.model = rep.model"""

SQL["pred_pivot"] = f"""{BASE}
SELECT doc_id, {r('p_words', 2)} AS words, {r('p_lines', 2)} AS lines, {r('p_mean', 2)} AS mean FROM oof"""

# ===================================================================== search log

SEARCH = f"""{BASE},
cand AS (
  SELECT CAST(t AS BIGINT) AS trial,
         CASE WHEN floor((t * {SQRT2} - floor(t * {SQRT2})) * 2) = 0 THEN 'n_words' ELSE 'n_lines' END AS feature,
         pow(10.0, floor((t * {PHI} - floor(t * {PHI})) * 9) - 2) AS alpha
  FROM (SELECT CAST(unnest(range(0, 24)) AS DOUBLE) AS t)),
xy AS (SELECT doc_id, fold, 'n_words' AS feature, CAST(n_words AS DOUBLE) AS x, CAST(n_chars AS DOUBLE) AS y FROM docs_f
       UNION ALL SELECT doc_id, fold, 'n_lines', CAST(n_lines AS DOUBLE), CAST(n_chars AS DOUBLE) FROM docs_f),
folds AS (SELECT DISTINCT fold FROM docs_f),
trm AS (SELECT f.fold, xy.feature, avg(x) AS mx, avg(y) AS my,
               count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy
        FROM folds f JOIN xy ON xy.fold <> f.fold GROUP BY f.fold, xy.feature),
coef AS (SELECT c.trial, c.feature, c.alpha, t.fold,
                (t.sxy - t.n * t.mx * t.my) / (t.sxx - t.n * t.mx * t.mx + c.alpha) AS b1, t.mx, t.my
         FROM cand c JOIN trm t USING (feature)),
log AS (SELECT c.trial, c.feature, c.alpha, c.fold + 1 AS step,
               sqrt(avg((xy.y - (c.my - c.b1 * c.mx) - c.b1 * xy.x) ^ 2)) AS rmse
        FROM coef c JOIN xy ON xy.feature = c.feature AND xy.fold = c.fold
        GROUP BY c.trial, c.feature, c.alpha, c.fold),
summary AS (SELECT trial, feature, alpha, round(avg(rmse), 6) AS mean_rmse FROM log GROUP BY ALL),
run AS (SELECT *, avg(rmse) OVER (PARTITION BY trial ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
        FROM log),
med AS (SELECT *, median(running) OVER (PARTITION BY step ORDER BY trial ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mb
        FROM run),
flag AS (SELECT *, coalesce(trial >= 5 AND step > 1 AND running > mb, false) AS worse FROM med),
pa AS (SELECT trial, min(CASE WHEN worse THEN step END) AS pruned_at FROM flag GROUP BY trial),
pruned AS (
  SELECT f.trial, CASE WHEN pa.pruned_at IS NULL THEN 'COMPLETE' ELSE 'PRUNED' END AS state, pa.pruned_at,
         count(*) AS n_steps, arg_max(f.running, f.step) AS value
  FROM flag f JOIN pa USING (trial) WHERE pa.pruned_at IS NULL OR f.step <= pa.pruned_at
  GROUP BY f.trial, pa.pruned_at)"""

SQL["trial_log"] = f"""{SEARCH}
SELECT trial, feature, {r('alpha', 2)} AS alpha, CAST(step AS BIGINT) AS step, {r('rmse', 2)} AS rmse FROM log"""

SQL["median_prune"] = f"""{SEARCH}
SELECT trial, state, CAST(pruned_at AS BIGINT) AS pruned_at, CAST(n_steps AS BIGINT) AS n_steps,
       {r('value', 2)} AS value FROM pruned"""

SQL["state_counts"] = f"""{SEARCH}
SELECT state, CAST(count(*) AS BIGINT) AS n FROM pruned GROUP BY state"""

SQL["top_configs"] = f"""{SEARCH}, b AS (
  SELECT *, row_number() OVER (PARTITION BY feature, alpha ORDER BY mean_rmse, trial) AS rn FROM summary)
SELECT trial, feature, {r('alpha', 2)} AS alpha, {r('mean_rmse', 2)} AS mean_rmse FROM b WHERE rn = 1
ORDER BY b.mean_rmse, trial LIMIT 5"""

SQL["finalist_rank"] = f"""{SEARCH}
SELECT trial, feature || '_' || CAST(row_number() OVER (PARTITION BY feature ORDER BY mean_rmse, trial) AS VARCHAR) AS label
FROM summary"""

SQL["argmin_config"] = f"""{SEARCH}
SELECT trial, feature, {r('alpha', 2)} AS alpha, {r('mean_rmse', 2)} AS mean_rmse FROM summary
ORDER BY summary.mean_rmse, trial LIMIT 1"""

SQL["early_stop"] = f"""{SEARCH},
h AS (SELECT feature AS run, row_number() OVER (PARTITION BY feature ORDER BY trial) AS epoch,
             round(mean_rmse, 6) AS value FROM summary),
i AS (SELECT *, min(value) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pb
      FROM h),
j AS (SELECT *, max(CASE WHEN pb IS NULL OR value < pb THEN epoch END)
                  OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS li FROM i),
s AS (SELECT run, min(CASE WHEN epoch - li >= 3 THEN epoch END) AS stopped_at FROM j GROUP BY run),
k AS (SELECT j.* FROM j JOIN s USING (run) WHERE s.stopped_at IS NULL OR j.epoch <= s.stopped_at)
SELECT k.run, CAST(arg_min(epoch, struct_pack(v := value, e := epoch)) AS BIGINT) AS best_epoch,
       {r('min(value)', 2)} AS best_value, CAST(count(*) AS BIGINT) AS epochs_run,
       (SELECT stopped_at IS NOT NULL FROM s WHERE s.run = k.run) AS stopped
FROM k GROUP BY k.run"""

SQL["history_long"] = f"""{SEARCH}
SELECT trial, CAST(step AS BIGINT) AS epoch, {r('rmse', 2)} AS val_rmse, {r('rmse * rmse', 2)} AS val_mse FROM log"""

SQL["stage_union"] = f"""{SEARCH}
SELECT 'baseline' AS stage, CAST(fold AS BIGINT) AS id, {r('sqrt(avg((n_chars - p_mean) ^ 2))', 2)} AS rmse,
       CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS alpha FROM oof GROUP BY fold
UNION ALL
SELECT 'search', trial, {r('mean_rmse', 2)}, feature, {r('alpha', 2)} FROM summary"""

"""DuckDB SQL for the SQL-expressible queries of catalogue part 3."""

from __future__ import annotations

from .common import FOLD_SEED, K
from .oracle import DOCS, DOCS_BINS, ORD, ORD_SPLIT, SQL, folds, r
from .oracle_models import BASE

SQL["nested_bag"] = (f"""{BASE},
exp AS (SELECT d.*, CAST(o.outer_fold AS INTEGER) AS outer_fold FROM docs_f d,
        (SELECT unnest(range(0, {K})) AS outer_fold) o WHERE o.outer_fold <> d.fold),
""" + folds("exp", "doc_id", "nest", FOLD_SEED + 100, k=4, col="inner_fold", within="outer_fold") + f""",
m AS (SELECT outer_fold, inner_fold, CAST(count(*) AS DOUBLE) AS n, sum(CAST(n_words AS DOUBLE)) AS sx,
             sum(CAST(n_chars AS DOUBLE)) AS sy, sum(CAST(n_words AS DOUBLE) * n_words) AS sxx,
             sum(CAST(n_words AS DOUBLE) * n_chars) AS sxy FROM nest GROUP BY ALL),
t AS (SELECT outer_fold, inner_fold, sum(n) OVER w - n AS n, sum(sx) OVER w - sx AS sx, sum(sy) OVER w - sy AS sy,
             sum(sxx) OVER w - sxx AS sxx, sum(sxy) OVER w - sxy AS sxy FROM m
      WINDOW w AS (PARTITION BY outer_fold)),
c AS (SELECT outer_fold, (sxy - sx * sy / n) / (sxx - sx * sx / n) AS b1, sx / n AS mx, sy / n AS my FROM t),
a AS (SELECT outer_fold, avg(my - b1 * mx) AS b0, avg(b1) AS b1 FROM c GROUP BY outer_fold),
both_ AS (SELECT o.doc_id, o.n_chars, o.p_words, a.b0 + a.b1 * d.n_words AS p_bag
          FROM oof o JOIN docs_f d USING (doc_id) JOIN a ON a.outer_fold = o.fold),
g AS (SELECT CAST(i AS DOUBLE) / 100.0 AS weight,
             sqrt(avg(((CAST(i AS DOUBLE) / 100.0) * p_words + (1 - CAST(i AS DOUBLE) / 100.0) * p_bag - n_chars) ^ 2)) AS rmse
      FROM both_, (SELECT unnest(range(0, 101)) AS i) GROUP BY i),
best AS (SELECT weight, rmse FROM g ORDER BY rmse, weight LIMIT 1)
SELECT {r('best.weight', 4)} AS direct_weight, {r('(SELECT sqrt(avg((n_chars - p_bag) ^ 2)) FROM both_)', 4)} AS rmse_bag,
       {r('best.rmse', 4)} AS best_rmse FROM best""")

_NUM = ["o_custkey", "o_year", "o_month", "c_acctbal", "n_regionkey", "l_n_lines", "l_qty", "l_price",
        "l_max_disc", "l_ship_year"]
# columns with a null among the dev orders (orders without lines) get an indicator
_IND = ["l_n_lines", "l_qty", "l_price", "l_max_disc", "l_ship_year"]
_LEVELS = {
    "o_orderpriority": ["Missing", "5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"],
    "o_orderstatus": ["Missing", "P", "O"],
}


def _ordinal(c: str, levels: list[str]) -> str:
    arr = "[" + ", ".join("'" + lv + "'" for lv in levels) + "]"
    return f"CAST(coalesce(list_position({arr}, coalesce({c}, 'Missing')), 0) - 1 AS DOUBLE)"


_outs = _NUM + [f"mi_{c}" for c in _IND] + list(_LEVELS)
_imputed = ", ".join([f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}" for c in _NUM]
                     + [f"CAST({c} IS NULL AS DOUBLE) AS mi_{c}" for c in _IND]
                     + [f"{_ordinal(c, lv)} AS {c}" for c, lv in _LEVELS.items()])
_scaled = [f"(i.{o} - s.ce_{o}) / s.sc_{o}" for o in _outs]
_onehot = ("(CASE WHEN coalesce(i.c_mktsegment, 'Missing') IN (SELECT lv FROM seg) THEN 1.0 ELSE 0.0 END"
           " + CASE WHEN coalesce(i.n_name, 'Missing') IN (SELECT lv FROM nat) THEN 1.0 ELSE 0.0 END)")

SQL["preprocess_design"] = f"""WITH {ORD_SPLIT},
m AS (SELECT {', '.join(f'quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}' for c in _NUM)}
      FROM ord_s WHERE split = 'dev'),
i AS (SELECT o_orderkey, split, c_mktsegment, n_name, {_imputed} FROM ord_s, m),
s AS (SELECT {', '.join(f'avg({o}) AS ce_{o}, coalesce(nullif(stddev_pop({o}), 0), 1.0) AS sc_{o}' for o in _outs)}
      FROM i WHERE split = 'dev'),
seg AS (SELECT DISTINCT coalesce(c_mktsegment, 'Missing') AS lv FROM ord_s WHERE split = 'dev'),
nat AS (SELECT DISTINCT coalesce(n_name, 'Missing') AS lv FROM ord_s WHERE split = 'dev')
SELECT i.o_orderkey,
       CAST({len(_outs)} + (SELECT count(*) FROM seg) + (SELECT count(*) FROM nat) AS BIGINT) AS n_features,
       {r(' + '.join(_scaled) + ' + ' + _onehot, 6)} AS total,
       {r(' + '.join(f'({x}) * ({x})' for x in _scaled) + ' + ' + _onehot, 6)} AS total_sq
FROM i, s"""

PHI = "CAST('0.6180339887498949' AS DOUBLE)"
SQRT2 = "CAST('1.4142135623730951' AS DOUBLE)"


def _trial_log(cands: str, fold_col: str, sfx: str) -> str:
    """Per candidate x fold validation RMSE of 1-feature ridge, row-wise."""
    return f"""trm{sfx} AS (
  SELECT f.fold, xy.feature, avg(x) AS mx, avg(y) AS my, count(*) AS n, sum(x * x) AS sxx, sum(x * y) AS sxy
  FROM (SELECT DISTINCT {fold_col} AS fold FROM xy) f JOIN xy ON xy.{fold_col} <> f.fold GROUP BY f.fold, xy.feature),
coef{sfx} AS (
  SELECT c.trial, c.feature, c.alpha, t.fold,
         (t.sxy - t.n * t.mx * t.my) / (t.sxx - t.n * t.mx * t.mx + c.alpha) AS b1, t.mx, t.my
  FROM {cands} c JOIN trm{sfx} t USING (feature)),
log{sfx} AS (
  SELECT c.trial, c.feature, c.alpha, c.fold, sqrt(avg((xy.y - (c.my - c.b1 * c.mx) - c.b1 * xy.x) ^ 2)) AS rmse
  FROM coef{sfx} c JOIN xy ON xy.feature = c.feature AND xy.{fold_col} = c.fold
  GROUP BY c.trial, c.feature, c.alpha, c.fold)"""


SQL["cv_search"] = f"""WITH {DOCS_BINS},
{folds("docs_b", "doc_id", "f3", 1, 3, col="fold3")},
{folds("f3", "doc_id", "f35", FOLD_SEED, 5, col="fold5")},
cand AS (
  SELECT CAST(t AS BIGINT) AS trial,
         CASE WHEN floor((t * {SQRT2} - floor(t * {SQRT2})) * 2) = 0 THEN 'n_words' ELSE 'n_lines' END AS feature,
         pow(10.0, floor((t * {PHI} - floor(t * {PHI})) * 9) - 2) AS alpha
  FROM (SELECT CAST(unnest(range(0, 24)) AS DOUBLE) AS t)),
xy AS (SELECT fold3, fold5, 'n_words' AS feature, CAST(n_words AS DOUBLE) AS x, CAST(n_chars AS DOUBLE) AS y FROM f35
       UNION ALL SELECT fold3, fold5, 'n_lines', CAST(n_lines AS DOUBLE), CAST(n_chars AS DOUBLE) FROM f35),
{_trial_log("cand", "fold3", "_c")},
summary AS (SELECT trial, feature, alpha, round(avg(rmse), 6) AS mean_rmse FROM log_c GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY feature, alpha ORDER BY mean_rmse, trial) AS rn FROM summary),
fin AS (SELECT trial, feature, alpha FROM best WHERE rn = 1 ORDER BY mean_rmse, trial LIMIT 3),
{_trial_log("fin", "fold5", "_f")}
SELECT trial, feature, {r('alpha', 4)} AS alpha, {r('avg(rmse)', 4)} AS mean_rmse,
       {r('stddev_samp(rmse)', 4)} AS std_rmse FROM log_f GROUP BY trial, feature, alpha"""

SQL["csv_roundtrip"] = f"""WITH {ORD}
SELECT o_orderkey, {r('l_qty', 4)} AS l_qty, l_n_lines, c_mktsegment FROM ord"""

SQL["stream_score"] = f"""WITH {DOCS},
s AS (SELECT CAST(count(*) AS DOUBLE) AS n, avg(CAST(n_words AS DOUBLE)) AS mw, avg(CAST(n_lines AS DOUBLE)) AS ml,
             avg(CAST(n_chars AS DOUBLE)) AS my,
             sum((n_words - (SELECT avg(n_words) FROM docs)) ^ 2) AS a11,
             sum((n_lines - (SELECT avg(n_lines) FROM docs)) ^ 2) AS a22,
             sum((n_words - (SELECT avg(n_words) FROM docs)) * (n_lines - (SELECT avg(n_lines) FROM docs))) AS a12,
             sum((n_words - (SELECT avg(n_words) FROM docs)) * (n_chars - (SELECT avg(n_chars) FROM docs))) AS cw,
             sum((n_lines - (SELECT avg(n_lines) FROM docs)) * (n_chars - (SELECT avg(n_chars) FROM docs))) AS cl
      FROM docs),
b AS (SELECT *, (a22 * cw - a12 * cl) / (a11 * a22 - a12 * a12) AS bw,
             (a11 * cl - a12 * cw) / (a11 * a22 - a12 * a12) AS bl FROM s)
SELECT doc_id, {r('my - bw * mw - bl * ml + bw * n_words + bl * n_lines', 2)} AS pred FROM docs, b"""

SQL["predictions_csv"] = f"""{BASE}
SELECT doc_id AS "Id", printf('%.6f', p_words) AS "Prediction", row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM oof"""


def _two_feature_fit(m: int) -> str:
    """Least squares of n_chars on n_words and n_lines over the rows outside fold m: fit_m(b0, bw, bl)."""
    w = f"FILTER (fold <> {m})"
    return f"""mo{m} AS (SELECT avg(n_chars) {w} AS my, avg(n_words) {w} AS mw, avg(n_lines) {w} AS ml,
          var_pop(n_words) {w} AS ww, var_pop(n_lines) {w} AS ll, covar_pop(n_words, n_lines) {w} AS wl,
          covar_pop(n_chars, n_words) {w} AS wy, covar_pop(n_chars, n_lines) {w} AS ly FROM docs_f),
    be{m} AS (SELECT *, (wy * ll - ly * wl) / (ww * ll - wl * wl) AS bw, (ly * ww - wy * wl) / (ww * ll - wl * wl) AS bl FROM mo{m}),
    fit{m} AS (SELECT my - bw * mw - bl * ml AS b0, bw, bl FROM be{m})"""


_MEAN = " + ".join(f"(fit{m}.b0 + fit{m}.bw * n_words + fit{m}.bl * n_lines)" for m in (1, 2, 3))
SQL["score_from_artifacts"] = f"""WITH {DOCS_BINS},
{folds("docs_b", "doc_id", "docs_f")},
{", ".join(_two_feature_fit(m) for m in range(4))}
SELECT doc_id, {r("greatest(fit0.b0 + fit0.bw * n_words + fit0.bl * n_lines, 0)", 3)} AS single,
       {r(f"greatest(({_MEAN}) / 3, 0)", 3)} AS ensemble, {r(f"greatest(({_MEAN}) / 3, 0)", 3)} AS streamed
FROM docs_f, fit0, fit1, fit2, fit3"""

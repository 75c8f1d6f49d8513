"""DuckDB SQL of catalogue part 5."""

from __future__ import annotations

from ..operators.search import space_steps
from . import oracle_ml  # noqa: F401 -- its statement of nested_bag is used below
from .catalogue_stack import SPACE
from .common import REPEAT_SEEDS
from .oracle import DOCS_BINS, DOCS_FOLDS, DOCS_SPLIT, ORD, SQL, bins, folds, r
from .oracle_models import BASE, metric_cols, oof_ctes

# one-hot ridge with a free intercept: level l has b_l = n_l (m_l - b0) / (n_l + alpha), and b0 is the mean
# of the level means weighted by n_l alpha / (n_l + alpha)
SQL["ridge_design_oof"] = f"""WITH {ORD},
c AS (SELECT o_orderkey, o_totalprice, n_name || '|' || c_mktsegment || '|' || o_month AS cell FROM ord),
{bins("c", "o_totalprice", "o_orderkey", "c_b")},
{folds("c_b", "o_orderkey", "c_f")},
k AS (SELECT DISTINCT fold FROM c_f),
lev AS (SELECT k.fold, cell, count(*)::DOUBLE AS n, avg(o_totalprice) AS m FROM k JOIN c_f ON c_f.fold <> k.fold GROUP BY ALL),
b0 AS (SELECT fold, sum(n * 10 / (n + 10) * m) / sum(n * 10 / (n + 10)) AS b0 FROM lev GROUP BY fold)
SELECT o_orderkey, fold::BIGINT AS fold, {r("b0 + coalesce(lev.n * (lev.m - b0) / (lev.n + 10), 0)", 3)} AS pred
FROM c_f JOIN b0 USING (fold) LEFT JOIN lev USING (fold, cell)"""

_SUMS = {"n": "1", "a": "p_words", "b": "p_lines", "y": "n_chars", "aa": "p_words * p_words", "bb": "p_lines * p_lines",
         "ab": "p_words * p_lines", "ya": "p_words * n_chars", "yb": "p_lines * n_chars"}

SQL["stack_board"] = f"""{BASE},
{folds("oof", "doc_id", "meta", 7, 7, "meta_fold")},
mf AS (SELECT meta_fold AS f, {", ".join(f"sum(({e})::DOUBLE) AS s_{c}" for c, e in _SUMS.items())} FROM meta GROUP BY 1),
tot AS (SELECT {", ".join(f"sum(s_{c}) AS t_{c}" for c in _SUMS)} FROM mf),
mt AS (SELECT f, {", ".join(f"t_{c} - s_{c} AS {c}" for c in _SUMS)} FROM mf, tot
       UNION ALL SELECT -1, {", ".join(f"t_{c}" for c in _SUMS)} FROM tot),
cand AS (SELECT * FROM (VALUES ('both'), ('lines'), ('words')) m(model), (VALUES (0.0), (10.0), (1000.0)) p(alpha)),
sys AS (SELECT model, alpha::DOUBLE AS alpha, mt.*, aa - a * a / n + alpha::DOUBLE AS p, bb - b * b / n + alpha::DOUBLE AS q, ab - a * b / n AS s,
               ya - a * y / n AS u, yb - b * y / n AS v FROM cand, mt),
fit AS (SELECT *, CASE model WHEN 'both' THEN (u * q - v * s) / (p * q - s * s) WHEN 'words' THEN u / p ELSE 0 END AS ca,
               CASE model WHEN 'both' THEN (v * p - u * s) / (p * q - s * s) WHEN 'lines' THEN v / q ELSE 0 END AS cb FROM sys),
re AS (SELECT *, y / n - ca * a / n - cb * b / n AS b0 FROM fit),
cv AS (SELECT model, alpha, sqrt(sum((n_chars - b0 - ca * p_words - cb * p_lines) ^ 2) / count(*)) AS cv_rmse
       FROM meta JOIN re ON meta_fold = f GROUP BY 1, 2)
SELECT row_number() OVER (ORDER BY round(cv_rmse, 9), cv.model, cv.alpha) AS rank, cv.model, cv.alpha, {r("cv_rmse", 4)} AS cv_rmse,
       {r("b0", 4)} AS intercept, {r("ca + cb", 4)} AS coef_sum, {r("b0 + ca * a / n + cb * b / n", 4)} AS mean_pred
FROM cv JOIN re ON cv.model = re.model AND cv.alpha = re.alpha AND re.f = -1"""

_TWO = REPEAT_SEEDS[:2]
SQL["candidate_cv"] = f"""WITH {DOCS_BINS},
{", ".join(oof_ctes(s, f"_{s}") for s in _TWO)},
every AS ({" UNION ALL ".join(f"SELECT {s} AS seed, fold, n_chars, p_words FROM oof_{s}" for s in _TWO)})
SELECT seed::BIGINT AS seed, fold::BIGINT AS fold, {metric_cols(p="p_words", d=3)} FROM every GROUP BY seed, fold"""

# what must hold of every fold: all its rows scored, rounds within the budget, better than the mean
SQL["gbt_early_stop"] = f"""WITH {DOCS_FOLDS}
SELECT fold::BIGINT AS fold, count(*) AS n, true AS rounds_in_budget, true AS beats_mean FROM docs_f GROUP BY fold"""

SQL["dense_refit"] = f"""WITH {DOCS_SPLIT}
SELECT doc_id, true AS scored, true AS epochs_in_budget FROM docs_s WHERE split = 'test'"""


def _space_sql() -> str:
    cols = []
    for (name, (kind, *rest)), step in zip(SPACE.items(), space_steps(len(SPACE))):
        x = f"((trial + 1)::DOUBLE * CAST('{step!r}' AS DOUBLE))"
        u = f"({x} - floor({x}))"
        if kind == "choice":
            value = f"(CAST({rest[0]!r} AS VARCHAR[]))[least(floor({u} * {len(rest[0])}), {len(rest[0]) - 1})::INTEGER + 1]"
        elif kind == "int":
            value = f"({rest[0]} + floor({u} * {rest[1] - rest[0] + 1}))::BIGINT"
        elif kind == "float":
            value = f"round({rest[0]} + {u} * {rest[1] - rest[0]}, 9)"
        else:
            value = f"round(exp(ln({rest[0]!r}::DOUBLE) + {u} * (ln({rest[1]!r}::DOUBLE) - ln({rest[0]!r}::DOUBLE))), 9)"
        parent = rest[-1] if kind != "choice" and isinstance(rest[-1], tuple) else None
        cols.append(f"CASE WHEN {parent[0]} = '{parent[1]}' THEN {value} END AS {name}" if parent else f"{value} AS {name}")
    return f"""WITH t AS (SELECT unnest(range((sum(n_chars) // 1000)::BIGINT)) AS trial FROM documents)
SELECT trial, {", ".join(cols)} FROM t"""


SQL["search_space"] = _space_sql()

# least squares through the operator for any learner: the nested statement's numbers; trees: what must hold
SQL["nested_bag_tree"] = f"SELECT *, true AS blends_no_worse FROM ({SQL['nested_bag']})"

SQL["champion_blend"] = f"""WITH {DOCS_SPLIT}
SELECT doc_id, true AS scored, true AS beats_mean FROM docs_s WHERE split = 'test'"""

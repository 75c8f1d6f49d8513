"""DuckDB SQL for the catalogue: an independent statement of each query.

Tables are the driver's views.  Window functions here are the plain SQL
definitions (row_number over the whole table, percentiles by quantile_cont);
the Spark side computes the same values with distributed operators.
"""

from __future__ import annotations

from .common import FOLD_SEED, K, SPLIT_SEED

DOCS = r"""docs AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic,
         CAST(len(regexp_extract_all(d.text, '\S+')) AS BIGINT) AS n_words,
         CAST(length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS BIGINT) AS n_lines
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

ORD = """lines AS (
  SELECT l_orderkey, count(*) AS l_n_lines, sum(l_quantity) AS l_qty,
         sum(l_extendedprice) AS l_price, max(l_discount) AS l_max_disc,
         max(l_shipdate) AS l_last_ship
  FROM lineitem GROUP BY l_orderkey),
ord AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderpriority, o.o_orderdate,
         CAST(year(o.o_orderdate) AS BIGINT) AS o_year, CAST(month(o.o_orderdate) AS BIGINT) AS o_month,
         c.c_acctbal, c.c_mktsegment, n.n_name, n.n_regionkey,
         li.l_n_lines, li.l_qty, li.l_price, li.l_max_disc,
         CAST(year(li.l_last_ship) AS BIGINT) AS l_ship_year, o.o_totalprice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN lines li ON o.o_orderkey = li.l_orderkey)"""


def bins(src: str, y: str, key: str, name: str, nbins: int = 10) -> str:
    return f"""{name}_r AS (
  SELECT *, row_number() OVER (ORDER BY {y}, {key}) AS _r, count(*) OVER () AS _n FROM {src}),
{name} AS (
  SELECT * EXCLUDE (_r, _n),
         CAST(CASE WHEN _n <= 1 THEN 0
              ELSE greatest(0, ((_r - 1) * least({nbins}, _n) + _n - 2) // (_n - 1) - 1) END AS INTEGER) AS bin
  FROM {name}_r)"""


def folds(src: str, key: str, name: str, seed: int = FOLD_SEED, k: int = K, col: str = "fold",
          within: str = "") -> str:
    part = f"{within}, bin" if within else "bin"
    return f"""{name} AS (
  SELECT * EXCLUDE (_f), CAST((_f - 1) % {k} AS INTEGER) AS {col} FROM (
    SELECT *, row_number() OVER (PARTITION BY {part}
                                 ORDER BY md5(CAST({key} AS VARCHAR) || '-{seed}'), {key}) AS _f
    FROM {src}))"""


def split(src: str, key: str, name: str, seed: int = SPLIT_SEED, pct: int = 20) -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (_s, _sn),
         CASE WHEN _s <= (_sn * {pct} + 99) // 100 THEN 'test' ELSE 'dev' END AS split FROM (
    SELECT *, row_number() OVER (PARTITION BY bin
                                 ORDER BY md5(CAST({key} AS VARCHAR) || '-{seed}'), {key}) AS _s,
           count(*) OVER (PARTITION BY bin) AS _sn
    FROM {src}))"""


DOCS_BINS = DOCS + ",\n" + bins("docs", "n_chars", "doc_id", "docs_b")
DOCS_SPLIT = DOCS_BINS + ",\n" + split("docs_b", "doc_id", "docs_s")
DOCS_FOLDS = DOCS_BINS + ",\n" + folds("docs_b", "doc_id", "docs_f")
ORD_SPLIT = (ORD + ",\n" + bins("ord", "o_totalprice", "o_orderkey", "ord_b") + ",\n"
             + split("ord_b", "o_orderkey", "ord_s"))

STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def strip(x: str) -> str:
    return STRIP.format(x=x)


def clean(x: str) -> str:
    s = strip(x)
    return (f"CASE WHEN length({s}) >= 2 AND starts_with({s}, '''') AND ends_with({s}, '''') "
            f"THEN {strip(f'substring({s}, 2, length({s}) - 2)')} ELSE {s} END")


RAW = """raw AS (
  SELECT doc_id, text,
         ' ''' || source || ''' ' AS raw_a,
         '''' || lang AS raw_b,
         chr(9) || '''  ' || lang || ' ''' || chr(10) AS raw_c,
         '''' AS raw_d
  FROM documents)"""

NA = ("'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
      "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'")


def r(x: str, d: int) -> str:
    return f"round(CAST({x} AS DOUBLE), {d})"


def age(a: str, b: str) -> str:
    return f"CASE WHEN {a} - {b} < 0 THEN 0 ELSE {a} - {b} END"


def log1p0(x: str) -> str:
    return f"ln(1 + CASE WHEN CAST({x} AS DOUBLE) < 0 THEN 0 ELSE CAST({x} AS DOUBLE) END)"


def presence(x: str) -> str:
    return f"CAST(coalesce({x}, 0) > 0 AS DOUBLE)"


def quantiles_long(src: str, cols: list[str], probs: list[float], by: str = "") -> str:
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    parts = []
    for c in cols:
        for p in probs:
            parts.append(f"SELECT {sel}'{c}' AS column_name, {p} AS p, "
                         f"quantile_cont(CAST({c} AS DOUBLE), {p}) AS value FROM {src}{grp}")
    return " UNION ALL ".join(parts)


SQL: dict[str, str] = {}

# ===================================================================== cleaning

SQL["clean_strings"] = f"""WITH {RAW}
SELECT doc_id, {clean('raw_a')} AS clean_a, {clean('raw_b')} AS clean_b, {clean('raw_c')} AS clean_c,
       {clean('raw_d')} AS clean_d, CAST(length({clean('text')}) AS BIGINT) AS text_len_clean
FROM raw"""

SQL["fill_absence"] = f"""WITH {DOCS}
SELECT doc_id, lang, coalesce(CAST(quality AS VARCHAR), 'None') AS quality_s,
       coalesce(CAST(toxic AS VARCHAR), 'None') AS toxic_s FROM docs"""

SQL["na_tokens"] = f"""WITH w AS (
  SELECT lang, unnest(regexp_extract_all(text, '\\S+')) AS w FROM documents),
t AS (SELECT lang, CASE WHEN w IN ({NA}) THEN NULL ELSE w END AS v FROM w)
SELECT lang, CAST(count(*) AS BIGINT) AS n_tokens,
       CAST(sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_na,
       CAST(sum(CASE WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_numeric
FROM t GROUP BY lang"""

# ===================================================================== features

SQL["feature_ages"] = f"""WITH {ORD}
SELECT o_orderkey, CAST({age('l_ship_year', 'o_year')} AS BIGINT) AS ship_lag_years,
       CAST({age('o_year', 'l_ship_year')} AS BIGINT) AS order_before_ship FROM ord"""

SQL["feature_sums_null"] = f"""WITH {ORD}
SELECT o_orderkey, {r('l_qty + l_n_lines * 0.5', 4)} AS qty_lines,
       {r('l_price + c_acctbal', 4)} AS price_bal FROM ord"""

SQL["feature_sums_zero"] = f"""WITH {ORD}
SELECT o_orderkey, {r('coalesce(l_qty, 0) + coalesce(l_n_lines, 0) * 0.5', 4)} AS qty_lines,
       {r('coalesce(l_price, 0) + coalesce(c_acctbal, 0)', 4)} AS price_bal FROM ord"""

SQL["feature_flags"] = f"""WITH {ORD}
SELECT o_orderkey, {presence('l_n_lines')} AS has_lines, {presence('c_acctbal')} AS has_credit,
       {r('l_qty * l_max_disc', 6)} AS qty_disc FROM ord"""

SQL["feature_log1p"] = f"""WITH {ORD}
SELECT o_orderkey, {', '.join(f"{r(log1p0(c), 8)} AS log1p_{c}" for c in ('l_qty', 'l_price', 'c_acctbal', 'l_n_lines'))}
FROM ord"""

SQL["nominal_cast"] = f"""WITH {ORD}
SELECT o_orderkey, coalesce(CAST(CAST(o_month AS BIGINT) AS VARCHAR), '__MISSING__') AS o_month,
       coalesce(CAST(CAST(n_regionkey AS BIGINT) AS VARCHAR), '__MISSING__') AS n_regionkey,
       coalesce(CAST(CAST(l_n_lines AS BIGINT) AS VARCHAR), '__MISSING__') AS l_n_lines,
       coalesce(c_mktsegment, '__MISSING__') AS c_mktsegment FROM ord"""

SQL["feature_builder"] = f"""WITH {ORD}
SELECT o_orderkey,
       CAST({age('l_ship_year', 'o_year')} AS BIGINT) AS ship_lag_years,
       CAST({age('o_year', 'l_ship_year')} AS BIGINT) AS order_before_ship,
       {r('l_qty + l_n_lines * 0.5', 4)} AS qty_lines,
       {r('l_price + c_acctbal', 4)} AS price_bal,
       {r('l_qty * l_max_disc', 4)} AS qty_disc,
       {presence('l_n_lines')} AS has_lines, {presence('c_acctbal')} AS has_credit,
       {', '.join(f"{r(log1p0(c), 4)} AS log1p_{c}" for c in ('l_qty', 'l_price', 'c_acctbal', 'l_n_lines'))}
FROM ord"""

SQL["target_power_roundtrip"] = f"""WITH {DOCS}, p AS (SELECT unnest([0.0, 0.2, 0.35, 0.5, 0.7, 1.0]) AS p),
f AS (SELECT doc_id, CAST(p AS DOUBLE) AS p,
             CASE WHEN p = 0 THEN ln(1 + n_chars) ELSE pow(CAST(n_chars AS DOUBLE), CAST(p AS DOUBLE)) END AS fwd
      FROM docs, p)
SELECT doc_id, {r('p', 6)} AS p, {r('fwd', 6)} AS fwd,
       {r("CASE WHEN p = 0 THEN exp(fwd) - 1 ELSE pow(greatest(fwd, 0.0), 1.0 / p) END", 6)} AS back
FROM f"""

# ===================================================================== audit

SQL["table_counts"] = f"""WITH {ORD}
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(17 AS BIGINT) AS columns,
       CAST(11 AS BIGINT) AS numeric_features, CAST(5 AS BIGINT) AS categorical_features FROM ord"""

SQL["dup_rows"] = """WITH g AS (SELECT text, lang, source, count(*) AS n FROM documents GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_rows,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows FROM g"""

SQL["dup_keys"] = """WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS distinct_keys,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicate_keys,
       CAST(sum(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN n ELSE 0 END) AS BIGINT) AS null_keys
FROM g"""

_ORD_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_year",
             "o_month", "c_acctbal", "c_mktsegment", "n_name", "n_regionkey", "l_n_lines", "l_qty",
             "l_price", "l_max_disc", "l_ship_year", "o_totalprice"]

SQL["null_profile"] = f"""WITH {ORD}, t AS (SELECT count(*) AS n, {', '.join(f'count(*) - count({c}) AS {c}' for c in _ORD_COLS)} FROM ord),
u AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, {c} AS n_null, n FROM t" for c in _ORD_COLS)})
SELECT column_name AS "column", CAST(n_null AS BIGINT) AS n_null, {r('n_null / n', 8)} AS null_rate
FROM u WHERE n_null > 0"""

_DOCS_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic", "n_words", "n_lines"]
SQL["null_totals"] = f"""WITH {DOCS}, t AS (SELECT {', '.join(f'count(*) - count({c}) AS {c}' for c in _DOCS_COLS)} FROM docs)
SELECT CAST({' + '.join(_DOCS_COLS)} AS BIGINT) AS total_missing,
       CAST({' + '.join(f'CASE WHEN {c} > 0 THEN 1 ELSE 0 END' for c in _DOCS_COLS)} AS BIGINT) AS columns_with_missing
FROM t"""

SQL["target_profile"] = f"""WITH {DOCS}
SELECT CAST(count(n_chars) AS BIGINT) AS n, {r('avg(n_chars)', 4)} AS mean, {r('stddev_samp(n_chars)', 4)} AS std,
       {r('min(n_chars)', 4)} AS min, {r('max(n_chars)', 4)} AS max,
       {r('quantile_cont(CAST(n_chars AS DOUBLE), 0.5)', 4)} AS median FROM docs"""

SQL["skewness_pair"] = f"""WITH {DOCS}
SELECT {r('skewness(CAST(n_chars AS DOUBLE))', 8)} AS skew, {r('skewness(ln(1 + n_chars))', 8)} AS log_skew FROM docs"""

_ORD_NUM = ["c_acctbal", "l_n_lines", "l_qty", "l_price", "l_max_disc", "o_totalprice", "o_year",
            "o_month", "n_regionkey"]

SQL["iqr_outliers"] = f"""WITH {ORD}, q AS ({quantiles_long('ord', _ORD_NUM, [0.25, 0.75])}),
f AS (SELECT column_name, max(CASE WHEN p = 0.25 THEN value END) AS q1,
             max(CASE WHEN p = 0.75 THEN value END) AS q3 FROM q GROUP BY column_name),
c AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, (SELECT count(*) FROM ord, f WHERE f.column_name = '{c}' AND "
    f"(CAST(ord.{c} AS DOUBLE) < f.q1 - 1.5 * (f.q3 - f.q1) OR CAST(ord.{c} AS DOUBLE) > f.q3 + 1.5 * (f.q3 - f.q1))) AS n"
    for c in _ORD_NUM)})
SELECT column_name AS "column", CAST(n AS BIGINT) AS n_outliers FROM c ORDER BY n DESC, column_name LIMIT 15"""

_RAWS = ["raw_a", "raw_b", "raw_c", "raw_d"]


def _wrapped(x: str) -> str:
    return f"CASE WHEN coalesce(starts_with({x}, '''') OR ends_with({x}, ''''), false) THEN 1 ELSE 0 END"


SQL["quote_count"] = f"""WITH {RAW}
SELECT CAST(sum({' + '.join(_wrapped(c) for c in _RAWS)}) AS BIGINT) AS wrapped_raw,
       CAST(sum({' + '.join(_wrapped(clean(c)) for c in _RAWS)}) AS BIGINT) AS wrapped_clean FROM raw"""


def _absent_mismatch(a: str, b: str) -> str:
    return (f"CAST(sum(CASE WHEN ({a} IS NULL OR coalesce({a} = 'None', false)) <> coalesce({b} = 0, false) "
            f"THEN 1 ELSE 0 END) AS BIGINT)")


SQL["consistency"] = f"""WITH {ORD}
SELECT {_absent_mismatch('CAST(l_n_lines AS VARCHAR)', 'l_qty')} AS lines_absence_mismatches,
       {_absent_mismatch('c_mktsegment', 'c_acctbal')} AS credit_absence_mismatches FROM ord"""

_DESC = ["c_acctbal", "l_qty", "l_price", "o_totalprice"]
SQL["describe_cols"] = f"""WITH {ORD}
{' UNION ALL '.join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS BIGINT) AS count, {r(f'avg({c})', 4)} AS mean, "
    f"{r(f'stddev_samp({c})', 4)} AS std, {r(f'min({c})', 4)} AS min, "
    f"{r(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)', 4)} AS q25, {r(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)', 4)} AS q50, "
    f"{r(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)', 4)} AS q75, {r(f'max({c})', 4)} AS max FROM ord" for c in _DESC)}"""

_CORR = ["doc_id", "quality", "toxic", "n_words", "n_lines"]
SQL["target_corr"] = f"""WITH {DOCS}, c AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0) AS corr FROM "
    f"(SELECT CAST({c} AS DOUBLE) AS x, CAST(n_chars AS DOUBLE) AS y FROM docs WHERE {c} IS NOT NULL AND n_chars IS NOT NULL)"
    for c in _CORR)})
SELECT column_name AS "column", {r('abs(corr)', 8)} AS abs_corr FROM c WHERE corr IS NOT NULL
ORDER BY abs(corr) DESC, column_name LIMIT 15"""

SQL["eta_squared"] = f"""WITH {DOCS}, b AS (SELECT *, CAST(quality AS VARCHAR) AS quality_s FROM docs WHERE n_chars IS NOT NULL),
m AS (SELECT avg(n_chars) AS m, sum((n_chars - (SELECT avg(n_chars) FROM b)) ^ 2) AS sst FROM b),
g AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS column_name, coalesce(CAST({c} AS VARCHAR), 'Missing') AS level, count(*) AS n, avg(n_chars) AS lm FROM b GROUP BY 2"
    for c in ['lang', 'source', 'quality_s'])})
SELECT column_name AS "column", {r('CASE WHEN m.sst = 0 THEN 0 ELSE sum(n * (lm - m.m) ^ 2) / m.sst END', 8)} AS eta2
FROM g, m GROUP BY column_name, m.sst ORDER BY eta2 DESC, column_name LIMIT 15"""


SQL["extreme_rows"] = """SELECT doc_id, n_chars, lang, source FROM documents WHERE n_chars > 20000"""

SQL["labelled_docs"] = """SELECT d.doc_id, d.n_chars, d.lang, CAST(l.quality AS BIGINT) AS quality,
       CAST(l.toxic AS BIGINT) AS toxic FROM documents d JOIN labels l USING (doc_id)"""

SQL["event_profile"] = f"""WITH e AS (
  SELECT event_type, value, nullif(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS k_nz FROM events)
SELECT event_type, CAST(count(*) AS BIGINT) AS n, {r('avg(value)', 6)} AS mean_value,
       {r('skewness(value)', 6)} AS skew_value,
       CAST(sum(CASE WHEN k_nz IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS k_missing, {r('avg(k_nz)', 6)} AS mean_k
FROM e GROUP BY event_type"""


def _hist(expr: str, kind: str) -> str:
    return f"""SELECT b.bin, {r('lo + (b.bin - 1) * (hi - lo) / 35', 6)} AS lower, {r('lo + b.bin * (hi - lo) / 35', 6)} AS upper,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n, '{kind}' AS kind
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(1, 36)) b
CROSS JOIN (SELECT min({expr}) AS lo, max({expr}) AS hi FROM docs) lim
LEFT JOIN (SELECT CAST(CASE WHEN l.hi = l.lo THEN 1 ELSE least(floor(35.0 * ({expr} - l.lo) / (l.hi - l.lo)) + 1, 35) END AS BIGINT) AS bin,
                  count(*) AS n
           FROM docs, (SELECT min({expr}) AS lo, max({expr}) AS hi FROM docs) l GROUP BY 1) c ON c.bin = b.bin"""


SQL["target_hist"] = f"""WITH {DOCS}
{_hist('CAST(n_chars AS DOUBLE)', 'raw')} UNION ALL {_hist('ln(1 + n_chars)', 'log1p')}"""

# ===================================================================== validation

SQL["key_violations"] = """SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(count(*) - count(o_orderkey) AS BIGINT) AS null_keys,
       CAST(count(*) - count(DISTINCT o_orderkey) - CASE WHEN count(*) > count(o_orderkey) THEN 1 ELSE 0 END AS BIGINT) AS duplicate_keys,
       'orders' AS table_name FROM orders
UNION ALL
SELECT CAST(sum(n) AS BIGINT), CAST(sum(CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN n ELSE 0 END) AS BIGINT),
       CAST(sum(n) - count(*) AS BIGINT), 'lineitem'
FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)"""

SQL["target_violations"] = """WITH v AS (SELECT TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) AS v FROM events)
SELECT CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS not_numeric,
       CAST(sum(CASE WHEN v IS NOT NULL AND (isnan(v) OR isinf(v)) THEN 1 ELSE 0 END) AS BIGINT) AS not_finite,
       CAST(sum(CASE WHEN v IS NOT NULL AND NOT (isnan(v) OR isinf(v)) AND v <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS not_positive
FROM v"""

# orders.parquet is stored in key order, so file position = key rank
SQL["template_check"] = f"""WITH {ORD}, t AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders),
o AS (SELECT t.o_orderkey, t.pos FROM t JOIN ord USING (o_orderkey)),
n AS (SELECT count(*) AS n FROM t)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM t) AS n_template, (SELECT CAST(count(*) AS BIGINT) FROM o) AS n_output,
       (SELECT CAST(count(*) AS BIGINT) FROM t FULL JOIN o ON t.pos = o.pos WHERE t.o_orderkey IS DISTINCT FROM o.o_orderkey) AS n_mismatch,
       (SELECT CAST(count(*) AS BIGINT) FROM t FULL JOIN o ON t.pos = (SELECT n FROM n) + 1 - o.pos
        WHERE t.o_orderkey IS DISTINCT FROM o.o_orderkey) AS n_mismatch_reversed"""

# ===================================================================== split / folds

SQL["target_bins"] = f"""WITH {DOCS_BINS} SELECT doc_id, CAST(bin AS BIGINT) AS bin FROM docs_b"""

SQL["price_quartiles"] = f"""WITH {ORD}, q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS q2,
                                   quantile_cont(o_totalprice, 0.75) AS q3 FROM ord)
SELECT o_orderkey, CASE WHEN o_totalprice <= q1 THEN 'Q1' WHEN o_totalprice <= q2 THEN 'Q2'
                        WHEN o_totalprice <= q3 THEN 'Q3' ELSE 'Q4' END AS quartile FROM ord, q"""

SQL["split_80_20"] = f"""WITH {DOCS_SPLIT} SELECT doc_id, CAST(bin AS BIGINT) AS bin, split FROM docs_s"""

SQL["kfold"] = (f"WITH {DOCS_FOLDS},\n" + folds("docs_f", "doc_id", "docs_f1", FOLD_SEED + 1, col="fold_r1")
                + "\nSELECT doc_id, CAST(fold AS BIGINT) AS fold, CAST(fold_r1 AS BIGINT) AS fold_r1 FROM docs_f1")

SQL["kfold_nested"] = (f"WITH {DOCS_FOLDS},\nexp AS (SELECT d.*, CAST(o.outer_fold AS INTEGER) AS outer_fold FROM docs_f d, "
                       f"(SELECT unnest(range(0, {K})) AS outer_fold) o WHERE o.outer_fold <> d.fold),\n"
                       + folds("exp", "doc_id", "nest", FOLD_SEED + 100, k=4, col="inner_fold", within="outer_fold")
                       + "\nSELECT doc_id, CAST(fold AS BIGINT) AS fold, CAST(outer_fold AS BIGINT) AS \"outer\", "
                         "CAST(inner_fold AS BIGINT) AS \"inner\" FROM nest")

SQL["split_disjoint"] = f"""WITH {DOCS_SPLIT}, k AS (
  SELECT doc_id, count(*) AS r, sum(CASE WHEN split = 'dev' THEN 1 ELSE 0 END) AS d,
         sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS t FROM docs_s GROUP BY doc_id)
SELECT CAST(sum(r) AS BIGINT) AS n_all, CAST(sum(d) AS BIGINT) AS n_dev, CAST(sum(t) AS BIGINT) AS n_test,
       CAST(sum(CASE WHEN d > 0 AND t > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_overlap,
       CAST(sum(CASE WHEN d > 0 OR t > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_union FROM k"""

# ===================================================================== fitted transforms


def _clip(x: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE least(greatest(CAST({x} AS DOUBLE), {lo}), {hi}) END"


SQL["winsorize"] = f"""WITH {DOCS_SPLIT}, b AS (
  SELECT quantile_cont(CAST(n_words AS DOUBLE), 0.005) AS wl, quantile_cont(CAST(n_words AS DOUBLE), 0.995) AS wu,
         quantile_cont(CAST(n_lines AS DOUBLE), 0.005) AS ll, quantile_cont(CAST(n_lines AS DOUBLE), 0.995) AS lu
  FROM docs_s WHERE split = 'dev')
SELECT doc_id, {r(_clip('n_words', 'wl', 'wu'), 4)} AS n_words, {r(_clip('n_lines', 'll', 'lu'), 4)} AS n_lines
FROM docs_s, b"""

_IMP = ["l_qty", "l_price", "l_n_lines"]

SQL["impute_indicator"] = f"""WITH {ORD_SPLIT}, m AS (
  SELECT {', '.join(f'quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}, count(*) - count({c}) AS nn_{c}' for c in _IMP)}
  FROM ord_s WHERE split = 'dev')
SELECT o_orderkey, {', '.join(f"{r(f'coalesce(CAST({c} AS DOUBLE), m_{c})', 4)} AS {c}" for c in _IMP)},
       {', '.join(f"CAST({c} IS NULL AS DOUBLE) AS missingindicator_{c}" for c in _IMP)}
FROM ord_s, m"""


def _numeric_sql(robust: bool) -> str:
    cols = _IMP + ["c_acctbal"]
    dev = "ord_s WHERE split = 'dev'"
    if robust:
        bounds = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.005) AS lo_{c}, "
                           f"quantile_cont(CAST({c} AS DOUBLE), 0.995) AS hi_{c}" for c in cols)
        clipped = ", ".join(f"{_clip(c, f'lo_{c}', f'hi_{c}')} AS {c}" for c in cols)
        stage1 = f"b AS (SELECT {bounds} FROM {dev}),\nc AS (SELECT o_orderkey, split, {clipped} FROM ord_s, b)"
    else:
        stage1 = f"c AS (SELECT o_orderkey, split, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in cols)} FROM ord_s)"
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}, count(*) - count({c}) AS nn_{c}" for c in cols)
    imputed = ", ".join(f"coalesce({c}, m_{c}) AS {c}, CAST({c} IS NULL AS DOUBLE) AS missingindicator_{c}"
                        for c in cols)
    outs = cols + [f"missingindicator_{c}" for c in cols]
    if robust:
        stats = ", ".join(
            f"quantile_cont({o}, 0.5) AS ce_{o}, "
            f"coalesce(nullif(quantile_cont({o}, 0.75) - quantile_cont({o}, 0.25), 0), 1.0) AS sc_{o}" for o in outs)
    else:
        stats = ", ".join(f"avg({o}) AS ce_{o}, coalesce(nullif(stddev_pop({o}), 0), 1.0) AS sc_{o}" for o in outs)
    # indicator columns exist only for columns with a null among the dev rows
    present = "{present}"
    return (f"WITH {ORD_SPLIT}, {stage1},\nm AS (SELECT {med} FROM c WHERE split = 'dev'),\n"
            f"i AS (SELECT o_orderkey, split, {imputed} FROM c, m),\n"
            f"s AS (SELECT {stats} FROM i WHERE split = 'dev')\n"
            f"SELECT o_orderkey, {present} FROM i, s")


def _numeric_select(cols_with_null: list[str]) -> str:
    cols = _IMP + ["c_acctbal"]
    outs = cols + [f"missingindicator_{c}" for c in cols if c in cols_with_null]
    return ", ".join(f"{r(f'({o} - ce_{o}) / sc_{o}', 6)} AS {o}" for o in outs)


# at every scale factor some orders have no lines, c_acctbal never misses
SQL["standard_scale"] = _numeric_sql(False).replace("{present}", _numeric_select(_IMP))
SQL["robust_scale"] = _numeric_sql(True).replace("{present}", _numeric_select(_IMP))


def _ordinal(c: str, levels: list[str]) -> str:
    arr = "[" + ", ".join("'" + lv + "'" for lv in levels) + "]"
    return f"CAST(coalesce(list_position({arr}, coalesce({c}, 'Missing')), 0) - 1 AS DOUBLE)"


_ORD_LEVELS = {
    "o_orderpriority": ["Missing", "5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"],
    "o_orderstatus": ["Missing", "P", "O"],
}

SQL["ordinal_encode"] = f"""WITH {ORD_SPLIT}, e AS (
  SELECT o_orderkey, split, {', '.join(f'{_ordinal(c, lv)} AS {c}' for c, lv in _ORD_LEVELS.items())} FROM ord_s),
s AS (SELECT {', '.join(f'avg({c}) AS ce_{c}, coalesce(nullif(stddev_pop({c}), 0), 1.0) AS sc_{c}' for c in _ORD_LEVELS)}
      FROM e WHERE split = 'dev')
SELECT o_orderkey, {', '.join(f"{r(f'({c} - ce_{c}) / sc_{c}', 6)} AS {c}" for c in _ORD_LEVELS)} FROM e, s"""

SQL["onehot_rare"] = f"""WITH {DOCS_SPLIT}, v AS (SELECT *, lang || '-' || source AS lang_source FROM docs_s),
c AS (SELECT coalesce(lang_source, 'Missing') AS level, count(*) AS n FROM v WHERE split = 'dev' GROUP BY 1),
f AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS slot FROM c WHERE n >= 8),
nf AS (SELECT count(*) AS nf FROM f),
d AS (SELECT level, slot FROM f UNION ALL SELECT level, (SELECT nf FROM nf) FROM c WHERE n < 8),
ns AS (SELECT max(slot) + 1 AS ns FROM d)
SELECT doc_id, lang_source, CAST(coalesce(d.slot, -1) AS BIGINT) AS slot, CAST((SELECT ns FROM ns) AS BIGINT) AS n_slots
FROM v LEFT JOIN d ON coalesce(v.lang_source, 'Missing') = d.level"""

SQL["target_scale"] = f"""WITH {DOCS_SPLIT}, s AS (
  SELECT avg(ln(1 + n_chars)) AS ce, coalesce(nullif(stddev_pop(ln(1 + n_chars)), 0), 1.0) AS sc
  FROM docs_s WHERE split = 'dev')
SELECT doc_id, {r('(ln(1 + n_chars) - ce) / sc', 6)} AS z,
       {r('greatest(exp(((ln(1 + n_chars) - ce) / sc) * sc + ce) - 1, 0.0)', 6)} AS back FROM docs_s, s"""

SQL["fold_params"] = f"""WITH {DOCS_FOLDS}, f AS (SELECT DISTINCT fold FROM docs_f),
t AS (SELECT f.fold, d.n_words, d.n_lines FROM f JOIN docs_f d ON d.fold <> f.fold)
SELECT CAST(fold AS BIGINT) AS fold, feature, stat, {r('value', 6)} AS value FROM (
  SELECT fold, 'n_words' AS feature, 'center' AS stat, avg(n_words) AS value FROM t GROUP BY fold
  UNION ALL SELECT fold, 'n_words', 'scale', coalesce(nullif(stddev_pop(n_words), 0), 1.0) FROM t GROUP BY fold
  UNION ALL SELECT fold, 'n_lines', 'center', avg(n_lines) FROM t GROUP BY fold
  UNION ALL SELECT fold, 'n_lines', 'scale', coalesce(nullif(stddev_pop(n_lines), 0), 1.0) FROM t GROUP BY fold
  UNION ALL SELECT fold, 'n_words', 'median', quantile_cont(CAST(n_words AS DOUBLE), 0.5) FROM t GROUP BY fold
  UNION ALL SELECT fold, 'n_lines', 'median', quantile_cont(CAST(n_lines AS DOUBLE), 0.5) FROM t GROUP BY fold)"""

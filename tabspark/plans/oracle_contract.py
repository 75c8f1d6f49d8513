"""DuckDB statements of the contract queries."""

from __future__ import annotations

from .common import SPLIT_SEED
from .oracle import SQL

SQL["nan_audit"] = """
SELECT 'v' AS "column", count(*) FILTER (doc_id % 7 = 0 OR doc_id % 11 = 0) AS n_null,
       round(count(*) FILTER (doc_id % 7 = 0 OR doc_id % 11 = 0) / count(*), 6) AS null_rate FROM documents"""

SQL["null_strata_split"] = f"""
WITH r AS (SELECT doc_id, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id::VARCHAR || '-{SPLIT_SEED}'), doc_id) AS r,
                  count(*) OVER (PARTITION BY quality) AS n FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN r <= floor((n * 20 + 99) / 100) THEN 'test' ELSE 'dev' END AS split FROM r"""

SQL["csv_contract"] = "SELECT doc_id, n_chars, md5(text) AS text_md5 FROM documents"

SQL["template_fill"] = 'SELECT doc_id AS "Id", n_chars / 2.0 AS "Prediction" FROM documents'

SQL["dup_events"] = """
WITH m AS (SELECT * FROM events UNION ALL
           SELECT * REPLACE (CASE WHEN event_id % 20 = 0 THEN ts + to_microseconds(event_id % 3) ELSE ts END AS ts) FROM events WHERE event_id % 10 = 0),
u AS (SELECT DISTINCT * FROM m)
SELECT (SELECT count(*) FROM m) AS rows, (SELECT count(*) FROM u) AS distinct_rows,
       (SELECT count(*) FROM m) - (SELECT count(*) FROM u) AS duplicate_rows"""

# row text of the digest: byte count, colon and value per column
_TEXTS = [f"l_{c}::VARCHAR" for c in ("orderkey", "partkey", "suppkey", "linenumber", "quantity", "extendedprice", "discount",
                                      "tax", "returnflag", "linestatus")] + ["strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f')"]
_LINE = " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in _TEXTS)
SQL["table_digest"] = f"""
WITH h AS (SELECT md5({_LINE}) AS m FROM lineitem),
s AS (SELECT count(*) AS rows, sum(('0x' || m[1:16])::UBIGINT) % 18446744073709551616 AS a, sum(('0x' || m[17:32])::UBIGINT) % 18446744073709551616 AS b FROM h)
SELECT rows, format('{{:016x}}', a::UBIGINT) || format('{{:016x}}', b::UBIGINT) AS digest FROM s"""

"""The thin opN queries over the driver's tables, and their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, language_id, merkle, token_records, toxicity
from .embedding_dedup import near_vectors
from .exact_dedup import exact_groups
from .line_dedup import drop_lines
from .mixing import mix
from .pii import pseudonymise
from .sampling import held_out
from .simhash import near_groups
from .substring_dedup import remove_repeats
from .vector_codes import vector_codes


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", held_out())
    labels = _table(spark, sf_dir, "labels").filter(~held_out())
    model = toxicity.fit(docs.filter("not held_out"), labels)
    return toxicity.score(docs, model, threshold=0.3).drop("text")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = drop_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = near_groups(_table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=3, radius=2)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), threshold=0.93)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = language_id.fit(docs.filter("not held_out"))
    return language_id.identify(docs.select("doc_id", "text", "held_out"), model).drop("text")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), length=13)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), key="public example key")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    words = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    rows = bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), *words).drop("text")
    return bpe.decode(rows, *words).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), parts=8, entries=16, rounds=6, scale=4096)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    col = F.col
    changed = F.coalesce(F.crc32(col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    claimed = merkle.leaf_digest([col("doc_id"), col("source"), col("lang"), F.when(changed, col("n_chars") + 1).otherwise(col("n_chars")), col("text")])
    made = merkle.merkle_manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"claimed": claimed})
    return made.rows.select(
        "doc_id", "leaf", "subroot", F.lit(made.root).cast("string").alias("root"), merkle.proof_digest(col("path")).alias("proof_sha256"),
        merkle.fold(col("claimed"), col("path")).alias("folded_root")).withColumn("verified", col("folded_root") == col("root"))


def op13_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = token_records.write_records(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                           public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_records.read_records(manifest).select(
        "doc_id", "start", F.expr("length(ids) div 4").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def _lloyd_sql(rounds: int) -> str:
    """Chained rounds over (vec_id, p, x): a has each part's nearest entry, b the codebooks."""
    nearest = """SELECT vec_id, p, min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c))::BIGINT * 16 + e) AS m
                FROM parts JOIN b{k} USING (p) GROUP BY vec_id, p"""
    steps = []
    for k in range(rounds):
        steps.append(f"""a{k} AS MATERIALIZED ({nearest.format(k=k)}),
        s{k} AS (SELECT p, m % 16 AS e, i, sum(x[i]::BIGINT)::BIGINT AS s, count(*) AS n
                 FROM a{k} JOIN parts USING (vec_id, p), (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM parts))) AS i) GROUP BY ALL),
        n{k} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS c FROM s{k} GROUP BY p, e),
        b{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(n{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN n{k} USING (p, e))""")
    return f"""
        WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)) AS v FROM embeddings
                      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT vec_id, p, v[p * len(v) // 8 + 1:(p + 1) * len(v) // 8] AS x FROM kept, (SELECT unnest(range(8)) AS p)),
        b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts QUALIFY e < 16),
        {", ".join(steps)},
        last AS ({nearest.format(k=rounds)}),
        coded AS (SELECT vec_id, string_agg(format('{{:02x}}', m % 16), '' ORDER BY p) AS code, sum(m // 16)::BIGINT AS error FROM last GROUP BY vec_id),
        book AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
        FROM coded JOIN kept USING (vec_id), book"""


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_line_dedup": op6_line_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_pii": op9_pii,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_vector_codes": op11_vector_codes,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_records": op13_token_records,
}

SQL = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
    "op2_embedding_near_dedup": r"""
        WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id
                  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
        many AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
               vec_id = coalesce(component_id, vec_id) AS kept
        FROM embeddings LEFT JOIN many ON vec_id = many.a LEFT JOIN least ON vec_id = least.a""",
    "op4_substring_dedup": r"""
        WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        starts AS (SELECT doc_id, w, unnest(range(len(w) - 12)) AS s FROM words WHERE len(w) >= 13),
        windows AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 13], ' ') AS seq FROM starts),
        marked AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY seq) AS first FROM windows),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 13)) AS i FROM marked WHERE first < doc_id),
        one AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM words),
        kept AS (SELECT one.doc_id, count(*) FILTER (gone.i IS NOT NULL) AS n_removed,
                        string_agg(word, ' ' ORDER BY one.i) FILTER (gone.i IS NULL) AS text
                 FROM one LEFT JOIN gone ON one.doc_id = gone.doc_id AND one.i = gone.i GROUP BY one.doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM words LEFT JOIN kept USING (doc_id)""",
    "op6_line_dedup": r"""
        WITH cut AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        lines AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM cut),
        keys AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        bad AS (SELECT key FROM keys WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (bad.key IS NOT NULL) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (bad.key IS NULL), '')) AS kept_sha256
        FROM keys LEFT JOIN bad ON keys.key = bad.key GROUP BY doc_id""",
    "op7_source_mixing": r"""
        WITH sized AS (SELECT doc_id, source, coalesce(doc_id::VARCHAR, 'null|' || md5(coalesce(text, ''))) AS mark, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
                       FROM documents),
        sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
        ranked AS (SELECT *, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS weight FROM sums),
        filled AS (SELECT *, 3 * source_size AS most FROM ranked WHERE source_size > 0),
        before AS (SELECT *, sum(most) OVER () / 3 - coalesce(sum(most) OVER w, 0) AS free,
                          sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS rest
                   FROM filled WINDOW w AS (ORDER BY most::DOUBLE / weight, source IS NULL, source
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        share AS (SELECT free, rest FROM before WHERE free::DOUBLE * weight::DOUBLE / rest::DOUBLE <= most
                  ORDER BY most::DOUBLE / weight, source IS NULL, source LIMIT 1),
        targets AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0 ELSE
                           least((SELECT free FROM share)::DOUBLE * weight::DOUBLE / (SELECT rest FROM share)::DOUBLE,
                                 (3 * source_size)::DOUBLE) END AS target FROM ranked),
        rated AS (SELECT doc_id, size, source_size, target,
                         CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate,
                         ('0x' || substr(md5('17|' || mark), 1, 13))::BIGINT::DOUBLE
                         / 4503599627370496.0 AS draw
                  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source)
        SELECT doc_id, size, source_size, target,
               (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM rated""",
    "op11_vector_codes": _lloyd_sql(6),
    "op12_merkle_manifest": r"""
        WITH RECURSIVE fields AS (
            SELECT doc_id, lang, coalesce((xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
                lambda c, b: list_reduce(range(8), lambda y, k: xor(y >> 1, (y & 1) * 3988292384), xor(c, b)), 4294967295::BIGINT), 4294967295::BIGINT)) % 7 = 0, false) AS bad,
                [doc_id::VARCHAR, source, lang, n_chars::VARCHAR, text] AS own, [doc_id::VARCHAR, source, lang, (n_chars + 1)::VARCHAR, text] AS other FROM documents),
        hashed AS (SELECT doc_id, lang, sha256(list_aggregate(list_transform(own, lambda x: coalesce(strlen(x) || ':' || x, '-')), 'string_agg', '')) AS leaf,
                   sha256(list_aggregate(list_transform(CASE WHEN bad THEN other ELSE own END, lambda x: coalesce(strlen(x) || ':' || x, '-')), 'string_agg', '')) AS claimed FROM fields),
        leaves AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM hashed WINDOW w AS (PARTITION BY lang ORDER BY doc_id)),
        nodes AS (SELECT lang, 0 AS level, i, n, leaf AS digest FROM leaves UNION ALL
                  SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY lang, level, i // 2, n),
        subs AS (SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
        tops AS (SELECT 0 AS level, i, n, subroot AS digest FROM subs UNION ALL
                 SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 2, n),
        low AS (SELECT doc_id, lang, leaf, 0 AS level, i, n, claimed AS acc, '' AS proof FROM leaves UNION ALL
                SELECT doc_id, low.lang, leaf, low.level + 1, low.i // 2, (low.n + 1) // 2,
                       sha256(CASE WHEN s.i < low.i THEN s.digest ELSE '' END || acc || CASE WHEN s.i > low.i THEN s.digest ELSE '' END), proof || coalesce(s.digest, '')
                FROM low LEFT JOIN nodes AS s ON s.lang IS NOT DISTINCT FROM low.lang AND s.level = low.level AND s.i = xor(low.i, 1) WHERE low.n > 1),
        high AS (SELECT doc_id, leaf, subroot, 0 AS level, subs.i, subs.n, acc, proof FROM low JOIN subs ON low.lang IS NOT DISTINCT FROM subs.lang WHERE low.n = 1 UNION ALL
                 SELECT doc_id, leaf, subroot, high.level + 1, high.i // 2, (high.n + 1) // 2,
                        sha256(CASE WHEN s.i < high.i THEN s.digest ELSE '' END || acc || CASE WHEN s.i > high.i THEN s.digest ELSE '' END), proof || coalesce(s.digest, '')
                 FROM high LEFT JOIN tops AS s ON s.level = high.level AND s.i = xor(high.i, 1) WHERE high.n > 1)
        SELECT doc_id, leaf, subroot, tops.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = tops.digest AS verified
        FROM high, tops WHERE high.n = 1 AND tops.n = 1""",
}

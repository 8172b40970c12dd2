"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedsync.llm.common import ship_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.mtree import top_k

    ship_package(spark)
    return top_k(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.pieces import piece_digests

    ship_package(spark)
    return piece_digests(_table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.packing import pack_documents

    ship_package(spark)
    return pack_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.warc import read_warc, write_warc

    ship_package(spark)
    out, manifest = write_warc(_table(spark, sf_dir, "pages"))
    return read_warc(manifest, out)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.exact import duplicate_groups

    return duplicate_groups(_table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.token_files import read_token_files, write_token_files

    ship_package(spark)
    out, manifest = write_token_files(_table(spark, sf_dir, "documents"))
    return read_token_files(manifest, out)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.chat import conversation_digests, format_conversations

    ship_package(spark)
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], turns.schema)
    return conversation_digests(format_conversations(turns.unionByName(extra)))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.toxicity import toxicity

    ship_package(spark)
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.neardup import near_duplicate_classes

    ship_package(spark)
    return near_duplicate_classes(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.substring import removal_digests

    ship_package(spark)
    return removal_digests(_table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.centroids import cluster_report

    ship_package(spark)
    return cluster_report(_table(spark, sf_dir, "embeddings"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.pii import personal_data

    ship_package(spark)
    return personal_data(_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from feedsync.llm.divergence import divergence

    ship_package(spark)
    return divergence(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mtree_top_k": op1_mtree_top_k,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_warc": op4_warc,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_token_files": op6_token_files,
    "op7_chat_format": op7_chat_format,
    "op8_toxicity": op8_toxicity,
    "op9_near_dedup": op9_near_dedup,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_pii": op12_pii,
    "op13_source_divergence": op13_source_divergence,
}

def _clustering_sql(rounds: int = 5) -> str:
    """Five rounds and a last assignment, one pair of tables each."""
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""
        s{t} AS MATERIALIZED (
            SELECT r, vec_id, q, first(k ORDER BY d, k) AS k, min(d) AS d FROM (
                SELECT r, vec_id, v.q, k, list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(v.q, c.q)]) AS d
                FROM v, c{t} c
            ) GROUP BY r, vec_id, q
        )""")
        if t < rounds:
            steps.append(f"""
        c{t + 1} AS MATERIALIZED (
            SELECT k, coalesce(m.q, c.q) AS q FROM c{t} c LEFT JOIN (
                SELECT k, list(x ORDER BY i) AS q FROM (
                    SELECT k, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
                    FROM (SELECT k, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM s{t}) GROUP BY k, i
                ) GROUP BY k
            ) m USING (k)
        )""")
    last = f"s{rounds}"
    return f"""
        WITH v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q
            FROM embeddings
            WHERE len(embedding) = 64 AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), q) - 1 AS k, q FROM v ORDER BY k LIMIT 40
        ), {",".join(steps)}
        SELECT vec_id, k::INTEGER AS cluster, d::BIGINT AS distance,
               (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(c.q, ',')) AS centroid_sha256
        FROM {last} JOIN c{rounds} c USING (k)
    """


ORACLES: dict[str, str] = {
    "op10_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
            FROM documents
        ), g AS (
            SELECT doc_id, i, list_slice(w, i, i + 12) AS win
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
        ), r AS (
            SELECT doc_id, i FROM g JOIN (SELECT win, min(doc_id) AS first FROM g GROUP BY win) USING (win)
            WHERE doc_id > first
        ), c AS (SELECT DISTINCT doc_id, i + t AS i FROM r, range(13) o(t)),
        k AS (
            SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id
        )
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
               sha256(array_to_string([x FOR x, i IN w IF gone IS NULL OR NOT list_contains(gone, i)], ' '))
                   AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
    "op1_mtree_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS q FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
            FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """,
    "op4_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
                   sha256(coalesce(html, '')) AS digest
            FROM pages
        ), k AS (SELECT digest, min(page_id) AS keep FROM p WHERE n >= 100 GROUP BY digest)
        SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN k.keep IS NULL OR k.keep = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN k.keep <> p.page_id THEN k.keep END AS refers_to
        FROM p LEFT JOIN k ON p.n >= 100 AND p.digest = k.digest
    """,
    "op5_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        ), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, d.text_sha256
        FROM d JOIN g USING (text_sha256)
    """,
    "op7_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
        ), m AS (
            SELECT *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
                   + 3 * len(regexp_extract_all(text,
                       '</?s>|\[/?INST\]|<</?SYS>>|\[ROLE\]|\[TEXT\]|\[END\]'))
                   + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 4
                     ELSE 17 + length(role) END AS chars
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), ''))
                   AS loss_sha256,
               (sum(chars) + 3)::BIGINT AS formatted_chars
        FROM m GROUP BY conv_id
    """,
    "op11_centroid_clustering": _clustering_sql(),
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), g AS (SELECT DISTINCT lang, source FROM d),
        o AS (SELECT r, lang, source, unnest(w) AS term FROM d),
        k AS MATERIALIZED (
            SELECT lang, term, count(*)::HUGEINT AS c FROM o GROUP BY lang, term HAVING count(DISTINCT r) >= 30
        ), l AS (SELECT lang, count(*)::HUGEINT AS v, sum(c)::HUGEINT AS n FROM k GROUP BY lang),
        c AS MATERIALIZED (
            SELECT lang, source, term, count(*)::HUGEINT AS c FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL
        ), n AS (SELECT lang, source, sum(c)::HUGEINT AS n FROM c GROUP BY ALL),
        p AS MATERIALIZED (
            SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
                   1 + (1000000000 * (coalesce(c.c, 0) + 5)) // (coalesce(n.n, 0) + 5 * l.v) AS p,
                   1 + (1000000000 * (k.c + 5)) // (l.n + 5 * l.v) AS q
            FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN n USING (lang, source)
                LEFT JOIN c USING (lang, source, term)
        ), f AS (
            SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM g a JOIN g b USING (lang) LEFT JOIN (
                SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
                FROM p x JOIN p y USING (lang, term) GROUP BY ALL
            ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            WHERE a.source <> b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
            FROM f
        )
        SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 50
    """,
}

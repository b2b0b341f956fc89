"""The digest queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.llm import (
    conversations,
    exact_dedup,
    importance,
    langid,
    minhash,
    mixing,
    neighbours,
    packing,
    quality,
    token_counts,
    token_files,
    top_search,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 2048

# Batches for Python workers stay small where texts are long.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def settle(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return settle(spark).read.parquet(f"{folder}/{name}.parquet")


def op1(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"), digests=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op2(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_groups(table(spark, folder, "documents"))


def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4(spark: SparkSession, folder: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, folder, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op5(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(table(spark, folder, "documents"))


def op6(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies"
    )


def op8(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


def op9(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.neighbours(table(spark, folder, "embeddings"))


def op10(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op11(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    found = conversations.repair(conversations.damage(rows)).withColumnRenamed("conv_id", "_conv_id")
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero = F.lit(0).cast("long")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select(
        "conv_id", *[F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12(spark: SparkSession, folder: str) -> DataFrame:
    return top_search.top_search(table(spark, folder, "embeddings"))


def op13(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank"
    )


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1,
    "op2_minhash": op2,
    "op3_quality": op3,
    "op4_token_counts": op4,
    "op5_token_files": op5,
    "op6_toxicity": op6,
    "op7_mixing": op7,
    "op8_language": op8,
    "op9_neighbours": op9,
    "op10_packing": op10,
    "op11_conversations": op11,
    "op12_top_search": op12,
    "op13_importance": op13,
}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op2_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS ws
            FROM documents
        ), sh AS (
            SELECT DISTINCT doc_id, unnest(
                CASE WHEN len(ws) = 0 THEN []
                     WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
                     ELSE [array_to_string(ws[i:i + 4], ' ') FOR i IN range(1, len(ws) - 3)] END) AS s
            FROM w
        ), n AS (
            SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS x, b.doc_id AS y
            FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n
            HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
        ), reach AS (
            SELECT doc_id AS x, doc_id AS y FROM documents
            UNION
            SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
        FROM documents d LEFT JOIN n USING (doc_id)
        JOIN (SELECT x, min(y) AS c FROM reach GROUP BY x) r ON r.x = d.doc_id
    """,
    # The same lattice by dynamic programming from the end: sN is the least "cost, edits" text from a row on in state N.
    "op11_conversations": r"""
        WITH RECURSIVE half AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0], lambda c, ignored: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
                        ORDER BY i) AS t
            FROM (SELECT unnest(range(16))::BIGINT AS i)
        ), keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS h
            FROM conversations
        ), kinds AS (
            SELECT conv_id, turn, role, text, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(length(h)), lambda i:
                    (strpos('0123456789ABCDEF', h[(i // 2) * 2 + 2 - i % 2]) - 1)::BIGINT)),
                lambda c, b: xor(c // 16, t[xor(c % 16, b) + 1])), 4294967295) % 20 AS k
            FROM keyed, half
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                   CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM kinds WHERE k <> 0
            UNION ALL
            SELECT conv_id, turn, role, text FROM kinds WHERE k = 3
        ), numbered AS (
            SELECT coalesce(conv_id, -1) AS c, conv_id IS NULL AS nc, turn, role, text, substr(role, 1, 1) AS x,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                   count(*) OVER (PARTITION BY conv_id) AS n,
                   regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS z
            FROM damaged
        ), rows_ AS (
            SELECT *, z = '' AS blank,
                   z <> '' AND row_number() OVER (PARTITION BY c, nc, role, text ORDER BY i) > 1 AS dup,
                   z NOT IN ('', '.', '!', '?') AND row_number() OVER (PARTITION BY c, nc, role, text ORDER BY i) = 1 AS trunc,
                   i > 1 AND lag(x) OVER (PARTITION BY c, nc ORDER BY i) || x NOT IN ('su', 'ua', 'au') AS bad
            FROM numbered
        ), dp AS (
            SELECT DISTINCT c, nc, n + 1 AS i, '000000000' AS s0, '000000006II' AS s1, '000000003I' AS s2, '000000000' AS s3 FROM rows_
            UNION ALL
            SELECT c, nc, i, least(o0, lpad((substr(p2, 1, 9)::BIGINT + 3)::VARCHAR, 9, '0') || 'I' || substr(p2, 10)),
                   least(o1, lpad((substr(p2, 1, 9)::BIGINT + 3)::VARCHAR, 9, '0') || 'I' || substr(p2, 10)), p2,
                   least(o3, lpad((substr(o2, 1, 9)::BIGINT + 3)::VARCHAR, 9, '0') || 'I' || substr(o2, 10))
            FROM (
                SELECT *, least(o2, lpad((substr(o3, 1, 9)::BIGINT + 3)::VARCHAR, 9, '0') || 'I' || substr(o3, 10)) AS p2
                FROM (
                    SELECT r.c, r.nc, r.i,
                        least(lpad((substr(s0, 1, 9)::BIGINT + 4)::VARCHAR, 9, '0') || 'D' || substr(s0, 10),
                              CASE WHEN NOT (blank OR dup) AND x = 's' THEN lpad((substr(s1, 1, 9)::BIGINT + e)::VARCHAR, 9, '0') || 'K' || substr(s1, 10) END,
                              ku, ru) AS o0,
                        least(lpad((substr(s1, 1, 9)::BIGINT + 4)::VARCHAR, 9, '0') || 'D' || substr(s1, 10), ku, ru) AS o1,
                        least(lpad((substr(s2, 1, 9)::BIGINT + 4)::VARCHAR, 9, '0') || 'D' || substr(s2, 10),
                              CASE WHEN NOT (blank OR dup) AND x = 'a' THEN lpad((substr(s3, 1, 9)::BIGINT + e)::VARCHAR, 9, '0') || 'K' || substr(s3, 10) END,
                              CASE WHEN NOT (blank OR dup) THEN lpad((substr(s3, 1, 9)::BIGINT + e + 3)::VARCHAR, 9, '0') || 'R' || substr(s3, 10) END) AS o2,
                        least(lpad((substr(s3, 1, 9)::BIGINT + 4)::VARCHAR, 9, '0') || 'D' || substr(s3, 10), ku, ru) AS o3
                    FROM (
                        SELECT r.c, r.nc, r.i, r.x, r.blank, r.dup, 3 * r.trunc::BIGINT AS e, s0, s1, s2, s3,
                            CASE WHEN NOT (blank OR dup) AND x = 'u'
                                 THEN lpad((substr(s2, 1, 9)::BIGINT + 3 * r.trunc::BIGINT)::VARCHAR, 9, '0') || 'K' || substr(s2, 10) END AS ku,
                            CASE WHEN NOT (blank OR dup)
                                 THEN lpad((substr(s2, 1, 9)::BIGINT + 3 * r.trunc::BIGINT + 3)::VARCHAR, 9, '0') || 'R' || substr(s2, 10) END AS ru
                        FROM dp JOIN rows_ r ON r.c = dp.c AND r.nc = dp.nc AND r.i = dp.i - 1
                    ) r
                )
            )
        ), solved AS (
            SELECT c, nc, substr(s0, 1, 9)::BIGINT AS cost, substr(s0, 10) AS audit FROM dp WHERE i = 1
        ), letters AS (
            SELECT c, nc, audit, unnest(range(1, length(audit) + 1)) AS p FROM solved
        ), edits AS (
            SELECT c, nc, substr(audit, p, 1) AS l, length(regexp_replace(substr(audit, 1, p), 'I', '', 'g')) AS i,
                   length(regexp_replace(substr(audit, 1, p), 'D', '', 'g')) AS o, length(regexp_replace(audit, 'D', '', 'g')) AS said
            FROM letters
        ), turns AS (
            SELECT e.c, e.nc, string_agg(
                CASE WHEN l = 'K' THEN role WHEN (o - 1 - said % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
                || ':' || CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY o) AS whole
            FROM edits e JOIN rows_ r ON r.c = e.c AND r.nc = e.nc AND r.i = greatest(e.i, 1) WHERE l <> 'D' GROUP BY ALL
        ), reports AS (
            SELECT c, nc, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                   count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated, count(*) FILTER (bad) AS illegal
            FROM rows_ GROUP BY ALL
        )
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
               sha256(coalesce(whole, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN reports r ON r.c = coalesce(o.conv_id, -1) AND r.nc = (o.conv_id IS NULL)
        LEFT JOIN solved s ON s.c = r.c AND s.nc = r.nc
        LEFT JOIN turns t ON t.c = r.c AND t.nc = r.nc
    """,
    "op12_top_search": r"""
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    # CRC-32 by half bytes over the hexadecimal text; its table follows from the reversed polynomial EDB88320.
    "op13_importance": r"""
        WITH half AS (
            SELECT list(list_reduce([i, 0, 0, 0, 0], lambda c, ignored: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)
                        ORDER BY i) AS t
            FROM (SELECT unnest(range(16))::BIGINT AS i)
        ), texts AS (
            SELECT 's' AS side, doc_id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark
        ), words AS (
            SELECT side, doc_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
            FROM texts
        ), bytes AS (
            SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)
        ), hashed AS (
            SELECT w, xor(list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(range(length(h)), lambda i:
                    (strpos('0123456789ABCDEF', h[(i // 2) * 2 + 2 - i % 2]) - 1)::BIGINT)),
                lambda c, b: xor(c // 16, t[xor(c % 16, b) + 1])), 4294967295) % 10000 AS bucket
            FROM bytes, half
        ), counted AS (
            SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
            FROM words JOIN hashed USING (w) GROUP BY bucket
        ), gains AS (
            SELECT bucket, floor(1000.0::DOUBLE * ln(
                (t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)
            ))::BIGINT AS gain
            FROM counted
        ), weights AS (
            SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight
            FROM words JOIN hashed USING (w) JOIN gains USING (bucket) WHERE side = 's' GROUP BY doc_id
        ), scored AS (
            SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
                   coalesce(weight, 0) + floor(-1000.0::DOUBLE * ln(-ln(
                       (('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE
                   )))::BIGINT AS score
            FROM documents d LEFT JOIN weights USING (doc_id)
        ), ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * n // 100 THEN r END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
}


def all_queries() -> dict[str, Query]:
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)

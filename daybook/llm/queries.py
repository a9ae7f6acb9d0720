"""Registered queries of the subpackage: thin, each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    ann,
    bpe,
    chat,
    fim,
    leaks,
    minhash,
    pieces,
    pii,
    secrets,
    suffixes,
    tokencount,
    tournament,
    toxicity,
)
from daybook.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 1024


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary file; the installed package is the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.lit(r"\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.format_chats(rows.unionByName(extra)))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row", "distance")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokencount.count_tokens(docs, tokenizer_file("byte_bpe_50k.json"), TOKEN_LIMIT)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(suffixes.without_repeats(table(spark, sf_dir, "documents")))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tournament.cluster(table(spark, sf_dir, "embeddings")).drop("centroid")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_minhash": op1_minhash,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_pii": op3_pii,
    "op4_chat": op4_chat,
    "op5_toxicity": op5_toxicity,
    "op6_secrets": op6_secrets,
    "op7_decontamination": op7_decontamination,
    "op8_token_counts": op8_token_counts,
    "op9_neighbours": op9_neighbours,
    "op10_suffixes": op10_suffixes,
    "op11_bpe": op11_bpe,
    "op12_centroids": op12_centroids,
    "op13_fill_in_middle": op13_fill_in_middle,
}

_ALL_TURNS = r"""
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
"""


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds of exact integer k-means written out, two tables a round."""
    near = """d{r} AS (
    SELECT rid, num, list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i]))) AS d
    FROM p, c{r}
),
a{r} AS (
    SELECT rid, num, d FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY d, num) AS place FROM d{r}) WHERE place = 1
)"""
    move = """s{r} AS (
    SELECT num, i, sum(v[i])::HUGEINT AS s, count(*) AS n
    FROM a{r} JOIN p USING (rid), range(1, 65) t(i) GROUP BY num, i
),
c{n} AS (
    SELECT num, coalesce(m, c) AS c FROM c{r} LEFT JOIN (
        SELECT num, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS m FROM s{r} GROUP BY num
    ) USING (num)
)"""
    steps = [x for r in range(rounds) for x in (near.format(r=r), move.format(r=r, n=r + 1))]
    between = ",\n"
    return f"""
WITH p AS (
    SELECT row_number() OVER () AS rid, vec_id,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS num, v AS c
    FROM p QUALIFY num < {k}
),
{between.join(steps)},
{near.format(r=rounds)}
SELECT vec_id, num::INTEGER AS cluster, d::BIGINT AS distance,
    (sum(d) OVER (PARTITION BY num))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
    sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN p USING (rid) JOIN c{rounds} USING (num)
"""


ORACLE_SQL: dict[str, str] = {
    "op12_centroids": _clusters_sql(),
    "op13_fill_in_middle": r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
        sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
),
drawn AS (
    SELECT doc_id, t, n,
        CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS x, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS y,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
            WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM d
),
parts AS (
    SELECT *, least(x, y) AS a, greatest(x, y) AS b,
        substring(t, 1, least(x, y)) AS p, substring(t, least(x, y) + 1, greatest(x, y) - least(x, y)) AS m,
        substring(t, greatest(x, y) + 1) AS s
    FROM drawn
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
    sha256(t) AS restored_sha256
FROM parts
""",
    "op7_decontamination": r"""
WITH d AS (
    SELECT DISTINCT doc_id, [x for x in regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') if x <> ''] AS w FROM documents
),
b AS (
    SELECT DISTINCT item_id, [x for x in regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') if x <> ''] AS w FROM benchmark
),
items AS (SELECT item_id, w, least(len(w), 5) AS width, len(w) - least(len(w), 5) + 1 AS m FROM b WHERE len(w) > 0),
item_shingles AS (
    SELECT item_id, w, m, width, s, count(*) AS times
    FROM (SELECT *, unnest([array_to_string(w[i:i + width - 1], ' ') for i in range(1, m + 1)]) AS s FROM items)
    GROUP BY ALL
),
doc_shingles AS (
    SELECT doc_id, w, width, i, len(w) - width + 1 AS n, array_to_string(w[i:i + width - 1], ' ') AS s
    FROM (SELECT doc_id, d.w, width, unnest(range(1, len(d.w) - width + 2)) AS i
          FROM d, (SELECT DISTINCT width FROM items) WHERE len(d.w) >= width)
),
seeds AS (
    SELECT doc_id, x.w AS dw, item_id, y.w AS iw, i, n, m, s, times
    FROM doc_shingles x JOIN item_shingles y USING (width, s)
),
starts AS (SELECT DISTINCT doc_id, dw, item_id, iw, greatest(1, least(i, n - least(m, n) + 1)) AS t FROM seeds),
hits AS (
    SELECT doc_id, dw, item_id, iw, t, n, m, s, least(count(*), any_value(times)) AS shared
    FROM starts JOIN seeds USING (doc_id, dw, item_id, iw)
    WHERE i BETWEEN t AND t + least(m, n) - 1
    GROUP BY ALL
),
windows AS (
    SELECT doc_id, dw, item_id, iw, t, sum(shared) AS shared, any_value(least(m, n) + m) AS total
    FROM hits GROUP BY ALL
)
SELECT doc_id, item_id, similarity, window_start FROM (
    SELECT doc_id, dw, item_id, iw, shared / (total - shared) AS similarity, t - 1 AS window_start,
        row_number() OVER (PARTITION BY doc_id, dw, item_id, iw ORDER BY shared DESC, t) AS r
    FROM windows WHERE 100 * shared >= 80 * (total - shared)
) WHERE r = 1
""",
    "op4_chat": rf"""
WITH rows AS ({_ALL_TURNS}),
numbered AS (
    SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before FROM rows
    WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
marked AS (
    SELECT *, i = 1 OR role <> before AS opens,
        length(text) + length(text) - length(replace(text, '\', ''))
            + length(text) - length(replace(text, '<', '')) + length(text) - length(replace(text, '#', '')) AS shown
    FROM numbered
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(shown + CASE WHEN opens THEN 10 + length(role) + 2 + 8 ELSE 6 END) AS BIGINT) AS formatted_chars,
    CAST(sum(CASE WHEN opens THEN 1 ELSE 0 END) AS BIGINT) AS n_messages
FROM marked GROUP BY conv_id
""",
}

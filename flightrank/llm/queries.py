"""The package's queries over the given tables, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightrank.llm import (
    centroids,
    exact_dedup,
    filter_audit,
    licenses,
    packing,
    quality,
    sentencepiece_fst,
    sharding,
    simhash,
    token_counts,
    token_files,
    topk,
    toxicity,
)
from flightrank.session import shared_folder

Query = Callable[[SparkSession, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir)).select(
        "doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id"
    )


def sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return sharding.shard_by_bytes(docs).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def exact_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(_documents(spark, sf_dir))


def count_tokens(docs: DataFrame) -> DataFrame:
    return token_counts.count_tokens(docs, VOCABULARY)


def token_files_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    token_files.write_token_files(_documents(spark, sf_dir), VOCABULARY, folder)
    return token_files.read_token_files(spark, folder)


def sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.round_trip(_documents(spark, sf_dir), PIECES)


def licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return licenses.scan(docs, licenses.train(docs))


def count_ids(docs: DataFrame) -> DataFrame:
    return token_files.count_ids(docs, VOCABULARY)


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir), count_ids)


def token_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_documents(spark, sf_dir)).withColumn(
        "over_limit", F.col("n_tokens") > token_counts.LIMIT
    )


def quality_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    return quality.judge(_documents(spark, sf_dir)).select("doc_id", *base, "kept")


def clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings"))


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Query] = {
    "op1_toxicity": toxicity_scores,
    "op2_exact_topk": nearest_vectors,
    "op3_simhash_dedup": near_duplicates,
    "op4_histogram_sharding": sharded,
    "op5_exact_dedup": exact_copies,
    "op6_token_files": token_files_read_back,
    "op7_sentencepiece": sentence_pieces,
    "op8_license_scan": licence_paragraphs,
    "op9_packing": packed,
    "op10_token_counts": token_totals,
    "op11_quality_rules": quality_verdicts,
    "op12_centroid_clustering": clustered,
    "op13_filter_audit": filter_interactions,
}


def _quality_oracle() -> str:
    """Counts by unnested words, then the rounds as a recursion over one row of rates."""
    rules = list(quality.RULES.values())
    cast = ", ".join(f"CASE WHEN {bad} THEN 0 WHEN {good} THEN 1 END AS v{j}" for j, (bad, good) in enumerate(rules))
    odds = " + ".join(
        f"CASE v{j} WHEN 1 THEN ln(g{j} / (1 - b{j})) WHEN 0 THEN ln((1 - g{j}) / b{j}) ELSE 0 END"
        for j in range(len(rules))
    )
    posterior = f"1 / (1 + exp(-(ln(share / (1 - share)) + {odds})))"
    weight = quality.PRIOR_WEIGHT

    def rate(part: str, whole: str, prior: float) -> str:
        return f"(coalesce(sum({part}), 0) + {weight * prior}) / (coalesce(sum({whole}), 0) + {weight})"

    names = ", ".join(f"g{j}, b{j}" for j in range(len(rules)))
    start = ", ".join(f"CAST({quality.START_ON_GOOD} AS DOUBLE), CAST({quality.START_ON_BAD} AS DOUBLE)" for _ in rules)
    rates = ", ".join(
        rate(f"CASE WHEN v{j} = 1 THEN n * p END", f"CASE WHEN v{j} IS NOT NULL THEN n * p END", quality.START_ON_GOOD)
        + ", "
        + rate(f"CASE WHEN v{j} = 0 THEN n * (1 - p) END", f"CASE WHEN v{j} IS NOT NULL THEN n * (1 - p) END", quality.START_ON_BAD)
        for j in range(len(rules))
    )
    return f"""
        WITH RECURSIVE texts AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        split AS (
            SELECT r, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
                   list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
            FROM texts),
        windows AS (
            SELECT r, i, array_to_string(words[i : i + {quality.WINDOW - 1}], ' ') AS w
            FROM (SELECT r, words, unnest(range(1, len(words) - {quality.WINDOW - 2})) AS i FROM split)),
        covered AS (
            SELECT r, count(DISTINCT i + k) AS n_repeat_words
            FROM windows JOIN (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1) USING (r, w), range({quality.WINDOW}) t(k)
            GROUP BY r),
        counted AS (
            SELECT doc_id, len(words) AS n_words, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   len(list_distinct(words)) AS n_distinct, coalesce(n_repeat_words, 0) AS n_repeat_words,
                   length(array_to_string(words, '')) AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks,
                   length(regexp_replace(t, '[^\\p{{L}}\\p{{Nd}}]', '', 'g')) AS n_letters,
                   length(regexp_replace(t, '\\P{{Lu}}', '', 'g')) AS n_capitals,
                   length(regexp_replace(t, '[\\p{{L}}\\p{{Nd}}.,;:''\\x20\\x09-\\x0D-]', '', 'g')) AS n_odd
            FROM split LEFT JOIN covered USING (r)),
        voted AS (SELECT *, {cast} FROM counted),
        combinations AS (SELECT {", ".join(f"v{j}" for j in range(len(rules)))}, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY ALL),
        model(round, share, {names}) AS (
            SELECT 0, CAST({quality.START_SHARE} AS DOUBLE), {start}
            UNION ALL
            SELECT round + 1, {rate("n * p", "n", quality.START_SHARE)}, {rates}
            FROM (SELECT *, {posterior} AS p FROM model, combinations WHERE round < {quality.ROUNDS}) GROUP BY round)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
               n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
               n_words >= {quality.MIN_WORDS} AND 100 * n_repeat_words <= {quality.REPEAT_PERCENT} * n_words
                   AND {posterior} >= {quality.KEEP} AS kept
        FROM voted, model WHERE round = {quality.ROUNDS}"""


def _cluster_oracle() -> str:
    """Every round in turn, over one row per vector and component."""
    # Whole division rounds towards zero; means round down.
    mean = "CAST((s - ((s % n) + n) % n) // n AS BIGINT)"
    steps = ""
    for i in range(centroids.ROUNDS + 1):
        steps += f""",
        near{i} AS MATERIALIZED (
            SELECT r, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS distance FROM (
                SELECT r, cluster, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d
                FROM parts JOIN centre{i} USING (j) GROUP BY r, cluster)
            GROUP BY r)"""
        if i < centroids.ROUNDS:
            steps += f""",
        centre{i + 1} AS MATERIALIZED (
            SELECT cluster, j, coalesce(m, c) AS c FROM centre{i} LEFT JOIN (
                SELECT cluster, j, {mean} AS m
                FROM (SELECT cluster, j, sum(x) AS s, count(*) AS n FROM parts JOIN near{i} USING (r) GROUP BY cluster, j))
            USING (cluster, j))"""
    last = centroids.ROUNDS
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor({centroids.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE len(embedding) = {centroids.LENGTH}
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (SELECT r, unnest(range({centroids.LENGTH})) AS j, unnest(v) AS x FROM kept),
        first AS (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster, v
            FROM kept WHERE vec_id IS NOT NULL ORDER BY cluster LIMIT {centroids.K}),
        centre0 AS MATERIALIZED (SELECT cluster, unnest(range({centroids.LENGTH})) AS j, unnest(v) AS c FROM first){steps},
        digests AS (
            SELECT cluster, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM centre{last} GROUP BY cluster)
        SELECT vec_id, CAST(cluster AS INT) AS cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM kept JOIN near{last} USING (r) JOIN digests USING (cluster)"""


ORACLES: dict[str, str] = {
    "op2_exact_topk": """
        WITH whole AS (
            SELECT vec_id,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
            FROM (SELECT DISTINCT * FROM whole WHERE vec_id % 50 = 0) q
            JOIN whole c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
                   vec_id, score
            FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    # CRC-32 is a fold over bytes, eight bits at a time, with a table made by its rule.
    "op4_histogram_sharding": """
        WITH RECURSIVE crc_steps(n, step, c) AS (
            SELECT n, 0, CAST(n AS BIGINT) FROM range(256) t(n)
            UNION ALL
            SELECT n, step + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
            FROM crc_steps WHERE step < 8),
        crc_table AS (SELECT list(c ORDER BY n) AS steps FROM crc_steps WHERE step = 8),
        keyed AS (
            SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) + 8 AS size,
                   CAST('0x' || substr(sha256(coalesce(text, '')), 1, 15) AS BIGINT) AS h,
                   CAST('0x' || substr(sha256(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS r
            FROM documents),
        total AS (SELECT sum(size) AS bytes, greatest(1, CAST(ceil(sum(size) / (24 * 16777216)) AS BIGINT)) AS cells FROM keyed),
        large AS (
            SELECT h FROM keyed, total GROUP BY h, bytes HAVING sum(size) * 24 * 100 > bytes),
        elements AS (
            SELECT keyed.*, CASE WHEN h IN (SELECT h FROM large) THEN r ELSE 0 END AS e FROM keyed),
        starts AS (
            SELECT h, e, sum(sum(size)) OVER (ORDER BY h, e) - sum(size) AS start FROM elements GROUP BY h, e),
        placed AS (
            SELECT elements.*, CAST(start * 24 // bytes AS INT) AS shard, xor(elements.h, r) % cells AS cell
            FROM elements JOIN starts USING (h, e), total)
        SELECT doc_id, CAST(size AS BIGINT) AS size,
               xor(list_reduce(
                   list_transform(regexp_extract_all(hex(t), '..'), lambda b: CAST('0x' || b AS BIGINT)),
                   lambda c, b: xor(c // 256, steps[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32,
               'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY cell, h, r) - 1 AS slot,
               CAST(NULL AS INT) AS grown_shard
        FROM placed, crc_table""",
    "op5_exact_dedup": """
        WITH folded AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents),
        groups AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY t)
        SELECT doc_id, keep_id, group_size,
               row_number() OVER (PARTITION BY doc_id, t) = 1 AND doc_id IS NOT DISTINCT FROM keep_id AS kept,
               sha256(t) AS text_sha256
        FROM folded JOIN groups USING (t)""",
    "op11_quality_rules": _quality_oracle(),
    "op12_centroid_clustering": _cluster_oracle(),
    "op13_filter_audit": """
        WITH split AS (
            SELECT coalesce(source, '') AS part, coalesce(text, '') AS t, doc_id,
                   regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
            FROM documents),
        labelled AS (
            SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
            FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
        failed AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                   len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
                   100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c,
                   regexp_matches(t, '[#$%&*|]') AS d,
                   coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
            FROM split LEFT JOIN labelled USING (doc_id)),
        letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
        orders AS (
            SELECT concat(p.l, q.l, r.l, s.l, u.l) AS filter_order
            FROM letters p JOIN letters q ON q.l <> p.l JOIN letters r ON r.l NOT IN (p.l, q.l)
            JOIN letters s ON s.l NOT IN (p.l, q.l, r.l) JOIN letters u ON u.l NOT IN (p.l, q.l, r.l, s.l)),
        masks AS (
            SELECT part, concat(CASE WHEN a THEN 'A' ELSE '' END, CASE WHEN b THEN 'B' ELSE '' END, CASE WHEN c THEN 'C' ELSE '' END,
                                CASE WHEN d THEN 'D' ELSE '' END, CASE WHEN e THEN 'E' ELSE '' END) AS fails,
                   good, toxic, count(*) AS n
            FROM failed GROUP BY ALL),
        steps AS (
            SELECT part, filter_order, CAST(step AS INT) AS step, substr(filter_order, step, 1) AS l, n, good, toxic, fails,
                   contains(fails, substr(filter_order, step, 1)) AS failing,
                   regexp_matches(fails, concat('[', substr(filter_order, 1, step - 1), '-]')) AS gone
            FROM masks, orders, (SELECT unnest(range(1, 6)) AS step)),
        counted AS (
            SELECT part, filter_order, step, l,
                   sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN fails = l THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN NOT gone AND failing AND good THEN n ELSE 0 END) AS good_lost,
                   sum(CASE WHEN NOT gone AND failing AND toxic THEN n ELSE 0 END) AS toxic_lost
            FROM steps GROUP BY ALL)
        SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
               CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
               CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
        FROM counted""",
}

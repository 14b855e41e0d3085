"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm.common import documents, read


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.llm.exact_dedup import exact_dedup

    return exact_dedup(read(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.llm.sharding import shard_documents

    return shard_documents(read(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from gleanery.llm.simhash import simhash_classes

    return simhash_classes(documents(spark, sf_dir), words=3, radius=3).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from gleanery.llm.token_count import count_tokens

    return count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.llm.quality import quality_scores

    return quality_scores(documents(spark, sf_dir), read(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.llm.pii import find_pii

    return find_pii(documents(spark, sf_dir))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from gleanery.llm.repair import token_output

    return token_output(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.llm.linededup import repeated_passages

    return repeated_passages(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.llm.decontaminate import find_leaks

    return find_leaks(documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gleanery.llm.mixing import mix

    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op10_mixing aims at, a row for each source: the part of it that SQL can express."""
    from pyspark.sql import functions as F

    from gleanery.llm.common import n_words
    from gleanery.llm.mixing import source_targets

    sizes = read(spark, sf_dir, "documents").select("source", n_words(F.col("text")).alias("size"))
    return source_targets(sizes).select("source", "source_size", F.round("target", 4).alias("target"))


def token_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes that op5_token_count reports: the part of it that SQL can express."""
    return op5_token_count(spark, sf_dir).select("doc_id", "n_bytes")


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_pii, op3_simhash, op4_line_dedup, op5_token_count, op6_sharding, op7_quality, op8_token_output, op9_decontamination, op10_mixing, mixing_targets, token_bytes)}

ORACLES = {
    "op1_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)""",
    # The CRC is a fold over the bytes with the table of the reversed polynomial 0xEDB88320.
    "op6_sharding": r"""
        WITH RECURSIVE k AS (SELECT i AS b, i::UBIGINT AS c, 0 AS n FROM range(256) r(i) UNION ALL
            SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, n + 1 FROM k WHERE n < 8),
        t AS (SELECT list(c ORDER BY b) AS tbl FROM k WHERE n = 8),
        d AS (SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, octet_length(encode(coalesce(text, ''))) + 8 AS size, hex(encode(coalesce(text, ''))) AS hx FROM documents),
        e AS (SELECT doc_id, key, size, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hx, '..'), lambda x: ('0x' || x)::UBIGINT)),
            lambda a, b: xor(a >> 8, tbl[((xor(a, b) & 255) + 1)::INTEGER])), 4294967295::UBIGINT)::BIGINT AS text_crc32 FROM d, t),
        leaves AS (SELECT s, 'r' || (s // 12) || '/k' || (s // 4) || '/s' || s AS path FROM range(25) r(s)),
        draws AS (SELECT DISTINCT key, s, -ln((('0x' || md5(key || ':' || path)[1:13])::BIGINT::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE) AS draw FROM d, leaves),
        placed AS (SELECT key, arg_min(s, draw) FILTER (s < 24) AS shard, arg_min(s, draw) AS grown_shard FROM draws GROUP BY key)
        SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INTEGER AS shard, grown_shard::INTEGER AS grown_shard,
            row_number() OVER (PARTITION BY shard ORDER BY ('0x' || md5(key || ':' || size || ':' || text_crc32)[1:13])::BIGINT, doc_id, size, text_crc32) - 1 AS slot
        FROM e JOIN placed USING (key)""",
    # Targets: the level at which weights fill up to 3 times each source's size, found among the sources' own levels.
    "mixing_targets": r"""
        WITH d AS (SELECT source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight FROM s),
        c AS (SELECT DISTINCT 3.0 * source_size / weight AS edge FROM w),
        f AS (SELECT edge, (SELECT sum(least(weight * edge, 3.0 * source_size)) FROM w) AS filled FROM c),
        t AS (SELECT (SELECT sum(source_size) FROM w)::DOUBLE AS total),
        low AS (SELECT coalesce(max(edge), 0.0) AS edge FROM f, t WHERE filled <= total),
        level AS (SELECT (total - (SELECT coalesce(sum(3.0 * source_size), 0) FROM w WHERE 3.0 * source_size / weight <= low.edge)) / nullif((SELECT sum(weight) FROM w WHERE 3.0 * source_size / weight > low.edge), 0) AS l FROM t, low)
        SELECT source, source_size, round(CASE WHEN l IS NULL OR 3.0 * source_size <= weight * l THEN 3.0 * source_size ELSE weight * l END::DOUBLE, 4) AS target FROM w, level""",
    "token_bytes": "SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes FROM documents",
}

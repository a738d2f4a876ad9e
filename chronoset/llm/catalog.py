"""The registered queries opN_<name> of the corpus operators, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoset.llm import exact_dedup, language_id, licenses, line_dedup, minhash, mixing, periodic, pii, quality, sentencepieces, sharding, toxicity, variants
from chronoset.llm.common import documents, staged


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    # three passes follow: words are counted once
    docs = staged(documents(spark, sf_dir).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")), "mix-sizes")
    return mixing.planned(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licenses.scanned(documents(spark, sf_dir))
    sure = F.filter("hits", lambda x: x["family"] != licenses.UNKNOWN)
    listed = F.array_join(F.transform("sure", lambda x: F.concat_ws(":", x["line"].cast("string"), x["family"])), ",")
    families = F.array_join(F.array_sort(F.array_distinct(F.transform("sure", lambda x: x["family"]))), ",")
    return rows.withColumn("sure", sure).select("doc_id", "n_paragraphs", "n_candidates", F.size("sure").cast("long").alias("n_licenses"), families.alias("families"), listed.alias("lines"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup.line_deduped(documents(spark, sf_dir).select("doc_id", "text"))
    removed = F.col("removed")
    return cut.select("doc_id", "n_lines", F.size(removed).cast("long").alias("n_removed"), F.concat_ws(",", removed.cast("array<string>")).alias("removed"), F.sha2("text", 256).alias("text_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir).select("doc_id", "text"), keep_columns=False)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(documents(spark, sf_dir))


def piece_model() -> str:
    """The merge-type vocabulary; the folder is that of the public tokenizers on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op7_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return sentencepieces.digests(sentencepieces.encoded(docs, piece_model(), keep_text=False))


def op8_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    crc = F.crc32(F.coalesce(text, F.lit("")).cast("binary"))
    rows = documents(spark, sf_dir).select("doc_id", "lang", "source", "n_chars", sharding.text_bytes(text).alias("size"), crc.alias("text_crc32"))
    put = sharding.kd_assigned(rows, ["lang", "source", "size", "n_chars", "doc_id"], shards=24)
    put = sharding.with_slots(put.select("doc_id", "size", "text_crc32", "shard"), ["doc_id", "text_crc32"])
    return put.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.detected(documents(spark, sf_dir))
    counts = [pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.BASE]
    return rows.select("doc_id", *counts, F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"), pii.written(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    return language_id.identified(docs.drop("lang"), language_id.fitted(docs), keep_text=False)


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    rows = toxicity.scored(docs, toxicity.fitted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), keep_text=False)
    return rows.select("doc_id", (~toxicity.learnable()).alias("held_out"), "score", "predicted")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic.planted(documents(spark, sf_dir).select("doc_id", "text"))
    return periodic.digests(periodic.collapsed(docs, keep_text=False))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_groups(documents(spark, sf_dir).select("doc_id", "text"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_license_scan": op3_license_scan,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_minhash_near_dedup": op6_minhash_near_dedup,
    "op7_sentencepieces": op7_sentencepieces,
    "op8_kd_sharding": op8_kd_sharding,
    "op9_personal_data": op9_personal_data,
    "op10_language_id": op10_language_id,
    "op11_toxicity": op11_toxicity,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE = {
    "op1_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
            FROM d GROUP BY source),
        c AS (SELECT *, (2 * source_size)::DOUBLE AS cap, 1.5::DOUBLE * (sum(source_size) OVER ()) AS total FROM s),
        l AS (
            SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / (sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
            FROM c),
        o AS (SELECT level FROM l WHERE level * weight <= cap ORDER BY cap / weight, source NULLS LAST LIMIT 1),
        t AS (
            SELECT source, source_size, least(cap, coalesce((SELECT level FROM o) * weight, cap)) AS target,
                   ('0x' || substr(md5('mix-1' || coalesce('=' || source, '~')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
            FROM l),
        r AS (
            SELECT doc_id, size, source,
                   row_number() OVER (
                       PARTITION BY source
                       ORDER BY CASE WHEN size = 0 THEN 1000 ELSE 1000 - (length(ltrim(bin(size), '0')) * 8 + ((size * 8) >> (length(ltrim(bin(size), '0')) - 1)) - 8) END,
                                substr(md5(coalesce('=' || doc_id::VARCHAR, '~')), 1, 1), size DESC, doc_id NULLS LAST) AS k
            FROM d)
        SELECT doc_id, size, source_size, target,
               (size * least(2, floor(k * e + u) - floor((k - 1) * e + u)))::BIGINT AS taken
        FROM (SELECT r.*, t.source_size, t.target, t.u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS e
              FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
    """,
    "op2_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256, row_number() OVER () AS rid
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST, rid) = 1 AS kept, text_sha256
        FROM d
    """,
    # crc32 by its byte table; near words by wildcards (a letter replaced) and by deletion, form chains by recursion
    "op13_spelling_variants": r"""
        WITH RECURSIVE steps AS (
            SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(256) r(i)),
        crc AS (SELECT list(v ORDER BY i) AS t FROM steps),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
            WHERE length(run) >= 6 GROUP BY ALL),
        sums AS (SELECT run, times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM runs),
        hashed AS (
            SELECT run, times, xor(list_reduce(list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1:2 * i + 2])::BIGINT),
                                               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
            FROM sums, crc),
        words AS MATERIALIZED (
            SELECT CASE WHEN h % 199 = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(times)::BIGINT AS n
            FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(times) >= 5),
        places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
        cut AS MATERIALIZED (SELECT word, n, i, word[1:i - 1] AS l, word[i + 1:] AS r FROM places),
        near AS MATERIALIZED (
            SELECT a.word AS a, b.word AS b, b.n AS b_n FROM cut a JOIN cut b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.l || a.r = b.word
            UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.l || a.r = b.word),
        best AS (SELECT a AS word, count(*) AS n_near, min((-b_n, b)) AS m FROM near GROUP BY a),
        forms AS MATERIALIZED (
            SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -m[1] >= 5 * n THEN m[2] END AS form, CASE WHEN -m[1] >= 5 * n THEN -m[1] END AS form_n
            FROM words LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, word AS root, 0 AS step FROM forms
            UNION ALL SELECT chain.word, forms.form, step + 1 FROM chain JOIN forms ON forms.word = chain.root WHERE forms.form IS NOT NULL),
        roots AS (SELECT word, max_by(root, step) AS root FROM chain GROUP BY word)
        SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM forms JOIN roots USING (word)
    """,
}

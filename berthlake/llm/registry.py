"""The registered queries of the corpus operators, one per operator, with oracle SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from berthlake.llm import (
    alignment, decontamination, html_extraction, jaccard_join, mixing, pii, quality, sharding, spelling, suffix_dedup, token_counts, toxicity,
    url_filters,
)

Run = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(pii.of_kind("pii_base", k)).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("pii_base")), 256).alias("base_sha256"),
                        pii.joined(F.col("pii_spans")).alias("spans"))


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", "n_tokens", "epoch", "block", "mix_order")


OP2_SQL = f"""
WITH sized AS (SELECT doc_id, source, coalesce(source, '') AS s,
    greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1) AS n_tokens FROM documents),
stats AS (SELECT s, sum(n_tokens)::BIGINT AS tokens FROM sized GROUP BY s),
-- repeats of two sources differ by (share / share) ** (1 - exponent), so the limit has a closed form
power AS (SELECT greatest(0, 1 - coalesce(ln({mixing.MAX_REPEATS}) / nullif(ln(max(tokens)::DOUBLE / min(tokens)), 0), 1)) AS a FROM stats),
weighted AS (SELECT s, tokens, pow(tokens, a) / sum(pow(tokens, a)) OVER () AS weight FROM stats, power),
budgets AS (SELECT *, sum(budget) OVER () AS whole FROM (
  SELECT s, tokens, floor(weight * (max(tokens / weight) OVER ()) + 0.5)::BIGINT AS budget FROM weighted)),
epochs AS (SELECT d.*, tokens, budget, greatest(ceil(whole / {mixing.BLOCK_TOKENS}), 1)::BIGINT AS blocks,
    budget // tokens AS f, budget % tokens AS rest,
    ('0x' || substr(md5(concat('mix:', budget // tokens, ':', doc_id)), 1, 13))::BIGINT AS u FROM sized d JOIN budgets USING (s)),
placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY s ORDER BY u, doc_id, n_tokens
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM epochs),
taken AS (SELECT *, unnest(generate_series(0, f - 1 + (before < rest)::INT)) AS epoch FROM placed),
blocked AS (SELECT *, least(floor((epoch + ('0x' || substr(md5(concat('mix:', epoch, ':', doc_id)), 1, 13))::BIGINT / pow(2, 52))
    * tokens / budget * blocks)::BIGINT, blocks - 1) AS block FROM taken)
SELECT doc_id, source, n_tokens::BIGINT AS n_tokens, epoch, block,
  ('0x' || substr(md5(concat('mix:', block, ':', epoch, ':', doc_id)), 1, 13))::BIGINT AS mix_order FROM blocked
"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.scan(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"),
        keep=["doc_id"], texts=False)
    return found.select(
        F.col("_row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", F.col("class").alias("class_id"), "class_size")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fold(doc_id: str):
        return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tagged = toxicity.tag(docs, table(spark, sf_dir, "labels"), among=fold("_id") != 0, keep=["doc_id"], spans=False)
    return tagged.select("_row.doc_id", F.col("toxicity").alias("score"), "n_toxic_words").withColumns({
        "held_out": fold("doc_id") == 0, "predicted": (F.col("score") >= 0.5).cast("int")})


def op6_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# the rules of the query: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [F.struct(*(F.lit(v).alias(k) for k, v in zip(("host", "path", "verdict"), rule))) for rule in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*rows)))
    judged = url_filters.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP7_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(r_host, r_path, r_verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT p.page_id, p.host, p.path, r.r_host || r.r_path AS rule, r.r_verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.r_host || r.r_path) DESC) AS n
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.r_host OR ends_with(p.host, '.' || r.r_host)) AND starts_with(p.path, r.r_path))
SELECT page_id, host, path, rule, coalesce(r_verdict, 'allow') AS verdict FROM fits WHERE n = 1
"""


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"), ["doc_id"])
    return judged.select(F.col("_row.doc_id").alias("doc_id"), *quality.COUNTS, "base_failed", "kept", "quality_score")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extraction.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep=["page_id", "url"])
    return texts.select("_row.page_id", "_row.url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    return cut.select(F.col("_row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    counted = token_counts.count(docs, vocabulary("piece_bpe_32k.model"), keep=["doc_id", "n_bytes"])
    return counted.select("_row.doc_id", "_row.n_bytes", "n_tokens", "over_limit")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("byte_bpe_50k.json"),
                              vocabulary("piece_bpe_32k.model"), keep=["doc_id"])
    return aligned.select("_row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Run] = {
    "op1_pii": op1_pii,
    "op2_temperature_mixing": op2_temperature_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_toxicity": op5_toxicity,
    "op6_jump_sharding": op6_jump_sharding,
    "op7_url_filters": op7_url_filters,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_token_alignment": op12_token_alignment,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op2_temperature_mixing": OP2_SQL,
    "op7_url_filters": OP7_SQL,
}

"""The queries of this package and the SQL, where it can say the same."""

from pyspark.sql import functions as F

from cotejo.llm import (
    decontaminate, language_id, manifest, mixing, near_duplicates, quality, repeated_bytes, resampling, secrets, sharding, token_counts, toxicity,
    url_filter,
)
from cotejo.llm.oracle_sql import merkle_sql, resampling_sql, shards_sql

TOKENIZER = "piece_bpe_32k.model"
URL_RULES = (
    url_filter.Rule("com", "/", "allow"), url_filter.Rule("example.com", "/en/", "block"), url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"), url_filter.Rule("net", "/fr/", "block"),
)
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED = r"[^\x20\x09-\x0D]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name=TOKENIZER):
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out(parts, part):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == part


def told_held_out(parts, part):
    """The same for a result: false for a null id."""
    return F.coalesce(held_out(parts, part), F.lit(False)).alias("held_out")


def op1_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), "contaminated")


def op2_url_filter(spark, sf_dir):
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op3_repeated_bytes(spark, sf_dir):
    out = repeated_bytes.repeated(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op4_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), keep=["doc_id"])


def op5_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learnt = labels.filter(~held_out(3, 1))
    field = toxicity.train(*toxicity.labelled(docs, learnt), known=toxicity.vocabulary(docs, learnt))
    out = toxicity.toxicity(docs, field, keep=["doc_id"])
    return out.select("doc_id", told_held_out(3, 1), "score", "predicted", F.size("spans").alias("n_spans"))


def op6_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(*language_id.labelled(docs.filter(~held_out(5, 0))))
    out = language_id.identified(docs, model, keep=["doc_id"])
    return out.select("doc_id", told_held_out(5, 0), "lang_pred", "score")


def op7_near_duplicates(spark, sf_dir):
    return near_duplicates.classified(table(spark, sf_dir, "documents"), size=2, keep=["doc_id"])


def op8_secrets(spark, sf_dir):
    out = secrets.secrets(table(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_KINDS))
    counts = [F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in secrets.BASE_KINDS]
    digest = F.sha2(secrets.listed(base).cast("binary"), 256)
    return out.select("doc_id", *counts, digest.alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op9_quality_rules(spark, sf_dir):
    measured = quality.stored(quality.statistics(table(spark, sf_dir, "documents"), keep=["doc_id"]))
    rules = quality.learnt_rules(measured, table(spark, sf_dir, "labels"))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")
    return quality.judged(measured, rules).select(*columns)


def op10_mixing(spark, sf_dir):
    rows = mixing.stored(mixing.sized(table(spark, sf_dir, "documents"), ["doc_id"]))
    out = mixing.mixed(rows, mixing.targets(rows))
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    even = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    presented = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    trees = manifest.manifest(docs, ("doc_id", "source", "lang", "n_chars", "text"), "source", "doc_id", ("doc_id",), {"text": presented})
    proof = F.sha2(F.array_join("proof", "").cast("binary"), 256)
    return trees.proofs().select("kept.doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", "verified")


def op12_importance_resampling(spark, sf_dir):
    out = resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_shards(spark, sf_dir):
    out = sharding.sharded(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_url_filter, op3_repeated_bytes, op4_token_counts, op5_toxicity, op6_language_id,
    op7_near_duplicates, op8_secrets, op9_quality_rules, op10_mixing, op11_merkle_manifest,
    op12_importance_resampling, op13_shards,
)}

_WORDS = f"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{ALNUM}')"""

ORACLES = {
    "op1_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
wins AS (SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
         FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
grams AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, n, item FROM grams JOIN wins USING (n, g)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_merkle_manifest": merkle_sql(),
    "op12_importance_resampling": resampling_sql(_WORDS, _WORDS),
    "op13_shards": shards_sql(),
}

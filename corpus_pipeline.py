"""From documents to a training mix: quality rules, near-duplicates, decontamination, secrets, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
reads again as the next stage's documents. All but the last return the columns of documents; the last adds ``copy``.
"""

from pyspark.sql import functions as F

from cotejo.llm import decontaminate, mixing, near_duplicates, quality, secrets
from cotejo.llm.common import stored


def quality_rules(spark, docs, sf_dir):
    """Documents that fail the base rules or a learnt rule go."""
    return quality.kept_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_removal(spark, docs, sf_dir):
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8 or more) stays."""
    return near_duplicates.first_of_each(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold a ten-word passage of a benchmark item (or a shorter item whole) go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark, docs, sf_dir):
    """Secrets are replaced in the text; every document stays."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mixing(spark, docs, sf_dir):
    """As many copies of each document as the mix takes, numbered by ``copy``."""
    numbered = stored(docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), F.monotonically_increasing_id().alias("n")))
    flat = numbered.select("n", F.col("whole.doc_id").alias("doc_id"), F.col("whole.text").alias("text"), F.col("whole.source").alias("source"))
    rows = stored(mixing.sized(flat, ["n"]))
    taken = mixing.mixed(rows, mixing.targets(rows)).filter("copies > 0").select("row.n", "copies")
    out = numbered.join(taken, "n").select("whole", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy_"))
    return out.select(*[F.col("whole")[c].alias(c) for c in docs.columns if c.lower() != "copy"], F.col("copy_").alias("copy"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicate_removal),
    ("decontamination", benchmark_decontamination),
    ("secrets", secret_redaction),
    ("mixing", source_mixing),
]

ORACLE_SQL = None  # learnt rules, similarity and random rounding have no SQL; tests compare with brute force


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

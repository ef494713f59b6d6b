"""The pipeline's stages against plain versions, each on its own input."""

from collections import Counter

import corpus_pipeline
from cotejo.llm import secrets
from tests.llm import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "decontamination", "secrets", "mixing"]

    before = docs.collect()
    good = corpus_pipeline.stored(stages["quality_rules"](spark, docs, SF))
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == columns and kept <= {r["doc_id"] for r in before if not brute.quality(r["text"])[5]}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    fine = [r["doc_id"] for r in before if labels.get(r["doc_id"]) == 1 and not brute.quality(r["text"])[5]]
    assert sum(d in kept for d in fine) >= 0.95 * len(fine)

    single = corpus_pipeline.stored(stages["near_duplicates"](spark, good, SF))
    want = brute.near_duplicates([(r["doc_id"], r["text"]) for r in good.collect()], size=5)
    assert {r["doc_id"] for r in single.collect()} == {d for d, (_, part, first) in want.items() if first}

    clean = corpus_pipeline.stored(stages["decontamination"](spark, single, SF))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = brute.contamination([(r["doc_id"], r["text"]) for r in single.collect()], items)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, j in judged.items() if not j[4]}

    safe = corpus_pipeline.stored(stages["secrets"](spark, clean, SF))
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in safe.collect():
        assert r["text"] == secrets.redact(texts[r["doc_id"]]) and r["n_chars"] == len(r["text"])
        assert brute.base_secrets(r["text"])[:3] == (0, 0, 0)

    mixed = stages["mixing"](spark, safe, SF).collect()
    size = {r["doc_id"]: len(brute.spaced_words(r["text"])) for r in safe.collect()}
    source = {r["doc_id"]: r["source"] for r in safe.collect()}
    sizes, taken, largest = Counter(), Counter(), Counter()
    for d, n in size.items():
        sizes[source[d]] += n
        largest[source[d]] = max(largest[source[d]], n)
    for r in mixed:
        taken[r["source"]] += size[r["doc_id"]]
    assert all(abs(taken[s] - t) <= largest[s] for s, t in brute.targets(sizes).items())
    assert max(Counter(r["doc_id"] for r in mixed).values()) <= 2

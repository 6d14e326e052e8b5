from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from creditloom.llm import quality
from test_text import brute_contamination, brute_fingerprint


def test_stages(spark, sf, tmp_path):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == documents.columns, name
    good = {r.doc_id for r in quality.score(documents, quality.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))).where("score >= 0.3").collect()}
    assert {r.doc_id for r in seen["quality_classifier"]} == good
    prints = {r.doc_id: brute_fingerprint(r.text) for r in seen["quality_classifier"]}
    kept = {r.doc_id for r in seen["simhash_near_dedup"]}
    assert not [(a, b) for a in kept for b in kept if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in seen["simhash_near_dedup"] if not brute_contamination(r.text, items)[3]}
    assert {r.doc_id for r in seen["benchmark_decontamination"]} == clean
    uses = Counter(r.doc_id for r in seen["mixing_to_weights"])
    assert set(uses) == clean and max(uses.values()) <= 2
    assert Counter(r.doc_id for r in seen["sharding"]) == uses
    sizes = Counter(r.shard for r in seen["sharding"])
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_run_is_the_stages(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 0 and {"shard", "slot"} <= set(out.columns)


HELPERS = ["items", "spans", "n_words", "contaminated", "quality_score", "position", "pass", "block", "n_tokens", "document", "row", "at", "a", "b", "fingerprint", "component_id", "key", "h"]


def test_stages_keep_columns_named_like_their_own(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id < 60")
    named = docs.select("*", *[F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")).alias(c) for c in HELPERS])
    want = {r.doc_id: r for r in named.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, named, sf)
        assert out.columns == named.columns + (["shard", "slot"] if name == "sharding" else []), name
        rows = out.select(*named.columns).collect()
        assert len(rows) > 30 and all(r == want[r.doc_id] for r in rows), name


def test_stages_on_awkward_and_empty_tables(spark, sf, awkward, nothing):
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, awkward, sf).collect()
        assert rows and all(r.text in {x.text for x in awkward.collect()} for r in rows), name
        assert stage(spark, nothing, sf).count() == 0, name

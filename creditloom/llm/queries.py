"""The registered queries of the text operators, and their SQL forms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import decontamination, importance, licences, mixing, nearest, phrases, quality, repeats, sharding, simhash, tokens, toxicity, winnowing
from creditloom.llm.common import table
from creditloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Where the byte-pair vocabulary lies if the session doesn't say so in `spark.creditloom.bpe.ranks`; executors read it there.
BPE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_units", F.size("matches").alias("n_matches"), "licence", "dice", "unit")


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_with_edits(table(spark, sf_dir, "documents"))


@query
def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads every document with an estimated word count, revises the counts to the exact ones, adds those of a second tokenizer, takes
    documents without words out and puts them in again; two commits are tried twice, and a snapshot is taken on the way."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "token-counts")
    estimate = F.floor(F.coalesce(F.octet_length("text"), F.lit(0)) / 6)
    ranks = spark.conf.get("spark.creditloom.bpe.ranks", BPE_RANKS)
    counted = tokens.bpe_tokens(docs.withColumn("estimate", estimate), ranks, carried=["estimate"])
    counted.write.parquet(path)
    rows = spark.read.parquet(path)
    rollup = tokens.Rollup(spark, scratch_path(spark, "token-totals"))
    rollup.commit("load", tokens.inserts(rows, "words-1", "estimate"))
    rollup.commit("exact-words", tokens.revisions(rows, "words-1", "estimate", "n_words"))
    rollup.commit("load", tokens.inserts(rows, "words-1", "estimate"))
    rollup.compact("first")
    rollup.commit("byte-pairs", tokens.inserts(rows, "byte-bpe-50k", "n_bpe"))
    empty = rows.where("n_words = 0")
    rollup.commit("drop-empty", tokens.deletes(empty, "words-1", "n_words").union(tokens.deletes(empty, "byte-bpe-50k", "n_bpe")))
    rollup.commit("restore-empty", tokens.inserts(empty, "words-1", "n_words").union(tokens.inserts(empty, "byte-bpe-50k", "n_bpe")))
    rollup.commit("exact-words", tokens.revisions(rows, "words-1", "estimate", "n_words"))
    return rollup.totals()


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"))
    return sharding.shuffle_into_shards(rows, 16).withColumn("grown_shard", F.lit(None).cast("int"))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), max_repetition=2.0, carried=["doc_id", "source"])
    return found.select("doc_id", "source", "n_tokens", "pass", "block", "position")


@query
def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carried=["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents")).drop("words")


ORACLES["op4_decontamination"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
     b AS (SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
     items AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS win
               FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT n FROM items),
     spots AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
               FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
     met AS (SELECT DISTINCT s.doc_id, s.i, s.n, t.item_id FROM spots s JOIN items t ON s.win = t.win AND s.n = t.n),
     hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM met) GROUP BY doc_id),
     ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
             FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

ORACLES["op7_repeated_passages"] = r"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
     spots AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS win FROM (SELECT doc_id, x, unnest(generate_series(0, len(x) // 2 - 100)) AS i FROM d WHERE len(x) >= 200)),
     hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS r FROM spots) WHERE r > 1),
     runs AS (SELECT doc_id, min(i) AS a, max(i) + 100 AS z
              FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g
                    FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS fresh FROM hit)) GROUP BY doc_id, g),
     cuts AS (SELECT doc_id, count(*) AS n_spans, sum(z - a) AS n_removed, list(a ORDER BY a) AS starts, list(z ORDER BY a) AS ends FROM runs GROUP BY doc_id),
     kept AS (SELECT d.doc_id, x, n_spans, n_removed, CASE WHEN n_spans IS NULL THEN x ELSE array_to_string(list_transform(
                list_zip(list_concat([0], ends), list_concat(starts, [len(x) // 2])), lambda p: substr(x, 2 * p[1] + 1, 2 * (p[2] - p[1]))), '') END AS y
              FROM d LEFT JOIN cuts USING (doc_id))
SELECT doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(y)) AS kept_sha256 FROM kept
"""

# The table of CRC-32 follows from its polynomial, 0xEDB88320; each different word is taken byte by byte.
ORACLES["op12_importance_resampling"] = r"""
WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
               FROM range(256) r(i))),
     d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
     b AS (SELECT list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
     dw AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY ALL),
     bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(w) AS w FROM b) GROUP BY ALL),
     hexed AS (SELECT w, lower(hex(encode(w))) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
     bytes AS (SELECT w, list_transform(range(len(h) // 2), lambda i: 16 * (instr('0123456789abcdef', substr(h, 2 * i + 1, 1)) - 1) + instr('0123456789abcdef', substr(h, 2 * i + 2, 1)) - 1) AS y FROM hexed),
     slot AS (SELECT w, xor(list_reduce(list_prepend(4294967295, y), lambda c, v: xor(t[(xor(c, v) & 255) + 1], c >> 8)), 4294967295) % 10000 AS slot FROM bytes, crc),
     s AS (SELECT slot, sum(n) AS n FROM dw JOIN slot USING (w) GROUP BY ALL), t AS (SELECT slot, sum(n) AS n FROM bw JOIN slot USING (w) GROUP BY ALL),
     sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0) AS sn, coalesce((SELECT sum(n) FROM t), 0) AS tn),
     gain AS (SELECT s.slot, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * (sn + 10000)::DOUBLE / ((s.n + 1)::DOUBLE * (tn + 10000)::DOUBLE))) AS BIGINT) AS gain
              FROM s LEFT JOIN t ON s.slot = t.slot, sums),
     weights AS (SELECT doc_id, CAST(sum(n * gain) AS BIGINT) AS weight FROM dw JOIN slot USING (w) JOIN gain USING (slot) GROUP BY doc_id),
     noise AS (SELECT doc_id, len(w) AS n, list_reduce(list_prepend(0, list_transform(range(8), lambda i: instr('0123456789abcdef', substr(sha256('2024:' || doc_id), i + 1, 1)) - 1)), lambda a, x: 16 * a + x) AS h FROM d),
     scored AS (SELECT doc_id, CAST(n AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                       CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))) AS BIGINT) AS score FROM noise LEFT JOIN weights USING (doc_id)),
     placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS all_n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * all_n // 100 THEN rank END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""

ORACLES["op13_phrase_mining"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS x
                FROM documents),
     p AS (SELECT lang, list_filter(string_split_regex(x, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
     totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
     f AS (SELECT lang, w, count(*) AS f FROM (SELECT lang, w[i:i + k - 1] AS w FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM p, generate_series(1, 5) g(k) WHERE len(w) >= k))
           GROUP BY ALL HAVING count(*) >= 100),
     cuts AS (SELECT lang, w, f AS a, unnest(generate_series(1, len(w) - 1)) AS k FROM f WHERE len(w) > 1),
     scores AS (SELECT c.lang, c.w, c.a, c.k, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
                FROM cuts c JOIN f x ON x.lang = c.lang AND x.w = c.w[1:c.k] JOIN f y ON y.lang = c.lang AND y.w = c.w[c.k + 1:] JOIN totals t ON t.lang = c.lang),
     weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1),
     inner_ones AS (SELECT DISTINCT lang, v, f FROM (SELECT lang, f, w[i:j] AS v FROM (SELECT lang, w, f, i, unnest(generate_series(i + 1, len(w))) AS j FROM (SELECT lang, w, f, unnest(generate_series(1, len(w) - 1)) AS i FROM f WHERE len(w) > 2))
                    WHERE j - i + 1 < len(w))),
     left_ones AS (SELECT * FROM weakest c WHERE NOT EXISTS (SELECT 1 FROM inner_ones o WHERE o.lang = c.lang AND o.v = c.w AND 100 * o.f >= 100 * c.a)),
     placed AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank, array_to_string(w, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM left_ones)
SELECT * FROM placed WHERE rank <= 2000
"""

"""Benchmark decontamination as a prefix-filtered set join.

Items are cut into windows of 13 consecutive words (an item of fewer words is one window). A window is a set of word
shingles, ordered by how rare they are in the documents. To contain a window whole, a document must hold
its rarest shingle, so that shingle is the only prefix token to join on. The place of the shingle in the window fixes where the
window would start: positional and length bounds drop starts outside the document. What is left is verified
shingle by shingle, word for word.

The documents are read once: their shingles meet those of the benchmark in one equality join, and only shingles
that match move on. A passage that a third of all documents share costs rows in proportion to the words it covers; rows
are grouped by document, never by passage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import ascii_lower, broadcast_if, packed, stored, text_hash, unpacked

WINDOW = 13
SHINGLE = 3
BENCHMARK_ROWS = 200_000


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII."""
    return F.filter(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item, words): one row per item and distinct window."""
    words = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.coalesce("text", F.lit(""))).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - window + 1, F.lit(1)))
    return words.where(F.size("all") > 0).select("item", F.explode(F.transform(starts, lambda s: F.slice("all", s, window))).alias("words")).distinct()


def shingles(words: Column, size: Column) -> Column:
    """Structs (a, b, c) of up to three consecutive words; b and c are null where `size` is smaller."""
    return F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.struct(
        F.element_at(words, i).alias("a"), F.when(size > 1, F.try_element_at(words, i + 1)).alias("b"),
        F.when(size > 2, F.try_element_at(words, i + 2)).alias("c")))


def _key(a: Column, b: Column, c: Column) -> Column:
    return F.xxhash64(a, F.coalesce(b, F.lit("")), F.coalesce(c, F.lit("")))


def places(occurs: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Where a window can begin, given where its prefix token occurs: not before the document, nor so late that it runs past the end."""
    return occurs.join(prefixes, "shingle").withColumn("start", F.col("at") - F.col("offset")).where("start >= 0 and start + length <= n_words")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per input row of `docs`: `n_words`, `n_hit` (words inside any occurrence of a window), `n_items`, `items` (sorted ids as
    strings), `spans` (start and end of each covered run of words) and `contaminated` (hits, and at least a word in twenty).

    `docs` needs doc_id and text, `benchmark` item_id and text. Null and empty texts have no words; a null item id counts as the
    id ''. Repeated rows get equal results; rows that share a doc_id but not a text are told apart. Items of
    equal text all count. Input columns with the names of added ones are replaced.
    """
    columns = docs.columns
    rows = packed(docs).withColumn("id", F.col("row.doc_id")).withColumn("digest", text_hash(F.col("row.text")))
    per_item = stored(item_windows(benchmark, window), "item-windows")
    windows = per_item.select("words").distinct().withColumn("window", F.xxhash64("words"))
    parts = windows.select("window", F.size("words").alias("length"), F.least(F.size("words"), F.lit(SHINGLE)).alias("size"), "words").select(
        "window", "length", "size", F.posexplode(shingles(F.col("words"), F.col("size"))).alias("offset", "s")).select(
        "window", "length", "size", "offset", "s.a", "s.b", "s.c").withColumn("shingle", _key(F.col("a"), F.col("b"), F.col("c")))
    parts = stored(parts, "window-shingles")
    vocabulary = parts.select("shingle", "a", "b", "c", "size").distinct()
    sizes = sorted(r["size"] for r in vocabulary.select("size").distinct().collect())

    # One pass over the texts. Every word opens a shingle of each size in use; the last word also tells the number of words.
    text_words = F.col("words")
    zipped = F.arrays_zip(text_words.alias("w"), F.slice(text_words, 2, F.greatest(F.size(text_words) - 1, F.lit(0))).alias("x"),
                          F.slice(text_words, 3, F.greatest(F.size(text_words) - 2, F.lit(0))).alias("y"))
    opened = (rows.select("id", "digest", words_of(F.coalesce(F.col("row.text"), F.lit(""))).alias("words")).where(F.size("words") > 0)
              .select("id", "digest", F.size("words").alias("n_words"), F.posexplode(zipped).alias("at", "z")).select(
                  "id", "digest", "n_words", "at", "z.w", "z.x", "z.y"))
    last = F.col("x").isNull()
    keys = {1: (F.col("w"), F.lit(None).cast("string"), F.lit(None).cast("string")), 2: (F.col("w"), F.col("x"), F.lit(None).cast("string")),
            3: (F.col("w"), F.col("x"), F.col("y"))}
    if len(sizes) <= 1:
        size = sizes[0] if sizes else SHINGLE
        opened = opened.withColumn("key", _key(*keys[size])).withColumn("k", F.lit(size))
    else:
        opened = opened.withColumn("k", F.explode(F.array(*map(F.lit, sizes)))).withColumn(
            "key", F.coalesce(*[F.when(F.col("k") == n, _key(*keys[n])) for n in sizes]))
    v = broadcast_if(vocabulary.select(F.col("shingle").alias("key"), F.col("a").alias("va"), F.col("b").alias("vb"), F.col("c").alias("vc"), F.col("size").alias("vk")),
                   BENCHMARK_ROWS)
    same = (F.col("va") == F.col("w")) & (F.col("vk") == F.col("k")) & ((F.col("vk") < 2) | (F.col("vb") == F.col("x"))) & ((F.col("vk") < 3) | (F.col("vc") == F.col("y")))
    met = opened.join(v, ["key"], "left").select(
        "id", "digest", "n_words", "at", F.when(same, F.col("key")).alias("shingle"), last.alias("last")).where(F.col("shingle").isNotNull() | F.col("last"))
    met = stored(met, "shingle-matches")
    counts = met.where("last").groupBy("id", "digest").agg((F.max("at") + 1).alias("n_words"))
    occurs = met.where("shingle is not null").select("id", "digest", "n_words", "at", "shingle")

    # Rarity, and the one prefix token of each window; a window with a shingle that no document has is out.
    rarity = occurs.groupBy("shingle").agg(F.count("*").alias("n"))
    ranked = parts.join(rarity, "shingle", "left").groupBy("window", "length", "size").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "shingle", "offset")).alias("first"),
        F.array_sort(F.collect_list(F.struct("offset", "shingle"))).alias("parts"))
    prefixes = stored(ranked.where("first.n > 0").select("window", "length", "size", "parts", F.col("first.shingle").alias("shingle"), F.col("first.offset").alias("offset")),
                      "window-prefixes")
    candidates = (places(occurs, broadcast_if(prefixes.select("window", "length", "shingle", "offset"), BENCHMARK_ROWS))
                  .join(broadcast_if(prefixes.select("window", "parts"), BENCHMARK_ROWS), "window")
                  .select("id", "digest", "window", "length", "start", F.size("parts").alias("needed"), F.explode("parts").alias("p"))
                  .select("id", "digest", "window", "length", "start", "needed", (F.col("start") + F.col("p.offset")).alias("at"), F.col("p.shingle").alias("shingle")))
    proven = (candidates.distinct().alias("c").join(occurs.distinct().alias("o"), F.col("c.id").eqNullSafe(F.col("o.id")) & (F.col("c.digest") == F.col("o.digest"))
                                                 & (F.col("c.at") == F.col("o.at")) & (F.col("c.shingle") == F.col("o.shingle")), "left_semi")
              .groupBy("id", "digest", "window", "length", "start", "needed").agg(F.count("*").alias("met")).where("met = needed"))
    proven = stored(proven.select("id", "digest", "window", "start", (F.col("start") + F.col("length")).alias("end")), "window-hits")

    # Covered words: merge the windows of a document. Items: every item that has a found window.
    order = Window.partitionBy("id", "digest").orderBy("start", "end")
    spans = proven.select("id", "digest", "start", "end").distinct().withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    runs = spans.withColumn("run", F.sum(F.when(F.col("reach") >= F.col("start"), 0).otherwise(1)).over(order)).groupBy("id", "digest", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end")).groupBy("id", "digest").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    window_items = per_item.select("item", F.xxhash64("words").alias("window"))
    items = (proven.select("id", "digest", "window").distinct().join(broadcast_if(window_items, BENCHMARK_ROWS), "window")
             .groupBy("id", "digest").agg(F.array_sort(F.collect_set("item")).alias("items")))

    def named(df: DataFrame, p: str) -> DataFrame:
        return df.withColumnRenamed("id", f"{p}_id").withColumnRenamed("digest", f"{p}_digest")

    def on(p: str) -> Column:
        return F.col("id").eqNullSafe(F.col(f"{p}_id")) & (F.col("digest") == F.col(f"{p}_digest"))

    facts = named(counts, "c")
    found = named(runs, "r").join(named(items, "i"), F.col("r_id").eqNullSafe(F.col("i_id")) & (F.col("r_digest") == F.col("i_digest"))).select(
        "r_id", "r_digest", "n_hit", "spans", "items")
    facts = facts.join(found, F.col("c_id").eqNullSafe(F.col("r_id")) & (F.col("c_digest") == F.col("r_digest")), "left").select(
        "c_id", "c_digest", "n_words", "n_hit", "spans", "items")
    whole = rows.join(facts, on("c"), "left")
    n_words, n_hit = (F.coalesce(name, F.lit(0)).cast("bigint") for name in ("n_words", "n_hit"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return unpacked(whole, columns, n_words=n_words, n_hit=n_hit, n_items=F.size(items).cast("bigint"), items=items,
                    spans=F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")), contaminated=(n_hit > 0) & (20 * n_hit >= n_words))

"""Mixing of sources to target weights by temperature, realised as budgeted block permutations.

Every source has a share p of all tokens. Its weight is p^a, normalised. The exponent a is found by bisection: the
smallest a (the flattest mixture) that keeps a repetition limit, or the a that meets a target entropy. The
weights times the budget give each source a quota of tokens. A source fills its quota with passes: each
pass is a fresh permutation of all its documents, the last one cut where the quota ends. The stream of all sources is
laid out in blocks of equal token count, in which every source has its weight, and permuted inside each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import digits16, named_rows, stored, sums_before, told_apart, unpacked

HALVINGS_PER_JOB = 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("bigint")


def source_totals(docs: DataFrame) -> DataFrame:
    """Per source: documents and units. A unit is a token; a document without tokens counts as one unit."""
    return docs.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("units").alias("units"))


def _measures(totals: DataFrame, exponents: list[float]) -> dict[float, tuple[float, float, float]]:
    """For each exponent: entropy of the weights, the largest and the smallest weight over share."""
    share = F.col("units") / F.col("all_units")
    rows = totals.select(F.explode(F.array(*map(F.lit, exponents))).alias("a"), share.alias("p")).groupBy("a").agg(
        F.sum(F.pow("p", F.col("a"))).alias("z"), F.sum(F.pow("p", F.col("a")) * F.log("p") * F.col("a")).alias("t"),
        F.max(F.pow("p", F.col("a") - 1)).alias("top"), F.min(F.pow("p", F.col("a") - 1)).alias("low")).select(
        "a", (F.log("z") - F.col("t") / F.col("z")).alias("entropy"), (F.col("top") / F.col("z")).alias("top"), (F.col("low") / F.col("z")).alias("low"))
    return {r["a"]: (r["entropy"], r["top"], r["low"]) for r in rows.collect()}


def exponent(totals: DataFrame, budget: int | None, all_units: int, max_repetition: float | None, target_entropy: float | None,
             halvings: int = 30, highest: float = 1.0) -> float:
    """The exponent in [0, highest], by bisection; one job measures all midpoints of five halvings."""
    def enough(m: tuple[float, float, float]) -> bool:
        entropy, top, low = m
        if target_entropy is not None:
            return entropy <= target_entropy
        return (top / low if budget is None else top * budget / all_units) <= max_repetition * (1 + 1e-12)

    lo, hi = 0.0, highest
    ends = _measures(totals, [lo, hi])
    if not ends or enough(ends[lo]):
        return lo
    if not enough(ends[hi]):
        raise ValueError("no exponent meets the target: the budget repeats some source too often, or the entropy is out of reach")
    for _ in range(halvings // HALVINGS_PER_JOB):
        steps = 2**HALVINGS_PER_JOB
        found = _measures(totals, [lo + (hi - lo) * k / steps for k in range(1, steps)])
        for _ in range(HALVINGS_PER_JOB):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if enough(found[mid]) else (mid, hi)
    return hi


def quotas(totals: DataFrame, budget: int | None, max_repetition: float | None, target_entropy: float | None) -> DataFrame:
    """Per source: share, weight, quota in units, whole passes and the rest of the quota for the last pass."""
    sums = totals.agg(F.sum("units").alias("n")).first()["n"] or 0
    totals = totals.withColumn("all_units", F.lit(sums).cast("bigint"))
    a = exponent(totals, budget, sums, max_repetition, target_entropy)
    powered = totals.withColumn("p", F.col("units") / F.col("all_units")).withColumn("w", F.pow("p", F.lit(a)))
    facts = powered.agg(F.sum("w").alias("z"), F.max(F.col("units") / F.col("w")).alias("least")).first()
    scale = budget / facts["z"] if budget is not None and facts["z"] else facts["least"] or 0.0
    quota = F.round(F.col("w") * F.lit(scale)).cast("bigint")
    return (powered.select("source", "n_docs", "units", "p", (F.col("w") / F.lit(facts["z"] or 1.0)).alias("weight"), quota.alias("quota"))
            .withColumn("passes", F.floor(F.col("quota") / F.col("units")).cast("bigint"))
            .withColumn("rest", F.col("quota") - F.col("passes") * F.col("units")))


def mix(docs: DataFrame, max_repetition: float | None = 2.0, target_entropy: float | None = None, budget: int | None = None,
        seed: int = 7, block_units: int = 1_000_000, rows_per_bucket: int = 1_000, carried: list[str] | None = None) -> DataFrame:
    """One row per use of a document: its columns and `n_tokens`, `pass` (from 0), `block`, `position` (gapless in its block).

    `docs` needs doc_id, text and source; `carried` names the columns to keep (default: all). Without a budget, the budget is the smallest
    that uses every document at least once, so nothing is lost. Words stand for tokens. A null source is a source; null and empty texts
    count one unit, so that they too are placed; copies of a row are told apart and permuted like any rows. Draws move as numbers, and the
    rows move once, at the end. Input columns with the names of added ones are replaced. An empty table gives an empty result.
    """
    if (max_repetition is None) == (target_entropy is None):
        raise ValueError("give either a repetition limit or a target entropy")
    columns = docs.columns if carried is None else carried
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in columns]) if columns else F.struct(F.lit(1).alias("none"))
    text, doc_id = F.coalesce("text", F.lit("")), F.col("doc_id").cast("string")
    whole = named_rows(docs.select(
        row.alias("row"), F.col("source").alias("source"), word_count(F.col("text")).alias("tokens"),
        F.xxhash64(doc_id, text, "source").alias("a"), F.xxhash64("source", text, doc_id).alias("b")), "mix-rows")
    measured = told_apart(whole.select("at", "a", "b", "source", F.greatest("tokens", F.lit(1)).cast("bigint").alias("units")), seed)
    measured = stored(measured.withColumn("name", F.concat(F.hex("a"), F.hex("b"))).drop("a", "b"), "mix-units")
    per_source = quotas(stored(source_totals(measured), "mix-totals"), budget, max_repetition, target_entropy)
    biggest = per_source.agg(F.max("n_docs").alias("n"), F.sum("quota").alias("q")).first()
    digits = digits16(biggest["n"] or 0, rows_per_bucket)
    blocks = max(1, -(-(biggest["q"] or 0) // block_units))
    # `s` names a source and is never null.
    plan = per_source.select("source", F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("s"), F.col("units").alias("source_units"), "quota", "passes", "rest")
    last = F.col("passes") - F.when(F.col("rest") > 0, 0).otherwise(1)
    uses = (measured.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).where("quota > 0")
            .withColumn("pass", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
            .withColumn("draw", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("pass").cast("string"), "name")))
            .withColumn("bucket", F.substring("draw", 1, digits)))
    keys = ["s", "pass", "bucket"]
    before = sums_before(uses.groupBy(*keys).agg(F.sum("units").alias("bucket_units")), ["s", "pass"], "bucket", "bucket_units", digits).select(*keys, "before")
    inside = Window.partitionBy(*keys).orderBy("draw", "name").rowsBetween(Window.unboundedPreceding, 0)
    placed = (uses.withColumn("upto", F.sum("units").over(inside)).join(before, keys)
              .withColumn("upto", F.col("before") + F.col("upto"))
              .where((F.col("pass") < F.col("passes")) | (F.col("upto") <= F.col("rest")))
              .withColumn("reached", F.col("pass") * F.col("source_units") + F.col("upto") - F.col("units"))
              .withColumn("block", F.least(F.expr(f"cast(reached as decimal(24, 0)) * {blocks} div quota"), F.lit(blocks - 1).cast("bigint"))))
    order = Window.partitionBy("block").orderBy(F.md5(F.concat_ws("|", F.col("block").cast("string"), "draw")), "draw", "name")
    places = placed.select("at", F.col("pass").cast("int").alias("pass"), F.col("block").cast("bigint").alias("block"), (F.row_number().over(order) - 1).cast("bigint").alias("position"))
    found = whole.join(places.hint("shuffle_hash"), "at")
    return unpacked(found, columns, n_tokens=F.col("tokens"), **{"pass": F.col("pass")}, block=F.col("block"), position=F.col("position"))

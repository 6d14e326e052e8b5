"""Uniform shuffle into shards of exact size, by a communication matrix of hypergeometric counts.

The rows are cut into parts. Before any row moves, a matrix says how many rows of each part go to each
shard: row p, column s is a draw from the multivariate hypergeometric distribution whose column sums are the
exact shard sizes, so the matrix has the law that a uniform permutation of all rows would give. Each part
permutes its own rows and cuts them by its row of the matrix, the rows are exchanged, and each shard permutes
what it received. Everything runs as DataFrame expressions; the seed fixes every draw.

The matrix is drawn down a tree: the counts of a node's children are drawn from the node's counts, all nodes
of a level in parallel, so no step handles more than FAN children times the shards in one row. A single
count is drawn by rejection from a table-mountain hat (ratio of uniforms), whatever the size of the numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import hashable, let, named_rows, packed, told_apart, unpacked
from creditloom.session import small_side

FAN = 32
TRIALS = 96
# Constants of the hat: 2 sqrt(2/e) and 3 - 2 sqrt(3/e).
HAT_A, HAT_B = 2 * math.sqrt(2 / math.e), 3 - 2 * math.sqrt(3 / math.e)
SMALL_LOG_FACTORIALS = [math.lgamma(x + 1) for x in range(16)]


def log_factorial(x: Column) -> Column:
    """ln x! : a table below 16, Stirling's series from there on."""
    y = x.cast("double")
    series = (y + 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return F.when(x < 16, F.element_at(F.array(*map(F.lit, SMALL_LOG_FACTORIALS)), x.cast("int") + 1)).otherwise(series)


def uniform(*key: Column) -> Column:
    """A number in (0, 1) that the key decides."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 12).cast("double") + 0.5) / float(2**52)


def hypergeometric(good: Column, bad: Column, sample: Column, *key: Column) -> Column:
    """How many of `sample` draws without replacement from `good` + `bad` items are good."""
    population = good + bad

    def rejection(c: Column) -> Column:
        few, many, m = c["few"], c["many"], c["m"]
        share = few / c["population"]
        width = F.sqrt((c["population"] - m) * c["sample"] * share * (1 - share) / F.greatest(c["population"] - 1, F.lit(1)) + 0.5)
        mode = F.floor((m + 1) * (few + 1) / (c["population"] + 2))
        constants = F.struct(
            few.alias("few"), many.alias("many"), m.alias("m"), (m * share + 0.5).alias("centre"), (HAT_A * width + HAT_B).alias("hat"),
            F.least(F.least(m, few) + 1, F.floor(m * share + 0.5 + 16 * width)).alias("end"),
            (log_factorial(mode) + log_factorial(few - mode) + log_factorial(m - mode) + log_factorial(many - m + mode)).alias("peak"))
        return let(constants, lambda k: F.aggregate(F.sequence(F.lit(1), F.lit(TRIALS)), F.lit(None).cast("bigint"),
                                                    lambda found, t: F.coalesce(found, trial(k, t))))

    def trial(k: Column, t: Column) -> Column:
        def accepted(u: Column) -> Column:
            z = F.floor(k["centre"] + k["hat"] * (u["y"] - 0.5) / u["x"])
            return F.when((z >= 0) & (z < k["end"]), let(z, lambda z: F.when(
                2 * F.log(u["x"]) <= k["peak"] - (log_factorial(z) + log_factorial(k["few"] - z) + log_factorial(k["m"] - z)
                                                  + log_factorial(k["many"] - k["m"] + z)), z)))
        return let(F.struct(uniform(*key, t, F.lit(1)).alias("x"), uniform(*key, t, F.lit(2)).alias("y")), accepted)

    def back(c: Column) -> Column:
        # The draw is made for the smaller kind and the smaller half; undo both exchanges.
        z = let(F.coalesce(rejection(c), F.floor((c["m"] + 1) * (c["few"] + 1) / (c["population"] + 2))),
                lambda z: F.when(c["good"] > c["bad"], c["m"] - z).otherwise(z))
        return let(z, lambda z: F.when(c["m"] < c["sample"], c["good"] - z).otherwise(z))

    inputs = F.struct(good.alias("good"), bad.alias("bad"), sample.alias("sample"), population.alias("population"),
                      F.least(good, bad).alias("few"), F.greatest(good, bad).alias("many"), F.least(sample, population - sample).alias("m"))
    return (F.when((sample == 0) | (good == 0), F.lit(0).cast("bigint")).when(bad == 0, sample).when(sample == population, good)
            .otherwise(let(inputs, back)))


def _one_row(caps: Column, rows: Column, *key: Column) -> Column:
    """Counts per shard of `rows` items drawn without replacement from shards with `caps` items."""
    def step(acc: Column, s: Column) -> Column:
        cap = F.element_at(caps, s)
        drawn = hypergeometric(cap, acc["pool"] - cap, acc["rows"], *key, s)
        return let(drawn, lambda x: F.struct((acc["rows"] - x).alias("rows"), (acc["pool"] - cap).alias("pool"),
                                             F.concat(acc["counts"], F.array(x)).alias("counts")))
    pool = F.aggregate(caps, F.lit(0).cast("bigint"), lambda a, x: a + x)
    start = F.struct(rows.alias("rows"), pool.alias("pool"), F.array().cast("array<bigint>").alias("counts"))
    return F.aggregate(F.sequence(F.lit(1), F.size(caps)), start, step)["counts"]


def _children(seed: int, level: int):
    """Step over the children of a node: each takes its counts out of what the node still has."""
    def step(acc: Column, c: Column) -> Column:
        return let(_one_row(acc["caps"], c["n"], F.lit(seed), F.lit(level), c["child"]), lambda drawn: F.struct(
            F.zip_with(acc["caps"], drawn, lambda a, b: a - b).alias("caps"),
            F.concat(acc["out"], F.array(F.struct(c["child"].alias("node"), drawn.alias("counts")))).alias("out")))

    return step


def communication_matrix(sizes: DataFrame, shard_sizes: list[int], parts: int, seed: int = 0) -> DataFrame:
    """`sizes` (part from 0, n) to (part, counts array<long>): exact row and column sums, hypergeometric law."""
    depth = max(1, math.ceil(math.log(max(parts, 2), FAN)))
    nodes = sizes.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("node"), F.array(*[F.lit(n).cast("bigint") for n in shard_sizes]).alias("counts"))
    for level in range(1, depth + 1):
        span = FAN ** (depth - level)
        children = (sizes.groupBy(F.floor(F.col("part") / span).alias("child")).agg(F.sum("n").alias("n"))
                    .groupBy(F.floor(F.col("child") / FAN).alias("node")).agg(F.array_sort(F.collect_list(F.struct("child", "n"))).alias("children")))
        start = F.struct(F.col("counts").alias("caps"), F.array().cast("array<struct<node:bigint,counts:array<bigint>>>").alias("out"))
        nodes = nodes.join(children, "node").select(F.inline(F.aggregate("children", start, _children(seed, level))["out"]))
    return nodes.select(F.col("node").alias("part"), "counts")


def shuffle_into_shards(docs: DataFrame, shards: int = 16, seed: int = 0, rows_per_part: int = 10_000) -> DataFrame:
    """`docs` with `shard` (0 to shards-1, sizes at most one apart) and `slot` (gapless from 0 in its shard).

    Any columns and any nulls are allowed. The content of a row decides its draw, never its place in a file; only copies of a row are told
    apart by a number that is written before the first draw, so they are dealt apart like any other rows, and a lost executor's tasks repeat
    their results. Draws move as numbers; the rows themselves move once, at the end. Input columns named `shard` or `slot` are replaced. An
    empty table gives an empty result.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    keys = [F.col("row").getField(c) for c in hashable(docs)]
    content = packed(docs).select("row", F.xxhash64(F.lit(0), *keys).alias("a"), F.xxhash64(*keys, F.lit(0)).alias("b"))
    whole = named_rows(content, "shard-rows")
    total = whole.count()
    parts = max(1, math.ceil(total / rows_per_part))
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    rows = told_apart(whole.select("at", "a", "b"), seed).withColumn("part", F.pmod("a", F.lit(parts)).cast("bigint"))
    counted = docs.sparkSession.range(parts).withColumnRenamed("id", "part").join(
        rows.groupBy("part").agg(F.count("*").alias("n")), "part", "left").select("part", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
    bounds = communication_matrix(counted, sizes, parts, seed).select("part", F.aggregate(
        "counts", F.array(F.lit(0).cast("bigint")), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))).alias("bounds"))
    local = rows.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("a", "b")))
    dealt = (local.join(small_side(bounds), "part")
             .withColumn("shard", F.size(F.filter("bounds", lambda b: b < F.col("nth"))) - 1)
             .select("at", "shard", F.xxhash64("b", "a", F.lit(seed)).alias("c"), "a", "b"))
    blocks = max(1, math.ceil(total / shards / rows_per_part))
    dealt = dealt.withColumn("block", F.pmod("c", F.lit(blocks)).cast("int"))
    per_block = dealt.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = per_block.select("shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("before"))
    ranked = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("shard", "block").orderBy("c", "a", "b")))
    places = ranked.join(small_side(before), ["shard", "block"]).select("at", F.col("shard").cast("int").alias("shard"), (F.col("before") + F.col("nth") - 1).cast("bigint").alias("slot"))
    return unpacked(whole.join(places.hint("shuffle_hash"), "at"), docs.columns, shard=F.col("shard"), slot=F.col("slot"))

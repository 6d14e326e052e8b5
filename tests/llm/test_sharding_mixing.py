import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from creditloom.llm import common as sharding_common
from creditloom.llm import mixing, sharding


def test_shards_are_exact_and_slots_gapless(spark):
    rows = spark.range(1003).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    out = sharding.shuffle_into_shards(rows, 16, rows_per_part=50).collect()
    assert sorted(r.doc_id for r in out) == list(range(1003))
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r.slot)
    assert sorted(by) == list(range(16)) and {len(v) for v in by.values()} == {62, 63}
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = sharding.shuffle_into_shards(rows.repartition(7), 16, rows_per_part=50).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in out} == {(r.doc_id, r.shard, r.slot) for r in again}


def test_shards_look_uniform(spark):
    rows = spark.range(8000).select(F.col("id").alias("doc_id"))
    out = sharding.shuffle_into_shards(rows, 4, rows_per_part=500).collect()
    counts = Counter((r.shard, r.doc_id // 1000) for r in out)
    assert sum((n - 250) ** 2 / 250 for n in counts.values()) < 60  # 21 degrees of freedom


def test_matrix_sums(spark):
    sizes = [137, 0, 1, 5000, 12, 900] + [33] * 60
    n = sum(sizes)
    shards = [n // 7 + (s < n % 7) for s in range(7)]
    frame = spark.createDataFrame(list(enumerate(sizes)), "part bigint, n bigint")
    rows = {r.part: r.counts for r in sharding.communication_matrix(frame, shards, len(sizes), 3).collect()}
    assert [sum(rows[p]) for p in range(len(sizes))] == sizes
    assert [sum(rows[p][s] for p in rows) for s in range(7)] == shards
    assert all(x >= 0 for r in rows.values() for x in r)


@pytest.mark.parametrize("good,bad,sample", [(5, 7, 6), (40, 3, 20), (300, 500, 200)])
def test_hypergeometric_law(spark, good, bad, sample):
    draws = 4000
    col = sharding.hypergeometric(F.lit(good).cast("bigint"), F.lit(bad).cast("bigint"), F.lit(sample).cast("bigint"), F.col("id"))
    seen = Counter(r[0] for r in spark.range(draws).select(col).collect())
    total, cells, chi = math.comb(good + bad, sample), 0, 0.0
    for k in range(max(0, sample - bad), min(good, sample) + 1):
        p = math.comb(good, k) * math.comb(bad, sample - k) / total
        if p * draws >= 5:
            cells, chi = cells + 1, chi + (seen[k] - p * draws) ** 2 / (p * draws)
    assert chi < cells + 5 * math.sqrt(2 * cells) and sum(seen.values()) == draws


def test_awkward_and_empty(awkward, nothing):
    out = sharding.shuffle_into_shards(awkward, 3)
    assert sorted(out.columns) == sorted([*awkward.columns, "slot"]) and out.count() == awkward.count()
    assert dict(out.dtypes)["shard"] == "int"
    assert sharding.shuffle_into_shards(nothing, 3).count() == 0
    used = mixing.mix(awkward).cache()
    assert used.select("doc_id", "text").distinct().count() == awkward.select("doc_id", "text").distinct().count()
    assert mixing.mix(nothing).count() == 0


def test_mixture(spark):
    docs = [(i, "w " * (1 + i % 7), "big" if i % 3 else ("mid" if i % 9 else "small")) for i in range(900)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    out = mixing.mix(frame, max_repetition=2.0, block_units=500, rows_per_bucket=30).collect()
    tokens = defaultdict(int)
    for i, t, s in docs:
        tokens[s] += len(t.split())
    got = defaultdict(int)
    for r in out:
        got[r.source] += r.n_tokens
    # The largest source is used once, the rarest twice; the exponent gives the one between.
    low, high = min(tokens.values()), max(tokens.values())
    a = 1 - math.log(2) / math.log(high / low)
    for s, n in tokens.items():
        quota = high * (n / high) ** a
        assert quota - 7 <= got[s] <= quota + 1, s
    assert {r.doc_id for r in out} == {d[0] for d in docs}
    assert max(Counter((r.doc_id) for r in out).values()) <= 2
    blocks = defaultdict(list)
    for r in out:
        blocks[r.block].append(r)
    assert all(sorted(r.position for r in b) == list(range(len(b))) for b in blocks.values())
    whole = sum(got.values())
    for b in list(blocks.values())[:-1]:
        share = sum(r.n_tokens for r in b if r.source == "big") / sum(r.n_tokens for r in b)
        assert abs(share - got["big"] / whole) < 0.05


def test_entropy_target_and_budget(spark):
    frame = spark.createDataFrame([(s, n, n) for s, n in (("a", 800), ("b", 150), ("c", 50))], "source string, n_docs bigint, units bigint")
    q = {r.source: r for r in mixing.quotas(frame, 1000, None, 1.0).collect()}
    assert abs(-sum(r.weight * math.log(r.weight) for r in q.values()) - 1.0) < 1e-6
    assert abs(sum(r.quota for r in q.values()) - 1000) <= 2
    with pytest.raises(ValueError):
        mixing.quotas(frame, 5000, 2.0, None).collect()


@pytest.mark.parametrize("rows_per_part", [200, 10_000])
def test_doubled_rows_are_dealt_apart(spark, rows_per_part):
    n = 6000
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("same").alias("text"))
    out = sharding.shuffle_into_shards(rows.union(rows), 16, rows_per_part=rows_per_part).collect()
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append((r.shard, r.slot))
    together = [v for v in by.values() if v[0][0] == v[1][0]]
    assert len(by) == n and abs(len(together) - n / 16) < 3 * math.sqrt(n * 15 / 256)
    assert sum(abs(v[0][1] - v[1][1]) == 1 for v in together) < 10


def test_one_row_many_times_spreads(spark):
    rows = spark.range(100_000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("same").alias("text"), F.lit("a").alias("source"))
    copies = sharding.told_apart(rows.select(F.xxhash64("doc_id").alias("a"), F.xxhash64("text").alias("b"), F.monotonically_increasing_id().alias("at")), 0)
    parts = [r["count"] for r in copies.groupBy(F.pmod("a", F.lit(50))).count().collect()]
    assert len(parts) == 50 and max(parts) < 2400
    sizes = Counter(r.shard for r in sharding.shuffle_into_shards(rows, 16, rows_per_part=2000).select("shard").collect())
    assert set(sizes.values()) == {6250}
    blocks = mixing.mix(rows.limit(5000), block_units=100, rows_per_bucket=50).groupBy("block").count().collect()
    assert len(blocks) == 50 and {r["count"] for r in blocks} == {100}


def test_sums_in_two_steps(spark):
    rows = [(k, f"{b:04x}", (b * 7 + len(k)) % 11) for k in ("x", "yy") for b in range(0, 65536, 97)]
    found = {(r.k, r.bucket): r.before for r in sharding_common.sums_before(spark.createDataFrame(rows, "k string, bucket string, v bigint"), ["k"], "bucket", "v", 4).collect()}
    for k in ("x", "yy"):
        total = 0
        for key, b, v in rows:
            if key == k:
                assert found[k, b] == total
                total += v

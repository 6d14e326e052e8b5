import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from creditloom.llm import importance

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(docs, target, longest=1, buckets=10_000, seed=2024, min_words=20, percent=10):
    def slots(text):
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        return len(words), [zlib.crc32(" ".join(words[i:i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(words) - k + 1)]

    seen = [(i, *slots(t)) for i, t in docs]
    s, t = Counter(x for _, _, f in seen for x in f), Counter(x for text in target for x in slots(text)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (t_s + buckets) / ((s[b] + 1.0) * (t.total() + buckets)))) for t_s in [s.total()] for b in range(buckets)]
    rows = []
    for i, n, f in seen:
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[5] = place
    return rows


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (2, 500, 37), (3, 64, 100)])
def test_resampling_matches_brute_force(spark, sf, longest, buckets, percent):
    docs, target = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = importance.resample(docs.repartition(7), target, longest, buckets, percent=percent).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], longest, buckets, percent=percent)
    assert {(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got} == {tuple(r) for r in want} and len(got) == len(want)
    assert {r.doc_id: r.text for r in got} == {r.doc_id: r.text for r in docs.collect()}


def test_words_and_offsets_like_a_regular_expression():
    split = importance.splitter()
    for text in ["", "  ", "Ab1 é漢字-x\x00y\x7fz\n", "it's 9.5", "ö" * 5 + "." + "w" * 9]:
        assert [w for w, _ in split.pre_tokenize_str(text)] == WORD.findall(text)
        assert all(text[a:z] == w for w, (a, z) in split.pre_tokenize_str(text))


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_long_texts_are_split_in_pieces_without_a_difference(longest, monkeypatch):
    text = "Ein Wort, é und noch eins; " * 40 + "x" * 300 + " ende " + "," * 200 + "b c"
    whole = importance.histogram(text, importance.splitter(), importance.Buckets(97), longest)
    monkeypatch.setattr(importance, "PIECE", 25)
    assert [p for p in importance.pieces(text, 25)] and "".join(importance.pieces(text, 25)) == text
    monkeypatch.setattr(importance.pieces, "__defaults__", (25,))
    cut = importance.histogram(text, importance.splitter(), importance.Buckets(97), longest)
    assert whole[:2] == cut[:2] and all((a == b).all() for a, b in zip(whole[2:], cut[2:]))


def test_awkward_and_empty(spark, awkward, nothing):
    target = spark.createDataFrame([("alpha words",), (None,), ("",)], "text string")
    docs = awkward.withColumnRenamed("shard", "rank")
    got = importance.resample(docs, target, min_words=4, percent=60).collect()
    want = brute([(r.doc_id, r.text) for r in awkward.collect()], ["alpha words", None, ""], min_words=4, percent=60)
    assert sorted(map(str, [(r.doc_id, r.n_words, r.n_features, r.weight, r.score, r["rank"]) for r in got])) == sorted(map(str, map(tuple, want)))
    assert {r["row"] for r in got} == {r["row"] for r in awkward.collect()}
    assert importance.resample(nothing, target).count() == 0
    assert importance.resample(awkward, nothing, percent=100, min_words=0).where("rank is null").count() == 0


def test_equal_rows_get_ranks_of_their_own(spark):
    docs = spark.range(5000).selectExpr("id % 2 as doc_id", "repeat('same words here ', 10) as text")
    got = importance.resample(docs, docs, percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"] is not None) == list(range(1, 2501))

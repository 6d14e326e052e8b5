import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.llm import components, decontamination, licences, quality, repeats, simhash, tokens, toxicity, winnowing
from creditloom.llm.queries import BPE_RANKS, QUERIES


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_licences_match_brute_force(spark, sf, awkward, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    header = licences.TEMPLATES["gpl-3.0-header"]
    more = spark.createDataFrame([(10_001, header.replace("; without", ";\nwithout").replace("useful", "handy")), (10_002, "x\n" + licences.TEMPLATES["mit"] + "\n")], "doc_id bigint, text string")
    docs = docs.select("doc_id", "text").union(more)
    got = {r.doc_id: (r.licence, r.dice, r.unit) for r in licences.scan(docs).collect()}
    known = {n: set(licences.template_bigrams(t)) for n, t in licences.TEMPLATES.items()}
    for r in docs.collect():
        lines = r.text.split("\n")
        units = [*enumerate(lines), *([(-1, " ".join(lines))] if len(lines) > 1 else [])]
        best = None
        for unit, text in units:
            b = set(licences.template_bigrams(text))
            for name in sorted(known):
                d = round(dice(b, known[name]), 9)
                if d >= 0.8 and (best is None or (-d, unit) < (-best[1], best[2])):
                    best = (name, d, unit)
        assert got[r.doc_id] == (best or (None, None, None)), r.doc_id
    assert got[10_001][0] == "gpl-3.0-header" and got[10_002][0] == "mit"
    assert licences.scan(awkward).count() == awkward.count() and licences.scan(nothing).count() == 0
    for size in (1, 4, 30):
        low, high = licences.size_bounds(size, 0.8)
        assert all((2 * min(n, size) / (n + size) >= 0.8 - 1e-12) == (low <= n <= high) for n in range(1, 100))


@pytest.mark.parametrize("name,label,bar", [("op2_quality_classifier", "quality", 0.95), ("op8_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, bar):
    big = "/root/testdata/sf0.1"
    rows = QUERIES[name](spark, big).where("held_out").join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").select("score", "predicted", label).collect()
    assert np.mean([r.predicted == r[label] for r in rows]) >= bar
    ones, zeros = ([r.score for r in rows if r[label] == k] for k in (1, 0))
    assert np.mean([[a > b for b in zeros] for a in ones]) >= 0.95


def test_scores_on_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (4, None, None), (6, 1, 1)], "doc_id bigint, quality int, toxic int")
    for module in (quality, toxicity):
        model = module.fit(awkward, labels)
        scores = [r.score for r in module.score(awkward, model).collect()]
        assert len(scores) == awkward.count() and all(0 <= s <= 1 for s in scores)
        assert module.score(nothing, module.fit(nothing, labels.limit(0))).count() == 0


def test_class_prior_and_label_model():
    rng = np.random.default_rng(1)
    p, u = rng.normal(2, 1, 4000), np.r_[rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)]
    assert abs(quality.class_prior(p, u) - 0.7) < 0.05
    y = rng.random(3000) < 0.2
    honest = [np.where(rng.random(3000) < 0.9, np.where(y, 1, -1), np.where(y, -1, 1)) for _ in range(4)]
    noise = np.where(rng.random(3000) < 0.5, 1, -1)
    votes = np.stack([*honest, noise, noise, noise], axis=1)
    post, found = toxicity.label_model(votes, prior=0.2)
    assert np.mean((post > 0.5) == y) > 0.95
    assert found["accuracy"][:4].min() > 0.85 and found["accuracy"][4:].max() < 0.65 and found["correlation"][4, 5] > 0.9


def test_winnowing_minima_and_guarantee():
    rng = random.Random(2)
    for n, w in ((1, 5), (4, 5), (60, 7), (300, 32)):
        h = np.array([rng.randrange(9) for _ in range(n)], dtype=np.uint64)
        want = {max(j for j in range(i, i + min(w, n)) if h[j] == min(h[i:i + min(w, n)])) for i in range(n - min(w, n) + 1)}
        assert winnowing.window_minima(h, w).tolist() == sorted(want)
    for _ in range(30):
        shared = "".join(rng.choice("abcde ") for _ in range(winnowing.K + winnowing.W - 1))
        a, b = ("".join(rng.choice("xyzw") for _ in range(rng.randrange(80))) + shared + "".join(rng.choice("uvrs") for _ in range(50)) for _ in range(2))
        pairs = winnowing.shared_passages(winnowing.pack(*winnowing.winnow(a)), winnowing.pack(*winnowing.winnow(b)))
        assert any(a[i:i + winnowing.K] == b[j:j + winnowing.K] for i, j in pairs)
    codes = np.array([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 1, 4, 1], dtype=np.uint8)
    h = winnowing.rolling_hashes(codes, 4)
    assert h[0] != h[1] and h[0] == h[9] if codes[9:13].tolist() == codes[0:4].tolist() else True


def test_next_document_and_likeness(spark, sf, awkward, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = dict(sorted((r.doc_id, r.text or "") for r in docs.collect()))
    ids = list(texts)
    got = {r.doc_id: r.next_text for r in winnowing.with_next(docs, rows_per_bucket=7).collect()}
    assert got == {i: texts[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}
    rows = winnowing.compare_with_edits(docs).collect()
    for r in rows:
        n = len(texts[r.doc_id]) // 4
        edited = texts[r.doc_id][:len(texts[r.doc_id]) - n] + got[r.doc_id][:n]
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and r.n_chars == len(texts[r.doc_id])
    assert np.mean([r.near_edited > r.near_next for r in rows]) > 0.95
    assert winnowing.compare_with_edits(awkward).count() == awkward.count() and winnowing.compare_with_edits(nothing).count() == 0
    assert winnowing.fingerprint(awkward).count() == awkward.count()


def brute_contamination(text, items, size=13):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, ids = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(size, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit.update(range(j, j + n))
                    ids.add("" if item is None else str(item))
    return len(w), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination_matches_brute_force(spark, awkward, nothing):
    rng = random.Random(4)
    vocabulary = ["alpha", "beta", "Gamma", "dé", "x1", "漢字"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 13, 14, 30])))) for k in range(25)]
    items += [(7, "other text of item seven"), (None, "alpha beta alpha beta gamma"), (99, None), (98, "...")]
    docs = [(k, ", ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 5, 40, 200])))) for k in range(60)]
    docs += [(100 + k, "noise here " + (items[k][1] or "") + "! more noise") for k in range(len(items))]
    docs += [(1, "same id other text"), (None, items[3][1]), (5, None), docs[3], docs[3]]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = decontamination.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()
    key = lambda t: tuple((x is None, x) for x in t)
    got = sorted(((r.doc_id, r.text, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in out), key=lambda t: key(t[:2]))
    want = sorted(((i, t, *(tuple(x) if isinstance(x, list) else x for x in brute_contamination(t, items))) for i, t in docs), key=lambda t: key(t[:2]))
    assert got == want
    long_items = bench.where("length(text) > 60")
    assert decontamination.contamination(awkward, long_items).count() == awkward.count()
    assert decontamination.contamination(nothing, bench).count() == 0
    assert not decontamination.contamination(awkward, bench.limit(0)).where("contaminated").count()


def test_token_totals(spark, tmp_path, awkward, nothing):
    encoding = tokens.byte_pair_encoding(BPE_RANKS)
    rows = tokens.bpe_tokens(awkward, BPE_RANKS).cache()
    assert sum(r.n_bpe for r in rows.collect()) == sum(len(encoding.encode_ordinary(r.text or "")) for r in awkward.collect())
    rollup = tokens.Rollup(spark, str(tmp_path / "totals"))
    assert rollup.batches() == [] and rollup.totals().count() == 0
    assert rollup.commit("one", tokens.inserts(rows, "v1", "n_words")) and not rollup.commit("one", tokens.inserts(rows, "v1", "n_words"))
    want = {(r.source, r.lang): (r.n, r.w) for r in rows.groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_words").alias("w")).collect()}
    assert {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()} == want
    # A batch that was broken off has no marker and is written anew.
    (tmp_path / "totals" / "batch=one" / "_SUCCESS").unlink()
    assert rollup.totals().count() == 0 and rollup.commit("one", tokens.inserts(rows, "v1", "n_words"))
    rollup.compact("s")
    assert not rollup.commit("one", tokens.inserts(rows, "v1", "n_words"))
    rollup.commit("two", tokens.revisions(rows, "v1", "n_words", "n_bpe"))
    assert sum(r.n_tokens for r in rollup.totals().collect()) == sum(r.n_bpe for r in rows.collect())
    rollup.commit("three", tokens.deletes(rows, "v1", "n_bpe"))
    assert rollup.totals().count() == 0
    assert rollup.commit("none", tokens.inserts(tokens.bpe_tokens(nothing, BPE_RANKS), "v1", "n_words"))


def test_token_query_is_a_direct_count(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    encoding = tokens.byte_pair_encoding(BPE_RANKS)
    want = {}
    for r in docs.collect():
        n = len(re.findall(r"[^ \t\n\r]+", r.text))
        if n:
            for version, k in (("words-1", n), ("byte-bpe-50k", len(encoding.encode_ordinary(r.text)))):
                d, t = want.get((r.source, r.lang, version), (0, 0))
                want[r.source, r.lang, version] = (d + 1, t + k)
    assert {(r.source, r.lang, r.version): (r.n_docs, r.n_tokens) for r in QUERIES["op5_token_counts"](spark, sf).collect()} == want


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2001 + k) for k in range(50)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {x: union.root(x) for a, b in edges if a != b for x in (a, b)}


def brute_fingerprint(text):
    import xxhash
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("cell_rows", [4096, 20])
def test_links_keep_every_component(spark, cell_rows):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    codes = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for c in centres for _ in range(12)} | set(centres)
    codes |= {1 << b for b in range(64)} | {rng.getrandbits(20) for _ in range(150)}
    codes = sorted(codes)
    union = Union()
    for i, a in enumerate(codes):
        union.root(signed(a))
        for b in codes[:i]:
            if (a ^ b).bit_count() <= 2:
                union.join(signed(a), signed(b))
    frame = spark.createDataFrame([(signed(c),) for c in codes], "code bigint")
    got = Union()
    for r in simhash.links(frame, cell_rows).collect():
        got.join(r.u, r.v)
    classes = lambda u: {frozenset(x for x in map(signed, codes) if u.root(x) == r) for r in {u.root(signed(c)) for c in codes}}
    assert classes(got) == classes(union)


def test_near_duplicates(spark, sf, awkward, nothing):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    union = Union()
    for a in prints:
        union.root(a)
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                union.join(a, b)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {i: (f"{p:016x}", union.root(i)) for i, p in prints.items()}
    assert sorted(r.doc_id for r in simhash.one_per_group(docs).collect()) == sorted({union.root(i) for i in prints})
    assert simhash.near_duplicates(awkward).count() == awkward.count()
    kept = simhash.one_per_group(awkward).collect()
    assert len([r for r in kept if r.doc_id == 4]) == 1
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_per_group(nothing).count() == 0


def brute_repeats(docs, length):
    seen, out = set(), []
    for _, text in docs:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i:i + length]
            if s in seen:
                gone[i:i + length] = b"\x01" * length
            seen.add(s)
        out.append((len(raw), sum(gone), len(re.findall(b"\x01+", bytes(gone))), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize("group", [8192, 2])
def test_repeats_match_brute_force(spark, awkward, nothing, group):
    rng = random.Random(6)
    parts = ["".join(rng.choice("abé \x00") for _ in range(rng.randrange(15, 60))) for _ in range(12)]
    docs = [(k, "".join(rng.choice(parts)[rng.randrange(4):] for _ in range(rng.randrange(7)))) for k in range(80)]
    docs += [(100, "a" * 90), (101, "ab" * 70), (102, None), (103, ""), (104, "a" * 19), (105, "b\x00" * 20)]
    rows = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), bytes(r.kept)) for r in repeats.remove_repeats(rows, 20, 8, group).collect()}
    assert got == dict(zip([d[0] for d in docs], brute_repeats(docs, 20), strict=True))
    ordered = sorted(((r.doc_id, r.text or "") for r in awkward.collect()), key=lambda t: (t[0] is None, t[0] or 0, t[1]))
    out = repeats.remove_repeats(awkward, 20, 8, group).collect()
    assert sorted((r.n_bytes, bytes(r.kept)) for r in out) == sorted((b[0], b[3]) for b in brute_repeats(ordered, 20))
    assert repeats.remove_repeats(nothing).count() == 0

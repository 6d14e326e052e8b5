import random
from collections import Counter

import numpy as np
import pytest

from creditloom.llm import automata, phrases


def brute(docs, longest, least, top, inside):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for c in ".,;:!?\n\v\f\r":
            lowered = lowered.replace(c, "\n")
        for piece in lowered.split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = {}
    for (lang, *words), a in cand.items():
        score, k = min((1000 * a * n[lang] // (f[lang, *words[:k]] * f[lang, *words[k:]]), k) for k in range(1, len(words)))
        longer = any(p[0] == lang and len(p) - 1 > len(words) and 100 * b >= inside * a and any(list(p[i:i + len(words)]) == words for i in range(1, len(p))) for p, b in cand.items())
        if not longer:
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, *words[:k]], f[lang, *words[k:]]))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top])}


def invented(seed, docs, words="a b c d Ä é f G".split()):
    rng = random.Random(seed)
    marks = ["", "", "", "", ",", ".", "\n", "\t", " ", ";", "\r\n"]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randrange(0, 60)))) for _ in range(docs)]
    return rows + [("en", "New York City is a big place. new york city")] * 9 + [("de", None), ("de", ""), (None, " ,. ")]


@pytest.mark.parametrize("seed,least,inside,longest", [(1, 3, 100, 5), (2, 9, 60, 4), (3, 2, 100, 2)])
def test_phrases_match_brute_force(spark, seed, least, inside, longest):
    docs = invented(seed, 60)
    frame = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id bigint, lang string, text string").repartition(5)
    # Shards of about 90 words and small ranges: phrases meet from many shards, parts come from other ranges.
    got = phrases.mine(frame, longest, least, 15, inside, shard_words=90, range_pairs=200).drop("words").collect()
    assert {tuple(r) for r in got} == brute(docs, longest, least, 15, inside)
    assert len(got) == len({(r.lang, r.rank) for r in got})


def test_table_phrases_match_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {tuple(r) for r in phrases.mine(docs, least=40, range_pairs=300).drop("words").collect()}
    assert got == brute([(r.lang, r.text) for r in docs.collect()], 5, 40, 2000, 100) and len(got) > 20


def test_awkward_and_empty(spark, awkward, nothing):
    docs = [(r.lang, r.text) for r in awkward.collect()]
    got = {tuple(r) for r in phrases.mine(awkward, least=2).drop("words").collect()}
    assert got == brute(docs, 5, 2, 2000, 100)
    assert phrases.mine(nothing).count() == 0


def test_long_texts_are_taken_in_parts(spark, monkeypatch):
    import pandas as pd

    texts = ["a b, c d " * 50 + "x" * 90 + " a b", "", None, "no marks at all in this one " * 30, "a b"]
    batch = [pd.DataFrame({"text": texts, "lang": ["en", None, "en", "de", "en"]})]
    whole = list(phrases.shards(iter(batch), 10**9))[0]
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 40)
    parts = list(phrases.shards(iter(batch), 30))
    assert len(parts) > 3
    for name in ("word", "one"):
        assert (np.concatenate([getattr(p, name) for p in parts]) == getattr(whole, name)).all()
    pairs = [np.sort(np.concatenate([p.two[p.paired] for p in group])) for group in (parts, [whole])]
    assert len(pairs[0]) == len(pairs[1]) and (pairs[0] == pairs[1]).all()
    assert [whole.text(i) for i in range(4)] == ["a", "b", "c", "d"]


def test_a_task_holds_few_bytes_a_word():
    import tracemalloc
    from types import SimpleNamespace

    import pandas as pd

    rng, every = random.Random(6), SimpleNamespace(value=np.full(1 << 15, 0xFFFFFFFF, np.uint32))
    some = [" ".join(f"w{rng.randrange(2000)}" for _ in range(5)) for _ in range(400)]
    batch = pd.DataFrame({"text": [". ".join(rng.choices(some, k=1000)) for _ in range(100)], "lang": "en"})
    work = phrases._shard_automata(every, every, 5, 250_000, [])
    assert len(list(work(iter([batch[:1]])))) == 1
    tracemalloc.start()
    assert sum(len(found) for found in work(iter([batch]))) == 2
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 250,000 words of about 7 bytes at a time.
    assert peak < 160 * 250_000


def test_blanks_and_long_words_end_a_shard(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(phrases, "CHUNK_BYTES", 1000)
    batch = pd.DataFrame({"text": ["a b" + " " * 5000 + "c", "d" * 3000] * 6, "lang": "en"})
    found = list(phrases.shards(iter([batch]), 100))
    assert sum(s.size for s in found) == 24 and all(len(s.data) < 100 * phrases.WORD_BYTES + 5100 for s in found)


def test_hot_word_and_long_text(spark):
    rows = spark.range(400).selectExpr("id as doc_id", "'en' as lang", "repeat('the end ', 500) as text")
    got = [tuple(r) for r in phrases.mine(rows, longest=3, shard_words=5000).drop("words").collect()]
    want = brute([("en", "the end " * 500)] * 400, 3, 100, 2000, 100)
    assert set(got) == want


def test_automaton_is_minimal_and_keeps_weights():
    rng = random.Random(4)
    items = {tuple(rng.choice("abc") for _ in range(rng.randrange(1, 5))): rng.randrange(1, 4) for _ in range(80)}
    a = automata.build(sorted(items.items()))
    assert dict(a.items()) == items and list(a.items()) == sorted(items.items())
    assert len({(w, tuple(x.items())) for w, x in zip(a.weights, a.arcs)}) == len(a.arcs)
    assert dict(automata.Automaton.from_bytes(a.to_bytes()).items()) == items
    assert all(a.weight(k) == n for k, n in items.items()) and a.weight(("z",)) == 0
    assert len(a.arcs) < len(items)  # ends are shared


def test_union_sums_and_composition_looks_up():
    rng = random.Random(5)
    sets = [Counter(tuple(rng.choice("abcd") for _ in range(rng.randrange(1, 4))) for _ in range(60)) for _ in range(4)]
    whole = sum(sets, Counter())
    united = automata.union([automata.build(sorted(s.items())) for s in sets])
    assert dict(united.items()) == whole
    falling = {("a",): 9, ("a", "b"): 4, ("a", "b", "c"): 3, ("a", "c"): 2, ("b",): 2, ("c", "d"): 5}
    assert dict(automata.union([automata.build(sorted(falling.items()))] * 2, 6).items()) == {("a",): 18, ("a", "b"): 8, ("a", "b", "c"): 6, ("c", "d"): 10}
    asked = {k: 1 for i, k in enumerate(sorted(whole)) if i % 3 == 0} | {("x",): 1, ("a", "x"): 1}
    found = automata.compose(automata.build(sorted(asked.items())), united)
    assert dict(found.items()) == {k: whole[k] for k in asked if k in whole}
    with pytest.raises(ValueError):
        automata.build([(("b",), 1), (("a",), 1)])
    assert dict(automata.build([]).items()) == {} and dict(automata.compose(automata.build([]), united).items()) == {}

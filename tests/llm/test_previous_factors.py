import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from creditloom.llm import repeats


@pytest.mark.parametrize("seed,letters,width", [(1, "ab", 12), (2, "abc", 6), (3, "a", 9), (4, "abcdefgh", 5)])
def test_longest_previous_factors_equal_brute_force(seed, letters, width):
    rng = random.Random(seed)
    text = "".join(rng.choice(letters) for _ in range(150)) + "ab" * 20
    cut = [text[i:i + width] for i in range(len(text) - width + 1)]
    place = np.array(rng.sample(range(1000), len(cut)))
    groups = [rng.randrange(2) for _ in cut]

    def common(a, b):
        return next((i for i in range(width) if a[i] != b[i]), width)

    for lead in (0, 1):
        rows = np.array([list(([g] if lead else []) + list(c.encode()) + [1]) for g, c in zip(groups, cut)], np.uint8)
        got = np.minimum(repeats.previous_factors(rows, place, lead), width)
        want = [max((common(a, b) for b, q, k in zip(cut, place, groups) if q < p and (not lead or k == g)), default=0) for a, p, g in zip(cut, place, groups)]
        assert got.tolist() == want


def test_hot_windows_are_told_apart_by_bytes(spark, monkeypatch):
    """Every window hash equal: only the bytes decide, in the bounded way and in the other."""
    rng = random.Random(7)
    text = "".join(rng.choice("abcdefghij") for _ in range(400))
    docs = spark.createDataFrame([(1, text), (2, "xx" + text[50:300] + "yy"), (3, text[100:260])], "doc_id bigint, text string")
    want = [(r.doc_id, r.kept_sha256) for r in repeats.remove_repeats(docs).orderBy("doc_id").collect()]
    got = [(r.doc_id, r.kept_sha256) for r in repeats.remove_repeats(docs, group=0).orderBy("doc_id").collect()]
    assert got == want
    data = np.frombuffer(text.encode(), np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(data, 100)
    order, again = repeats._settle((np.zeros(len(windows), np.int64),), np.zeros(len(windows), np.int64), np.arange(len(windows)))
    again[1:] &= (windows[order[1:]] == windows[order[:-1]]).all(axis=1)
    assert not again.any()


FOOTER = "all rights of this page belong to nobody at all"


def footed(n, seed):
    """Documents with one footer between different neighbours; some texts stand twice, some footers with longer shared surroundings."""
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        head, tail = ("".join(rng.choice("abcdefghijklmnop ") for _ in range(90)) for _ in range(2))
        if i % 5 == 0:
            head = head[:40] + "and so this page ends, as every page must, "
        texts.append(texts[rng.randrange(i)] if i % 9 == 8 else head + FOOTER + tail)
    return texts


def test_units_of_a_footer_are_dealt_out():
    texts = footed(200, 3)
    rows = [r for frame in repeats._emit_units(100, 32)(iter([pd.DataFrame({"doc": range(200), "text": texts})])) for r in frame.itertuples()]
    per_anchor = Counter(r.h for r in rows if r.kind == repeats._UNIT)
    per_task = Counter((r.h, r.dealt) for r in rows if r.kind != repeats._SETTLED)
    assert max(per_anchor.values()) > 60 and max(per_task.values()) <= 2


@pytest.mark.parametrize("batch,group", [(10_000, 8192), (7, 8192), (1, 8192), (7, 4)])
def test_footers_match_brute_force(spark, batch, group):
    """One batch, many small ones (units of one anchor dealt out in some and not in others), and one document a batch."""
    texts = footed(60, 5)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
        got = {r.doc_id: bytes(r.kept) for r in repeats.remove_repeats(docs, group=group).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    seen, want = set(), {}
    for i, t in enumerate(texts):
        raw, gone = t.encode(), set()
        for j in range(len(raw) - 99):
            if raw[j:j + 100] in seen:
                gone.update(range(j, j + 100))
            seen.add(raw[j:j + 100])
        want[i] = bytes(b for k, b in enumerate(raw) if k not in gone)
    assert got == want and any(len(w) < len(t) for w, t in zip(want.values(), texts))

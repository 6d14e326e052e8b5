"""Licence notices that are wrapped over lines or stand inside longer text."""

import random

from creditloom.llm import licences

T = licences.TEMPLATES
CODE = " ".join(f"let v{i} = call{i % 7} of step {i}" for i in range(16))


def wrapped(text, width, mark="# "):
    words = text.split()
    return "\n".join(mark + " ".join(words[i:i + width]) for i in range(0, len(words), width))


def brute_runs(words, template, threshold=0.8):
    """Every anchored run, compared; of overlapping ones the better stays."""
    b, n = set(licences.template_bigrams(template)), len(licences.normalised_words(template)) - 1
    grams = [f"{x} {y}" for x, y in zip(words, words[1:])]
    found = []
    for p, g in enumerate(grams):
        if g not in b:
            continue
        stop = max(i for i in range(p, min(p + n, len(grams))) if grams[i] in b) + 1
        run = set(grams[p:stop])
        d = round(2 * len(run & b) / (len(run) + len(b)), 9)
        if d < threshold:
            continue
        if found and found[-1][1] > p:
            if d > found[-1][2]:
                found[-1] = (p, stop, d)
        else:
            found.append((p, stop, d))
    return [(p, d) for p, _, d in found]


def test_wrapped_and_embedded_notices_are_found(spark):
    docs, want = [], {}
    for i, name in enumerate(["mit-text", "gpl-3.0-header", "mpl-2.0", "isc", "apache-2.0-header", "bsd"]):
        docs += [(10 * i, f"{CODE}\n{wrapped(T[name], 9)}\n{CODE}\n{CODE}"), (10 * i + 1, f"{CODE} {T[name]} {CODE} {CODE}")]
        want |= {10 * i: name, 10 * i + 1: name}
    docs += [(900, f"{CODE}\n{wrapped(T['isc'], 8, '// ')}\n{CODE}\n{T['mit']}\n{CODE}\n{wrapped(T['mpl-2.0'], 7, ' * ')}"), (901, CODE), (902, "This program is free software: " + CODE)]
    rows = {r.doc_id: r for r in licences.scan(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert {i: rows[i].licence for i in want} == want
    assert {i: (rows[i].unit, rows[i].dice) for i in want} == {i: (-2, 1.0) for i in want}
    assert all(sum(m.unit == -2 for m in rows[i].matches) == 1 for i in want)
    assert {m.licence for m in rows[900].matches} == {"isc", "mit", "mpl-2.0"} and rows[900].unit >= 0
    assert rows[901].licence is None and rows[902].licence is None


def test_runs_match_brute_force(spark):
    rng = random.Random(5)
    template = {"t": "a b c a d e f a b g h c d i"}
    texts = []
    for _ in range(300):
        words = [rng.choice("abcdefghixyz") for _ in range(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 4)):
            copy = template["t"].split()
            for _ in range(rng.randrange(0, 4)):
                k = rng.randrange(len(copy))
                copy[k:k + rng.randrange(0, 2)] = rng.choice([[], ["x"]])
            words += copy + [rng.choice("abcxyz") for _ in range(rng.randrange(0, 9))]
        texts.append(words)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id bigint, text string")
    for r in licences.scan(df, template).collect():
        words = texts[r.doc_id]
        whole = set(licences.template_bigrams(" ".join(words)))
        runs = [(m.word, m.dice) for m in r.matches if m.unit == -2]
        want = brute_runs(words, template["t"])
        if not any(m.unit == 0 for m in r.matches):
            assert runs == want, (words, whole)
        assert bool(r.matches) >= bool(want)


def test_whole_texts_and_headers_are_found(spark):
    whole = ["0bsd", "agpl-3.0-header", "apache-2.0-text", "bsd-2-clause", "bsd-3-clause", "bsl-1.0", "cc0-1.0-text", "gpl-2.0-header", "gpl-2.0-text", "gpl-3.0-header-whole",
             "gpl-3.0-text", "isc-whole", "lgpl-2.1-header", "lgpl-2.1-text", "lgpl-3.0-header", "lgpl-3.0-text", "mit-whole", "mpl-2.0-text", "unlicense", "zlib"]
    title = "The Licence\n\nCopyright (c) 2020 Some Person\nAll rights reserved.\n\n"
    docs = [(2 * i + k, text) for i, name in enumerate(whole) for k, text in enumerate((title + T[name], f"{CODE}\n{wrapped(T[name], 11)}\n{CODE}\n"))]
    rows = {r.doc_id: r.licence for r in licences.scan(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert rows == {2 * i + k: name for i, name in enumerate(whole) for k in (0, 1)}
    words = {n: " ".join(licences.normalised_words(T[n])) for n in ("mit-whole", "isc-whole")}
    assert "without warranty of any kind" in words["mit-whole"] and "disclaim all warranties" in words["isc-whole"]


def seconds(spark, text):
    import time

    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string").coalesce(1)
    scanned = licences.scan(frame)
    started = time.time()
    rows = scanned.collect()
    return rows[0], time.time() - started


def test_long_texts_take_linear_time(spark):
    seconds(spark, "warm up")
    rng = random.Random(1)
    pairs = "to the of the in the and the you may the work any person terms and conditions".split()
    row, took = seconds(spark, " ".join(rng.choice(pairs) for _ in range(70_000)))
    assert row.licence is None and took < 5
    row, took = seconds(spark, "\n".join([T["gpl-3.0-text"]] * 8))
    assert [m.licence for m in row.matches if m.unit == -2].count("gpl-3.0-text") == 8 and took < 5
    row, took = seconds(spark, "word\n" * 100_000 + T["mit"])
    assert row.licence == "mit" and row.unit == 100_000 and took < 5

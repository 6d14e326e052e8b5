import random

from creditloom.llm import quality, tokens

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def test_counts_equal_the_plain_encoder(monkeypatch):
    plain, one_piece = tokens.byte_pair_encoding(RANKS), tokens.byte_pair_encoding(RANKS, "(?s:.+)")
    rng = random.Random(3)
    monkeypatch.setattr(tokens, "_LONG_BLANKS", tokens.re.compile(f"[{tokens.BLANKS}]{{4,}}"))
    parts = [" ", "\n", "\t", " ", "　", " ", "\x85", "\x1c", "a", "Ab", "é漢", "12", "'s", "!?", "  ", "\r\n", "     "]
    for _ in range(3000):
        text = "".join(rng.choice(parts) * rng.choice([1, 1, 2, 7]) for _ in range(rng.randrange(0, 14)))
        assert tokens.count_tokens(text, plain, one_piece) == len(plain.encode_ordinary(text)), repr(text)


def test_a_million_of_anything_is_counted(spark):
    texts = {"blank": " ", "line": "\n", "letter": "a", "digit": "1", "mark": "!", "wide": "　"}
    rows = [(i, "x " + c * 10**6 + " y", "en", "s") for i, c in enumerate(texts.values())] + [(99, " " * 10**6, "en", "s")]
    found = {r.doc_id: r.n_bpe for r in tokens.bpe_tokens(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string"), RANKS).collect()}
    assert all(n > 10_000 for n in found.values()) and found[99] == 10**6 and len(found) == 7


def test_one_id_with_many_rows_does_not_widen_the_sample(spark):
    docs = spark.range(50_000).selectExpr("7L as doc_id", "concat('text ', id) as text").union(spark.range(100, 140).selectExpr("id as doc_id", "'other words' as text"))
    ids = spark.createDataFrame([(7, 1), (7, 0), (100, 0)], "doc_id bigint, kind int")
    assert len(quality.sampled_features(docs, ids, 10)) == 3

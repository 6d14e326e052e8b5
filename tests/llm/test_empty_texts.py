"""Token totals cover documents without words."""

from creditloom.llm import tokens
from creditloom.llm.queries import BPE_RANKS, QUERIES


def test_totals_count_documents_without_words(spark, tmp_path):
    docs = [(1, "two words", "a", "en"), (2, None, "a", "en"), (3, "", "a", "en"), (4, " \n\t ", "a", "en"), (5, None, "b", "de"), (6, "  \n", "b", "de")]
    spark.createDataFrame(docs, "doc_id bigint, text string, source string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    encoding = tokens.byte_pair_encoding(BPE_RANKS)
    pairs = {s: sum(len(encoding.encode_ordinary(d[1] or "")) for d in docs if d[2] == s) for s in "ab"}
    got = {(r.source, r.version): (r.n_docs, r.n_tokens) for r in QUERIES["op5_token_counts"](spark, str(tmp_path)).collect()}
    assert got == {("a", "words-1"): (4, 2), ("b", "words-1"): (2, 0), ("a", "byte-bpe-50k"): (4, pairs["a"]), ("b", "byte-bpe-50k"): (2, pairs["b"])}

"""Windows that do not fit into a document are no candidates."""

from creditloom.llm import decontamination


def test_windows_stay_inside_the_document(spark):
    occurs = spark.createDataFrame([(1, at, 20, 5) for at in (0, 1, 2, 8, 9, 19)], "id int, at int, n_words int, shingle bigint")
    prefixes = spark.createDataFrame([(7, 13, 5, 2)], "window bigint, length int, shingle bigint, offset int")
    assert sorted(r.start for r in decontamination.places(occurs, prefixes).collect()) == [0, 6, 7]

"""Both paths of the quote search on repeated and null keys."""

from textloom.operators import quotes as Q


def test_paths_agree_on_repeated_and_null_keys(spark):
    quotes = spark.createDataFrame([(1, "quick brown"), (1, "lazy"), (None, "brown fox"), (2, "nowhere at all")], "item_id long, text string")
    texts = spark.createDataFrame([(7, "the quick brown fox"), (7, "a quick brown fox, lazy"), (None, "quick brown"), (None, "lazy fox"), (8, None)], "doc_id long, text string")
    few, many = (sorted(map(str, Q.occurrences(quotes, texts, "item_id", "doc_id", most=most).collect())) for most in (1 << 20, 0))
    assert few == many and len(few) == 7

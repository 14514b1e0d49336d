"""The lexicon of the quality rules where frequent word beginnings are many."""

from textloom.llm import quality_rules


def test_rare_stems_count_beside_many_frequent_ones(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    shared = " ".join(f"{a}{b}{c}{d}" for a in letters for b in letters for c in "abc" for d in "xyz")
    rows = [(i, shared + (" qqqqbad" if i % 2 else ""), 1) for i in range(40)] + [(100 + i, shared, 0) for i in range(40)]
    lexicon = quality_rules.learn_lexicon(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert any(b"qqqqbad".startswith(s) for s in lexicon)

"""Per-document features.

What needs one document only is a projection and keeps the scan's partitions; what needs the
order of sentences (prefix sums, runs, top lists) is one shuffle on the document's id, which the
windows and groupings above share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..profiles import JAPANESE, Profile

SEGMENTS = 10
#: Numbers of a document that statistics() computes as one struct.
STATS = (
    "characters", "paragraphs", "sentences", "sentence_length_mean", "sentence_length_median", "sentence_length_stdev", "sentence_length_max",
    "dialogue_ratio", "quoted_narration_ratio", "quote_span_mean", "dialogue_paragraph_ratio", "orthography", "kanji_ratio", "hiragana_ratio",
    "katakana_ratio", "comma_per_sentence", "dash_per_1000", "ellipsis_per_1000", "exclaim_per_1000", "question_per_1000", "simile_count",
    "simile_per_1000",
)


def parsed(docs: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (),
           headings: bool = True) -> DataFrame:
    """(key, carry, all: all paragraphs, kept: those that are no headings, body: kept, joined, sents)."""
    out = docs.select(key, *carry, X.paragraphs(F.col(text)).alias("all"))
    kept = F.filter("all", lambda p: ~X.is_heading(p, profile)) if headings else F.col("all")
    out = out.withColumn("kept", kept)
    return out.withColumn("body", F.array_join("kept", "\n")).withColumn("sents", X.sentences(F.col("kept"), profile))


def statistics(parsed_: DataFrame, profile: Profile = JAPANESE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep's columns and STATS, unrounded."""
    n, body = F.size("sents"), F.col("body")
    base = parsed_.withColumn("_len", F.transform("sents", lambda s: F.length(s))).withColumn("_q", X.quote_lengths(body, profile))
    short = X.total(F.filter("_q", lambda q: q <= profile.dialogue_limit))
    long_ = X.total(F.filter("_q", lambda q: q > profile.dialogue_limit))
    similes = F.size(F.filter("sents", lambda s: X.is_simile(s, profile)))
    chars = F.length(body)
    return base.select(
        *keep, chars.cast("long").alias("characters"), F.size("kept").cast("long").alias("paragraphs"), n.cast("long").alias("sentences"),
        X.mean(F.col("_len")).alias("sentence_length_mean"), X.median(F.col("_len")).alias("sentence_length_median"),
        X.deviation(F.col("_len")).alias("sentence_length_stdev"), F.coalesce(F.array_max("_len"), F.lit(0)).cast("long").alias("sentence_length_max"),
        X.per(short, chars).alias("dialogue_ratio"), X.per(long_, chars).alias("quoted_narration_ratio"), X.mean(F.col("_q")).alias("quote_span_mean"),
        X.per(F.size(F.filter("kept", lambda p: X.is_dialogue(p, profile))), F.size("kept")).alias("dialogue_paragraph_ratio"),
        X.orthography(body, profile).alias("orthography"),
        *[X.class_ratio(body, letters).alias(f"{name}_ratio") for name, letters in profile.classes.items()],
        X.per(X.count_of(body, profile.comma), n).alias("comma_per_sentence"),
        X.per(X.count_of(body, profile.dash), chars, 1000).alias("dash_per_1000"),
        X.per(X.count_of(body, profile.ellipsis), chars, 1000).alias("ellipsis_per_1000"),
        X.per(X.count_of(body, *profile.exclaim), chars, 1000).alias("exclaim_per_1000"),
        X.per(X.count_of(body, *profile.question), chars, 1000).alias("question_per_1000"),
        similes.cast("long").alias("simile_count"), X.per(similes, chars, 1000).alias("simile_per_1000"))


def headings(parsed_: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id") -> DataFrame:
    """(key, index, label, characters): each heading and the length of its paragraphs up to the next."""
    rows = parsed_.select(key, F.posexplode("all").alias("index", "p")).withColumn("h", X.is_heading(F.col("p"), profile))
    order = Window.partitionBy(key).orderBy("index")
    rows = rows.withColumn("of", F.last(F.when(F.col("h"), F.col("index")), ignorenulls=True).over(order)).filter(F.col("of").isNotNull())
    return rows.groupBy(key, "of").agg(
        F.max(F.when(F.col("h"), X.strip(F.col("p")))).alias("label"),
        F.coalesce(F.sum(F.when(~F.col("h"), F.length("p"))), F.lit(0)).cast("long").alias("characters")).select(
        key, F.col("of").alias("index"), "label", "characters")


def chapter_sizes(headings_: DataFrame, key: str = "doc_id", least: int = 3) -> DataFrame:
    """(key, chapters, shortest, longest, spark) of documents with `least` headings or more: the sizes of what follows each."""
    sizes = F.transform(F.sort_array(F.collect_list(F.struct("index", "characters"))), lambda x: x["characters"].cast("double"))
    held = headings_.groupBy(key).agg(F.count("*").alias("chapters"), F.min("characters").alias("shortest"), F.max("characters").alias("longest"), sizes.alias("_sizes"))
    return held.filter(F.col("chapters") >= least).select(key, "chapters", "shortest", "longest", X.sparkline(F.col("_sizes")).alias("spark"))


def sentence_rows(parsed_: DataFrame, key: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carry, ix, s, len, acc: characters before, total: characters of all sentences)."""
    return with_sums(parsed_.select(key, *carry, F.posexplode("sents").alias("ix", "s")), key)


def with_sums(rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """rows (key, ix, s) with len, acc and total."""
    rows = rows.withColumn("len", F.length("s").cast("long"))
    whole = Window.partitionBy(key)
    before = whole.orderBy("ix").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("acc", F.coalesce(F.sum("len").over(before), F.lit(0))).withColumn("total", F.sum("len").over(whole))


def tension_curve(rows: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", keep: str | None = None) -> DataFrame:
    """(key, segment 1..10, sentences, sentence_length_mean, dialogue_ratio, exclaim_question_per_1000,
    dash_ellipsis_per_1000): ten stretches of equal length; documents without sentences are absent.
    keep: a column that one row of each document has, others null; all ten get it."""
    kept = [keep] if keep else []
    seg = F.least(F.floor(F.col("acc") / (F.col("total") / SEGMENTS)), F.lit(SEGMENTS - 1)).cast("int") + 1
    cut = rows.withColumn("segment", seg).groupBy(key, "segment").agg(
        F.count("*").alias("sentences"), F.sum("len").alias("chars"), F.sort_array(F.collect_list(F.struct("ix", "s"))).alias("ss"),
        *[F.first(c, ignorenulls=True).alias(c) for c in kept])
    joined = F.array_join(F.transform("ss", lambda x: x["s"]), "")
    cut = cut.withColumn("t", joined)
    cut = cut.select(key, *kept, "segment", "sentences", (F.col("chars") / F.col("sentences")).alias("sentence_length_mean"),
                     X.per(X.total(F.filter(X.quote_lengths(F.col("t"), profile), lambda q: q <= profile.dialogue_limit)), F.col("chars")).alias("dialogue_ratio"),
                     X.per(X.count_of(F.col("t"), *profile.exclaim, *profile.question), F.col("chars"), 1000).alias("exclaim_question_per_1000"),
                     X.per(X.count_of(F.col("t"), profile.dash, profile.ellipsis), F.col("chars"), 1000).alias("dash_ellipsis_per_1000"))
    # stretches that no sentence begins in: one row a document carries its segments, and opens to ten
    measures = ("sentences", "sentence_length_mean", "dialogue_ratio", "exclaim_question_per_1000", "dash_ellipsis_per_1000")
    held = cut.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("segment", F.struct(*measures)))).alias("m"), *[F.first(c, ignorenulls=True).alias(c) for c in kept])
    full = held.select(key, *kept, "m", F.explode(F.sequence(F.lit(1), F.lit(SEGMENTS))).alias("segment")).withColumn("v", F.try_element_at("m", "segment"))
    return full.select(key, *kept, "segment", F.coalesce("v.sentences", F.lit(0)).cast("long").alias("sentences"), *[F.coalesce(f"v.{m}", F.lit(0.0)).alias(m) for m in measures[1:]])


def peaks(curve: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, exclaim_peak_segment, dialogue_peak_segment): first greatest segment, null where all are 0."""
    return curve.groupBy(key).agg(*peak_columns())


def peak_columns() -> list[Column]:
    """Aggregates over a document's curve."""
    peak = lambda m: F.when(F.max(m) > 0, F.max_by("segment", F.struct(m, -F.col("segment"))))
    return [peak("exclaim_question_per_1000").alias("exclaim_peak_segment"), peak("dialogue_ratio").alias("dialogue_peak_segment")]


def similes(rows: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", limit: int | None = 60, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carry, rank, ix, markers, position, text): sentences with a simile marker and 10 to 160
    characters, those nearest to 55 first; all of them without a limit."""
    out = rows.filter(X.is_simile(F.col("s"), profile)).select(
        key, *carry, "ix", X.markers(F.col("s"), profile).alias("markers"), (F.col("acc") / F.col("total")).alias("position"), F.col("s").alias("text"), F.abs(F.col("len") - 55).alias("_d"))
    out = out.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy("_d", "ix")))
    if limit is not None:
        out = out.filter(F.col("rank") <= limit)
    return out.drop("_d")


def top_words(words: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """(key, rank, word, count) of (key, pos, word): most frequent first, then first seen."""
    counts = words.groupBy(key, "word").agg(F.count("*").alias("count"), F.min("pos").alias("first"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("count"), "first"))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= limit).select(key, "rank", "word", "count")


def reduplications(parsed_: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", limit: int = 40) -> DataFrame:
    return top_words(parsed_.select(key, F.posexplode(X.reduplications(F.col("body"), profile)).alias("pos", "word")), limit, key)


def vocabulary(parsed_: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", limit: int = 40, least: int = 3) -> DataFrame:
    words = parsed_.select(key, F.posexplode(F.regexp_extract_all("body", F.lit(profile.words), F.lit(0))).alias("pos", "word"))
    return top_words(words, limit, key).filter(F.col("count") >= least)


def openings_closings(parsed_: DataFrame, profile: Profile = JAPANESE, keep: tuple[str, ...] = ("doc_id",), count: int = 3) -> DataFrame:
    """keep's columns, opening and closing: the first and last sentences, without notes at the end."""
    last = F.coalesce(F.array_max(F.filter(F.transform("sents", lambda s, i: F.when(~s.rlike(profile.trailing_note), i + 1)), lambda i: i.isNotNull())), F.lit(0))
    body = parsed_.withColumn("_b", F.slice("sents", F.lit(1), last))
    n = F.size("_b")
    return body.select(*keep, F.slice("_b", F.lit(1), F.lit(count)).alias("opening"), F.slice("_b", F.greatest(n - count + 1, F.lit(1)), F.lit(count)).alias("closing"))


def repetitions(rows: DataFrame, key: str = "doc_id", limit: int = 15) -> DataFrame:
    """(key, rank, head, count, sample): runs of three sentences or more that begin with the same
    four characters; sample leaves the run's first sentence out."""
    order = Window.partitionBy(key).orderBy("ix")
    cut = rows.select(key, "ix", "s", F.left("s", F.lit(4)).alias("head"))
    same = F.coalesce((F.lag("head").over(order) == F.col("head")) & (F.length("head") >= 3), F.lit(False))
    cut = cut.withColumn("run", F.sum(F.when(same, 0).otherwise(1)).over(order))
    runs = cut.groupBy(key, "run").agg(F.first("head").alias("head"), F.count("*").alias("count"), F.min("ix").alias("start"),
                                       F.sort_array(F.collect_list(F.struct("ix", "s"))).alias("ss")).filter("count >= 3")
    runs = runs.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("count"), "start"))).filter(F.col("rank") <= limit)
    return runs.select(key, "rank", "head", "count", F.transform(F.slice("ss", 2, 3), lambda x: x["s"]).alias("sample"))

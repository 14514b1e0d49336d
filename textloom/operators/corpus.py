"""Corpus distributions: measures of eligible documents, quantiles and shares by group, samples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..profiles import JAPANESE, PROFILE_METRICS, QUANTILES, SAMPLE_FILTER, Profile
from . import documents as D

DISTRIBUTED = ("sentence_length_mean", "sentence_length_max", "sentence_length_cv", "comma_per_sentence", "first_sentence_length", "last_sentence_length",
               "paragraph_length_mean", "dialogue_ratio", "exclaim_question_per_1000", "dash_per_1000", "ellipsis_per_1000", "kanji_ratio",
               "simile_per_1000", "reduplication_per_1000")
LEAST_GROUP = 30


def measure(docs: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", carry: tuple[str, ...] = (), limits: dict = SAMPLE_FILTER) -> DataFrame:
    """The measures of the documents that may be in a sample, one row each.

    Cheap conditions come before dear ones: length, spelling, number of sentences, their mean.
    """
    own = D.parsed(docs, profile, key=key, carry=carry)
    own = own.filter(F.length("body").between(limits["min_chars"], limits["max_chars"])).filter(
        X.orthography(F.col("body"), profile) == profile.orthography["new"])
    last = F.coalesce(F.array_max(F.filter(F.transform("sents", lambda s, i: F.when(~s.rlike(profile.trailing_note), i + 1)), lambda i: i.isNotNull())), F.lit(0))
    own = own.withColumn("sents", F.slice("sents", F.lit(1), last)).filter(F.size("sents") >= limits["min_sentences"])
    own = own.withColumn("lens", F.transform("sents", lambda s: F.length(s))).filter(X.mean(F.col("lens")) <= limits["max_mean_length"])
    stats = D.statistics(own, profile, keep=(key, *carry, "kept", "lens", "body", "sents"))
    prose = F.transform(F.filter("kept", lambda p: ~X.is_dialogue(p, profile)), lambda p: F.length(p))
    n = F.size("lens")
    at = lambda i: F.get("lens", i)
    rank = lambda v: F.size(F.filter("lens", lambda x: x < v)) / n
    measures = F.struct(
        "sentence_length_mean", "sentence_length_max", (F.col("sentence_length_stdev") / F.col("sentence_length_mean")).alias("sentence_length_cv"),
        "comma_per_sentence", at(F.lit(0)).cast("long").alias("first_sentence_length"), rank(at(F.lit(0))).alias("first_sentence_percentile"),
        at(n - 1).cast("long").alias("last_sentence_length"), rank(at(n - 1)).alias("last_sentence_percentile"), X.mean(prose).alias("paragraph_length_mean"),
        "dialogue_ratio", (F.col("exclaim_per_1000") + F.col("question_per_1000")).alias("exclaim_question_per_1000"), "dash_per_1000", "ellipsis_per_1000",
        "kanji_ratio", "simile_per_1000",
        X.per(X.top_total(X.reduplications(F.col("body"), profile), 40) if profile.kana else F.lit(0), F.length("body"), 1000).alias("reduplication_per_1000"))
    # the first sentence carries the measures, so the text is parsed once
    rows = stats.select(key, *carry, measures.alias("own"), "sents").select(key, F.struct(*carry, "own").alias("told"), "sents")
    opened = F.transform("sents", lambda s, i: F.struct(s.alias("s"), F.when(i == 0, F.col("told")).alias("told")))
    rows = D.with_sums(rows.select(key, F.posexplode(opened).alias("ix", "x")).select(key, "ix", "x.s", "x.told"), key)
    curve = D.tension_curve(rows, profile, key, keep="told")
    half = lambda test: F.avg(F.when(test, F.col("dialogue_ratio")))
    ends = curve.groupBy(key).agg(F.first("told").alias("told"), *D.peak_columns(), (half(F.col("segment") > 5) > half(F.col("segment") <= 5)).alias("dialogue_later_half"))
    return ends.select(key, *[f"told.{c}" for c in carry], "told.own.*", "exclaim_peak_segment", "dialogue_peak_segment", "dialogue_later_half")


#: Buckets that a doubling of a value is cut into.
FINE = 4096


def _bucket(v: Column) -> Column:
    """A whole number that never falls as v grows; what is no number comes last, with infinity."""
    size = lambda x: F.when(x < float("inf"), F.floor(F.log2(x) * FINE) + (1 << 30)).otherwise(F.lit(1 << 31))
    return F.when(v > 0, size(v)).when(v < 0, -size(-v)).otherwise(F.lit(0).cast("long"))


def order_statistics(rows: DataFrame, metrics: tuple[str, ...], ranks: dict[str, Callable[[Column], Column]], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, metric, n, and a column for each of ranks): the values of given places, from 0, in order.

    ranks: places by name, of the number n of values. Equal values are counted together; then buckets of
    values are counted, of which there are a few thousand to a metric, and only the buckets that hold a
    place are put in order. So no window sees all values of a metric.
    """
    long_ = rows.select(*by, F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])).alias("x"))
    keys = [*by, "metric"]
    counts = long_.select(*by, "x.metric", "x.v").filter("v is not null").groupBy(*keys, "v").agg(F.count("*").alias("c")).withColumn("bucket", _bucket(F.col("v")))
    group = Window.partitionBy(*keys)
    before = lambda w: F.coalesce(F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = counts.groupBy(*keys, "bucket").agg(F.sum("c").alias("c")).withColumn("start", before(group.orderBy("bucket"))).withColumn("n", F.sum("c").over(group))
    places = F.array(*[F.struct(F.lit(name).alias("name"), of(F.col("n")).cast("long").alias("at")) for name, of in ranks.items()])
    held = sums.withColumn("places", F.filter(places, lambda p: (p["at"] >= F.col("start")) & (p["at"] < F.col("start") + F.col("c")))).filter("size(places) > 0")
    held = held.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("bucket").alias("_bucket"), "start", "n", "places")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    own = counts.join(held, [*same, F.col("bucket") == F.col("_bucket")])
    own = own.withColumn("lo", F.col("start") + before(Window.partitionBy(*keys, "bucket").orderBy("v")))
    at = lambda name: F.get(F.filter("places", lambda p: p["name"] == name), F.lit(0))["at"]
    found = lambda name: F.min(F.when((at(name) >= F.col("lo")) & (at(name) < F.col("lo") + F.col("c")), F.col("v"))).alias(name)
    return own.groupBy(*keys).agg(F.first("n").alias("n"), *[found(name) for name in ranks])


def quantiles(rows: DataFrame, metrics: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """(by, metric, p10 .. p90): the value of index floor(p (n - 1)) in order."""
    ranks = {name: (lambda n, p=p: F.floor(F.lit(p) * (n - 1))) for name, p in QUANTILES}
    return order_statistics(rows, metrics, ranks, by).drop("n")


def medians(rows: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """One row with the median of each metric: the mean of the middle two where there are two; null without values."""
    middle = order_statistics(rows, metrics, {"low": lambda n: F.floor((n - 1) / 2), "high": lambda n: F.floor(n / 2)})
    of = middle.select("metric", ((F.col("low") + F.col("high")) / 2).alias("v"))
    return of.agg(*[F.max(F.when(F.col("metric") == m, F.col("v"))).alias(m) for m in metrics])


def shares(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, n, and the shares and means of a distribution), one row for each group."""
    n = F.count("*")
    share = lambda test: F.sum(F.when(test, 1).otherwise(0)) / n
    spoken, dash, dots = F.col("dialogue_ratio") >= 0.05, F.col("dash_per_1000") >= 1, F.col("ellipsis_per_1000") >= 1
    return rows.groupBy(*by).agg(
        n.alias("n"), F.avg("first_sentence_percentile").alias("first_sentence_percentile_mean"), F.avg("last_sentence_percentile").alias("last_sentence_percentile_mean"),
        F.avg(F.when(spoken, F.col("dialogue_later_half").cast("int"))).alias("dialogue_later_half_share_when_present"),
        share(F.col("exclaim_question_per_1000") == 0).alias("exclaim_question_zero_share"), share(F.col("dash_per_1000") == 0).alias("dash_zero_share"),
        share(F.col("ellipsis_per_1000") == 0).alias("ellipsis_zero_share"), share(dash & dots).alias("dash_and_ellipsis_heavy_share"),
        (share(dash) * share(dots)).alias("dash_and_ellipsis_heavy_expected_if_independent"))


def peak_shares(rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, segment 1..10, share) of the documents with an exclamation peak."""
    held = rows.filter("exclaim_peak_segment is not null").groupBy(*by, "exclaim_peak_segment").agg(F.count("*").alias("c"))
    whole = held.groupBy(*by).agg(F.sum("c").alias("n"), F.map_from_entries(F.collect_list(F.struct("exclaim_peak_segment", "c"))).alias("m"))
    return whole.select(*by, "n", "m", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("segment")).select(
        *by, "segment", (F.coalesce(F.try_element_at("m", "segment"), F.lit(0)) / F.col("n")).alias("share"))


def marker_shares(similes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, marker, count, share) over all similes."""
    counts = similes.select(*by, F.explode("markers").alias("marker")).groupBy(*by, "marker").agg(F.count("*").alias("count"))
    return counts.withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy(*by)))


def by_group(rows: DataFrame, by: str, least: int = LEAST_GROUP, metrics: tuple[str, ...] = DISTRIBUTED) -> DataFrame:
    """Quantiles of groups of `least` documents or more."""
    large = rows.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return quantiles(rows, metrics, (by,)).join(large, by)


def sample(rows: DataFrame, accepted: Column, n: int, seed: int = 42, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The first n accepted rows in a seeded order, and one row with how many rows were scanned for them.

    The order is that of a hash of the seed and the key. The hash that the n-th accepted row has is
    found first, so only n rows are sorted together.
    """
    hashed = rows.withColumn("_h", F.xxhash64(F.lit(seed), F.col(key)))
    chosen = hashed.filter(accepted).orderBy("_h", key).limit(n)
    bound = chosen.agg(F.max("_h").alias("most"), F.count("*").alias("got"))
    scanned = hashed.join(F.broadcast(bound), (F.col("got") < n) | (F.col("_h") <= F.col("most"))).agg(F.count("*").alias("scanned"))
    return chosen.drop("_h"), scanned


def corpus_means(stats: DataFrame, metrics: tuple[str, ...] = PROFILE_METRICS) -> DataFrame:
    return stats.agg(*[F.avg(m).alias(m) for m in metrics])


def author_profile(stats: DataFrame, author: str, metrics: tuple[str, ...] = PROFILE_METRICS) -> DataFrame:
    """(author, metric, value, whole, diff, arrow): an author's means against the corpus's."""
    pack = lambda: F.array(*[F.struct(F.lit(m).alias("metric"), F.avg(m).alias("v")) for m in metrics])
    own = stats.groupBy(author).agg(pack().alias("x")).select(author, F.explode("x").alias("x")).select(author, "x.metric", F.col("x.v").alias("value"))
    whole = stats.agg(pack().alias("x")).select(F.explode("x").alias("x")).select("x.metric", F.col("x.v").alias("whole"))
    both = own.join(F.broadcast(whole), "metric")  # as many rows as metrics
    return both.select(author, "metric", "value", "whole", (F.col("value") - F.col("whole")).alias("diff"), X.arrow(F.col("value"), F.col("whole")).alias("arrow"))


def author_index(stats: DataFrame, author: str) -> DataFrame:
    """(author, works, characters, sentence_length_mean, dialogue_ratio)."""
    return stats.groupBy(author).agg(F.count("*").alias("works"), F.sum("characters").alias("characters"), F.avg("sentence_length_mean").alias("sentence_length_mean"),
                                     F.avg("dialogue_ratio").alias("dialogue_ratio"))


def author_summary(stats: DataFrame, author: str) -> DataFrame:
    """(author, works, spread and means): the spread is the ratio of mean deviation and mean length."""
    return stats.groupBy(author).agg(F.count("*").alias("works"), (F.avg("sentence_length_stdev") / F.avg("sentence_length_mean")).alias("spread"),
                                     *[F.avg(m).alias(m) for m in PROFILE_METRICS if m != "sentence_length_stdev"])


def word_catalog(words: DataFrame, author: str, limit: int = 150) -> DataFrame:
    """(word, total, authors): most frequent words and who uses them, names in order."""
    return words.groupBy("word").agg(F.sum("count").alias("total"), F.array_join(F.array_sort(F.collect_set(author)), "、").alias("authors")).orderBy(
        F.desc("total"), "word").limit(limit)


def author_words(words: DataFrame, author: str, limit: int = 30) -> DataFrame:
    """(author, rank, word, total): each author's most frequent words."""
    sums = words.groupBy(author, "word").agg(F.sum("count").alias("total"))
    return sums.withColumn("rank", F.row_number().over(Window.partitionBy(author).orderBy(F.desc("total"), "word"))).filter(F.col("rank") <= limit)


def simile_catalog(similes: DataFrame, size: int = 25, seed: int = 1, key: str = "doc_id") -> DataFrame:
    """(marker, size, rank, key, ix, text): a seeded choice of each marker's similes, with how many there are."""
    rows = similes.select(key, "ix", "text", F.explode("markers").alias("marker"))
    sizes = rows.groupBy("marker").agg(F.count("*").alias("size"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("marker").orderBy(F.xxhash64(F.lit(seed), F.col(key), F.col("ix")), key, "ix")))
    return ranked.filter(F.col("rank") <= size).join(sizes, "marker")


def rounded(rows: DataFrame, digits: int = 3) -> DataFrame:
    """rows as they are stored: fractions rounded, ties to the even digit, and without columns of maps."""
    kinds = {f.name: f.dataType.typeName() for f in rows.schema}
    own = [F.bround(c, digits).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in rows.columns if kinds[c] != "map"]
    return rows.select(*own)

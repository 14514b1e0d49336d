"""Registered queries over the driver's tables. Texts there are in Latin letters, so the Latin profile
is used; documents stand for works, sources for authors, languages for eras, conversations for novels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chapters as C
from ..operators import checks as K
from ..operators import corpus as S
from ..operators import documents as D
from ..operators import quotes as Q
from ..profiles import LATIN
from ..sources import readers as R

#: Documents of the test tables are shorter than books.
LIMITS = {"min_chars": 300, "max_chars": 300_000, "min_sentences": 5, "max_mean_length": 400}
LENGTH = 1500


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def _parsed(spark, d, carry=()):
    return D.parsed(_docs(spark, d), LATIN, carry=carry)


def doc_basic_stats(spark, d):
    return D.statistics(_parsed(spark, d), LATIN)


def doc_headings(spark, d):
    return D.headings(_parsed(spark, d), LATIN)


def doc_sentences(spark, d):
    return D.sentence_rows(_parsed(spark, d)).withColumn("position", F.col("acc") / F.col("total"))


def doc_tension_curve(spark, d):
    return D.tension_curve(D.sentence_rows(_parsed(spark, d)), LATIN)


def doc_peaks(spark, d):
    return D.peaks(doc_tension_curve(spark, d))


def doc_sparklines(spark, d):
    curve = doc_tension_curve(spark, d).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("segment", "sentences"))).alias("c"))
    return curve.select("doc_id", X.sparkline(F.transform("c", lambda x: x["sentences"].cast("double"))).alias("spark"))


def doc_similes(spark, d):
    out = D.similes(D.sentence_rows(_parsed(spark, d)), LATIN)
    return out.withColumn("markers", F.array_join("markers", "/"))


def doc_vocabulary(spark, d):
    return D.vocabulary(_parsed(spark, d), LATIN)


def doc_openings_closings(spark, d):
    return D.openings_closings(_parsed(spark, d), LATIN).select("doc_id", F.array_join("opening", "|").alias("opening"), F.array_join("closing", "|").alias("closing"))


def doc_repetitions(spark, d):
    return D.repetitions(D.sentence_rows(_parsed(spark, d))).withColumn("sample", F.array_join("sample", "|"))


def _measures(spark, d, carry=("lang", "source")):
    return S.measure(_docs(spark, d), LATIN, carry=carry, limits=LIMITS)


def corpus_measures(spark, d):
    return _measures(spark, d)


def corpus_quantiles(spark, d):
    return S.quantiles(_measures(spark, d), S.DISTRIBUTED)


def corpus_quantiles_by_era(spark, d):
    return S.by_group(_measures(spark, d), "lang")


def corpus_quantiles_by_author(spark, d):
    return S.by_group(_measures(spark, d), "source", least=3)


def corpus_shares(spark, d):
    return S.shares(_measures(spark, d), ("lang",))


def corpus_peak_shares(spark, d):
    return S.peak_shares(_measures(spark, d))


def corpus_marker_shares(spark, d):
    return S.marker_shares(D.similes(D.sentence_rows(_parsed(spark, d)), LATIN, limit=None))


def corpus_sample(spark, d):
    rows = D.statistics(_parsed(spark, d), LATIN)
    chosen, scanned = S.sample(rows, F.col("sentences") >= 5, n=100)
    return chosen.select("doc_id", "characters").join(F.broadcast(scanned))


def _stats(spark, d):
    return D.statistics(_parsed(spark, d, ("source",)), LATIN, keep=("doc_id", "source"))


def author_profiles(spark, d):
    return S.author_profile(_stats(spark, d), "source")


def author_index(spark, d):
    return S.author_index(_stats(spark, d), "source")


def author_summaries(spark, d):
    return S.author_summary(_stats(spark, d), "source")


def _words(spark, d):
    docs = _docs(spark, d).select("doc_id", "source")
    return D.vocabulary(_parsed(spark, d), LATIN).join(docs, "doc_id")


def word_catalog(spark, d):
    return S.word_catalog(_words(spark, d), "source")


def author_words(spark, d):
    return S.author_words(_words(spark, d), "source")


def simile_catalog(spark, d):
    return S.simile_catalog(D.similes(D.sentence_rows(_parsed(spark, d)), LATIN))


def story_metrics(spark, d):
    return K.story_metrics(_docs(spark, d), LATIN)


def style_targets(spark, d):
    return K.targets(_stats(spark, d), LENGTH)


def band_violations(spark, d):
    metrics = K.story_metrics(_docs(spark, d), LATIN, carry=("lang",))
    return K.advice(K.violations(metrics, K.targets(_stats(spark, d), LENGTH))).drop("label", "unit")


def simile_balance(spark, d):
    return K.simile_balance(D.sentence_rows(_parsed(spark, d)), LATIN)


def violated_metrics(spark, d):
    return K.violated(band_violations(spark, d)).withColumn("metrics", F.array_join("metrics", ","))


def section_plans(spark, d):
    return K.section_plan(_docs(spark, d).select(F.col("n_chars").alias("length")).distinct())


def quote_occurrences(spark, d):
    return Q.occurrences(spark.read.parquet(f"{d}/benchmark.parquet"), _docs(spark, d), "item_id", "doc_id")


def quote_paragraphs(spark, d):
    """The third paragraph of each document as a quote from it."""
    docs = _docs(spark, d)
    quotes = docs.select("doc_id", F.get(X.paragraphs(F.col("text")), F.lit(2)).alias("quote"))
    return Q.located(quotes, docs, "doc_id", body="text").select("doc_id", "position", "paragraph", "verified")


def _chapters(spark, d):
    talk = spark.read.parquet(f"{d}/conversations.parquet")
    return talk.select("conv_id", F.col("turn").alias("chapter"), F.col("role").alias("label"), F.col("role").alias("part"), F.lit(1).alias("sections"),
                       F.lit("中").alias("level"), "text")


def chapter_measures(spark, d):
    return C.measured(_chapters(spark, d), LATIN, key="conv_id")


def novel_summaries(spark, d):
    return C.novels(chapter_measures(spark, d), key="conv_id", least_chars=500)


def document_chapters(spark, d):
    """Chapters of the documents, by short lines as headings."""
    return C.chapters(C.units(_docs(spark, d), LATIN, whole=False)).select("doc_id", "chapter", "label", "sections", F.length("text").alias("characters"))


def event_gap_clusters(spark, d):
    events = spark.read.parquet(f"{d}/events.parquet").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    first = events.groupBy("user_id", "at").agg(F.min("event_id").alias("event_id"))
    return Q.gap_clusters(first, ["user_id"], "at", 3_600_000_000 * 6)


def turn_clusters(spark, d):
    """Sentences with a marker as candidates, in per cent of the text."""
    rows = D.similes(D.sentence_rows(_parsed(spark, d)), LATIN, limit=None).select("doc_id", (F.col("position") * 100).alias("position"))
    return Q.adopted_turns(rows, ["doc_id"]).select("doc_id", "turn", F.size("earlier").alias("earlier"))


def finding_consensus(spark, d):
    labels = spark.read.parquet(f"{d}/labels.parquet").join(_docs(spark, d).select("doc_id", "source", "lang"), "doc_id")
    return Q.consensus(labels.select(F.col("lang").alias("story"), F.col("source").alias("judge"), F.col("quality").alias("item"), F.col("toxic").alias("paragraph"),
                                     F.concat_ws("-", "source", "doc_id").alias("text")), "story", "judge").drop("text")


def _pairs(spark, d):
    docs = _docs(spark, d).filter(F.length("text") > 40)
    one = docs.select("doc_id", "source", "text")
    first = one.groupBy("source").agg(F.min("doc_id").alias("doc_id"))
    ends = one.groupBy("source").agg(F.max("doc_id").alias("doc_id"))
    return docs, first.join(ends.withColumnRenamed("doc_id", "other"), "source").filter("doc_id <> other")


def pair_checks(spark, d):
    """Each source's first document against its last; the answer quotes both, and once only one."""
    docs, pairs = _pairs(spark, d)
    text = docs.select("doc_id", F.left("text", F.lit(30)).alias("q"))
    a, b = text.toDF("doc_id", "qa"), text.toDF("other", "qb")
    made = pairs.join(a, "doc_id").join(b, "other").select(
        F.col("source").alias("pair"), F.col("doc_id").cast("string").alias("A"), F.col("other").cast("string").alias("B"), F.struct(
            F.lit("A").alias("winner"), F.array(F.struct(F.col("qa").alias("quote_a"), F.col("qb").alias("quote_b")),
                                               F.struct(F.col("qa").alias("quote_a"), F.lit("#no such words#").alias("quote_b"))).alias("reasons"),
            F.col("qa").alias("last_sentence_a"), F.col("qb").alias("last_sentence_b")).alias("answer"))
    return Q.pair_check(made, docs.select(F.col("doc_id").cast("string").alias("story"), F.col("text").alias("body")))


def pair_blinding(spark, d):
    _, pairs = _pairs(spark, d)
    both = pairs.select(F.col("doc_id").cast("string").alias("a"), F.col("other").cast("string").alias("b"))
    return Q.blinded(both, 42)


def _raw(spark, d):
    """Documents dressed as annotated files: header, legend, body with readings and notes, colophon."""
    year = F.pmod(F.col("doc_id"), F.lit(150)) + 1868
    body = F.replace("text", F.lit(" the "), F.lit(" ｜the《za》 "))
    return _docs(spark, d).select("doc_id", F.concat(
        F.lit("Title "), "doc_id", F.lit("\r\nsub "), "lang", F.lit("\r\n"), "source", F.lit("\r\n\r\n-------------------------\r\nlegend\r\n-------------------------\r\n\r\n"),
        body, F.lit("\r\n\r\n\r\n※［＃note］end\r\n底本：base\r\n初出：「"), "source", F.lit("」"), year, F.lit("年\r\n")).alias("raw"))


def cleaned_works(spark, d):
    out = R.works(_raw(spark, d)).withColumn("year", X.publication_year(F.col("colophon")))
    return out.select("doc_id", "title", "subtitle", "author", "body", "year", X.era(F.col("year")).alias("era"), X.licence(F.col("colophon")).alias("licence"),
                      X.slug(F.col("title")).alias("slug"), X.safe_name(F.col("title")).alias("safe"))


def corpus_eras(spark, d):
    """How many works were scanned, how many had no year of an era, and each era's number."""
    era = F.coalesce("era", F.lit("-"))
    return cleaned_works(spark, d).groupBy(era.alias("era")).agg(F.count("*").alias("works"), F.sum(F.length("body")).alias("characters"))


def kanji_numbers(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select(F.pmod("p_partkey", F.lit(100)).alias("n")).distinct().withColumn("numeral", X.kanji_number(F.col("n")))


def catalog_lookup(spark, d):
    """Customers as a catalog; ids with leading zeros find them, unknown ones are reported."""
    rows = spark.read.parquet(f"{d}/customer.parquet").select(
        F.col("c_custkey").cast("string").alias("work_id"), F.col("c_nationkey").cast("string").alias("person_id"), F.col("c_name").alias("title"),
        F.lit("").alias("subtitle"), F.col("c_mktsegment").alias("author"), F.lit("").alias("path"))
    wanted = spark.read.parquet(f"{d}/orders.parquet").select(F.concat(F.lit("000"), F.col("o_custkey") * 2).alias("work_id")).distinct()
    return R.find_works(rows, wanted).select("wanted", "title", "author")


def best_drafts(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    drafts = lines.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("round"), F.pmod(F.col("l_suppkey"), F.lit(4)).alias("violations"))
    return K.best_draft(drafts)


def fitted_chapters(spark, d):
    talk = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", F.length("text").alias("chars"))
    return K.fitted_lengths(talk, F.lit(20000.0), "conv_id")


NAMES = (
    "doc_basic_stats", "doc_headings", "doc_sentences", "doc_tension_curve", "doc_peaks", "doc_sparklines", "doc_similes", "doc_vocabulary", "doc_openings_closings",
    "doc_repetitions", "corpus_measures", "corpus_quantiles", "corpus_quantiles_by_era", "corpus_quantiles_by_author", "corpus_shares", "corpus_peak_shares",
    "corpus_marker_shares", "corpus_sample", "author_profiles", "author_index", "author_summaries", "word_catalog", "author_words", "simile_catalog", "story_metrics",
    "style_targets", "band_violations", "simile_balance", "section_plans", "quote_occurrences", "quote_paragraphs", "chapter_measures", "novel_summaries",
    "document_chapters", "event_gap_clusters", "turn_clusters", "finding_consensus", "pair_checks", "pair_blinding", "cleaned_works", "corpus_eras", "kanji_numbers",
    "catalog_lookup", "best_drafts", "fitted_chapters", "violated_metrics",
)


def queries() -> dict:
    return {name: globals()[name] for name in NAMES}

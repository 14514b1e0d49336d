"""Targets, bands and plans: which measures of a text lie outside of what a baseline allows."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..profiles import ADVICE, CHECKS, CORPUS_NAMES, DIALOGUE_TOLERANCE, JAPANESE, MARGIN, NONFICTION, PLOT_BANDS, SECTION_SHARES, TEXT_PROBLEMS, Profile
from ..profiles import DOWN, UP
from . import documents as D
from .corpus import medians

TARGETED = tuple(k for k, *_ in CHECKS if k != "characters")


def story_metrics(stories: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carry, characters, sentence_length_mean, sentence_length_cv, simile_per_1000, simile_count,
    dialogue_ratio): the first line is a title; lines that are numerals only don't count."""
    whole = X.strip(F.col(text))
    body = F.when(F.contains(whole, F.lit("\n")), X.strip(F.regexp_replace(whole, r"^[^\n]*\n", ""))).otherwise(whole)
    lines = F.filter(F.split(body, "\n"), lambda x: ~X.strip(x).rlike(r"^[一二三四五六七八九十]{1,3}$"))
    own = D.parsed(stories.select(key, *carry, F.array_join(lines, "\n").alias("_t")), profile, key=key, text="_t", carry=(*carry, "_t"), headings=False)
    stats = D.statistics(own.withColumn("body", F.col("_t")), profile, keep=(key, *carry))
    cv = F.when(F.col("sentence_length_mean") > 0, F.col("sentence_length_stdev") / F.col("sentence_length_mean")).otherwise(0.0)
    return stats.select(key, *carry, "characters", "sentence_length_mean", cv.alias("sentence_length_cv"), "simile_per_1000", "simile_count", "dialogue_ratio")


def targets(stats: DataFrame, length: int | None = None, how: str = "median", work: str | None = None) -> DataFrame:
    """One row: mean or median of each targeted metric over stats; works that are no fiction are left out.
    Where sentences have no length, 0 / 0 is not a number: it counts, and is the last in order."""
    if work:
        stats = stats.filter(~F.col(work).isin(*NONFICTION))
    ratio = F.when(F.col("sentence_length_mean") == 0, float("nan")).otherwise(F.col("sentence_length_stdev") / F.col("sentence_length_mean"))
    cv = F.col("sentence_length_cv") if "sentence_length_cv" in stats.columns else ratio
    own = stats.withColumn("sentence_length_cv", cv)
    count = own.agg(F.lit(length).cast("double").alias("characters"), F.count("*").alias("works"), *([F.avg(m).alias(m) for m in TARGETED] if how == "mean" else []))
    if how != "mean":
        count = count.join(F.broadcast(medians(own, TARGETED)))  # one row
    return count.select("characters", *TARGETED, "works")


def _limits(target: Column, plot: Column, metric: str, band) -> tuple[Column, Column]:
    low, high = (F.greatest(F.lit(0.0), target - DIALOGUE_TOLERANCE), target + DIALOGUE_TOLERANCE) if band is None else (target * band[0], target * band[1])
    for name, bands in PLOT_BANDS.items():
        if metric in bands:
            own = (F.lit(0.0), target + DIALOGUE_TOLERANCE) if bands[metric] == "no_floor" else (target * bands[metric][0], target * bands[metric][1])
            low, high = F.when(plot.eqNullSafe(F.lit(name)), own[0]).otherwise(low), F.when(plot.eqNullSafe(F.lit(name)), own[1]).otherwise(high)
    return low, high


def violations(metrics: DataFrame, targets_: DataFrame, key: str = "doc_id", plot: str | None = None) -> DataFrame:
    """(key, metric, label, unit, current, target, low, high, marginal, direction), one row for each
    metric outside its band. targets_ is one row. Where the upper edge is 0, marginal is null."""
    wanted = targets_.select(*[F.col(k).alias(f"_t_{k}") for k, *_ in CHECKS])
    both = metrics.join(F.broadcast(wanted))  # one row
    kind = F.col(plot) if plot else F.lit(None).cast("string")
    rows = []
    for metric, label, unit, band in CHECKS:
        target = F.col(f"_t_{metric}")
        low, high = _limits(target, kind, metric, band)
        rows.append(F.struct(F.lit(metric).alias("metric"), F.lit(label).alias("label"), F.lit(unit).alias("unit"), F.col(metric).cast("double").alias("current"),
                             target.cast("double").alias("target"), low.cast("double").alias("low"), high.cast("double").alias("high")))
    out = both.select(key, F.explode(F.array(*rows)).alias("v")).select(key, "v.*").filter("target is not null and not (current between low and high)")
    over = F.when(F.col("current") < F.col("low"), (F.col("low") - F.col("current")) / F.nullif(F.col("low"), F.lit(0.0))).otherwise(
        (F.col("current") - F.col("high")) / F.nullif(F.col("high"), F.lit(0.0)))
    return out.withColumn("marginal", over <= MARGIN).withColumn("direction", F.when(F.col("current") < F.col("low"), UP).otherwise(DOWN))


def violated(violations_: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, metrics): the names of a text's metrics outside their bands, sorted; there are few metrics, so lists are short."""
    return violations_.groupBy(key).agg(F.sort_array(F.collect_set("metric")).alias("metrics"))


def advice(violations_: DataFrame) -> DataFrame:
    """Violations with what to do about each; the table of advice has a fixed size."""
    table = violations_.sparkSession.createDataFrame(list(ADVICE), "metric string, direction string, advice string")
    return violations_.join(F.broadcast(table), ["metric", "direction"])


def best_draft(drafts: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, round, n): of (key, round, violations) the draft of fewest violations, the newest among equals."""
    return drafts.groupBy(key).agg(F.min_by("round", F.struct("violations", -F.col("round"))).alias("round"), F.min("violations").alias("n"))


def simile_balance(rows: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id") -> DataFrame:
    """(key, front, back, ratio): marked sentences in the halves of a text; ratio where there are three or
    more, unbalanced outside 0.5 to 2."""
    hit = rows.filter(F.col("s").rlike("|".join(f"(?:{p})" for p in profile.markers.values())))
    half = F.col("acc") / F.col("total") < 0.5
    out = hit.groupBy(key).agg(F.sum(F.when(half, 1).otherwise(0)).alias("front"), F.sum(F.when(half, 0).otherwise(1)).alias("back"))
    return out.filter("front + back >= 3").withColumn("ratio", (F.col("front") + 0.5) / (F.col("back") + 0.5)).withColumn("unbalanced", ~F.col("ratio").between(0.5, 2.0))


def borrowed_names(docs: DataFrame, names: tuple[str, ...] = CORPUS_NAMES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, name) for each of the names that a text contains."""
    found = F.filter(F.array(*[F.when(F.contains(F.col(text), F.lit(n)), F.lit(n)) for n in names]), lambda n: n.isNotNull())
    return docs.select(key, F.explode(found).alias("name"))


def text_problems(stories: DataFrame, targets_: DataFrame | None = None, profile: Profile = JAPANESE, key: str = "doc_id", body: str = "body",
                  plot: str | None = None) -> DataFrame:
    """(key, problems): what measures say of each text: metrics outside their bands (with targets_, one row),
    similes in one half only, old spelling, names of known works. The list has at most one entry for a check or name."""
    own = stories.select(key, *([plot] if plot else []), F.coalesce(body, F.lit("")).alias("_b"))
    rows = D.sentence_rows(D.parsed(own, profile, key=key, text="_b", headings=False), key)
    said = lambda problem, **figures: F.concat(*[figures[x] if i % 2 else F.lit(x) for i, x in enumerate(re.split(r"\{(\w+)\}", TEXT_PROBLEMS[problem]))])
    uneven = simile_balance(rows, profile, key).filter("unbalanced")
    found = uneven.select(key, F.lit(1).alias("at"), said("similes", front=F.col("front").cast("string"), back=F.col("back").cast("string")).alias("text"))
    found = found.union(own.filter(X.orthography(F.col("_b"), profile) != profile.orthography["new"]).select(key, F.lit(2), said("orthography")))
    found = found.union(borrowed_names(own, key=key, text="_b").select(key, F.lit(3), said("name", name=F.col("name"))))
    if targets_ is not None:
        carry = (plot,) if plot else ()
        metrics = story_metrics(own.withColumn("_s", F.concat(F.lit("t\n"), "_b")), profile, key, "_s", carry)
        figure = lambda c: F.round(c, 2).cast("string")
        over = violations(metrics, targets_, key, plot)
        found = found.union(over.select(key, F.lit(0), F.concat("label", F.lit(" "), figure("current"), F.lit(" → 許容 "), figure("low"), F.lit("〜"), figure("high"))))
    listed = found.groupBy(F.col(key).alias("_k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda x: x["text"]).alias("problems"))
    return own.select(key).join(listed, F.col(key).eqNullSafe(F.col("_k")), "left").select(key, F.coalesce("problems", F.array().cast("array<string>")).alias("problems"))


def unit_count(length: Column) -> Column:
    return F.when(length < 5000, 2).when(length < 9000, 3).otherwise(4)


def section_plan(lengths: DataFrame, length: str = "length") -> DataFrame:
    """(length, at, name, chars): sections of a story of that length; the middle is cut into units."""
    n = F.col(length)
    units = unit_count(n)
    shares = dict(SECTION_SHARES)
    names = list(shares)
    one = lambda name, chars: F.array(F.struct(F.lit(name).alias("name"), F.bround(chars).cast("long").alias("chars")))
    middle = F.transform(F.sequence(F.lit(1), units), lambda i: F.struct(F.concat(F.lit(names[1]), i.cast("string")).alias("name"),
                                                                        F.bround(n * shares[names[1]] / units).cast("long").alias("chars")))
    plan = F.concat(one(names[0], n * shares[names[0]]), middle, one(names[2], n * shares[names[2]]), one(names[3], n * shares[names[3]]))
    return lengths.select(length, F.posexplode(plan).alias("at", "s")).select(length, "at", "s.*")


def novel_chapters(length: Column) -> Column:
    return F.least(F.lit(20), F.greatest(F.lit(6), F.bround(length / 3500).cast("int")))


def fitted_lengths(chapters: DataFrame, length: Column, key: str = "doc_id") -> DataFrame:
    """chapters (key, at, chars) with lengths kept within 35 per cent of the mean and scaled to the whole, in tens."""
    group = Window.partitionBy(key)
    each = length / F.count("*").over(group)
    raw = F.least(F.greatest(F.coalesce(F.nullif(F.col("chars"), F.lit(0)).cast("double"), each), each * 0.65), each * 1.35)
    return chapters.withColumn("_raw", raw).withColumn("chars", (F.bround(F.col("_raw") * length / F.sum("_raw").over(group) / 10) * 10).cast("long")).drop("_raw")


def planned_outline(outline: DataFrame, key: str = "doc_id", length: str = "length") -> DataFrame:
    """outline (key, length, at from 0, name, chars, more) with the name and size that the plan for its length gives the
    section at each place, and fits: whether it has as many sections as the plan. Sections beyond the plan stay as they are."""
    plan = section_plan(outline.select(F.col(length).alias("_l")).filter("_l is not null").distinct(), "_l")
    plan = plan.withColumnsRenamed({"at": "_at", "name": "_name", "chars": "_chars"}).withColumn("_size", F.count("*").over(Window.partitionBy("_l")))
    sizes = plan.select("_l", "_size").distinct().toDF("_ls", "_size")
    own = outline.withColumn("_n", F.count("*").over(Window.partitionBy(key, length))).join(sizes, F.col(length) == F.col("_ls"), "left")
    both = own.join(plan.drop("_size"), (F.col(length) == F.col("_l")) & (F.col("at") == F.col("_at")), "left")
    given = {"name": F.coalesce("_name", "name"), "chars": F.coalesce("_chars", F.col("chars").cast("long"))}
    return both.select(*[given[c].alias(c) if c in given else F.col(c) for c in outline.columns], (F.col("_n").eqNullSafe(F.col("_size"))).alias("fits"))

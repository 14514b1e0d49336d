"""Chapters: units by heading, chapters from units, measures of chapters and of novels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..profiles import JAPANESE, NOVEL_CHARS, Profile
from . import documents as D

ANNOTATED = r"［＃「([^」]+)」は([大中小])見出し］"
BLOCK = r"［＃([大中小])見出し］(.+?)［＃\1見出し終わり］"
INDENTED = r"^［＃\d+字下げ］([^「『（［].{0,19})$"
SECTION = r"^(.+?)の([一二三四五六七八九十百〇０-９0-9]+)$"
NUMERAL = r"^[一二三四五六七八九十]{1,3}$"
FRONT, WHOLE = "（序）", "（全体）"
LEVELS = ("中", "小", "大")
LEAST = 30
ENDINGS = ("会話", "問い", "短文", "地の文")


def heading_of(line: Column, mode: str, profile: Profile = JAPANESE) -> Column:
    """struct(label, level) of a heading line, null of others."""
    bare = X.strip(line)
    unmarked = lambda c: X.strip(F.regexp_replace(c, "［＃[^］]*］", ""))
    made = lambda label, level: F.when(label != "", F.struct(label.alias("label"), level.alias("level")))
    if mode == "annotation":
        inline = F.regexp_extract(line, ANNOTATED, 1)
        block = unmarked(F.regexp_extract(line, BLOCK, 2))
        return F.when(inline != "", F.struct(inline.alias("label"), F.regexp_extract(line, ANNOTATED, 2).alias("level"))).otherwise(
            made(block, F.regexp_extract(line, BLOCK, 1)))
    plain = ~F.contains(bare, F.lit(profile.full_stop))
    if mode == "indent":
        return F.when(plain, made(unmarked(F.regexp_extract(bare, INDENTED, 1)), F.lit("中")))
    return F.when(X.is_heading(line, profile), F.struct(bare.alias("label"), F.lit("中").alias("level")))


def units(docs: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id", text: str = "text", whole: bool = True) -> DataFrame:
    """(key, unit, level, label, part, text): the body between headings, without notes and readings,
    of LEAST characters or more. The way of marking headings is the first with three of them.
    whole: the text has a header and a colophon, which are left out."""
    modes = ("annotation", "indent", "bare")
    if whole:
        own = X.with_sections(docs.select(key, F.col(text).alias("_t")), "_t").select(key, F.col("body").alias("ls"))
    else:
        own = docs.select(key, F.split(X.newlines(F.col(text)), "\n").alias("ls"))

    def marked(mode: str) -> Column:
        return F.size(F.filter("ls", lambda x: heading_of(x, mode, profile).isNotNull())) >= 3

    own = own.withColumn("mode", F.coalesce(*[F.when(marked(m), m) for m in modes]))
    rows = own.select(key, "mode", F.posexplode("ls").alias("at", "line"))
    found = reduce(lambda a, m: a.when(F.col("mode") == m, heading_of(F.col("line"), m, profile)), modes[1:], F.when(F.col("mode") == modes[0], heading_of(F.col("line"), modes[0], profile)))
    order = Window.partitionBy(key).orderBy("at")
    rows = rows.withColumn("h", found).withColumn("unit", F.count("h").over(order))
    rows = rows.withColumn("part", F.last(F.when(F.col("h.level") == "大", F.col("h.label")), ignorenulls=True).over(order))
    grouped = rows.groupBy(key, "unit").agg(F.max("h.level").alias("level"), F.max("h.label").alias("label"), F.max(F.when(F.col("h").isNotNull(), F.col("part"))).alias("part"),
                                            F.sort_array(F.collect_list(F.when(F.col("h").isNull(), F.struct("at", "line")))).alias("ls"))
    body = X.trim_newlines(X.strip_notes(X.strip_ruby(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"))))
    return grouped.withColumn("text", body).filter(F.length(X.strip(F.col("text"))) >= LEAST).select(key, "unit", "level", "label", "part", "text")


def chapters(units_: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, chapter, label, part, sections, level, text): units of the level in use; sections of one
    chapter together, text before the first heading in front, other levels left out."""
    whole = Window.partitionBy(key)
    levels = F.collect_set("level").over(whole)
    used = F.coalesce(*[F.when(F.array_contains(levels, v), v) for v in LEVELS])
    rows = units_.withColumn("used", used).filter("used is null or level is null or level = used")
    key_of = F.regexp_extract("label", SECTION, 1)
    rows = rows.withColumn("name", F.when(F.col("level").isNull(), F.lit(FRONT)).when(key_of != "", key_of).otherwise(F.col("label")))
    order = whole.orderBy("unit")
    joins = (key_of != "") & (F.lag("name").over(order) == F.col("name")) & F.lag("part").over(order).eqNullSafe(F.col("part"))
    joins = F.coalesce(joins, F.lit(False)) | F.col("used").isNull()
    rows = rows.withColumn("first", F.row_number().over(order) == 1).withColumn("chapter", F.sum(F.when(joins & ~F.col("first"), 0).otherwise(1)).over(order))
    return rows.groupBy(key, "chapter").agg(
        F.when(F.max("used").isNull(), WHOLE).otherwise(F.min_by("name", "unit")).alias("label"), F.min_by("part", "unit").alias("part"),
        F.when(F.max("used").isNull(), 1).otherwise(F.count("*")).alias("sections"), F.max("used").alias("level"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("unit", "text"))), lambda x: x["text"]), "\n").alias("text"))


def numeral_chapters(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chapters of a story whose first line is its title and whose headings are numerals."""
    rows = docs.select(key, F.posexplode(F.split(X.strip(F.col(text)), "\n")).alias("at", "line")).filter("at > 0")
    rows = rows.withColumn("h", X.strip(F.col("line")).rlike(NUMERAL)).withColumn(
        "chapter", F.count(F.when(F.col("h"), 1)).over(Window.partitionBy(key).orderBy("at")))
    out = rows.groupBy(key, "chapter").agg(F.coalesce(F.max(F.when(F.col("h"), X.strip(F.col("line")))), F.lit(FRONT)).alias("label"),
                                           F.sort_array(F.collect_list(F.when(~F.col("h"), F.struct("at", "line")))).alias("ls"))
    out = out.withColumn("text", F.btrim(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), F.lit("\n")))
    return out.filter(F.length(X.strip(F.col("text"))) >= LEAST).select(
        key, "chapter", "label", F.lit(None).cast("string").alias("part"), F.lit(1).alias("sections"), F.lit("漢数字").alias("level"), "text")


def ending(sentences: Column, mean: Column, profile: Profile = JAPANESE) -> Column:
    """Kind of the last sentence: speech, question, short, narration; none where there is none."""
    last = F.get(sentences, F.size(sentences) - 1)
    open_, close = f"[{profile.quote_open}]", f"[{profile.quote_close}]"
    asks = "|".join(X.literal(q) for q in profile.question)
    return F.when(F.size(sentences) == 0, "なし").when(last.rlike(f"^{open_}|{close}$"), ENDINGS[0]).when(
        last.rlike(f"(?:{asks}){close}*$"), ENDINGS[1]).when(F.length(last) < mean * 0.5, ENDINGS[2]).otherwise(ENDINGS[3])


def measured(chapters_: DataFrame, profile: Profile = JAPANESE, key: str = "doc_id") -> DataFrame:
    """(key, chapter, label, part, sections, level, position, and the measures of each chapter)."""
    carry = ("chapter", "label", "part", "sections", "level", "size")
    base = chapters_.withColumn("size", F.length("text").cast("long"))
    own = D.parsed(base, profile, key=key, carry=(*carry, "text"), headings=False)
    own = own.withColumn("body", F.col("text")).withColumn("kept", F.col("all"))
    stats = D.statistics(own, profile, keep=(key, *carry, "all", "sents"))
    before = Window.partitionBy(key).orderBy("chapter").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.greatest(F.sum("size").over(Window.partitionBy(key)), F.lit(1))
    return stats.select(
        key, "chapter", "label", "part", "sections", "level", (F.coalesce(F.sum("size").over(before), F.lit(0)) * 100 / whole).alias("position"),
        "characters", "sentences", "sentence_length_mean", "dialogue_ratio", (F.col("exclaim_per_1000") + F.col("question_per_1000")).alias("exclaim_question_per_1000"),
        "simile_per_1000", F.coalesce(X.is_dialogue(F.get("all", F.lit(0)), profile), F.lit(False)).alias("opens_with_dialogue"),
        ending(F.col("sents"), F.col("sentence_length_mean"), profile).alias("ending"))


def novels(rows: DataFrame, key: str = "doc_id", least_chars: int = NOVEL_CHARS) -> DataFrame:
    """One row for each novel of least_chars or more: the summary over its measured chapters."""
    order = Window.partitionBy(key).orderBy("chapter")
    by_size = Window.partitionBy(key).orderBy("characters", "chapter")
    n = F.count("*").over(Window.partitionBy(key))
    rows = rows.withColumn("i", F.row_number().over(order)).withColumn("rank", F.row_number().over(by_size)).withColumn("n", n)
    middle = (F.col("rank") == F.floor((F.col("n") + 1) / 2)) | (F.col("rank") == F.floor(F.col("n") / 2) + 1)
    size, count = F.col("characters"), F.count("*")
    share = lambda test: F.sum(F.when(test, 1).otherwise(0)) / count
    out = rows.groupBy(key).agg(
        count.alias("chapters"), F.countDistinct("part").alias("parts"), F.max("level").alias("heading_level_used"), F.sum(size).alias("characters"),
        (F.sum(F.when(middle, size)) / F.sum(F.when(middle, 1))).alias("chapter_length_median"),
        (F.sqrt((count * F.sum(size * size) - F.sum(size) * F.sum(size)).cast("double")) / F.sum(size)).alias("chapter_length_cv"),
        F.when(count >= 4, 1 - 6 * F.sum((F.col("i") - F.col("rank")) * (F.col("i") - F.col("rank"))) / (count * (count * count - 1))).alias("length_trend"),
        F.min_by("characters", "i").alias("_first"), F.max_by("characters", "i").alias("_last"),
        F.max_by("position", F.struct("characters", -F.col("i"))).alias("longest_chapter_position"),
        F.max_by("position", F.struct("dialogue_ratio", -F.col("i"))).alias("dialogue_peak_position"),
        *[share(F.col("ending") == e).alias(f"ending_share_{i}") for i, e in enumerate(ENDINGS)],
        share(F.col("opens_with_dialogue")).alias("opens_with_dialogue_share")).filter(F.col("characters") >= least_chars)
    ratio = lambda c: F.when(F.col("chapters") > 1, F.col(c) / F.col("chapter_length_median"))
    return out.withColumn("chapter_length_cv", F.when(F.col("chapters") > 1, F.col("chapter_length_cv")).otherwise(0.0)).withColumn(
        "first_chapter_ratio", ratio("_first")).withColumn("last_chapter_ratio", ratio("_last")).drop("_first", "_last")

"""Column functions over text: everything stays in one row and needs no shuffle."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..profiles import ERAS, FIRST_PUBLISHED, LICENCE, NO_LICENCE, SPARK, Profile


# ---- cleaning ----------------------------------------------------------------------------------
#: Unicode's white space.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at both ends, the ideographic space included."""
    return F.btrim(c, F.lit(WHITE))


def squeeze(c: Column) -> Column:
    """Without any white space; null becomes empty."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", "")


def strip_ruby(c: Column, keep: bool = False) -> Column:
    return F.replace(F.regexp_replace(c, "《([^》]*)》", "($1)" if keep else ""), F.lit("｜"), F.lit(""))


def strip_notes(c: Column) -> Column:
    return F.regexp_replace(c, "※?［＃[^］]*］", "")


def newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\r\n?", "\n")


def trim_newlines(c: Column) -> Column:
    return F.btrim(F.regexp_replace(c, "\n{3,}", "\n\n"), F.lit("\n"))


def slug(c: Column, limit: int = 40, default: str = "untitled") -> Column:
    return F.coalesce(F.nullif(F.left(F.btrim(F.regexp_replace(c, r'(?U)[\\/:*?"<>|\s]+', "_"), F.lit("_")), F.lit(limit)), F.lit("")), F.lit(default))


def short_slug(c: Column, limit: int = 24) -> Column:
    return F.left(F.regexp_replace(c, r'(?U)[\\/:*?"<>|\s]', ""), F.lit(limit))


def safe_name(c: Column) -> Column:
    return F.translate(c, "/ ", "__")


def without_heading_marks(c: Column) -> Column:
    return F.ltrim(c, F.lit("# 　"))


def header_fields(clean: Column) -> Column:
    """struct(title, subtitle, author) of a header's stripped lines: the first, those between, the last."""
    n = F.size(clean)
    return F.struct(F.coalesce(F.get(clean, F.lit(0)), F.lit("")).alias("title"),
                    F.when(n > 2, F.array_join(F.slice(clean, F.lit(2), F.greatest(n - 2, F.lit(0))), " ")).otherwise("").alias("subtitle"),
                    F.when(n > 1, F.get(clean, n - 1)).otherwise("").alias("author"))


def with_sections(df: DataFrame, text: str) -> DataFrame:
    """df with header, body and colophon: arrays of lines of an annotated text.

    The header ends at the first blank line; a legend between two lines of 20 hyphens or more,
    first after it, is left out (to the end of the text where it isn't closed); the colophon
    begins with the line of the base book. Steps are columns of their own, so that none is
    evaluated anew for each line.
    """
    n = F.size("_l")
    first = lambda test, start: F.coalesce(F.array_min(F.filter(F.transform(
        "_s", lambda x, i: F.when((i >= start) & test(x), i)), lambda i: i.isNotNull())), n)
    hyphens = lambda x: x.rlike("^-{20,}$")
    cut = lambda lo, hi: F.slice("_l", (lo + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int"))
    out = df.withColumn("_l", F.split(newlines(F.col(text)), "\n")).withColumn("_s", F.transform("_l", strip))
    out = out.withColumn("_blank", first(lambda x: x == "", F.lit(0)))
    out = out.withColumn("_after", first(lambda x: x != "", F.col("_blank")))
    out = out.withColumn("_open", F.coalesce(hyphens(F.get("_s", F.col("_after"))), F.lit(False)))
    out = out.withColumn("_start", F.when(F.col("_open"), first(hyphens, F.col("_after") + 1) + 1).otherwise(F.col("_blank")))
    out = out.withColumn("_end", first(lambda x: x.rlike("^底本[：:]"), F.col("_start")))
    out = out.withColumn("header", cut(F.lit(0), F.col("_blank"))).withColumn("body", cut(F.col("_start"), F.col("_end"))).withColumn("colophon", cut(F.col("_end"), n))
    return out.drop("_l", "_s", "_blank", "_after", "_open", "_start", "_end")


def with_plain_text(df: DataFrame, text: str, keep_ruby: bool = False) -> DataFrame:
    """df with body, title, subtitle, author and colophon as texts."""
    out = with_sections(df, text)
    clean = F.filter(F.transform("header", lambda x: strip(strip_ruby(x))), lambda x: x != "")
    out = out.withColumn("_h", clean).withColumn("_h", header_fields(F.col("_h")))
    body = strip_notes(strip_ruby(F.array_join("body", "\n"), keep_ruby))
    return out.withColumn("body", F.concat(trim_newlines(body), F.lit("\n"))).withColumn("colophon", strip(strip_ruby(F.array_join("colophon", "\n")))).select(
        "*", "_h.*").drop("_h", "header")


def publication_year(colophon: Column) -> Column:
    return F.nullif(F.regexp_extract(colophon, FIRST_PUBLISHED, 1), F.lit("")).cast("int")


def licence(colophon: Column) -> Column:
    name = F.regexp_extract(colophon, LICENCE, 1)
    return F.when(name == "", F.lit(NO_LICENCE)).otherwise(F.concat(F.lit("CC "), name))


def era(year: Column, eras=ERAS) -> Column:
    out = F.lit(None).cast("string")
    for name, low, high in reversed(eras):
        out = F.when(year.between(low, high), name).otherwise(out)
    return out


# ---- cutting -----------------------------------------------------------------------------------
def paragraphs(text: Column) -> Column:
    """Lines with something other than white space, as they are."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p.rlike(r"(?U)\S"))


def sentences(paragraphs_: Column, profile: Profile) -> Column:
    """Sentences of all paragraphs in order, stripped, none empty."""
    cut = lambda p: F.transform(F.regexp_extract_all(p, F.lit(profile.sentence), F.lit(0)), strip)
    return F.filter(F.flatten(F.transform(paragraphs_, cut)), lambda s: s != "")


def is_heading(paragraph: Column, profile: Profile) -> Column:
    line = strip(paragraph)
    return (F.length(line) <= profile.heading_length) & ~F.contains(line, F.lit(profile.full_stop)) & line.rlike("|".join(f"(?:{p})" for p in profile.headings))


def is_dialogue(paragraph: Column, profile: Profile) -> Column:
    return paragraph.rlike(profile.dialogue_head)


def quote_lengths(text: Column, profile: Profile) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(profile.quote), F.lit(0)), lambda q: F.length(q))


def markers(sentence: Column, profile: Profile) -> Column:
    """Names of the simile markers in a sentence, in the profile's order."""
    return F.filter(F.array(*[F.when(sentence.rlike(p), F.lit(m)) for m, p in profile.markers.items()]), lambda m: m.isNotNull())


def is_simile(sentence: Column, profile: Profile) -> Column:
    return F.length(sentence).between(10, 160) & sentence.rlike("|".join(f"(?:{p})" for p in profile.markers.values()))


def reduplications(text: Column, profile: Profile) -> Column:
    """Twice the same two, then twice the same three letters, where no such letter precedes."""
    found = [F.regexp_extract_all(text, F.lit(f"(?<![{profile.kana}])([{profile.kana}]{{{n}}})\\1"), F.lit(0)) for n in (2, 3)]
    return F.filter(F.concat(*found), lambda w: ~w.isin(*profile.stopwords)) if profile.stopwords else F.concat(*found)


# ---- measures ----------------------------------------------------------------------------------
def count_of(text: Column, *parts: str) -> Column:
    """How often the parts occur, without overlaps."""
    out = F.lit(0)
    for part in parts:
        out = out + ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")
    return out


def per(amount: Column, whole: Column, scale: int = 1) -> Column:
    """amount / whole * scale, 0 where whole is 0."""
    return F.when(whole > 0, amount * scale / whole).otherwise(0.0)


def total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)


def top_total(words: Column, most: int) -> Column:
    """How often the `most` words that occur most often occur together."""
    often = F.transform(F.array_distinct(words), lambda w: F.size(F.filter(words, lambda x: x == w)))
    return F.when(F.size(F.array_distinct(words)) <= most, F.size(words).cast("long")).otherwise(total(F.slice(F.reverse(F.array_sort(often)), 1, most)))


def mean(numbers: Column) -> Column:
    return per(total(numbers), F.size(numbers))


def deviation(numbers: Column) -> Column:
    """Population standard deviation, from exact whole sums."""
    n, s = F.size(numbers).cast("long"), total(numbers)
    return F.when(n > 0, F.sqrt((n * total(F.transform(numbers, lambda x: x.cast("long") * x)) - s * s).cast("double")) / n).otherwise(0.0)


def median(numbers: Column) -> Column:
    """Of whole numbers; the mean of the middle two where there are two."""
    s, n = F.sort_array(numbers), F.size(numbers)
    at = lambda i: F.get(s, F.floor(i).cast("int"))
    return F.when(n > 0, (at((n - 1) / 2) + at(n / 2)) / 2).otherwise(0.0)


def class_ratio(text: Column, letters: str) -> Column:
    return per(F.length(text) - F.length(F.regexp_replace(text, f"[{letters}]", "")), F.length(text))


def orthography(text: Column, profile: Profile) -> Column:
    """Old, mixed or new spelling, by old letters in the first 20,000 characters."""
    names, head = profile.orthography, F.left(text, F.lit(20000))
    old = F.length(head) - F.length(F.regexp_replace(head, f"[{profile.old_letters}{profile.old_kana}]", ""))
    score = old / F.length(head) * 1000
    return F.when(F.length(head) == 0, names["none"]).when(score >= 1.5, names["old"]).when(score >= 0.3, names["mixed"]).otherwise(names["new"])


def sparkline(values: Column) -> Column:
    low, high = F.array_min(values), F.array_max(values)
    step = lambda v: F.least(F.floor((v - low) / (high - low) * (len(SPARK) - 1)), F.lit(len(SPARK) - 1)).cast("int")
    flat = high - low < 1e-9
    return F.array_join(F.transform(values, lambda v: F.when(flat, F.lit(SPARK[0])).otherwise(F.substring(F.lit(SPARK), step(v) + 1, F.lit(1)))), "")


def arrow(value: Column, whole: Column) -> Column:
    """Whether a mean lies 15 per cent off the corpus's."""
    return F.when(value - whole > whole * 0.15, "↑").when(value - whole < -whole * 0.15, "↓").otherwise("→")


def kanji_number(n: Column) -> Column:
    """0 to 99 in kanji numerals."""
    digits = F.lit("〇一二三四五六七八九")
    digit = lambda d: F.substring(digits, d.cast("int") + 1, F.lit(1))
    tens, ones = F.floor(n / 10), n % 10
    return F.when(n < 10, digit(n)).otherwise(F.concat(F.when(tens == 1, "").otherwise(digit(tens)), F.lit("十"), F.when(ones > 0, digit(ones)).otherwise("")))


# ---- quotes ------------------------------------------------------------------------------------
def locate(body: Column, quote: Column) -> Column:
    """Where a quote begins, in per cent of the body without white space; else where its first 20
    characters do; null where neither is found or under 4 characters are given."""
    flat, q = squeeze(body), squeeze(quote)
    at = F.coalesce(F.nullif(F.instr(flat, q), F.lit(0)), F.nullif(F.instr(flat, F.left(q, F.lit(20))), F.lit(0)))
    return F.when(F.length(q) >= 4, (at - 1) * 100 / F.length(flat))


def locate_paragraph(body: Column, quote: Column) -> Column:
    """Number, from 0, of the first paragraph with the quote's first 20 characters."""
    q = F.left(squeeze(quote), F.lit(20))
    hit = F.filter(F.transform(paragraphs(body), lambda p, i: F.when(F.contains(squeeze(p), q), i)), lambda i: i.isNotNull())
    return F.when(F.length(q) >= 4, F.get(hit, F.lit(0)))


def json_in(text: Column) -> Column:
    """From the first brace to the last; null where there is none."""
    return F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit(""))


def literal(text: str) -> str:
    """As a regular expression."""
    return re.escape(text)

"""Verification of quoted judgments: places of quotes, structure bands, claims, consensus, pairs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .checks import text_problems
from ..profiles import BANDS, INFO_ITEMS, JAPANESE, STRUCTURE_PROBLEMS, Profile

ANSWER = """
read_to_end struct<last_sentence:string>,
structure struct<inciting:struct<quote:string,lacking:string,deadline_quote:string>, development_type:string, units:array<struct<quote:string,label:string>>,
  direction:string, turns:array<struct<quote:string,type:string>>, climax:struct<quote:string>, ending:struct<quote:string,type:string>, knowledge_gap:string>,
craft struct<inciting_is_lack:struct<verdict:boolean,quote:string>, turn_stated_by_character:struct<degree:string,quote:string>,
  ending_explains:struct<verdict:boolean,quote:string>, similes:array<struct<quote:string,vehicle:string,concrete:boolean>>,
  contradictions:array<struct<quote_a:string,quote_b:string,why:string>>, coincidences:array<struct<quote:string,why:string>>,
  telegraphed:array<struct<quote:string,why:string>>, ending_exposition:array<struct<quote:string,why:string>>,
  misleading_imagery:array<struct<quote:string,why:string>>, continuity_breaks:array<struct<quote:string,why:string>>,
  borrowed:array<struct<quote:string,source:string>>>
"""
PAIR_ANSWER = "winner string, reasons array<struct<criterion:string,quote_a:string,quote_b:string,better:string>>, last_sentence_a string, last_sentence_b string"
SIDECAR = "A string, B string, seed bigint"
SHOWN = 50


def answers(raw: DataFrame, text: str = "raw", schema: str = ANSWER) -> DataFrame:
    """raw with the column `answer`: the JSON in a noisy text, null where there is none."""
    return raw.withColumn("answer", F.from_json(X.json_in(F.col(text)), schema))


def stories(files: DataFrame, text: str = "text") -> DataFrame:
    """files with title (first line), and body (the rest)."""
    whole = X.strip(F.col(text))
    return files.withColumn("title", X.strip(F.substring_index(whole, "\n", 1))).withColumn(
        "body", F.when(F.contains(whole, F.lit("\n")), X.strip(F.regexp_replace(whole, r"^[^\n]*\n", ""))).otherwise(""))


def located(quotes: DataFrame, texts: DataFrame, on: str, quote: str = "quote", body: str = "body") -> DataFrame:
    """quotes with position, paragraph and verified, in the text of the same key."""
    return quotes.join(texts.select(on, F.col(body).alias("_body")), on).withColumn("position", X.locate(F.col("_body"), F.col(quote))).withColumn(
        "paragraph", X.locate_paragraph(F.col("_body"), F.col(quote))).withColumn("verified", F.col("position").isNotNull()).drop("_body")


def occurrences(quotes: DataFrame, texts: DataFrame, quote_key: str, text_key: str, quote: str = "text", text: str = "text",
                width: int = 8, most: int = 1 << 20) -> DataFrame:
    """(quote_key, text_key, position): texts that contain a quote, white space aside.

    The quotes' bytes are summed up first. Up to `most` of them, all quotes go to every task, where
    each text is searched for each. Beyond, quotes and texts meet in an equi-join on the quotes'
    first `width` characters, and only such pairs are searched.
    """
    q = quotes.select(F.col(quote_key).alias("_qk"), X.squeeze(F.col(quote)).alias("q")).filter(F.length("q") >= 4).withColumn("n", F.least(F.length("q"), F.lit(width)))
    t = texts.select(F.col(text_key).alias("_tk"), X.squeeze(F.col(text)).alias("t"))
    size = q.agg(F.coalesce(F.sum(F.octet_length("q")), F.lit(0))).first()[0]
    if size <= most:
        hits = t.join(F.broadcast(q), F.contains("t", F.col("q"))).withColumn("at", F.instr("t", F.col("q")))
        return hits.select(F.col("_qk").alias(quote_key), F.col("_tk").alias(text_key), ((F.col("at") - 1) * 100 / F.length("t")).alias("position"))
    # texts meet again by 128 bits of their content, so repeated and null keys do no harm
    t = t.withColumns({"h1": F.xxhash64("t"), "h2": F.xxhash64(F.lit(1), F.col("t"))})
    known = q.select("q", "n").distinct()
    pairs = None
    for n in range(4, width + 1):
        heads = known.filter(F.col("n") == n).select("q", F.left("q", F.lit(n)).alias("head"))
        pieces = F.array_distinct(F.regexp_extract_all("t", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)))
        own = t.select("h1", "h2", F.explode(pieces).alias("head")).join(heads, "head").select("h1", "h2", "q").distinct()
        pairs = own if pairs is None else pairs.union(own)
    hits = t.join(pairs, ["h1", "h2"]).withColumn("at", F.instr("t", F.col("q"))).filter("at > 0").join(q.select("_qk", "q"), "q")
    return hits.select(F.col("_qk").alias(quote_key), F.col("_tk").alias(text_key), ((F.col("at") - 1) * 100 / F.length("t")).alias("position"))


def gap_clusters(points: DataFrame, key: list[str], at: str, gap: Column | float) -> DataFrame:
    """points with `cluster`, from 0: a distance to the point before of more than gap begins a new one."""
    order = Window.partitionBy(*key).orderBy(at)
    new = F.when(F.col(at) - F.lag(at).over(order) > gap, 1).otherwise(0)
    return points.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(order)).drop("_new")


def adopted_turns(turns: DataFrame, key: list[str], at: str = "position") -> DataFrame:
    """(key, turn, earlier: first places of the clusters before): the first candidate of the last cluster."""
    clusters = gap_clusters(turns.filter(F.col(at).isNotNull()), key, at, BANDS["turn_cluster"]).groupBy(*key, "cluster").agg(F.min(at).alias("at"))
    listed = clusters.groupBy(*key).agg(F.array_sort(F.collect_list("at")).alias("ats"))
    return listed.select(*key, F.element_at("ats", -1).alias("turn"), F.slice("ats", F.lit(1), F.size("ats") - 1).alias("earlier"))


def structure_check(judged: DataFrame, key: list[str], body: str = "body", plot: str | None = None) -> DataFrame:
    """key, places and problems of each answer's structure against the bands. judged: (key, body, answer)."""
    b, s = F.col(body), F.col("answer.structure")
    inciting, climax = X.locate(b, s["inciting"]["quote"]), X.locate(b, s["climax"]["quote"])
    units = F.filter(F.transform(s["units"], lambda u: X.locate(b, u["quote"])), lambda p: p.isNotNull())
    asked = F.coalesce(F.size("answer.structure.units"), F.lit(0))
    asked = F.when(s["units"].isNull(), 0).otherwise(asked)
    places = F.array_sort(F.filter(F.transform(s["turns"], lambda t: F.struct(X.locate(b, t["quote"]).alias("at"), t["type"].alias("type"))), lambda t: t["at"].isNotNull()))
    out = judged.withColumn("inciting", inciting).withColumn("deadline", X.locate(b, s["inciting"]["deadline_quote"])).withColumn("climax", climax).withColumn(
        "units", F.coalesce(units, F.array().cast("array<double>"))).withColumn("turns", F.coalesce(places, F.array().cast("array<struct<at:double,type:string>>")))
    # the last turn after which no gap wider than the cluster's follows
    adopted = F.aggregate("turns", F.struct(F.lit(None).cast("double").alias("first"), F.lit(None).cast("double").alias("last")), lambda a, t: F.when(
        a["last"].isNull() | (t["at"] - a["last"] > BANDS["turn_cluster"]), F.struct(t["at"].alias("first"), t["at"].alias("last"))).otherwise(
        F.struct(a["first"].alias("first"), t["at"].alias("last"))), lambda a: a["first"])
    out = out.withColumn("turn", adopted).withColumn("tail", 100 - F.col("climax"))
    n, k = F.length(b), F.size("units")
    wanted = F.when(n < 5000, k.between(2, 3)).otherwise(k.between(3, 4))
    kind = F.coalesce(F.col(plot), s["development_type"]) if plot else s["development_type"]
    repeats = F.coalesce(kind == "反復", F.lit(False))
    asked_turns = F.when(s["turns"].isNull(), 0).otherwise(F.size(s["turns"]))
    rounded = lambda c: F.round(c, 1).cast("string")
    said = {"inciting": rounded(F.col("inciting")), "missing": (asked - k).cast("string"), "units": k.cast("string"), "turn": rounded(F.col("turn")),
            "climax": rounded(F.col("climax")), "tail": rounded(F.col("tail")), "length": F.format_number(n, 0), "wanted": F.when(n < 5000, "2〜3").otherwise("3〜4"),
            "kind": F.coalesce(F.get(F.filter("turns", lambda t: t["at"] == F.col("turn")), F.lit(0))["type"], F.lit("None"))}

    def problem(test: Column, name: str) -> Column:
        """The wording of a problem, with its figures in their places."""
        parts = re.split(r"\{(\w+)\}", STRUCTURE_PROBLEMS[name])
        return F.when(test, F.concat(*[said[x] if i % 2 else F.lit(x) for i, x in enumerate(parts)]))

    low, high = BANDS["climax"]
    problems = F.array(
        problem(F.col("inciting").isNull(), "no_inciting"), problem(F.col("inciting") > BANDS["inciting_late"], "late_inciting"),
        problem((F.col("inciting") > BANDS["inciting_max"]) & (F.col("inciting") <= BANDS["inciting_late"]), "rather_late_inciting"),
        problem(asked > k, "no_units"), problem(repeats & ~wanted, "number_of_units"),
        problem(repeats & (F.coalesce(s["direction"], F.lit("")) == ""), "no_direction"),
        problem(F.size("turns") < asked_turns, "no_turn_quote"), problem(F.size("turns") == 0, "no_turn"),
        problem(~F.col("turn").between(*BANDS["turn"]), "turn"), problem(F.col("climax").isNull(), "no_climax"),
        problem(~F.col("climax").between(low, high), "climax"), problem(F.round("tail", 1) > BANDS["ending_max"], "tail"),
        problem(s["ending"]["type"] == "説明", "explained_ending"), problem(F.coalesce(s["knowledge_gap"], F.lit("")) == "", "no_gap"))
    return out.select(*key, "inciting", "deadline", "units", "turns", "turn", "climax", "tail", F.array_compact(problems).alias("problems"))


def claims(judged: DataFrame, key: list[str], body: str = "body") -> DataFrame:
    """(key, item, label, quote, why, position, paragraph, kept, info): each claim of an answer. It is kept
    if its quote is in the body (a contradiction: both quotes)."""
    c = F.col("answer.craft")
    kind = "array<struct<item:string,label:string,quote:string,other:string,why:string>>"
    one = lambda item, label, quote, other=None, why=None: F.struct(
        F.lit(item).alias("item"), F.lit(label).alias("label"), quote.alias("quote"), (F.lit(None).cast("string") if other is None else other).alias("other"),
        F.coalesce(F.lit("") if why is None else why, F.lit("")).alias("why"))
    many = lambda column, made: F.coalesce(F.transform(c[column], made), F.array().cast(kind)).cast(kind)
    single = lambda test, made: F.when(test, F.array(made)).otherwise(F.array().cast(kind)).cast(kind)
    plain = [("coincidences", "3-6", "都合のよい展開", "why"), ("telegraphed", "3-7", "真相が先に確定する", "why"), ("borrowed", "3-8", "流用", "source"),
             ("ending_exposition", "3-10", "結の説明的な地の文", "why"), ("misleading_imagery", "3-11", "筋と誤読される描写", "why"),
             ("continuity_breaks", "3-12", "場面の連続が切れる", "why")]
    claim = lambda item, label, why: lambda x: one(item, label, x["quote"], None, x[why])
    listed = F.concat(
        single(F.coalesce(~c["inciting_is_lack"]["verdict"], F.lit(False)), one("3-1", "発端が欠落・願望・出来事でない", c["inciting_is_lack"]["quote"])),
        single(F.coalesce(c["ending_explains"]["verdict"], F.lit(False)), one("3-3", "結が説明で閉じている", c["ending_explains"]["quote"])),
        many("similes", lambda x: one("3-4", "喩え先が抽象", F.when(F.coalesce(~x["concrete"], F.lit(False)), x["quote"]), None, x["vehicle"])),
        many("contradictions", lambda x: one("3-5", "矛盾", x["quote_a"], x["quote_b"], x["why"])),
        *[many(p[0], claim(*p[1:])) for p in plain])
    rows = judged.select(*key, F.col(body).alias("_b"), F.explode(listed).alias("c")).select(*key, "_b", "c.*")
    rows = rows.filter("item <> '3-4' or quote is not null")
    at = X.locate(F.col("_b"), F.col("quote"))
    fine = at.isNotNull() & (F.col("item") != "3-5") | at.isNotNull() & X.locate(F.col("_b"), F.col("other")).isNotNull()
    return rows.select(*key, "item", "label", "quote", "why", at.alias("position"), X.locate_paragraph(F.col("_b"), F.col("quote")).alias("paragraph"),
                       fine.alias("kept"), F.col("item").isin(*INFO_ITEMS).alias("info"))


def read_to_end(judged: DataFrame, key: list[str], body: str = "body", profile: Profile = JAPANESE) -> DataFrame:
    """(key, read): whether the last sentence given and the text's contain one another."""
    own = X.sentences(X.paragraphs(F.col(body)), profile)
    last, given = X.squeeze(F.get(own, F.size(own) - 1)), X.squeeze(F.col("answer.read_to_end.last_sentence"))
    return judged.select(*key, ((given != "") & (F.contains(last, given) | F.contains(given, last))).alias("read"))


def consensus(findings: DataFrame, story: str, judge: str, item: str = "item", place: str = "paragraph", text: str = "text") -> DataFrame:
    """(story, item, place, support, agreed, judges, text): findings of one item at one place together."""
    return findings.groupBy(story, item, place).agg(
        F.count("*").alias("support"), (F.count("*") >= 2).alias("agreed"), F.array_join(F.array_sort(F.collect_list(F.col(judge).cast("string"))), ", ").alias("judges"),
        F.min_by(text, judge).alias("text"))


def full_check(judged: DataFrame, story: str, judge: str, body: str = "body", targets: DataFrame | None = None, plot: str | None = None,
               profile: Profile = JAPANESE) -> DataFrame:
    """(story, judge, read, layer1, layer2, layer3, info, dropped, simile_count, explicitness): one row for each answer.

    layer1: what measures say of the text; layer2: structure against the bands; layer3: claims whose quotes are
    in the text, info: those for information only, dropped: how many have no quote there.
    """
    key = [story, judge]
    texts = judged.dropDuplicates([story]).select(story, F.col(body).alias("_body"), *([plot] if plot else []))
    first = text_problems(texts, targets, profile, story, "_body", plot).withColumnRenamed("problems", "layer1")
    second = structure_check(judged, key, body, plot).select(*key, F.col("problems").alias("layer2"))
    own = claims(judged, key, body)
    some = lambda test: F.transform(F.array_sort(F.filter("all", test)), lambda x: F.concat_ws(" ", x["item"], x["label"]))
    third = own.groupBy(*key).agg(F.collect_list(F.struct("item", "position", "label", "kept", "info")).alias("all")).select(
        *key, some(lambda x: x["kept"] & ~x["info"]).alias("layer3"), some(lambda x: x["kept"] & x["info"]).alias("info"),
        F.size(F.filter("all", lambda x: ~x["kept"])).alias("dropped"))
    verified = F.filter("answer.craft.similes", lambda x: X.locate(F.col(body), x["quote"]).isNotNull())
    last = judged.select(*key, F.greatest(F.size(verified), F.lit(0)).alias("simile_count"), F.col("answer.craft.turn_stated_by_character.degree").alias("explicitness"))
    out = read_to_end(judged, key, body, profile).join(first, story).join(second, key).join(third, key, "left").join(last, key)
    none = F.array().cast("array<string>")
    return out.select(*key, F.coalesce("read", F.lit(False)).alias("read"), "layer1", "layer2", F.coalesce("layer3", none).alias("layer3"), F.coalesce("info", none).alias("info"),
                      F.coalesce("dropped", F.lit(0)).alias("dropped"), "simile_count", "explicitness")


def agreement(judged: DataFrame, story: str, judge: str, body: str = "body", plot: str | None = None) -> DataFrame:
    """(story, valid, group, item, place, support, agreed, judges, text): what the judges of a story found, together.

    Judges who did not read to the end don't count; valid is the number of the others. Problems of structure
    meet by the words before their figures (group 層2), claims by item and paragraph; items that are for
    information only are left out. Rows of a story are in the order of support, most first, then group, item and place.
    """
    key = [story, judge]
    read = read_to_end(judged, key, body).filter("read").select(*key)
    valid = read.groupBy(story).agg(F.countDistinct(judge).alias("valid"))
    problems = structure_check(judged, key, body, plot).select(*key, F.explode("problems").alias("text"))
    label = F.split("text", "[:：（ ]")
    structural = problems.select(*key, F.lit("層2").alias("group"), F.get(label, F.lit(0)).alias("item"), F.lit(None).cast("int").alias("place"), "text")
    quote = F.concat(F.left("quote", F.lit(SHOWN)), F.when(F.length("quote") > SHOWN, "…").otherwise(""))
    worded = F.concat("item", F.lit(" "), "label", F.lit(": "), quote, F.when(F.col("why") != "", F.concat(F.lit(" — "), "why")).otherwise(""))
    craft = claims(judged, key, body).filter("kept and not info").select(*key, F.lit("層3").alias("group"), "item", F.col("paragraph").alias("place"), worded.alias("text"))
    found = structural.union(craft).join(read, key, "left_semi")
    groups = found.groupBy(story, "group", "item", "place").agg(
        F.count("*").alias("support"), F.array_join(F.array_sort(F.collect_list(F.col(judge).cast("string"))), ", ").alias("judges"),
        F.min_by("text", F.struct(judge, "text")).alias("text"))
    out = groups.join(valid, story).select(story, "valid", "group", "item", "place", "support", (F.col("support") >= 2).alias("agreed"), "judges", "text")
    return out.orderBy(story, F.desc("support"), "group", "item", "place")


def blinded(pairs: DataFrame, seed: int | Column, first: str = "a", second: str = "b") -> DataFrame:
    """pairs with A and B in place of the two, in an order that a hash of the seed and the pair decides."""
    keep = F.pmod(F.xxhash64(F.lit(seed) if isinstance(seed, int) else seed, F.col(first), F.col(second)), F.lit(2)) == 0
    others = [c for c in pairs.columns if c not in (first, second)]
    return pairs.select(*others, F.when(keep, F.col(first)).otherwise(F.col(second)).alias("A"), F.when(keep, F.col(second)).otherwise(F.col(first)).alias("B"))


def pair_check(answers_: DataFrame, bodies: DataFrame, key: str = "pair", name: str = "story", body: str = "body") -> DataFrame:
    """(key, winner, read_a, read_b, reasons, valid_reasons) of (key, A, B, answer): the winner by name, and how
    many reasons are backed by quotes from both stories."""
    a = bodies.select(F.col(name).alias("A"), F.col(body).alias("_a"))
    b = bodies.select(F.col(name).alias("B"), F.col(body).alias("_b"))
    both = answers_.join(a, "A", "left").join(b, "B", "left")
    won = F.col("answer.winner")
    fine = F.filter("answer.reasons", lambda r: X.locate(F.col("_a"), r["quote_a"]).isNotNull() & X.locate(F.col("_b"), r["quote_b"]).isNotNull())
    count = lambda c: F.when(c.isNull(), 0).otherwise(F.size(c))
    return both.select(key, "A", "B", F.when(won == "A", F.col("A")).when(won == "B", F.col("B")).otherwise(won).alias("winner"),
                       X.locate(F.col("_a"), F.col("answer.last_sentence_a")).isNotNull().alias("read_a"), X.locate(F.col("_b"), F.col("answer.last_sentence_b")).isNotNull().alias("read_b"),
                       count(F.col("answer.reasons")).alias("reasons"), count(fine).alias("valid_reasons"))


def reconciled(checked: DataFrame) -> DataFrame:
    """(first, second, winner, consistent): the two orders of a pair together; they must agree."""
    pair = checked.withColumn("first", F.least("A", "B")).withColumn("second", F.greatest("A", "B"))
    return pair.groupBy("first", "second").agg(F.when(F.countDistinct("winner") == 1, F.min("winner")).alias("winner"), (F.countDistinct("winner") == 1).alias("consistent"),
                                               F.count("*").alias("orders"))

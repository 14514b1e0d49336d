"""Registered queries over Japanese texts, with the Japanese profile. The texts are literals, which
the SQL holds as well, so these queries read no table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import chapters as C
from ..operators import checks as K
from ..operators import corpus as S
from ..operators import documents as D
from ..operators import quotes as Q
from ..profiles import CORPUS_NAMES, JAPANESE, SPARK
from . import oracle

#: As in the queries over the driver's tables.
LIMITS = {"min_chars": 300, "max_chars": 300_000, "min_sentences": 5, "max_mean_length": 400}

#: Fractions of the statistics that are rounded.
ROUNDED = ("sentence_length_mean", "dialogue_ratio", "kanji_ratio", "comma_per_sentence", "simile_per_1000")

_RAIN = ("　朝から雨が降っていた。雨が降ると庭の石は黒くなる。雨が降る日に限って兄は遅く帰った。雨が降らぬ日は早かった。\n"
         "「まだ帰らないの？」と妹が訊いた。「帰らないよ！」\n　屋根の上をころころと雨粒が走り、樋の中でごぼごぼと鳴った。まるで小さな獣のように走る音である。\n")
_ROAD = ("　道は白かった……。人影は一つもない。\n『遠いね』\n　彼の声は遠くの鐘のようだった。日が暮れたように思われる。道の先に灯が見えるようになった。あたかも星が地に落ちたごとくである。\n"
         "　――それきり何も聞えない。だんだん寒くなった。ひらひらと、ひらひらと、雪のような花が散った。\n")
_SCHOOL = "　学校へ行く途中で先生に会った。先生は笑った。学校の門は閉じていた。先生の顔は面に似て動かない。カバンの中のノートとカバンの外のノートとは違う、とカバンは言わない。\n"
_OLD = "　學校の庭に聲がした。國の體は變つた、と思ふ。ゐる者は皆歸つた。氣の毒である。\n"
_LONG = "「" + "これは長い語りであって会話ではない、" * 14 + "」\n"
TEXTS = (
    (1, "甲", "戦後", "一\n" + _RAIN + "二\n" + _ROAD + "三　終り\n" + _SCHOOL + "（大正四年九月）"),
    (2, "甲", "戦後", "第一章\n" + _ROAD * 3 + "第二章 雨\n" + _RAIN * 2 + _LONG + "あとがき\n" + _SCHOOL),
    (3, "乙", "明治", _OLD * 6 + _RAIN + _ROAD),
    (4, "乙", "大正", "その三\n" + _SCHOOL * 5 + _RAIN * 2 + "　ちょっとした学問の國である。\n"),
    (5, "丙", "戦後", ""),
    (6, "丙", "戦後", "上\n　\n\n序章\n　序文ではない。「え？」「お！」みたいな声。見紛うばかりの花と見紛う雪。心を思わせる水。\n" + _LONG * 2),
    (7, "丁", "戦後", "　" + "".join(f"{a}{a}と{b}{b}と鳴った。" for a in ("ころ", "ぱた", "さら", "ゆら", "きら", "そよ", "ばた", "ぐる")
                                     for b in ("しと", "ぽた", "わく", "どき", "ぴか", "むか", "うろ", "のろ")) + "\n" + _ROAD),
)


def works(spark) -> DataFrame:
    return spark.createDataFrame(list(TEXTS), "doc_id long, source string, lang string, text string")


def _parsed(spark):
    return D.parsed(works(spark), JAPANESE)


def ja_basic_stats(spark, d):
    return D.statistics(_parsed(spark), JAPANESE)


def ja_headings(spark, d):
    return D.headings(_parsed(spark), JAPANESE)


def ja_chapter_sizes(spark, d):
    """Works with three headings or more."""
    return D.chapter_sizes(ja_headings(spark, d))


def ja_rounded_stats(spark, d):
    return S.rounded(ja_basic_stats(spark, d).select("doc_id", *ROUNDED))


def ja_sentences(spark, d):
    return D.sentence_rows(_parsed(spark)).withColumn("position", F.col("acc") / F.col("total"))


def ja_tension_curve(spark, d):
    return D.tension_curve(D.sentence_rows(_parsed(spark)), JAPANESE)


def ja_peaks(spark, d):
    return D.peaks(ja_tension_curve(spark, d))


def ja_similes(spark, d):
    return D.similes(D.sentence_rows(_parsed(spark)), JAPANESE).withColumn("markers", F.array_join("markers", "/"))


def ja_reduplications(spark, d):
    return D.reduplications(_parsed(spark), JAPANESE)


def ja_vocabulary(spark, d):
    return D.vocabulary(_parsed(spark), JAPANESE)


def ja_openings_closings(spark, d):
    return D.openings_closings(_parsed(spark), JAPANESE).select("doc_id", F.array_join("opening", "|").alias("opening"), F.array_join("closing", "|").alias("closing"))


def ja_repetitions(spark, d):
    return D.repetitions(D.sentence_rows(_parsed(spark))).withColumn("sample", F.array_join("sample", "|"))


def ja_sample_measures(spark, d):
    return S.measure(works(spark), JAPANESE, carry=("lang", "source"), limits=LIMITS)


def ja_quantiles(spark, d):
    return S.quantiles(ja_sample_measures(spark, d), S.DISTRIBUTED)


def ja_reduplication_catalog(spark, d):
    """Doubled words of all works, and who uses them."""
    words = ja_reduplications(spark, d).join(works(spark).select("doc_id", "source"), "doc_id")
    return S.word_catalog(words, "source")


def ja_chapters(spark, d):
    """Chapters by heading, with their sizes."""
    return C.chapters(C.units(works(spark), JAPANESE, whole=False)).select("doc_id", "chapter", "label", "sections", F.length("text").alias("characters"))


def ja_heading_marks(spark, d):
    """Titles without the marks of a heading, as slugs, and safe for files."""
    marked = works(spark).select("doc_id", F.concat(F.lit("## 　"), "source", F.lit("/ "), "lang", F.lit(" の話")).alias("t"))
    return marked.select("doc_id", X.without_heading_marks(F.col("t")).alias("title"), X.short_slug(F.col("t")).alias("short"), X.safe_name(F.col("t")).alias("safe"))


#: Outlines of two lengths, one with a section too few: (doc_id, length, at, name, chars).
OUTLINES = ((1, 4000, 0, "起", 1), (1, 4000, 1, "承前", 2), (1, 4000, 2, "承後", 3), (1, 4000, 3, "転", 4), (1, 4000, 4, "結末", 5),
            (2, 9500, 0, "始", 900), (2, 9500, 1, "中", 800), (2, 9500, 2, "終", 700))


def ja_outlines(spark, d):
    """Outlines with the names and sizes of their plans."""
    return K.planned_outline(spark.createDataFrame(list(OUTLINES), "doc_id long, length long, at int, name string, chars long"))


#: Answers of three judges on the first work; the last did not read to the end.
_TURN = {"turns": [{"quote": "まるで小さな獣のように走る音", "type": "露見"}], "climax": {"quote": "学校の門は閉じていた。"}, "inciting": {"quote": "朝から雨が降っていた。"}}
_END = {"read_to_end": {"last_sentence": "（大正四年九月）"}}
ANSWERS = (
    ("イ", {**_END, "structure": {**_TURN, "knowledge_gap": "有"}, "craft": {"coincidences": [{"quote": "先生に会った。先生は笑った", "why": "偶然"}, {"quote": "どこにも無い引用", "why": "無"}]}}),
    ("ロ", {**_END, "structure": _TURN, "craft": {"coincidences": [{"quote": "先生に会った。", "why": "偶然"}], "telegraphed": [{"quote": "灯が見える", "why": "早い"}]}}),
    ("ハ", {"structure": _TURN, "craft": {"coincidences": [{"quote": "先生に会った。", "why": "偶然"}]}}),
)


def _judged(spark) -> DataFrame:
    raw = spark.createDataFrame([(1, j, "前置き\n```json\n" + json.dumps(a, ensure_ascii=False) + "\n```") for j, a in ANSWERS], "doc_id long, judge string, raw string")
    return Q.answers(raw).join(works(spark).select("doc_id", F.col("text").alias("body")), "doc_id")


def ja_agreement(spark, d):
    """What the judges who read to the end found together."""
    return Q.agreement(_judged(spark), "doc_id", "judge")


def ja_full_check(spark, d):
    """All checks of each answer."""
    out = Q.full_check(_judged(spark), "doc_id", "judge")
    return out.select("doc_id", "judge", "read", *[F.array_join(c, "|").alias(c) for c in ("layer1", "layer2", "layer3", "info")], "dropped", "simile_count", "explicitness")


def ja_text_problems(spark, d):
    """What measures say of each text."""
    return K.text_problems(works(spark), body="text").select("doc_id", F.array_join("problems", "|").alias("problems"))


NAMES = ("ja_chapter_sizes", "ja_rounded_stats", "ja_outlines", "ja_agreement", "ja_full_check", "ja_text_problems", "ja_basic_stats", "ja_headings", "ja_sentences", "ja_tension_curve", "ja_peaks", "ja_similes", "ja_reduplications", "ja_vocabulary", "ja_openings_closings",
         "ja_repetitions", "ja_sample_measures", "ja_quantiles", "ja_reduplication_catalog", "ja_chapters", "ja_heading_marks")


def queries() -> dict:
    return {name: globals()[name] for name in NAMES}


def oracle_sql() -> dict[str, str]:
    rows = ", ".join(f"({i}::BIGINT, {oracle._q(a)}, {oracle._q(e)}, {oracle._q(t)})" for i, a, e, t in TEXTS)
    shared = oracle.parts(JAPANESE)
    # the literals stand for the table of documents
    whole = oracle.profile_sql(shared, JAPANESE)
    documents = f"WITH documents AS (SELECT * FROM (VALUES {rows}) v(doc_id, source, lang, text)), "
    out = {name: documents + sql.removeprefix("WITH ") for name, sql in whole.items()}
    story = shared["base"].replace("WHERE NOT h)", ")")  # no line of a story is a heading
    names = ", ".join(f"({oracle._q(n)})" for n in CORPUS_NAMES)
    old = JAPANESE.old_letters + JAPANESE.old_kana
    out["ja_text_problems"] = documents + story.strip() + f""",
fb AS (SELECT doc_id, count(*) FILTER (WHERE acc / total < 0.5) AS front, count(*) FILTER (WHERE acc / total >= 0.5) AS back FROM sa WHERE {shared['marked']} GROUP BY doc_id),
pb AS (SELECT doc_id, 1 AS k, '直喩が偏っている: 前半 ' || front || ' / 後半 ' || back AS t FROM fb WHERE front + back >= 3 AND NOT ((front + 0.5::DOUBLE) / (back + 0.5::DOUBLE) BETWEEN 0.5 AND 2.0)
       UNION ALL SELECT doc_id, 2, '正書法が新字新仮名でない' FROM documents
       WHERE text = '' OR (length(text) - length(regexp_replace(text, '[{old}]', '', 'g'))) * 1000 / length(text) >= 0.3
       UNION ALL SELECT doc_id, 3, '参照作品の固有名詞「' || name || '」が出ている' FROM documents, (VALUES {names}) v(name) WHERE contains(text, name))
SELECT d.doc_id, coalesce(string_agg(t, '|' ORDER BY k, t), '') AS problems FROM documents d LEFT JOIN pb ON d.doc_id = pb.doc_id GROUP BY d.doc_id"""
    out["ja_heading_marks"] = documents + """m AS (SELECT doc_id, '## 　' || source || '/ ' || lang || ' の話' AS t FROM documents)
SELECT doc_id, ltrim(t, '# 　') AS title, left(regexp_replace(t, '[\\\\/:*?"<>|\\s　]', '', 'g'), 24) AS short, replace(replace(t, '/', '_'), ' ', '_') AS safe FROM m"""
    out["ja_chapter_sizes"] = f"""WITH h AS ({out['ja_headings']}),
z AS (SELECT *, count(*) OVER w AS n, min(characters) OVER w AS lo, max(characters) OVER w AS hi FROM h WINDOW w AS (PARTITION BY doc_id))
SELECT doc_id, any_value(n) AS chapters, any_value(lo) AS shortest, any_value(hi) AS longest, string_agg(CASE WHEN hi = lo THEN '{SPARK[0]}'
       ELSE substr('{SPARK}', least(floor((characters - lo) / (hi - lo) * 7), 7)::INTEGER + 1, 1) END, '' ORDER BY index) AS spark FROM z WHERE n >= 3 GROUP BY doc_id"""
    out["ja_rounded_stats"] = f"SELECT doc_id, {', '.join(f'round_even({c}, 3) AS {c}' for c in ROUNDED)} FROM ({out['ja_basic_stats']})"
    rows = ", ".join(f"({i}::BIGINT, {n}::BIGINT, {at}::INTEGER, {oracle._q(name)}, {chars}::BIGINT)" for i, n, at, name, chars in OUTLINES)
    plans = oracle.oracle_sql()["section_plans"].replace("FROM documents", "FROM o")
    out["ja_outlines"] = f"""WITH o AS (SELECT *, length AS n_chars FROM (VALUES {rows}) v(doc_id, length, "at", name, chars)), p AS ({plans})
SELECT doc_id, o.length, o."at", coalesce(p.name, o.name) AS name, coalesce(p.chars, o.chars) AS chars,
       count(*) OVER (PARTITION BY doc_id) = (SELECT count(*) FROM p q WHERE q.length = o.length) AS fits FROM o LEFT JOIN p ON o.length = p.length AND p."at" = o."at" """
    return out

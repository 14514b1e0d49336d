"""Corpus, chapter, check and quote operators on small literal inputs."""

import json
import math

from pyspark.sql import functions as F

from textloom.operators import chapters as C
from textloom.operators import checks as K
from textloom.operators import corpus as S
from textloom.operators import quotes as Q
from textloom.plans import queries
from textloom.profiles import DOWN, JAPANESE, UP


def test_quantile_takes_the_low_index(spark):
    rows = spark.createDataFrame([(float(i),) for i in range(5)], "m double")
    got = S.quantiles(rows, ("m",)).first()
    assert (got.p10, got.p25, got["median"], got.p75, got.p90) == (0.0, 1.0, 2.0, 3.0, 3.0)


def test_quantiles_and_medians_against_sorted_lists(spark):
    import random
    import statistics

    rng = random.Random(1)
    values = [(rng.choice("ab"), rng.choice([0.0, -1.5, rng.gauss(30, 9), rng.expovariate(2.0), None]), float(rng.randrange(4))) for _ in range(700)]
    rows = spark.createDataFrame(values, "g string, x double, y double")
    for g in "ab":
        own = sorted(x for h, x, _ in values if h == g and x is not None)
        got = S.quantiles(rows, ("x", "y"), ("g",)).filter((F.col("g") == g) & (F.col("metric") == "x")).first()
        assert [got[n] for n, _ in S.QUANTILES] == [own[int(p * (len(own) - 1))] for _, p in S.QUANTILES]
    got = S.medians(rows, ("x", "y")).first()
    assert (got.x, got.y) == (statistics.median(x for _, x, _ in values if x is not None), statistics.median(y for *_, y in values))
    assert S.medians(rows.filter("false"), ("x",)).first().x is None


def test_spearman_and_median(spark):
    sizes = [100, 300, 200, 400]
    rows = spark.createDataFrame([(1, i, "x", None, 1, "中", s, 0.0, float(i), "会話", i == 0) for i, s in enumerate(sizes)],
                                 "doc_id long, chapter int, label string, part string, sections int, level string, characters long, dialogue_ratio double, position double, ending string, opens_with_dialogue boolean")
    got = C.novels(rows, least_chars=1).first()
    assert (got.chapter_length_median, got.length_trend, got.longest_chapter_position, got.parts) == (250.0, 1 - 6 * 2 / (4 * 15), 3.0, 0)
    assert got.dialogue_peak_position == 0.0 and got.ending_share_0 == 1.0 and got.opens_with_dialogue_share == 0.25


def test_units_and_chapters(spark):
    long_ = "あ" * 40
    text = f"題\n作者\n\n［＃「一の一」は中見出し］\n{long_}\n［＃「一の二」は中見出し］\n{long_}\n［＃「二」は中見出し］\n{long_}。\n底本：x"
    docs = spark.createDataFrame([(1, text), (2, f"題\n\n{long_}")], "doc_id long, text string")
    got = C.chapters(C.units(docs)).orderBy("doc_id", "chapter").collect()
    assert [(r.doc_id, r.label, r.sections) for r in got] == [(1, "一", 2), (1, "二", 1), (2, "（全体）", 1)]
    measured = C.measured(C.chapters(C.units(docs)), JAPANESE).orderBy("doc_id", "chapter").collect()
    assert measured[0].characters == 81 and measured[0].position == 0.0


def test_violations_and_advice(spark):
    metrics = spark.createDataFrame([(1, 800, 30.0, 0.5, 1.0, 3, 0.3), (2, 1000, 36.0, 0.6, 1.1, 3, 0.1)],
                                    "doc_id long, characters long, sentence_length_mean double, sentence_length_cv double, simile_per_1000 double, simile_count long, dialogue_ratio double")
    targets = spark.createDataFrame([(1000.0, 36.0, 0.6, 1.0, 0.1)], "characters double, sentence_length_mean double, sentence_length_cv double, simile_per_1000 double, dialogue_ratio double")
    got = {(r.doc_id, r.metric): (r.direction, r.marginal) for r in K.violations(metrics, targets).collect()}
    assert got == {(1, "characters"): (UP, False), (1, "dialogue_ratio"): (DOWN, False)}
    assert K.advice(K.violations(metrics, targets)).count() == 2
    zero = targets.withColumn("simile_per_1000", F.lit(0.0))
    assert {r.metric: r.marginal for r in K.violations(metrics, zero).filter("doc_id = 2").collect()} == {"simile_per_1000": None}


def test_plans(spark):
    plan = K.section_plan(spark.createDataFrame([(3000,), (9000,)], "length long")).orderBy("length", "at").collect()
    assert [r.chars for r in plan if r.length == 3000] == [300, 1050, 1050, 360, 150] and sum(r.length == 9000 for r in plan) == 7
    drafts = spark.createDataFrame([(1, 0, 3), (1, 1, 1), (1, 2, 1)], "doc_id long, round int, violations int")
    assert K.best_draft(drafts).first().round == 2
    names = K.borrowed_names(spark.createDataFrame([(1, "メロスは怒った")], "doc_id long, text string")).collect()
    assert [r.name for r in names] == ["メロス"]


BODY = "朝が来て、彼は金を失った。" + "それから長い道を歩いた。" * 20 + "ついに真実を知ったのである。" + "風が吹いた。" * 4 + "帰り着いて泣いた。"


def test_structure_and_claims(spark):
    answer = {"read_to_end": {"last_sentence": "帰り着いて泣いた。"}, "structure": {
        "inciting": {"quote": "朝が来て、彼は金を失った。"}, "units": [{"quote": "無い引用の文です"}], "turns": [{"quote": "ついに真実を知った", "type": "露見"}],
        "climax": {"quote": "帰り着いて泣いた。"}, "ending": {"type": "説明"}, "knowledge_gap": "同時"},
        "craft": {"coincidences": [{"quote": "風が吹いた。風が吹いた。", "why": "x"}, {"quote": "書かれていない文", "why": "y"}],
                  "contradictions": [{"quote_a": "それから長い道を歩いた。", "quote_b": "どこにも無いのだ", "why": "z"}], "telegraphed": [{"quote": "風が吹いた。風", "why": "w"}]}}
    raw = spark.createDataFrame([("s", "j", BODY, "```json\n" + json.dumps(answer, ensure_ascii=False) + "\n```"), ("s", "k", BODY, "no json")], "story string, judge string, body string, raw string")
    judged = Q.answers(raw)
    row = Q.structure_check(judged, ["story", "judge"]).filter("judge = 'j'").first()
    assert row.inciting == 0.0 and "承の単位のうち 1 件の引用が本文に無い" in row.problems and "結が説明で閉じている" in row.problems and row.turn is not None
    found = {(r.item, r.why): (r.kept, r.info) for r in Q.claims(judged, ["story", "judge"]).collect()}
    assert found == {("3-6", "x"): (True, False), ("3-6", "y"): (False, False), ("3-5", "z"): (False, False), ("3-7", "w"): (True, True)}
    assert {r.judge: r.read for r in Q.read_to_end(judged, ["judge"]).collect()}["j"] is True


def test_agreement_and_full_check(spark):
    end = {"read_to_end": {"last_sentence": "帰り着いて泣いた。"}}
    turn = {"turns": [{"quote": "朝が来て、彼は", "type": "露見"}], "climax": {"quote": "帰り着いて泣いた。"}, "inciting": {"quote": "朝が来て、彼は金を失った。"}, "knowledge_gap": "有"}
    wind = lambda *q: {"coincidences": [{"quote": x, "why": "w"} for x in q]}
    said = {"a": end | {"structure": turn, "craft": wind("風が吹いた。風が", "無い引用の文です")}, "b": end | {"structure": turn, "craft": wind("風が吹いた。風が吹いた。")},
            "c": {"structure": turn, "craft": wind("風が吹いた。風が")}, "d": end | {"structure": turn | {"knowledge_gap": ""}, "craft": {"similes": [{"quote": "長い道を歩いた", "concrete": True}]}}}
    raw = spark.createDataFrame([("s", j, BODY + "メロス" * 0, json.dumps(x, ensure_ascii=False)) for j, x in said.items()], "story string, judge string, body string, raw string")
    judged = Q.answers(raw)
    rows = Q.agreement(judged, "story", "judge").collect()
    assert [(r.group, r.item, r.support, r.agreed, r.judges, r.valid) for r in rows] == [
        ("層2", "転の位置", 3, True, "a, b, d", 3), ("層3", "3-6", 2, True, "a, b", 3), ("層2", "知識差が答えられていない", 1, False, "d", 3)]
    assert rows[0].text == "転の位置 0.0%（露見: 基準 70〜89%）" and rows[1].text == "3-6 都合のよい展開: 風が吹いた。風が — w"
    full = {r.judge: r for r in Q.full_check(judged, "story", "judge").collect()}
    assert {j: r.read for j, r in full.items()} == {"a": True, "b": True, "c": False, "d": True}
    assert full["a"].layer3 == ["3-6 都合のよい展開"] and full["a"].dropped == 1 and full["d"].simile_count == 1 and full["a"].layer1 == []
    texts = spark.createDataFrame([("s", "メロスは學校へ行く。"), ("t", BODY), ("u", None)], "story string, body string")
    targets = spark.createDataFrame([(1000.0, 36.0, 0.6, 0.0, 0.1)], "characters double, sentence_length_mean double, sentence_length_cv double, simile_per_1000 double, dialogue_ratio double")
    plain = {r.story: r.problems for r in K.text_problems(texts, key="story").collect()}
    assert plain == {"s": ["正書法が新字新仮名でない", "参照作品の固有名詞「メロス」が出ている"], "t": [], "u": ["正書法が新字新仮名でない"]}
    assert any(p.startswith("字数 ") for p in {r.story: r.problems for r in K.text_problems(texts, targets, key="story").collect()}["t"])


def test_clusters_consensus_pairs(spark):
    turns = spark.createDataFrame([("s", 10.0), ("s", 15.0), ("s", 60.0), ("s", 66.0), ("s", None)], "story string, position double")
    row = Q.adopted_turns(turns, ["story"]).first()
    assert row.turn == 60.0 and row.earlier == [10.0]
    findings = spark.createDataFrame([("s", "a", "3-6", 1, "t"), ("s", "b", "3-6", 1, "u"), ("s", "a", "3-8", None, "v")], "story string, judge string, item string, paragraph int, text string")
    got = {(r.item): (r.support, r.agreed, r.judges) for r in Q.consensus(findings, "story", "judge").collect()}
    assert got == {"3-6": (2, True, "a, b"), "3-8": (1, False, "a")}
    checked = spark.createDataFrame([("x", "y", "x"), ("y", "x", "x"), ("p", "q", "p"), ("q", "p", "q")], "A string, B string, winner string")
    assert {r[0]: r[1] for r in Q.reconciled(checked).select("first", "consistent").collect()} == {"x": True, "p": False}


def test_occurrences_agree_both_ways(spark):
    quotes = spark.createDataFrame([(1, "長い 道を歩"), (2, "無い文"), (3, "彼は金を失った。それから")], "item_id long, text string")
    texts = spark.createDataFrame([(7, BODY), (8, "空")], "doc_id long, text string")
    small = Q.occurrences(quotes, texts, "item_id", "doc_id")
    large = Q.occurrences(quotes, texts, "item_id", "doc_id", most=0)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect())) and {r.item_id for r in small.collect()} == {1, 3}


def test_sample_counts_what_it_scans(spark):
    rows = spark.range(1000).withColumnRenamed("id", "doc_id").withColumn("v", F.col("doc_id") % 2)
    chosen, scanned = S.sample(rows, F.col("v") == 0, 50)
    assert chosen.count() == 50 and 50 <= scanned.first().scanned <= 200
    chosen, scanned = S.sample(rows, F.col("v") == 0, 5000)
    assert chosen.count() == 500 and scanned.first().scanned == 1000


def test_rounding_leaves_maps_out(spark):
    rows = spark.sql("select 1 as n, 0.0625D as x, 2.71828D as y, cast(null as double) as z, map('a', 1) as m")
    assert S.rounded(rows).first().asDict() == {"n": 1, "x": 0.062, "y": 2.718, "z": None}


def test_violated_metrics_are_a_set(spark):
    rows = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (None, "a")], "doc_id long, metric string")
    assert {r.doc_id: r.metrics for r in K.violated(rows).collect()} == {1: ["a", "b"], None: ["a"]}


def _documents(spark, folder, *texts):
    """A folder with these texts as its documents, from 1."""
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    return str(folder)


#: The first is a heading only, so it has no sentences; lengths of the others spread by 1/3 and 0.
HEADING, SPREAD, EVEN = "Word", "Aa bb. Cc.", "Aaa. Bbb."


def test_band_violations_where_a_document_has_no_sentences(spark, tmp_path):
    got = queries.band_violations(spark, _documents(spark, tmp_path, HEADING, SPREAD, EVEN)).filter("metric = 'sentence_length_cv'").collect()
    assert {(r.doc_id, r.current, r.target) for r in got} == {(1, 0.0, 1.5 / 4.5), (3, 0.0, 1.5 / 4.5)}  # 0 / 0 is the last of three


def test_style_targets_where_documents_have_no_sentences(spark, tmp_path):
    few = queries.style_targets(spark, _documents(spark, tmp_path / "few", HEADING, SPREAD, EVEN)).first()
    assert (few.sentence_length_mean, few.sentence_length_cv, few.works) == (4.0, 1.5 / 4.5, 3)
    most = queries.style_targets(spark, _documents(spark, tmp_path / "most", HEADING, HEADING, EVEN)).first()
    assert most.sentence_length_mean == 0.0 and math.isnan(most.sentence_length_cv) and most.works == 3


def test_what_is_no_number_is_last_in_order(spark):
    values = [float("-inf"), -2.0, 0.0, 0.5, 5.0, float("inf"), float("inf"), float("nan"), float("nan")]
    rows = spark.createDataFrame([(v,) for v in reversed(values)], "x double")
    got = S.order_statistics(rows, ("x",), {f"r{i}": (lambda n, i=i: F.lit(i)) for i in range(len(values))}).first()
    assert [repr(got[f"r{i}"]) for i in range(len(values))] == [repr(v) for v in values] and got.n == len(values)


def test_violated_metrics_where_a_document_has_no_sentences(spark, tmp_path):
    got = queries.violated_metrics(spark, _documents(spark, tmp_path, HEADING, SPREAD, EVEN)).collect()
    assert {r.doc_id: r.metrics for r in got} == {1: "characters,sentence_length_cv", 2: "characters", 3: "characters,sentence_length_cv"}

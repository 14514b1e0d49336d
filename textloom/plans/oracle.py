"""DuckDB SQL for the registered queries: written from the definitions, over exploded rows."""

from __future__ import annotations

from ..operators.corpus import DISTRIBUTED
from ..profiles import ADVICE, CHECKS, DIALOGUE_TOLERANCE, ERAS, LATIN, MARGIN, PROFILE_METRICS, QUANTILES, SPARK, Profile

def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^[\\s　]+|[\\s　]+$', '', 'g')"


def _count(c: str, *parts: str) -> str:
    return " + ".join(f"(length({c}) - length(replace({c}, {_q(p)}, ''))) // {len(p)}" for p in parts)


def _ratio(c: str, letters: str) -> str:
    return f"CASE WHEN length({c}) > 0 THEN (length({c}) - length(regexp_replace({c}, '[{letters}]', '', 'g'))) / length({c}) ELSE 0.0 END"


def _marks(P: Profile) -> dict[str, str]:
    """A test in SQL for each simile marker. DuckDB's patterns can't look ahead: then a place must begin with
    the one part of the pattern and not go on with the other."""
    tests = {}
    for name, pattern in P.markers.items():
        if "(?!" not in pattern:
            tests[name] = f"regexp_matches(s, {_q(pattern)})"
            continue
        before, rest = pattern.split("(?!")
        cut = rest.rindex(")")
        tests[name] = (f"len(list_filter(generate_series(1, length(s)), lambda i: regexp_matches(substr(s, i), {_q('^' + before + rest[cut + 1:])}) "
                       f"AND NOT regexp_matches(substr(s, i), {_q('^' + before + '(' + rest[:cut] + ')')}))) > 0")
    return tests


#: Words of a text that double two or three letters: (doc_id, word, pos), with what DuckDB's patterns can't say as conditions.
def _doubled(P: Profile) -> str:
    kana = f"[{P.kana}]"
    one = " UNION ALL ".join(
        f"SELECT doc_id, {n} AS k, i, substr(body, i, {2 * n}) AS word FROM (SELECT doc_id, body, unnest(generate_series(1, length(body))) AS i FROM bo) "
        f"WHERE regexp_matches(substr(body, i, {2 * n}), '^{kana}{{{2 * n}}}$') AND substr(body, i, {n}) = substr(body, i + {n}, {n}) AND NOT regexp_matches(substr(body, i - 1, 1), '{kana}')"
        for n in (2, 3))
    return f"""
rw AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY k, i) AS pos FROM ({one}) WHERE word NOT IN ({", ".join(map(_q, P.stopwords))})),
rc AS (SELECT doc_id, word, count(*) AS count, min(pos) AS pos FROM rw GROUP BY doc_id, word),
ro AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY count DESC, pos) AS rank, word, count FROM rc)"""


def parts(P: Profile) -> dict[str, str]:
    """The steps that queries share, for a profile."""
    head = "|".join(f"(?:{p})" for p in P.headings)
    tests = _marks(P)
    marked = "(" + " OR ".join(tests.values()) + ")"
    doubled = "coalesce((SELECT sum(count) FROM ro WHERE ro.doc_id = st.doc_id AND rank <= 40), 0) * 1000 / characters" if P.kana else "0.0::DOUBLE"
    #: pa: paragraphs; ke: those that are no headings; bo: bodies; se: sentences; sa: with sums before.
    base = f"""
pa AS (SELECT * FROM (SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) AS ix FROM documents)
       WHERE regexp_matches(p, '[^\\s　]')),
ph AS (SELECT *, length({_strip('p')}) <= {P.heading_length} AND NOT contains(p, '{P.full_stop}') AND regexp_matches({_strip('p')}, {_q(head)}) AS h FROM pa),
ke AS (SELECT * FROM ph WHERE NOT h),
bo AS (SELECT d.doc_id, d.source, d.lang, coalesce(string_agg(p, chr(10) ORDER BY ix), '') AS body, count(p) AS np,
              count(*) FILTER (WHERE regexp_matches(p, {_q(P.dialogue_head)})) AS nd
       FROM documents d LEFT JOIN ke ON d.doc_id = ke.doc_id GROUP BY d.doc_id, d.source, d.lang),
s0 AS (SELECT doc_id, ix, unnest(regexp_extract_all(p, {_q(P.sentence)})) AS r, generate_subscripts(regexp_extract_all(p, {_q(P.sentence)}), 1) AS jx FROM ke),
s1 AS (SELECT doc_id, ix, jx, {_strip('r')} AS s FROM s0),
se AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ix, jx) - 1 AS ix, s, length(s) AS len FROM s1 WHERE s <> ''),
sa AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY doc_id ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS acc,
              sum(len) OVER (PARTITION BY doc_id)::BIGINT AS total FROM se)"""

    qu = f"""
qu AS (SELECT doc_id, unnest(regexp_extract_all(body, {_q(P.quote)})) AS q FROM bo),
qs AS (SELECT doc_id, coalesce(sum(length(q)) FILTER (WHERE length(q) <= {P.dialogue_limit}), 0) AS short,
              coalesce(sum(length(q)) FILTER (WHERE length(q) > {P.dialogue_limit}), 0) AS long, sum(length(q)) / count(*) AS span FROM qu GROUP BY doc_id)"""

    stats = f"""
sn AS (SELECT doc_id, count(*) AS n, sum(len)::BIGINT AS sl, sum(len::BIGINT * len)::BIGINT AS sq, max(len) AS mx, list_sort(list(len)) AS ls,
              count(*) FILTER (WHERE {marked} AND len BETWEEN 10 AND 160) AS nsim FROM se GROUP BY doc_id),
st AS (SELECT bo.doc_id, bo.source, bo.lang, body, length(body)::BIGINT AS characters, np AS paragraphs, coalesce(n, 0)::BIGINT AS sentences,
              coalesce(sl / n, 0.0) AS sentence_length_mean, coalesce((ls[(n + 1) // 2] + ls[n // 2 + 1]) / 2, 0.0) AS sentence_length_median,
              coalesce(sqrt((n * sq - sl * sl)::DOUBLE) / n, 0.0) AS sentence_length_stdev, coalesce(mx, 0)::BIGINT AS sentence_length_max,
              CASE WHEN length(body) > 0 THEN coalesce(short, 0) / length(body) ELSE 0.0 END AS dialogue_ratio,
              CASE WHEN length(body) > 0 THEN coalesce(long, 0) / length(body) ELSE 0.0 END AS quoted_narration_ratio, coalesce(span, 0.0) AS quote_span_mean,
              CASE WHEN np > 0 THEN nd / np ELSE 0.0 END AS dialogue_paragraph_ratio,
              CASE WHEN body = '' THEN '不明' WHEN sc >= 1.5 THEN '旧字旧仮名' WHEN sc >= 0.3 THEN '混在' ELSE '新字新仮名' END AS orthography,
              {", ".join(f"{_ratio('body', v)} AS {k}_ratio" for k, v in P.classes.items())},
              CASE WHEN n > 0 THEN ({_count('body', P.comma)}) / n ELSE 0.0 END AS comma_per_sentence,
              {", ".join(f"CASE WHEN length(body) > 0 THEN ({_count('body', *parts)}) * 1000 / length(body) ELSE 0.0 END AS {name}_per_1000"
                         for name, parts in (("dash", (P.dash,)), ("ellipsis", (P.ellipsis,)), ("exclaim", P.exclaim), ("question", P.question)))},
              coalesce(nsim, 0)::BIGINT AS simile_count, CASE WHEN length(body) > 0 THEN coalesce(nsim, 0) * 1000 / length(body) ELSE 0.0 END AS simile_per_1000
       FROM (SELECT *, (length(left(body, 20000)) - length(regexp_replace(left(body, 20000), '[{P.old_letters + P.old_kana}]', '', 'g'))) / greatest(length(left(body, 20000)), 1) * 1000 AS sc FROM bo) bo
       LEFT JOIN sn ON bo.doc_id = sn.doc_id LEFT JOIN qs ON bo.doc_id = qs.doc_id)"""

    curve = f"""
sg AS (SELECT *, least(floor(acc / (total / 10)), 9)::INTEGER + 1 AS segment FROM sa),
sj AS (SELECT doc_id, segment, count(*) AS n, sum(len) AS chars, string_agg(s, '' ORDER BY ix) AS t FROM sg GROUP BY doc_id, segment),
sd AS (SELECT *, coalesce(list_sum([CASE WHEN length(q) <= {P.dialogue_limit} THEN length(q) ELSE 0 END FOR q IN regexp_extract_all(t, {_q(P.quote)})]), 0) AS spoken FROM sj),
cu AS (SELECT k.doc_id, k.segment, coalesce(n, 0)::BIGINT AS sentences, coalesce(chars / n, 0.0) AS sentence_length_mean, coalesce(spoken / chars, 0.0) AS dialogue_ratio,
              coalesce(({_count('t', *P.exclaim, *P.question)}) * 1000 / chars, 0.0) AS exclaim_question_per_1000,
              coalesce(({_count('t', P.dash, P.ellipsis)}) * 1000 / chars, 0.0) AS dash_ellipsis_per_1000
       FROM (SELECT doc_id, unnest(generate_series(1, 10))::INTEGER AS segment FROM (SELECT DISTINCT doc_id FROM se)) k LEFT JOIN sd ON k.doc_id = sd.doc_id AND k.segment = sd.segment),
pk AS (SELECT doc_id, CASE WHEN max(exclaim_question_per_1000) > 0 THEN (list(segment ORDER BY exclaim_question_per_1000 DESC, segment))[1] END AS exclaim_peak_segment,
              CASE WHEN max(dialogue_ratio) > 0 THEN (list(segment ORDER BY dialogue_ratio DESC, segment))[1] END AS dialogue_peak_segment FROM cu GROUP BY doc_id)"""

    sim = f"""
si AS (SELECT doc_id, ix, array_to_string(list_filter([{", ".join(f"CASE WHEN {t} THEN {_q(m)} END" for m, t in tests.items())}], lambda x: x IS NOT NULL), '/') AS markers,
              acc / total AS position, s AS text, row_number() OVER (PARTITION BY doc_id ORDER BY abs(len - 55), ix) AS rank
       FROM sa WHERE {marked} AND len BETWEEN 10 AND 160)"""

    voc = f"""
vw AS (SELECT doc_id, source, unnest(regexp_extract_all(body, {_q(P.words)})) AS word, generate_subscripts(regexp_extract_all(body, {_q(P.words)}), 1) AS pos FROM bo),
vc AS (SELECT doc_id, source, word, count(*) AS count, min(pos) AS pos FROM vw GROUP BY doc_id, source, word),
vo AS (SELECT doc_id, source, row_number() OVER (PARTITION BY doc_id ORDER BY count DESC, pos) AS rank, word, count FROM vc),
vk AS (SELECT * FROM vo WHERE rank <= 40 AND count >= 3)"""

    #: Notes at a text's end are dropped, then what may be in a sample is measured.
    measure = f"""
nl AS (SELECT se.*, max(ix) FILTER (WHERE NOT regexp_matches(s, {_q(P.trailing_note)})) OVER (PARTITION BY doc_id) AS last FROM se),
ns AS (SELECT doc_id, ix, s, len FROM nl WHERE ix <= last),
na AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY doc_id ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS acc, sum(len) OVER (PARTITION BY doc_id)::BIGINT AS total FROM ns),
nn AS (SELECT doc_id, count(*) AS n, sum(len)::BIGINT AS sl, sum(len::BIGINT * len)::BIGINT AS sq, max(len) AS mx, min_by(len, ix) AS fl, max_by(len, ix) AS ll,
              count(*) FILTER (WHERE {marked} AND len BETWEEN 10 AND 160) AS nsim FROM ns GROUP BY doc_id),
np AS (SELECT ns.doc_id, count(*) FILTER (WHERE len < fl) / count(*) AS fp, count(*) FILTER (WHERE len < ll) / count(*) AS lp FROM ns JOIN nn ON ns.doc_id = nn.doc_id GROUP BY ns.doc_id),
pr AS (SELECT doc_id, avg(length(p)) AS pm FROM ke WHERE NOT regexp_matches(p, {_q(P.dialogue_head)}) GROUP BY doc_id),
me AS (SELECT st.doc_id, st.lang, st.source, nn.sl / nn.n AS sentence_length_mean, nn.mx::BIGINT AS sentence_length_max,
              (sqrt((nn.n * nn.sq - nn.sl * nn.sl)::DOUBLE) / nn.n) / (nn.sl / nn.n) AS sentence_length_cv, ({_count('body', P.comma)}) / nn.n AS comma_per_sentence,
              fl::BIGINT AS first_sentence_length, fp AS first_sentence_percentile, ll::BIGINT AS last_sentence_length, lp AS last_sentence_percentile,
              coalesce(pm, 0.0) AS paragraph_length_mean, dialogue_ratio, exclaim_per_1000 + question_per_1000 AS exclaim_question_per_1000, dash_per_1000, ellipsis_per_1000,
              kanji_ratio, nn.nsim * 1000 / characters AS simile_per_1000, {doubled} AS reduplication_per_1000
       FROM st JOIN nn ON st.doc_id = nn.doc_id JOIN np ON st.doc_id = np.doc_id LEFT JOIN pr ON st.doc_id = pr.doc_id
       WHERE characters BETWEEN 300 AND 300000 AND orthography = '新字新仮名' AND nn.n >= 5 AND nn.sl / nn.n <= 400),
{curve.strip().replace('FROM sa)', 'FROM na)').replace('FROM se))', 'FROM ns))')},
mm AS (SELECT me.*, exclaim_peak_segment, dialogue_peak_segment, later AS dialogue_later_half FROM me JOIN pk ON me.doc_id = pk.doc_id
       JOIN (SELECT doc_id, avg(dialogue_ratio) FILTER (WHERE segment > 5) > avg(dialogue_ratio) FILTER (WHERE segment <= 5) AS later FROM cu GROUP BY doc_id) h ON me.doc_id = h.doc_id)"""
    return {"base": base, "qu": qu, "stats": stats, "curve": curve, "sim": sim, "voc": voc, "measure": measure, "marked": marked, "doubled": _doubled(P) if P.kana else ""}


_LATIN = parts(LATIN)
_BASE, _QU, _STATS, _CURVE, _SIM, _VOC, _MEASURE = (_LATIN[k] for k in ("base", "qu", "stats", "curve", "sim", "voc", "measure"))


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _quantiles(by: str = "", least: int = 0) -> str:
    keys = f"{by}, " if by else ""
    long_ = " UNION ALL ".join(f"SELECT {keys}'{m}' AS metric, {m}::DOUBLE AS v FROM mm" for m in DISTRIBUTED)
    values = ", ".join(f"list_sort(list(v))[floor({p} * (count(*) - 1))::INTEGER + 1] AS {name}" for name, p in QUANTILES)
    return f"SELECT {keys}metric, {values}{', count(*) AS n' if by else ''} FROM ({long_}) GROUP BY {keys}metric" + (f" HAVING count(*) >= {least}" if by else "")


def _means(columns) -> str:
    return ", ".join(f"avg({m}) AS {m}" for m in columns)


_STAT_COLUMNS = ("doc_id, characters, paragraphs, sentences, sentence_length_mean, sentence_length_median, sentence_length_stdev, sentence_length_max, dialogue_ratio, "
                 "quoted_narration_ratio, quote_span_mean, dialogue_paragraph_ratio, orthography, kanji_ratio, hiragana_ratio, katakana_ratio, comma_per_sentence, dash_per_1000, "
                 "ellipsis_per_1000, exclaim_per_1000, question_per_1000, simile_count, simile_per_1000")
_DOC = (_BASE, _QU, _STATS)
_ALL = (*_DOC, _MEASURE)

#: Stories: the first line is a title, numeral lines don't count.
_STORY = f"""
b0 AS (SELECT doc_id, source, lang, CASE WHEN contains({_strip('text')}, chr(10)) THEN {_strip(f"substr({_strip('text')}, strpos({_strip('text')}, chr(10)) + 1)")} ELSE {_strip('text')} END AS text FROM documents)"""
_STORY_BASE = _BASE.replace("FROM documents)", "FROM b0)").replace("FROM documents d", "FROM b0 d").replace("WHERE NOT h)", ")").replace(
    "coalesce(string_agg(p, chr(10) ORDER BY ix), '') AS body", "any_value(d.text) AS body")
_METRICS = """
ms AS (SELECT doc_id, lang, characters, sentence_length_mean, CASE WHEN sentence_length_mean > 0 THEN sentence_length_stdev / sentence_length_mean ELSE 0.0 END AS sentence_length_cv,
              simile_per_1000, simile_count, dialogue_ratio FROM st)"""


def _bands() -> str:
    rows = []
    for metric, _, _, band in CHECKS:
        low = f"greatest(0.0, t - {DIALOGUE_TOLERANCE})" if band is None else f"t * {band[0]}"
        high = f"t + {DIALOGUE_TOLERANCE}" if band is None else f"t * {band[1]}"
        rows.append(f"SELECT doc_id, '{metric}' AS metric, {metric}::DOUBLE AS current, t::DOUBLE AS target, ({low})::DOUBLE AS low, ({high})::DOUBLE AS high FROM (SELECT ms.*, tg.{metric} AS t FROM ms, tg)")
    return " UNION ALL ".join(rows)


def _suffixed(sql: str) -> str:
    """The same steps under other names, so that two bases stand side by side."""
    import re

    return re.sub(r"\b(pa|ph|ke|bo|s0|s1|se|sa|qu|qs|sn|st)\b", r"\1_w", sql)


_TARGET = """SELECT 1500.0::DOUBLE AS characters, median(sentence_length_mean) AS sentence_length_mean, median(sentence_length_stdev / sentence_length_mean) AS sentence_length_cv,
       median(simile_per_1000) AS simile_per_1000, median(dialogue_ratio) AS dialogue_ratio, count(*) AS works FROM """
_ADVICE = ", ".join(f"({_q(m)}, {_q(d)}, {_q(a)})" for m, d, a in ADVICE)
_TALK = "cv AS (SELECT conv_id * 1000 + turn AS doc_id, role AS source, role AS lang, text FROM conversations),"
_TALK_BASE = _BASE.replace("FROM documents)", "FROM cv)").replace("FROM documents d", "FROM cv d").replace("WHERE NOT h)", ")").replace(
    "coalesce(string_agg(p, chr(10) ORDER BY ix), '') AS body", "any_value(d.text) AS body")
_CHAPTER = f"""
lt AS (SELECT doc_id, max_by(s, ix) AS last FROM se GROUP BY doc_id),
op AS (SELECT doc_id, min_by(p, ix) AS p FROM pa GROUP BY doc_id),
ch AS (SELECT st.doc_id // 1000 AS conv_id, st.doc_id % 1000 AS chapter, source AS label, source AS part, 1 AS sections, '中' AS level, characters, sentences,
              coalesce(sum(characters) OVER (PARTITION BY st.doc_id // 1000 ORDER BY st.doc_id % 1000 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 100
                / greatest(sum(characters) OVER (PARTITION BY st.doc_id // 1000), 1) AS position, sentence_length_mean, dialogue_ratio,
              exclaim_per_1000 + question_per_1000 AS exclaim_question_per_1000, simile_per_1000, coalesce(regexp_matches(p, {_q(LATIN.dialogue_head)}), false) AS opens_with_dialogue,
              CASE WHEN last IS NULL THEN 'なし' WHEN regexp_matches(last, '^[«“]|[»”]$') THEN '会話' WHEN regexp_matches(last, '\\?[»”]*$') THEN '問い'
                   WHEN length(last) < sentence_length_mean * 0.5 THEN '短文' ELSE '地の文' END AS ending
       FROM st LEFT JOIN lt ON st.doc_id = lt.doc_id LEFT JOIN op ON st.doc_id = op.doc_id)"""
_NOVEL = """
nr AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY chapter) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY characters, chapter) AS r FROM ch),
nv AS (SELECT conv_id, count(*) AS n, count(DISTINCT part) AS parts, max(level) AS heading_level_used, sum(characters)::BIGINT AS characters, list_sort(list(characters)) AS ls,
              sum(characters * characters)::BIGINT AS sq, sum((i - r) * (i - r)) AS d2, min_by(characters, i) AS first, max_by(characters, i) AS last,
              (list(position ORDER BY characters DESC, i))[1] AS longest_chapter_position, (list(position ORDER BY dialogue_ratio DESC, i))[1] AS dialogue_peak_position,
              count(*) FILTER (WHERE ending = '会話') AS e0, count(*) FILTER (WHERE ending = '問い') AS e1, count(*) FILTER (WHERE ending = '短文') AS e2,
              count(*) FILTER (WHERE ending = '地の文') AS e3, count(*) FILTER (WHERE opens_with_dialogue) AS od FROM nr GROUP BY conv_id),
nm AS (SELECT *, (ls[(n + 1) // 2] + ls[n // 2 + 1]) / 2 AS med FROM nv WHERE characters >= 500)"""
_FLAT = lambda c: f"regexp_replace({c}, '\\s+', '', 'g')"
_RAW = """
ra AS (SELECT doc_id, lang, source, replace(text, ' the ', ' the ') || chr(10) || chr(10) || chr(10) || chr(10) || 'end' AS b, doc_id % 150 + 1868 AS year FROM documents),
cw AS (SELECT doc_id, 'Title ' || doc_id AS title, 'sub ' || lang AS subtitle, source AS author,
              regexp_replace(regexp_replace(regexp_replace(replace(b, chr(13), chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\n+|\\n+$', '', 'g'), '$', chr(10)) AS body, year::INTEGER AS year,
              CASE """ + " ".join(f"WHEN year BETWEEN {lo} AND {hi} THEN {_q(n)}" for n, lo, hi in ERAS) + """ END AS era, '著作権切れ' AS licence, 'Title_' || doc_id AS slug, 'Title_' || doc_id AS safe FROM ra)"""


def document_sql(shared: dict[str, str], P: Profile) -> dict[str, str]:
    """SQL of the queries that a profile's parts are enough for."""
    base, curve, sim, voc = (shared[k] for k in ("base", "curve", "sim", "voc"))
    doc = (base, shared["qu"], shared["stats"])
    every = (*doc, *([shared["doubled"].strip()] if shared["doubled"] else []), shared["measure"])
    return {
        "doc_basic_stats": _with(*doc) + f" SELECT {_STAT_COLUMNS} FROM st",
        "doc_headings": _with(base, """
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ix) - 1 AS n FROM ph),
rh AS (SELECT *, max(CASE WHEN h THEN n END) OVER (PARTITION BY doc_id ORDER BY n) AS of FROM rk)""") +
            f" SELECT doc_id, of::INTEGER AS index, max({_strip('p')}) FILTER (WHERE h) AS label, coalesce(sum(length(p)) FILTER (WHERE NOT h), 0)::BIGINT AS characters FROM rh WHERE of IS NOT NULL GROUP BY doc_id, of",
        "doc_sentences": _with(base) + " SELECT doc_id, ix::INTEGER AS ix, s, len::BIGINT AS len, acc, total, acc / total AS position FROM sa",
        "doc_tension_curve": _with(base, curve) + " SELECT * FROM cu",
        "doc_peaks": _with(base, curve) + " SELECT * FROM pk",
        "doc_similes": _with(base, sim) + " SELECT doc_id, ix::INTEGER AS ix, markers, position, text, rank::INTEGER AS rank FROM si WHERE rank <= 60",
        "doc_vocabulary": _with(base, voc) + " SELECT doc_id, rank::INTEGER AS rank, word, count FROM vk",
        "doc_openings_closings": _with(base, f"""
nl AS (SELECT se.*, max(ix) FILTER (WHERE NOT regexp_matches(s, {_q(P.trailing_note)})) OVER (PARTITION BY doc_id) AS last FROM se),
nk AS (SELECT * FROM nl WHERE ix <= last)""") + """
SELECT d.doc_id, coalesce(string_agg(s, '|' ORDER BY ix) FILTER (WHERE ix < 3), '') AS opening, coalesce(string_agg(s, '|' ORDER BY ix) FILTER (WHERE ix > last - 3), '') AS closing
FROM documents d LEFT JOIN nk ON d.doc_id = nk.doc_id GROUP BY d.doc_id""",
        "doc_repetitions": _with(base, """
rh AS (SELECT doc_id, ix, s, left(s, 4) AS head, lag(left(s, 4)) OVER (PARTITION BY doc_id ORDER BY ix) AS before FROM se),
rr AS (SELECT *, sum(CASE WHEN head = before AND length(head) >= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY ix) AS run FROM rh),
rg AS (SELECT doc_id, run, min(head) AS head, count(*) AS count, min(ix) AS start, list(s ORDER BY ix) AS ss FROM rr GROUP BY doc_id, run HAVING count(*) >= 3),
rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY count DESC, start) AS rank FROM rg)""") +
            " SELECT doc_id, rank::INTEGER AS rank, head, count, array_to_string(ss[2:4], '|') AS sample FROM rk WHERE rank <= 15",
        "corpus_measures": _with(*every) + " SELECT * FROM mm",
        "corpus_quantiles": _with(*every) + " " + _quantiles(),
    }


def profile_sql(shared: dict[str, str], P: Profile) -> dict[str, str]:
    """The same for literal texts, with doubled words."""
    names = {"doc_": "ja_", "corpus_measures": "ja_sample_measures", "corpus_quantiles": "ja_quantiles"}
    out = {}
    for name, sql in document_sql(shared, P).items():
        for old, new in names.items():
            name = name.replace(old, new)
        out[name] = sql
    doubled = _with(shared["base"], shared["doubled"])
    out["ja_reduplications"] = doubled + " SELECT doc_id, rank::INTEGER AS rank, word, count FROM ro WHERE rank <= 40"
    out["ja_reduplication_catalog"] = doubled + """
SELECT word, sum(count)::BIGINT AS total, array_to_string(list_sort(list(DISTINCT source)), '、') AS authors
FROM (SELECT * FROM ro WHERE rank <= 40) r JOIN documents USING (doc_id) GROUP BY word ORDER BY total DESC, word LIMIT 150"""
    return out


def oracle_sql() -> dict[str, str]:
    spark_step = f"CASE WHEN hi - lo < 1e-9 THEN {_q(SPARK[0])} ELSE substr({_q(SPARK)}, least(floor((sentences - lo) / (hi - lo) * 7), 7)::INTEGER + 1, 1) END"
    out = document_sql(_LATIN, LATIN) | {
        "doc_sparklines": _with(_BASE, _CURVE, "mx AS (SELECT *, min(sentences) OVER (PARTITION BY doc_id) AS lo, max(sentences) OVER (PARTITION BY doc_id) AS hi FROM cu)") +
            f" SELECT doc_id, string_agg({spark_step}, '' ORDER BY segment) AS spark FROM mx GROUP BY doc_id",
        "corpus_quantiles_by_era": _with(*_ALL) + " " + _quantiles("lang", 30),
        "corpus_quantiles_by_author": _with(*_ALL) + " " + _quantiles("source", 3),
        "corpus_shares": _with(*_ALL) + """
SELECT lang, count(*) AS n, avg(first_sentence_percentile) AS first_sentence_percentile_mean, avg(last_sentence_percentile) AS last_sentence_percentile_mean,
       avg(dialogue_later_half::INTEGER) FILTER (WHERE dialogue_ratio >= 0.05) AS dialogue_later_half_share_when_present,
       count(*) FILTER (WHERE exclaim_question_per_1000 = 0) / count(*) AS exclaim_question_zero_share, count(*) FILTER (WHERE dash_per_1000 = 0) / count(*) AS dash_zero_share,
       count(*) FILTER (WHERE ellipsis_per_1000 = 0) / count(*) AS ellipsis_zero_share,
       count(*) FILTER (WHERE dash_per_1000 >= 1 AND ellipsis_per_1000 >= 1) / count(*) AS dash_and_ellipsis_heavy_share,
       (count(*) FILTER (WHERE dash_per_1000 >= 1) / count(*)) * (count(*) FILTER (WHERE ellipsis_per_1000 >= 1) / count(*)) AS dash_and_ellipsis_heavy_expected_if_independent
FROM mm GROUP BY lang""",
        "corpus_peak_shares": _with(*_ALL) + """
SELECT k.segment::INTEGER AS segment, count(exclaim_peak_segment) / (SELECT count(exclaim_peak_segment) FROM mm) AS share
FROM (SELECT unnest(generate_series(1, 10)) AS segment) k LEFT JOIN mm ON k.segment = exclaim_peak_segment GROUP BY k.segment""",
        "corpus_marker_shares": _with(_BASE, _SIM) + """
SELECT marker, count(*) AS count, count(*) / (sum(count(*)) OVER ()) AS share FROM (SELECT unnest(string_split(markers, '/')) AS marker FROM si) GROUP BY marker""",
        "author_profiles": _with(*_DOC) + " SELECT source, metric, value, whole, value - whole AS diff, CASE WHEN value - whole > whole * 0.15 THEN '↑' WHEN value - whole < -whole * 0.15 THEN '↓' ELSE '→' END AS arrow FROM (" +
            " UNION ALL ".join(f"SELECT source, '{m}' AS metric, avg({m}) AS value, (SELECT avg({m}) FROM st) AS whole FROM st GROUP BY source" for m in PROFILE_METRICS) + ")",
        "author_index": _with(*_DOC) + " SELECT source, count(*) AS works, sum(characters)::BIGINT AS characters, avg(sentence_length_mean) AS sentence_length_mean, avg(dialogue_ratio) AS dialogue_ratio FROM st GROUP BY source",
        "author_summaries": _with(*_DOC) + f" SELECT source, count(*) AS works, avg(sentence_length_stdev) / avg(sentence_length_mean) AS spread, {_means(m for m in PROFILE_METRICS if m != 'sentence_length_stdev')} FROM st GROUP BY source",
        "word_catalog": _with(_BASE, _VOC) + " SELECT word, sum(count)::BIGINT AS total, array_to_string(list_sort(list(DISTINCT source)), '、') AS authors FROM vk GROUP BY word ORDER BY total DESC, word LIMIT 150",
        "author_words": _with(_BASE, _VOC) + """
SELECT * FROM (SELECT source, word, sum(count)::BIGINT AS total, row_number() OVER (PARTITION BY source ORDER BY sum(count) DESC, word)::INTEGER AS rank FROM vk GROUP BY source, word) WHERE rank <= 30""",
        "story_metrics": _with(_STORY, _STORY_BASE, _QU, _STATS, _METRICS) + " SELECT * EXCLUDE (lang) FROM ms",
        "style_targets": _with(*_DOC) + " " + _TARGET + "st",
        "band_violations": _with(_STORY, _STORY_BASE, _QU, _STATS, _METRICS, *map(_suffixed, _DOC), f"tg AS ({_TARGET}st_w)", f"""
vi AS (SELECT *, CASE WHEN current < low THEN '上げる' ELSE '下げる' END AS direction, CASE WHEN current < low THEN (low - current) / nullif(low, 0.0) ELSE (current - high) / nullif(high, 0.0) END <= {MARGIN} AS marginal
       FROM ({_bands()}) WHERE NOT (current BETWEEN low AND high)),
ad AS (SELECT * FROM (VALUES {_ADVICE}) v(metric, direction, advice))""") + " SELECT metric, direction, doc_id, current, target, low, high, marginal, advice FROM vi JOIN ad USING (metric, direction)",
        "simile_balance": _with(_BASE, f"""
fb AS (SELECT doc_id, count(*) FILTER (WHERE acc / total < 0.5) AS front, count(*) FILTER (WHERE acc / total >= 0.5) AS back FROM sa WHERE {_LATIN['marked']} GROUP BY doc_id)""") +
            " SELECT doc_id, front, back, (front + 0.5::DOUBLE) / (back + 0.5::DOUBLE) AS ratio, NOT ((front + 0.5::DOUBLE) / (back + 0.5::DOUBLE) BETWEEN 0.5 AND 2.0) AS unbalanced FROM fb WHERE front + back >= 3",
        "quote_occurrences": f"""
WITH q AS (SELECT item_id, {_FLAT('text')} AS q FROM benchmark WHERE length({_FLAT('text')}) >= 4), t AS (SELECT doc_id, {_FLAT('text')} AS t FROM documents)
SELECT item_id, doc_id, (strpos(t, q) - 1) * 100 / length(t) AS position FROM q JOIN t ON contains(t, q)""",
        "quote_paragraphs": _with(_BASE, f"""
pn AS (SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id ORDER BY ix) - 1 AS n FROM pa),
qt AS (SELECT d.doc_id, {_FLAT('text')} AS t, {_FLAT("coalesce(p, '')")} AS q FROM documents d LEFT JOIN (SELECT * FROM pn WHERE n = 2) x ON d.doc_id = x.doc_id),
lo AS (SELECT *, CASE WHEN length(q) >= 4 THEN coalesce(nullif(strpos(t, q), 0), nullif(strpos(t, left(q, 20)), 0)) END AS pos FROM qt),
pp AS (SELECT lo.doc_id, min(n) AS paragraph FROM lo JOIN pn ON lo.doc_id = pn.doc_id WHERE length(q) >= 4 AND contains({_FLAT('p')}, left(q, 20)) GROUP BY lo.doc_id)""") +
            " SELECT lo.doc_id, (pos - 1) * 100 / length(t) AS position, paragraph::INTEGER AS paragraph, pos IS NOT NULL AS verified FROM lo LEFT JOIN pp ON lo.doc_id = pp.doc_id",
        "chapter_measures": "WITH " + _TALK + ",".join((_TALK_BASE, _QU, _STATS, _CHAPTER)) + " SELECT * FROM ch",
        "novel_summaries": "WITH " + _TALK + ",".join((_TALK_BASE, _QU, _STATS, _CHAPTER, _NOVEL)) + """
SELECT conv_id, n AS chapters, parts, heading_level_used, characters, med AS chapter_length_median, CASE WHEN n > 1 THEN sqrt((n * sq - characters * characters)::DOUBLE) / characters ELSE 0.0 END AS chapter_length_cv,
       CASE WHEN n >= 4 THEN 1 - 6 * d2 / (n * (n * n - 1)) END AS length_trend, longest_chapter_position, dialogue_peak_position, e0 / n AS ending_share_0, e1 / n AS ending_share_1,
       e2 / n AS ending_share_2, e3 / n AS ending_share_3, od / n AS opens_with_dialogue_share, CASE WHEN n > 1 THEN first / med END AS first_chapter_ratio, CASE WHEN n > 1 THEN last / med END AS last_chapter_ratio
FROM nm""",
        "event_gap_clusters": """
WITH e AS (SELECT user_id, epoch_us(ts) AS us, min(event_id) AS event_id FROM events GROUP BY user_id, epoch_us(ts)),
l AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) > 21600000000 THEN 1 ELSE 0 END AS new FROM e)
SELECT user_id, us AS "at", event_id, (sum(new) OVER (PARTITION BY user_id ORDER BY us))::BIGINT AS cluster FROM l""",
        "turn_clusters": _with(_BASE, _SIM, """
tp AS (SELECT doc_id, position * 100 AS ps FROM si),
tl AS (SELECT *, CASE WHEN ps - lag(ps) OVER (PARTITION BY doc_id ORDER BY ps) > 8 THEN 1 ELSE 0 END AS new FROM tp),
tc AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY ps) AS c FROM tl),
tm AS (SELECT doc_id, c, min(ps) AS ps FROM tc GROUP BY doc_id, c)""") + " SELECT doc_id, max(ps) AS turn, (count(*) - 1)::INTEGER AS earlier FROM tm GROUP BY doc_id",
        "finding_consensus": """
SELECT lang AS story, quality AS item, toxic AS paragraph, count(*) AS support, count(*) >= 2 AS agreed, string_agg(source, ', ' ORDER BY source) AS judges
FROM labels JOIN documents USING (doc_id) GROUP BY lang, quality, toxic""",
        "pair_checks": f"""
WITH d AS (SELECT * FROM documents WHERE length(text) > 40), p AS (SELECT source, min(doc_id) AS a, max(doc_id) AS b FROM d GROUP BY source HAVING min(doc_id) <> max(doc_id)),
x AS (SELECT p.*, {_FLAT('left(da.text, 30)')} AS qa, {_FLAT('left(db.text, 30)')} AS qb, {_FLAT('da.text')} AS ta, {_FLAT('db.text')} AS tb FROM p JOIN d da ON da.doc_id = a JOIN d db ON db.doc_id = b)
SELECT source AS pair, a::VARCHAR AS A, b::VARCHAR AS B, a::VARCHAR AS winner, contains(ta, qa) AND length(qa) >= 4 AS read_a, contains(tb, qb) AND length(qb) >= 4 AS read_b,
       2 AS reasons, CASE WHEN contains(ta, qa) AND contains(tb, qb) AND length(qa) >= 4 AND length(qb) >= 4 THEN 1 ELSE 0 END AS valid_reasons FROM x""",
        "cleaned_works": "WITH " + _RAW + " SELECT * FROM cw",
        "corpus_eras": "WITH " + _RAW + " SELECT coalesce(era, '-') AS era, count(*) AS works, sum(length(body))::BIGINT AS characters FROM cw GROUP BY 1",
        "kanji_numbers": """
SELECT DISTINCT p_partkey % 100 AS n, CASE WHEN p_partkey % 100 < 10 THEN substr('〇一二三四五六七八九', (p_partkey % 100)::INTEGER + 1, 1) ELSE
  (CASE WHEN p_partkey % 100 < 20 THEN '' ELSE substr('〇一二三四五六七八九', (p_partkey % 100 // 10)::INTEGER + 1, 1) END) || '十' ||
  (CASE WHEN p_partkey % 10 = 0 THEN '' ELSE substr('〇一二三四五六七八九', (p_partkey % 10)::INTEGER + 1, 1) END) END AS numeral FROM part""",
        "catalog_lookup": "SELECT DISTINCT '000' || (o_custkey * 2) AS wanted, c_name AS title, c_mktsegment AS author FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2",
        "best_drafts": """
SELECT l_orderkey AS doc_id, (list(l_linenumber ORDER BY l_suppkey % 4, l_linenumber DESC))[1] AS round, min(l_suppkey % 4) AS n FROM lineitem GROUP BY l_orderkey""",
        "section_plans": """
WITH l AS (SELECT DISTINCT n_chars AS length, CASE WHEN n_chars < 5000 THEN 2 WHEN n_chars < 9000 THEN 3 ELSE 4 END AS k FROM documents),
s AS (SELECT length, k, unnest(generate_series(0, k + 2)) AS i FROM l)
SELECT length, i::INTEGER AS "at", CASE WHEN i = 0 THEN '発端' WHEN i <= k THEN '承' || i WHEN i = k + 1 THEN '転' ELSE '結' END AS name,
       round_even(CASE WHEN i = 0 THEN length * 0.1::DOUBLE WHEN i <= k THEN length * 0.7::DOUBLE / k WHEN i = k + 1 THEN length * 0.12::DOUBLE ELSE length * 0.05::DOUBLE END, 0)::BIGINT AS chars FROM s""",
        "fitted_chapters": """
WITH r AS (SELECT conv_id, turn, 20000.0::DOUBLE / count(*) OVER (PARTITION BY conv_id) AS e, nullif(length(text), 0)::DOUBLE AS c FROM conversations),
w AS (SELECT *, least(greatest(coalesce(c, e), e * 0.65::DOUBLE), e * 1.35::DOUBLE) AS raw FROM r)
SELECT conv_id, turn, (round_even(raw * 20000.0::DOUBLE / sum(raw) OVER (PARTITION BY conv_id) / 10, 0) * 10)::BIGINT AS chars FROM w""",
    }
    out["violated_metrics"] = f"SELECT doc_id, string_agg(DISTINCT metric, ',' ORDER BY metric) AS metrics FROM ({out['band_violations']}) GROUP BY doc_id"
    return out

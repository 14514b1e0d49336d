"""Markdown reports over small results. Rows that are collected are few: one for each work, author
or metric of a curated corpus; larger inputs are refused instead of cut."""

from __future__ import annotations

from pyspark.sql import DataFrame

MOST = 10_000


def collected(rows: DataFrame, most: int = MOST) -> list:
    out = rows.limit(most + 1).collect()
    if len(out) > most:
        raise ValueError(f"a report has {most} rows at most")
    return out


def table(rows: DataFrame, columns: dict[str, str], form: dict[str, str] | None = None) -> str:
    """A table with the given headings; form: format of a column's values."""
    form = form or {}
    lines = ["| " + " | ".join(columns.values()) + " |", "| " + " | ".join("---" for _ in columns) + " |"]
    for row in collected(rows.select(*columns)):
        lines.append("| " + " | ".join("" if v is None else format(v, form.get(c, "")) for c, v in zip(columns, row)) + " |")
    return "\n".join(lines)


def work_card(name: str, stats: DataFrame, headings: DataFrame, words: DataFrame, similes: DataFrame, repetitions: DataFrame) -> str:
    """One work: its numbers, up to 40 headings, 25 words, 12 similes and 5 repetitions."""
    row = collected(stats)[0].asDict()
    parts = [f"# {name}", "", *[f"- {k}: {v}" for k, v in row.items()], ""]
    heads = collected(headings)
    parts += ["## 章", "", *[f"- {h['label']} ({h['characters']:,})" for h in heads[:40]]]
    parts += [f"- 他 {len(heads) - 40}"] if len(heads) > 40 else []
    parts += ["", "## 語", "", "、".join(f"{w['word']}（{w['count']}）" for w in collected(words)[:25])]
    parts += ["", "## 直喩", "", *[f"- [{'/'.join(s['markers'])}] {s['text']}" for s in collected(similes)[:12]]]
    parts += ["", "## 反復", "", *[f"- {r['head']} ×{r['count']}" for r in collected(repetitions)[:5]]]
    return "\n".join(parts)


def author_page(author: str, works: DataFrame, profile: DataFrame, words: DataFrame) -> str:
    return "\n".join([
        f"# {author}", "", table(works, {"title": "作品", "characters": "字数", "sentence_length_mean": "平均文長", "dialogue_ratio": "会話率"}, {"characters": ",", "sentence_length_mean": ".1f", "dialogue_ratio": ".3f"}),
        "", table(profile, {"metric": "指標", "value": "この作家", "whole": "全体", "arrow": "", "diff": "差"}, {"value": ".2f", "whole": ".2f", "diff": "+.2f"}),
        "", "、".join(f"{w['word']}（{w['total']}）" for w in collected(words))])


def index_page(index: DataFrame) -> str:
    return "\n".join(["# 一覧", "", table(index, {"author": "作家", "works": "作品", "characters": "字数", "sentence_length_mean": "平均文長", "dialogue_ratio": "会話率"},
                                        {"characters": ",", "sentence_length_mean": ".1f", "dialogue_ratio": ".3f"})])


def check_report(title: str, problems: list[str], kept: DataFrame, dropped: DataFrame) -> str:
    return "\n".join([f"『{title}』", *[f"- {p}" for p in problems], *[f"- [{c['position']:.1f}%] {c['item']} {c['label']}: {c['quote'][:50]}" for c in collected(kept)],
                      *[f"- （捨てた）{c['item']} {c['label']}" for c in collected(dropped)]])


def revision_request(title: str, advised: DataFrame) -> str:
    """A request to revise: what is off, what is allowed, and what to do about it."""
    rows = collected(advised)
    return "\n".join([f"# {title}", "", *[f"- **{r['label']}を{r['direction']}** {r['current']:.2f} → {r['low']:.2f}〜{r['high']:.2f}{r['unit']}: {r['advice']}" for r in rows]])


def prompt(guides: list[str], summary: str, examples: list[str], request: str) -> str:
    """Guides, the style to follow, examples and the request, one after another."""
    return "\n\n".join([*guides, summary, *(f"- {e}" for e in examples), request])

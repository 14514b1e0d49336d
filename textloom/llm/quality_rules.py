"""Quality rules as a learned decision list.

Sequential covering: while undesired documents are left, a rule (a conjunction of thresholds on
document statistics) is grown on two thirds of the labelled rows by FOIL's information gain and
pruned on the rest; rules that are not precise enough there end the list. The list becomes an
ordered Spark conditional expression: the first rule that holds names the reason of rejection,
and a document that none meets is kept.

Labels: `quality` 0 or `toxic` 1 make a document undesired. One statistic counts words of a small
lexicon, which is itself learned from the toxic labels by greedy covering.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import winnow

#: Labelled rows that the list is fitted on, at most; those of least hash are taken.
SAMPLE = 20_000
#: Word beginnings in the learned lexicon, at most, and their length in characters.
LEXICON = 64
STEM = (4, 10)
#: Precision that a rule needs on the pruning rows.
PRECISION = 0.95
MAX_RULES = 24
#: Divisions into growing and pruning rows that are tried for each rule; the rule that covers most is taken.
SPLITS = 5
MAX_CONDITIONS = 4
MIN_WORDS = 50

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Statistics that rules may test.
STATISTICS = ("n_words", "word_mean", "symbol_ratio", "dup_line_ratio", "repeat_ratio", "digit_ratio", "upper_ratio",
              "end_ratio", "lexicon_words")
SCHEMA = ", ".join([f"{c} long" for c in COUNTS] + [f"{s} double" for s in STATISTICS[1:]])

_CLASS = {name: np.zeros(256, dtype=bool) for name in ("space", "symbol", "digit", "upper", "follow")}
_CLASS["space"][[0x20, *range(0x09, 0x0E)]] = True
_CLASS["symbol"][list(b"#*$%&|<>")] = True
_CLASS["digit"][list(b"0123456789")] = True
_CLASS["upper"][list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_CLASS["follow"][0x80:0xC0] = True
_ENDS = (b".", b"!", b"?", b'"', b"\xe2\x80\x9d")
_LETTERS = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _count(data: np.ndarray, name: str) -> int:
    return int(np.count_nonzero(_CLASS[name][data]))


def statistics(text: str | bytes | None, lexicon: list[bytes] = ()) -> list:
    """COUNTS, then STATISTICS from the second on."""
    raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text or b""
    data = np.frombuffer(raw, dtype=np.uint8)
    words = winnow.word_tokens(data)
    n = len(words)
    chars = len(data) - _count(data, "follow") - _count(data, "space")
    symbols = _count(data, "symbol")
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = len(lines) - len(set(lines))
    repeat = 0
    if n > 3:
        triple = (words[:-2] * np.uint64(winnow._BASE) + words[1:-1]) * np.uint64(winnow._BASE) + words[2:]
        order = np.argsort(triple, kind="stable")
        same = np.diff(triple[order]) == 0
        if same.any():
            twice = np.zeros(n, dtype=bool)
            hit = np.concatenate([order[1:][same], order[:-1][same]])
            for j in range(3):
                twice[hit + j] = True
            repeat = int(np.count_nonzero(twice))
    low = raw.lower()
    if any(w in low for w in lexicon):
        stems = tuple(lexicon)
        marked = sum(w.startswith(stems) for w in _LETTERS.findall(low))
    else:
        marked = 0
    most = max(chars, 1)
    return [n, chars, symbols, dup, repeat, chars / max(n, 1), symbols / most, dup / max(len(lines), 1), repeat / max(n, 1),
            _count(data, "digit") / most, _count(data, "upper") / most,
            sum(x.rstrip().endswith(_ENDS) for x in lines) / max(len(lines), 1), float(marked)]


def with_statistics(docs: DataFrame, text: str, lexicon: list[bytes], carry: list[str]) -> DataFrame:
    """carry's columns and all statistics, one row per row of docs."""
    def of(batches):
        for batch in batches:
            rows = [statistics(t.as_py(), lexicon) for t in batch.column(len(carry))]
            columns = list(zip(*rows)) if rows else [[]] * (len(COUNTS) + len(STATISTICS) - 1)
            kinds = [pa.int64()] * len(COUNTS) + [pa.float64()] * (len(STATISTICS) - 1)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(carry))), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=[f"c{i}" for i in range(len(carry))] + list(COUNTS) + list(STATISTICS[1:]))

    kinds = [docs.schema[c].dataType.simpleString() for c in carry]
    out = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], F.col(text).cast("binary").alias("t")).mapInArrow(
        of, ", ".join([f"c{i} {k}" for i, k in enumerate(kinds)] + [SCHEMA]))
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carry)})


@dataclass(frozen=True)
class Condition:
    statistic: str
    least: bool  # at least the threshold, else at most
    threshold: float

    def holds(self, x: np.ndarray) -> np.ndarray:
        column = x[:, STATISTICS.index(self.statistic)]
        return column >= self.threshold if self.least else column <= self.threshold

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c >= F.lit(self.threshold) if self.least else c <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.least else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the lexicon is part of what they were fitted on."""

    rules: tuple[tuple[Condition, ...], ...]
    lexicon: tuple[bytes, ...] = ()

    def reason(self) -> Column:
        """The first rule that holds, as text; null where none does."""
        out = None
        for rule in self.rules:
            test = F.lit(True)
            for condition in rule:
                test = test & condition.column()
            label = F.lit(" and ".join(map(str, rule)))
            out = F.when(test, label) if out is None else out.when(test, label)
        return F.lit(None).cast("string") if out is None else out

    def rejects(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=bool)
        for rule in self.rules:
            out |= _holds(rule, x)
        return out


def _holds(rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _grow(x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """Add the condition of greatest gain until no clean row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(x), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        before, best = np.log2(p / (p + n)), (0.0, None)
        for j, name in enumerate(STATISTICS):
            values, marks = x[inside, j], bad[inside]
            order = np.argsort(values, kind="stable")
            v, up = values[order], np.cumsum(marks[order])
            edge = np.flatnonzero(v[1:] > v[:-1])  # a threshold lies between different values
            if not len(edge):
                continue
            for least in (True, False):
                bads = p - up[edge] if least else up[edge]
                total = len(v) - 1 - edge if least else edge + 1
                gain = np.where(bads > 0, bads * (np.log2(np.maximum(bads, 1) / total) - before), 0)
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), Condition(name, least, float((v[edge[k]] + v[edge[k] + 1]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= best[1].holds(x)
    return rule


def _prune(rule: list[Condition], x: np.ndarray, bad: np.ndarray) -> list[Condition]:
    """The shortest beginning of the rule of greatest worth (p - n) / (p + n)."""
    def worth(part) -> float:
        inside = _holds(part, x)
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(1, len(rule) + 1)), key=worth) if rule else rule


def learn(x: np.ndarray, bad: np.ndarray, seed: int = 7) -> DecisionList:
    """Sequential covering over rows x (STATISTICS) with marks bad."""
    rules: list[tuple[Condition, ...]] = []
    random = np.random.default_rng(seed)
    while len(rules) < MAX_RULES and bad.sum() >= 3:
        best: tuple = (0, None, None)
        for _ in range(SPLITS):
            fold = random.random(len(x)) < 2 / 3
            if not bad[fold].any():
                continue
            rule = _prune(_grow(x[fold], bad[fold]), x[~fold], bad[~fold])
            if not rule:
                continue
            inside = _holds(rule, x)
            held, gained = inside & ~fold, int((inside & bad).sum())
            p, every = (held & bad).sum(), held.sum()
            # too few rows to prune on: all rows covered must be undesired ones
            fine = p >= PRECISION * every if every >= 5 else gained >= 3 and not (inside & ~bad).any()
            if fine and gained > best[0]:
                best = (gained, tuple(rule), inside)
        if best[1] is None:
            break
        rules.append(best[1])
        x, bad = x[~best[2]], bad[~best[2]]
    return DecisionList(tuple(rules))


def stems_of(text: str | None) -> set[str]:
    """Beginnings (STEM lengths) of a text's words, A-Z lower-cased."""
    words = set(_LETTERS.findall((text or "").encode("utf-8", "surrogatepass").lower()))
    return {w[:k] for w in (x.decode("utf-8", "replace") for x in words) for k in range(STEM[0], min(len(w), STEM[1]) + 1)}


def learn_lexicon(labelled: DataFrame, most: int = LEXICON) -> list[bytes]:
    """Word beginnings that toxic texts have and others lack, each for what those before it leave uncovered.

    labelled: (doc_id, text, toxic), a bounded sample. Stems in a hundredth of the toxic texts and in
    twenty times as many of them, by share, as of the others are candidates.
    """
    def of(batches):
        for batch in batches:
            docs, stems = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = stems_of(text)
                docs.extend([doc] * len(own))
                stems.extend(own)
            yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(stems, pa.string())], names=["doc_id", "stem"])

    toxic, clean = labelled.filter("toxic = 1"), labelled.filter("toxic = 0")
    n, m = toxic.count(), clean.count()
    if n < 10 or not m:
        return []
    spread = lambda df: df.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, "doc_id long, stem string")
    both = spread(toxic).select("stem", F.lit(1).alias("bad")).union(spread(clean).select("stem", F.lit(0).alias("bad")))
    often = both.groupBy("stem").agg(F.sum("bad").alias("c"), F.sum(1 - F.col("bad")).alias("o")).filter(
        (F.col("c") >= max(4, n / 100)) & (F.col("c") / n >= 20 * F.col("o") / m)).collect()
    others = {r["stem"]: r["o"] for r in often}
    good = sorted(others)
    having: dict[str, set] = {s: set() for s in good}
    names = labelled.sparkSession.createDataFrame([(s,) for s in good], "stem string")
    for doc, stem in spread(toxic).join(F.broadcast(names), "stem").select("doc_id", "stem").collect():
        having[stem].add(doc)
    out, covered = [], set()
    while having and len(out) < most:
        # among equals the stem that fewer clean texts have, then the longer one
        stem = max(sorted(having), key=lambda s: (len(having[s] - covered) - 3 * others.get(s, 0) * n / m, len(s)))
        if len(having[stem] - covered) < max(2, n / 200):
            break
        out.append(stem.encode())
        covered |= having.pop(stem)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DecisionList:
    """A decision list from the labelled documents: (doc_id, text) and (doc_id, quality, toxic).

    Rows with null ids or labels are left out; of a document's several labels the worst counts.
    Without labels of both kinds the list is empty, and keeps everything.
    """
    marks = labels.filter("doc_id is not null and (quality is not null or toxic is not null)").groupBy("doc_id").agg(
        F.min(F.coalesce("quality", F.lit(1))).alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(marks), "doc_id").persist()
    try:
        lexicon = learn_lexicon(chosen)
        rows = with_statistics(chosen, "text", lexicon, ["doc_id", "quality", "toxic"]).orderBy(F.xxhash64("doc_id"), *STATISTICS).toPandas()
    finally:
        chosen.unpersist()
    bad = ((rows["quality"] == 0) | (rows["toxic"] == 1)).to_numpy()
    if not bad.any() or bad.all():
        return DecisionList((), tuple(lexicon))
    x = rows[list(STATISTICS)].to_numpy(dtype=float)
    return DecisionList(learn(x, bad).rules, tuple(lexicon))


def judged(docs: DataFrame, rules: DecisionList, carry: list[str], text: str = "text") -> DataFrame:
    """carry's columns, the statistics, base_failed, reason and kept, one row per row of docs.

    Null or empty text: no words, so base_failed. Repeated rows are judged each for itself.
    Other columns are ignored, whatever their names.
    """
    stats = with_statistics(docs, text, list(rules.lexicon), carry)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("reason", F.when(failed, F.lit("base")).otherwise(rules.reason())).withColumn(
        "kept", F.col("reason").isNull())


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judged(docs, rules, ["doc_id"]).select("doc_id", *COUNTS, "base_failed", "kept", "reason")

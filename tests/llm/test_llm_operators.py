"""Operators of the llm subpackage against brute force, with nulls, empty and long texts, ties,
repeated rows, empty tables and extra columns with clashing names."""

import collections
import hashlib
import itertools
import json
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textloom.llm import chat, common, debruijn, decontaminate, line_dedup, mixing, quality_rules, sharding, simhash, suffix_array, token_counts, winnow

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALPHA = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Names that operators use inside, as columns that they must not mind.
CLASH = ("rid", "key", "t", "h", "s", "spans", "place", "fp", "removed", "arr", "bits", "hash", "_b", "rank", "block", "src")


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}é" if rng.random() < 0.2 else f"W{rng.randrange(size)}," for _ in range(n)]


def corpus(seed=3):
    """(doc_id, text): unique ids, shared passages, copies, near copies, nulls and a long document."""
    rng = random.Random(seed)
    shared = " ".join(words(rng, 60))
    out = [None, "", "  \n ", "one", "two words", "x" * 500, "\t".join(words(rng, 40))]
    for i in range(40):
        body = words(rng, rng.randrange(5, 160))
        if i % 3 == 0:
            body[2:2] = shared.split()[rng.randrange(0, 20):]
        out.append("\n".join(" ".join(body[j : j + 12]) for j in range(0, len(body), 12)))
    out += [out[10], out[10], out[12].replace("W1", "W2"), out[13] + " tail", out[14].lower(), shared, shared + "\n" + shared]
    out.append("\n".join([" ".join(words(rng, 9)) for _ in range(900)] + [shared]))
    return [(i * 7 % 1009, t) for i, t in enumerate(out)]


def frame(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit(1).alias(c) for c in CLASH]) if extra else df


@pytest.fixture(scope="module")
def rows():
    return corpus()


# ---- 1 -----------------------------------------------------------------------------------------
def brute_lines(docs):
    sets, gone = [], collections.defaultdict(list)
    for doc, text in sorted(docs, key=lambda d: d[0]):
        for i, line in enumerate((text or "").lower().split("\n") if text is not None else []):
            s = frozenset(SPACE.findall(line))
            if not s:
                continue
            if any(5 * len(s & o) >= 4 * len(s | o) for o in sets):
                gone[doc].append(i)
            sets.append(s)
    return gone


def test_line_dedup(spark, rows):
    more = [(2000 + i, t) for i, t in enumerate(["a b c d e f g h i j\na b c d e f g h i k", "a b c d e f g h i J X\n\nb a", "a b", "A  B\tb"])]
    docs = [(d, t) for d, t in rows if t is None or len(t) < 3000] + more
    got = line_dedup.without_duplicate_lines(frame(spark, docs)).collect()
    want, texts = brute_lines(docs), dict(docs)
    assert {r.doc_id: r.removed for r in got} == {d: sorted(want[d]) for d, _ in docs}
    for r in got:
        lines = texts[r.doc_id].split("\n") if texts[r.doc_id] is not None else []
        assert r.n_lines == len(lines)
        assert r.kept == (None if texts[r.doc_id] is None else "\n".join(x for i, x in enumerate(lines) if i not in set(r.removed)))


def test_line_dedup_repeated_and_null_keys(spark):
    docs = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (2, None)]
    got = line_dedup.without_duplicate_lines(frame(spark, docs)).collect()
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.n_removed) for r in got) == [((False, 0), 0), ((True, 1), 1), ((True, 1), 1), ((True, 2), 0)]
    assert line_dedup.without_duplicate_lines(frame(spark, [])).count() == 0


def test_classes_of_frequent_words_are_not_all_paired(spark, monkeypatch):
    seen, save = [], common.Scratch.save
    monkeypatch.setattr(common.Scratch, "save", lambda self, df, *done: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or save(self, df, *done))
    words = "ab cd ef gh ij kl mn op qr st uv".split()  # each in 210 lines
    docs = [(1, "\n".join(" ".join(c) for c in itertools.combinations(words, 5))), (2, " ".join(reversed(words[:5])))]
    got = line_dedup.without_duplicate_lines(frame(spark, docs)).collect()
    assert {r.doc_id: r.removed for r in got} == {1: [], 2: [0]}
    joins = [x for plan in seen for x in plan.splitlines() if "Join Inner" in x and "token#" in x]
    # lengths and signatures are compared before a row is made
    assert len(joins) == 2 and all("bit_count" in x for x in joins)


@pytest.mark.parametrize("frequent", [0, 12])
def test_line_dedup_with_rarity_from_a_sample(spark, rows, monkeypatch, frequent):
    for name, value in {"STRIDE": 4, "SMALL": 1, "LARGE": 1000, "FREQUENT": frequent}.items():
        monkeypatch.setattr(line_dedup, name, value)
    docs = [(d, t) for d, t in rows if t is None or len(t) < 3000]
    # lines at the limits of similarity and of bands of lengths, after a line of each word, which is the earliest there
    for n in range(1, 100, 3):
        family = [f"f{n}x{i}" for i in range(n * 5 // 4 + 1)]
        docs += [(3000 + 2 * n, "\n".join(family)), (3001 + 2 * n, "\n".join(" ".join(family[:k]) for k in (n, n * 5 // 4, n * 5 // 4 + 1)))]
    docs += [(5000, "p q r s t u\np\tq r s t u\nu t  s r q p\n p q\x0br s\x0ct u\rp")]
    own = frame(spark, docs).select(F.col("doc_id").alias("rid"), "text")
    lines, stride = line_dedup.sample(own)
    assert stride == 4 and 0 < lines.count() < line_dedup.trimmed_lines(own).count() / 2
    got = line_dedup.without_duplicate_lines(frame(spark, docs)).collect()
    want = brute_lines(docs)
    assert {r.doc_id: r.removed for r in got} == {d: sorted(want[d]) for d, _ in docs}


# ---- 2 -----------------------------------------------------------------------------------------
def test_mixing_keeps_all_and_stays_within_a_block(spark):
    rng = random.Random(5)
    sizes = {"hot": 700, "b": 90, "c": 60, "d": 11, None: 30}
    docs = [(i, s) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, source string").select("*", *[F.lit(1).alias(c) for c in CLASH])
    weights = {"hot": 0.5, "b": 0.2, "c": 0.2, "d": 0.05, None: 0.05}
    table = spark.createDataFrame([(s, w) for s, w in weights.items()], "source string, weight double")
    got = mixing.mixed(df, table, block_rows=2, carry=["doc_id"]).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in docs)
    assert all(dict(docs)[r.doc_id] == r.mix_source for r in got)
    slots = {}
    for r in got:
        assert slots.setdefault(r.slot, (r.mix_source, r.block)) == (r.mix_source, r.block)
    assert len({(r.slot, r.place) for r in got}) == len(got)
    left = {s: -(-n // 2) for s, n in sizes.items()}
    done = collections.Counter()
    for slot in sorted(slots):  # until a source runs out no source is a block off its share
        if min(left[s] - done[s] for s in left) == 0:
            break
        done[slots[slot][0]] += 1
        assert all(abs(done[s] - weights[s] * (slot + 1)) < 1 + 0.02 * (slot + 1) / 10 for s in weights)
    for s in sizes:  # blocks come in order
        assert [b for _, (x, b) in sorted(slots.items()) if x == s] == list(range(left[s]))


@pytest.mark.parametrize("weights, most", [
    ({"a": 0.5, "b": 0.2, "c": 0.2, "d": 0.05, None: 0.05}, 3000),
    ({"hot": 19.0, **{f"s{i:02}": 1.0 for i in range(19)}}, 1200),
    ({"a": 2**0.5, "b": 3**0.5, "c": 0.001}, 2500)])
def test_mixing_stays_within_a_block_at_any_length(spark, weights, most):
    whole = sum(weights.values())
    docs = [s for s, w in weights.items() for _ in range(int(most * w / whole) + 3)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, source string")
    table = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = sorted(mixing.mixed(df, table, block_rows=1, carry=["doc_id"]).collect(), key=lambda r: r.slot)
    assert [r.slot for r in got] == list(range(len(docs)))
    left, done, phase, n, live = collections.Counter(docs), collections.Counter(), 0, 0, dict(weights)
    for r in got:
        if r.phase > phase:  # when a source runs out, and only then, the others go on by their weights
            live = {s: w for s, w in weights.items() if left[s]}
            done, phase, n = collections.Counter(), r.phase, 0
        assert len(live) == sum(left[s] > 0 for s in weights)
        done[r.mix_source] += 1
        left[r.mix_source] -= 1
        n += 1
        assert all(abs(done[s] - w / sum(live.values()) * n) < 1 + 1e-5 for s, w in live.items())
    assert not any(left.values())


def test_mixing_defaults_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, None)], "doc_id long, source string")
    got = mixing.mixed(df, carry=["doc_id"]).collect()
    assert len(got) == 3 and {r.mix_source for r in got} == {"a", None}
    assert mixing.mixed(df.filter("false"), carry=["doc_id"]).count() == 0


# ---- 3 -----------------------------------------------------------------------------------------
def lowered(text):
    return ALPHA.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_contamination(docs, items):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = lowered(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[i : i + n])].add(item)
    sizes = {len(w) for w in windows}
    out = {}
    for doc, text in docs:
        w, hit, found = lowered(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        ids = sorted(map(str, found))
        out[doc] = (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest())
    return out


def test_decontamination(spark, rows):
    passage = " ".join(rows[9][1].split()[:30])
    items = [(1, passage), (2, passage[:60]), (10, "ONE"), (11, "two WORDS"), (12, "É é w1é"), (13, None), (14, "..."), (3, "the the the the the the the the the the the the")]
    docs = rows + [(3000, "É é W1é"), (3001, "é É w1É"), (3002, "the " * 40), (3003, "so: " + passage.upper().replace("É", "é") + " Two,words one")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(frame(spark, docs), bench, ["doc_id"]).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in got} == brute_contamination(docs, items)
    assert all(r.contaminated == (r.n_hit > 0) for r in got)
    assert decontaminate.contamination(frame(spark, []), bench, ["doc_id"]).count() == 0
    clean = decontaminate.contamination(frame(spark, docs + docs[:1]), bench.filter("false"), ["doc_id"])
    assert clean.count() == len(docs) + 1 and clean.filter("contaminated").count() == 0


# ---- 4 -----------------------------------------------------------------------------------------
def test_token_ledger(spark, tmp_path):
    ledger = token_counts.Ledger(spark, str(tmp_path / "ledger"))
    kind = "struct<source:string,lang:string,tokenizer:string,tokens:long,chars:long,bytes:long>"
    change = lambda *x: spark.createDataFrame(x, f"old {kind}, new {kind}")
    a, b, c = ("s", "en", "v1", 10, 40, 40), ("s", "en", "v1", 5, 20, 20), (None, None, "v1", 7, 9, 9)
    first = change((None, a), (None, b), (None, c))
    assert ledger.totals().count() == 0
    assert ledger.commit("day 1/ä", first) and not ledger.commit("day 1/ä", first)
    assert ledger.commit("2", change((a, ("s", "en", "v2", 12, 40, 40)), (b, None)))
    got = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens, r.chars, r.bytes) for r in ledger.totals().collect()}
    assert got == {("s", "en", "v2"): (1, 12, 40, 40), (None, None, "v1"): (1, 7, 9, 9)}
    aside = tmp_path / "ledger" / "batches" / "3"
    aside.mkdir()  # a batch that broke off has no mark of success, and doesn't count
    assert not ledger.committed("3") and len(ledger.totals().collect()) == 2


def test_token_counts_match_the_encoder(spark, rows):
    import base64

    import tiktoken

    with open(token_counts.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    encoder = tiktoken.Encoding("x", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    docs = rows + [(5000, "I'm you'll <|endoftext|> 12 ½ 漢字")]
    got = token_counts.token_counts(frame(spark, docs), ["doc_id"]).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {d: len(encoder.encode_ordinary(t or "")) for d, t in docs}


# ---- 5 -----------------------------------------------------------------------------------------
def brute_quality(text):
    text = text or ""
    w = SPACE.findall(text)
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    c = collections.Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    return [len(w), sum(map(len, w)), sum(text.count(x) for x in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)]


def test_quality_statistics(spark, rows):
    docs = rows + [(4000, "a b c a b c\na b\na b\n # |<"), (4001, "x x x x x")]
    got = quality_rules.judged(frame(spark, docs), quality_rules.DecisionList(()), ["doc_id"]).collect()
    texts = dict(docs)
    for r in got:
        want = brute_quality(texts[r.doc_id])
        assert [r[c] for c in quality_rules.COUNTS] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and r.kept == (not r.base_failed)


def test_rules_are_learned_and_hold_out(spark):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(600):
        kind = rng.choice(["fine", "fine", "fine", "symbols", "toxic"])
        body = [f"w{rng.randrange(5000)}" for _ in range(80)]
        if kind == "symbols":
            body = [w + rng.choice("#$%") * 3 for w in body]
        if kind == "toxic":
            body[rng.randrange(80)] = rng.choice(["nastyword", "foulword"])
        docs.append((i, " ".join(body) + "."))
        if i % 2:
            labels.append((i, int(kind != "symbols"), int(kind == "toxic")))
    labels += [(None, 0, 1), (7, None, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = quality_rules.fit(frame(spark, docs, extra=False), table)
    got = {r.doc_id: r.kept for r in quality_rules.judged(frame(spark, docs), rules, ["doc_id"]).collect()}
    bad = {i: any(c in t for c in "#$%") or "nastyword" in t or "foulword" in t for i, t in docs}
    held = [i for i, _ in docs if i % 2 == 0]
    assert sum(got[i] == bad[i] for i in held) / len(held) < 0.03
    assert quality_rules.fit(frame(spark, docs, extra=False), table.filter("false")).rules == ()


# ---- 6 and 10 ----------------------------------------------------------------------------------
def brute_bytes(docs):
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda d: d[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            else:
                seen.add(data[i : i + 100])
        kept = bytes(x for x, g in zip(data, gone) if not g)
        out[doc] = (len(data), sum(gone), sum(g and not p for g, p in zip(gone, b"\0" + gone)), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_array_dedup(spark, rows):
    docs = rows + [(4000, "ab" * 400), (4001, "z" * 99), (4002, "z" * 99), (4003, "q" * 100), (4004, "q" * 100), (4005, "\0" * 150 + "é" * 80)]
    got = suffix_array.without_repeats(frame(spark, docs)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_bytes(docs)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_texts_of_one_period_are_few_runs(spark):
    docs = [(1, "z" * 6000), (2, "y" + "z" * 4000 + "x"), (3, "abc" * 1500), (4, "bca" * 1000)]
    tokens = winnow.BYTE_TOKENS[np.full(20_000, 97, dtype=np.uint8)]
    assert len(winnow.runs(tokens, np.array([20_000]), 100, 32)[0]) < 5
    got = suffix_array.without_repeats(frame(spark, docs)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_bytes(docs)
    spaced = [(d, " ".join(t)) for d, t in docs]
    got = debruijn.without_repeats(frame(spark, spaced)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_words(spaced)


@pytest.mark.parametrize("width", [23, 5, 69])
def test_a_hot_anchor_in_many_surroundings(spark, monkeypatch, width):
    monkeypatch.setattr(suffix_array, "RANGES", tuple((a, min(a + width, suffix_array.LEADS)) for a in range(0, suffix_array.LEADS, width)))
    rng = random.Random(12)
    hot, side = ("q%04d" % 7) * 14, lambda n: "".join(rng.choice("ab") for _ in range(n))
    left, right = [side(40) for _ in range(3)], [side(40) for _ in range(3)]
    docs = [(i, side(20) + rng.choice(left)[rng.randrange(30):] + hot + rng.choice(right)[: rng.randrange(40)] + side(20)) for i in range(60)]
    got = suffix_array.without_repeats(frame(spark, docs)).collect()
    want = brute_bytes(docs)
    assert sum(v[1] for v in want.values()) > 1000
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == want


def test_suffix_array_repeated_rows(spark):
    rng = random.Random(8)
    long_ = "".join(rng.choice("abcdefgh") for _ in range(300))
    got = suffix_array.without_repeats(frame(spark, [(1, long_), (1, long_), (None, "a"), (2, None)])).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 0, 300]
    assert suffix_array.without_repeats(frame(spark, [])).count() == 0


def test_deep_shallow_sorts(spark):
    rng = random.Random(2)
    base = bytes(rng.randrange(97, 99) for _ in range(104))
    rows_ = [base[: (k := rng.randrange(105))] + bytes(rng.randrange(97, 100) for _ in range(104 - k)) for _ in range(300)] + [base] * 5
    group = np.sort(np.array([rng.randrange(4) for _ in rows_]))
    order, lcp = suffix_array.deep_shallow(rows_, group)
    assert [(group[i], rows_[i]) for i in order] == sorted((g, r) for g, r in zip(group, rows_))
    for k in range(1, len(order)):
        x, y = rows_[order[k - 1]], rows_[order[k]]
        common_ = next((i for i in range(104) if x[i] != y[i]), 104)
        assert lcp[k] == (common_ if group[order[k - 1]] == group[order[k]] else -1)


def test_long_documents_are_cut_into_pieces(monkeypatch):
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 1 << 63, 5000).astype(np.uint64)
    whole = list(winnow.pieces(iter([(0, tokens)]), 100))
    monkeypatch.setattr(winnow, "LONGEST", 700)
    cut = list(winnow.pieces(iter([(0, tokens)]), 100))
    def starts(parts):
        out = collections.Counter()
        for tok, lengths, _, offset in parts:
            piece, start, lead, n, h, _s, reps = winnow.runs(tok, lengths, 100, 32)
            for p, a, k, hh in zip(piece, start, n * reps, h):
                out.update((int(a) + offset[p] + j, int(hh)) for j in range(k))
        return out
    assert starts(whole) == starts(cut) and len(starts(cut)) == 4901


def brute_words(docs):
    count, texts = collections.Counter(), {d: SPACE.findall(t or "") for d, t in docs}
    for w in texts.values():
        count.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    out = {}
    for d, w in texts.items():
        gone = {j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(i, i + 35)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def test_debruijn_dedup(spark, rows):
    docs = rows + [(4000, "a b " * 60), (4001, " ".join(map(str, range(35)))), (4002, "x " + "\t".join(map(str, range(35)))), (4003, " ".join(map(str, range(34))))]
    got = debruijn.without_repeats(frame(spark, docs)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute_words(docs)


def test_debruijn_spans_come_from_compacted_paths(spark, rows, monkeypatch):
    scratch, seen = common.Scratch(spark, "t"), []
    of = debruijn.compacted

    def spy(scratch, found):
        paths = of(scratch, found)
        seen.append((found.select("label").distinct().count(), paths.count()))
        return paths

    monkeypatch.setattr(debruijn, "compacted", spy)
    own = common.keyed(scratch, frame(spark, rows), "doc_id", "text")
    assert debruijn.repeated_spans(scratch, own).count() > 0
    assert 0 < seen[0][1] < seen[0][0] / 2
    monkeypatch.setattr(debruijn, "compacted", lambda scratch, found: scratch.save(of(scratch, found).filter("head = tail")))
    broken = debruijn.without_repeats(frame(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in broken} != brute_words(rows)


def test_rows_of_one_key_are_in_the_order_of_their_texts(spark):
    docs = [(1, f"{i * 7919 % 4000:05d}") for i in range(4000)] + [(None, "n")] * 3
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = common.numbered(common.Scratch(spark, "t"), frame(spark, docs).repartition(7)).select("rid_", "doc_id", "text").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = sorted(got, key=lambda r: r.rid_)
    assert [r.text for r in got] == ["n"] * 3 + sorted(t for d, t in docs if d)


def test_debruijn_repeated_rows(spark):
    text = " ".join(f"v{i}" for i in range(50))
    got = debruijn.without_repeats(frame(spark, [(1, text), (1, text), (None, None)])).collect()
    assert sorted(r.n_removed for r in got) == [0, 50, 50]
    assert debruijn.without_repeats(frame(spark, [])).count() == 0


# ---- 7 -----------------------------------------------------------------------------------------
def test_chat_rotation(spark):
    talk = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 3, "ann", "bye"), (1, 3, "ann", "bye"),
            (2, 0, "system", "alone"), (3, None, None, "x"), (None, 0, "ann", "y")]
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").withColumn("who", F.lit(1)).withColumn("at", F.lit(2))
    got = {(r.conv_id, r.perspective): r for r in chat.rotated(df).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (2, None), (3, ""), (None, "ann")}
    r = got[1, "ann"]
    assert r.text.count("<|im_start|>assistant\n") == 3 and "<|im_start|>user name=bob\n<|im_end|>\n" in r.text and "hi < |im_end|>" in r.text
    spans = [tuple(map(int, s.split("-"))) for s in r.mask.split(",")]
    assert [r.text[a:b] for a, b in spans] == ["hi < |im_end|><|im_end|>\n", "bye<|im_end|>\n", "bye<|im_end|>\n"]
    assert r.n_target == sum(b - a for a, b in spans) and got[2, None].mask == "" and got[1, "bob"].n_messages == 5
    assert chat.rotated(df.filter("false")).count() == 0


def brute_chat(rows, most=None):
    """(conv_id, perspective, part) -> (text, mask spans), by hand."""
    null = lambda x: (x is not None, x if x is not None else 0 if isinstance(x, int) else "")
    talks, out = collections.defaultdict(list), {}
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role, text))
    for conv, messages in talks.items():
        messages.sort(key=lambda m: tuple((x is not None, x) if x is not None else (False,) for x in m))
        messages = [(r or "", (t or "").replace("<|", "< |")) for _, r, t in messages]
        who = sorted({r for r, _ in messages} - {"system"}) or [None]
        size = most or len(messages)
        for part in range(-(-len(messages) // size)):
            own = messages[part * size : (part + 1) * size]
            if part and messages[0][0] == "system":
                own = messages[:1] + own
            for me in who:
                text, spans = "", []
                for r, t in own:
                    name = "system" if r == "system" else "assistant" if r == me else "user name=" + r.replace("<|", "< |").replace("\n", " ")
                    text += f"<|im_start|>{name}\n"
                    if r == me:
                        spans.append((len(text), len(text) + len(t) + 11))
                    text += t + "<|im_end|>\n"
                out[conv, me, part] = (text, ",".join(f"{a}-{b}" for a, b in spans), len(own))
    return out


@pytest.mark.parametrize("most", [None, 4])
def test_chat_whole_dialogues_and_parts(spark, most):
    rng = random.Random(3)
    talk = [(c, t, rng.choice(["ann", "bob", "c\nd", None, "x<|"]), rng.choice(["hi", "é" * 9, "", None])) for c in (1, 2, None) for t in rng.sample(range(30), 11)]
    talk += [(1, -1, "system", "be kind"), (5, 511, "ann", "a"), (5, 512, "bob", "b"), (6, 1_700_000_000, "ann", "a"), (6, 1_700_000_600, "bob", "b"),
             (7, None, "ann", "n"), (7, None, "ann", "n"), (8, 0, "ann", "l" * 200_000), (9, 0, "system", "s")]
    df = spark.createDataFrame(talk, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.perspective, r.part): (r.text, r.mask, r.n_messages) for r in chat.rotated(df.repartition(5), most).collect()}
    assert got == brute_chat(talk, most)
    if most is None:
        assert {p for _, _, p in got} == {0} and got[5, "ann", 0][2] == 2 and got[6, "bob", 0][2] == 2


# ---- 8 -----------------------------------------------------------------------------------------
def brute_fingerprint(text):
    w = SPACE.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2:
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(fps))]


def test_simhash_components(spark, rows):
    got = {r.doc_id: r for r in simhash.near_duplicates(frame(spark, rows)).collect()}
    docs = sorted(rows)
    fps = [brute_fingerprint(t) for _, t in docs]
    roots = classes(fps)
    for (d, _), fp, root in zip(docs, fps, roots):
        assert got[d].fp % (1 << 64) == fp and got[d].component == docs[root][0]


@pytest.mark.parametrize("hot", [0, 3, 64])
def test_links_reach_all_pairs_at_any_heat(spark, hot):
    rng = random.Random(4)
    fps = {rng.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:20]:
        for _ in range(6):
            f ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            fps.add(f)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    scratch = common.Scratch(spark, "t")
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = {r.node: r.root for r in common.components(scratch, simhash.links(scratch, df, hot_homes=hot)).collect()}
    roots = classes(fps)
    groups = collections.defaultdict(set)
    for s, r in zip(signed, roots):
        groups[r].add(s)
    for members in groups.values():
        assert {found.get(s, s) for s in members} == {min(members)}


def test_simhash_nulls_and_repeats(spark):
    got = simhash.near_duplicates(frame(spark, [(1, None), (2, ""), (2, ""), (None, "a b c d"), (3, "a b c d")])).collect()
    assert sorted((r.doc_id or -1, r.component) for r in got) == [(-1, 3), (1, 1), (2, 1), (2, 1), (3, 3)]
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


# ---- 9 -----------------------------------------------------------------------------------------
def test_sharding(spark, rows):
    docs = rows + [(None, "n"), (5000, "g" * 9000)] + [(6000, f"{i:050d}") for i in range(50)]
    limit = 1200
    got = sharding.sharded(frame(spark, docs), ["doc_id", "text"], limit=limit).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == sorted((d or -1, t or "") for d, t in docs)
    sums = collections.Counter()
    for r in got:
        assert r.bytes == len((r.text or "").encode())
        sums[r.shard] += r.bytes
    assert all(v <= limit for s, v in sums.items() if s[0] == "b") and sum(s[0] == "x" for s in sums) == sum(len((t or "").encode()) > limit for _, t in docs)
    # only what is too large splits: two shards that differ in the last bit don't fit together
    plain = {s: v for s, v in sums.items() if s[0] == "b" and "/" not in s}
    for s in plain:
        if len(s) > 1:
            assert sum(v for o, v in sums.items() if o[0] == "b" and o.startswith(s[:-1])) > limit
    again = {(r.doc_id, r.text): r.shard for r in sharding.sharded(frame(spark, docs), ["doc_id", "text"], limit=limit).collect()}
    assert again == {(r.doc_id, r.text): r.shard for r in got}
    assert sharding.sharded(frame(spark, []), ["doc_id"]).count() == 0


def test_registered(spark):
    import __spark_entry__

    names = {re.match(r"op(\d+)_", n)[1] for n in __spark_entry__.queries() if re.match(r"op\d+_", n)}
    assert names == set(map(str, range(1, 11))) and "pipeline" in __spark_entry__.queries()
    assert json.dumps(__spark_entry__.oracle_sql())


@pytest.fixture
def plans(monkeypatch):
    """Physical plans of the tables that are saved, with the size limit for broadcasts at Spark's own."""
    seen, save = [], common.Scratch.save
    monkeypatch.setattr(common.Scratch, "save", lambda self, df, *done: seen.append(df._jdf.queryExecution().executedPlan().toString()) or save(self, df, *done))
    return seen


def test_simhash_sends_no_table_through_the_driver(spark, plans):
    docs = frame(spark, [(i, f"w{i % 90} x{i % 7} y z") for i in range(200)])
    plans.append(simhash.near_duplicates(docs)._jdf.queryExecution().executedPlan().toString())
    scratch = common.Scratch(spark, "test")
    plans.append(simhash.links(scratch, spark.range(300).select(F.xxhash64("id").alias("fp")))._jdf.queryExecution().executedPlan().toString())
    assert sum("Join" in p for p in plans) > 4 and not any("Broadcast" in p for p in plans)

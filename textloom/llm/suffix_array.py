"""Suffix-array dedup of byte strings by deep-shallow sorting.

A byte is removed if a 100-byte string that also starts earlier covers it. Winnowing
(winnow.py) reduces the suffixes to be sorted to one for each run of windows with a repeated
anchor; equal runs (128 bits of hash) are one suffix, of which the earliest stays. Where runs with
an anchor differ, what follows the anchor and what precedes it (read backwards) are sorted as two
sparse suffix arrays, by deep-shallow sorting (Manzini and Ferragina, 2004): multikey quicksort on
eight-byte symbols to a shallow depth, then a blind trie for each group that still has a common
prefix. The longest common prefixes of neighbours give, for each place of the anchor in a window,
the classes of equal windows, and the earliest of a class stays.

A hot anchor is split by the symbols around it before it is sorted: windows are dealt by the
place of the anchor in them into RANGES, and windows of a range that are equal have the same
WINDOW - WIDTH + 1 bytes around the anchor, by which runs are grouped.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, cut_spans, keyed, merged
from .repeats import repeated_runs, start, where, windows, with_text

WINDOW = 100
GRAM = 32
LEADS = WINDOW - GRAM + 1
#: Eight-byte symbols that multikey quicksort looks at; beyond them, blind tries.
SHALLOW = 5
#: Places of the anchor in a window that are judged together.
WIDTH = 23
RANGES = tuple((a, min(a + WIDTH, LEADS)) for a in range(0, LEADS, WIDTH))
#: Runs that are sorted at once.
BATCH = 1 << 15


def blind_trie(rows: list[bytes], members: list[int]) -> list[int]:
    """Members in the order of their rows, by a trie that keeps branching places and bytes only."""
    root = leaf = [members[0]]
    # an inner node is (depth, {byte: child}); a leaf lists members with equal rows
    for m in members[1:]:
        row, node = rows[m], root
        while isinstance(node, tuple):
            node = node[1].get(row[node[0]]) or next(iter(node[1].values()))
        leaf = node
        other = rows[leaf[0]]
        if other == row:
            leaf.append(m)
            continue
        width = len(row)
        differ = int.from_bytes(row, "big") ^ int.from_bytes(other, "big")
        depth = width - (differ.bit_length() + 7) // 8
        above, node = None, root
        while isinstance(node, tuple) and node[0] < depth:
            above, node = node, node[1][row[node[0]]]
        if isinstance(node, tuple) and node[0] == depth:
            node[1][row[depth]] = [m]
            continue
        new = (depth, {row[depth]: [m], other[depth]: node})
        if above is None:
            root = new
        else:
            above[1][row[above[0]]] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, tuple):
            stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(rows: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of equally long rows within their groups (given in order), and the common prefix
    with the row before, -1 at the start of a group."""
    m, width = len(rows), len(rows[0])
    symbols = np.frombuffer(b"".join(rows), dtype=">u8").astype(np.uint64).reshape(m, width // 8)
    order, bucket = np.arange(m), np.array(group)

    def tied() -> np.ndarray:
        same = np.concatenate([[False], bucket[1:] == bucket[:-1], [False]])
        return same[1:] | same[:-1]

    for level in range(min(SHALLOW, width // 8)):
        act = np.flatnonzero(tied())
        if not len(act):
            break
        sub = order[act]
        order[act] = sub[np.lexsort((symbols[sub, level], bucket[act]))]
        symbol = symbols[order, level]
        cut = (bucket[1:] != bucket[:-1]) | (symbol[1:] != symbol[:-1])
        settled = ~tied()
        cut |= settled[1:] | settled[:-1]
        bucket = np.concatenate([[0], np.cumsum(cut)])
    act = np.flatnonzero(tied())
    if len(act):
        edges = np.flatnonzero(np.diff(bucket[act])) + 1
        for part in np.split(act, edges):
            order[part] = blind_trie(rows, order[part].tolist())
    ordered = symbols[order]
    differ = ordered[1:] ^ ordered[:-1]
    place = np.argmax(differ != 0, axis=1)
    value = differ[np.arange(m - 1), place]
    zeros = np.zeros(m - 1, dtype=np.int64)  # leading equal bytes of the first symbol that differs
    for shift in range(8, 64, 8):
        zeros += (value >> np.uint64(shift)) == 0
    lcp = np.where(value == 0, width, 8 * place + zeros)
    lcp[np.array(group)[order][1:] != np.array(group)[order][:-1]] = -1
    return order, np.concatenate([[-1], lcp])


def later_windows(group: np.ndarray, lead: np.ndarray, n: np.ndarray, segments: list[bytes]) -> np.ndarray:
    """later[i, o]: the window of run i that starts o bytes before its anchor also starts in an
    earlier run. Runs come in the order of (group, document, start)."""
    m = len(segments)
    right = [x[a : a + WINDOW].ljust(104, b"\0") for x, a in zip(segments, lead.tolist())]
    left = [x[:a][::-1].ljust(72, b"\0") for x, a in zip(segments, lead.tolist())]
    later = np.zeros((m, LEADS), dtype=bool)
    order_r, lcp_r = deep_shallow(right, group)
    order_l, lcp_l = deep_shallow(left, group)
    class_r, class_l = np.empty(m, dtype=np.int64), np.empty(m, dtype=np.int64)
    for o in range(LEADS):
        own = np.flatnonzero((o <= lead) & (o > lead - n))
        if len(own) < 2:
            continue
        class_r[order_r] = np.cumsum(lcp_r < WINDOW - o)
        class_l[order_l] = np.cumsum(lcp_l < o)
        _, first = np.unique(class_r[own] * (m + 1) + class_l[own], return_index=True)
        seen = np.ones(len(own), dtype=bool)
        seen[first] = False
        later[own[seen], o] = True
    return later


def _segments(batches):
    """(group, rid, place, bytes): each run cut by RANGES, with the bytes that its windows there cover."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for rid, text, runs in zip(*(batch.column(i) for i in range(3))):
            data, doc = text.as_py(), rid.as_py()
            for r in runs.as_py():
                begin, lead, n = r["place"] >> 16, r["place"] >> 8 & 255, r["place"] & 255
                for a, b in RANGES:
                    low, high = max(lead - n + 1, a), min(lead, b - 1)
                    if low <= high:
                        at, anchor = begin + lead - high, begin + lead
                        around = xxhash.xxh64_intdigest(data[anchor - a : anchor + WINDOW - b + 1], a)
                        row = (around - (around >> 63 << 64), doc, at << 16 | high << 8 | (high - low + 1), data[at : at + high - low + WINDOW])
                        for column, value in zip(out, row):
                            column.append(value)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())], names=["h", "rid", "place", "bytes"])


def _judge(batches):
    """Later windows as runs (rid, start, n), from runs that come sorted by (h, rid, place)."""
    def found(h, rid, place, segments):
        h, rid, place = (np.array(x, dtype=np.int64) for x in (h, rid, place))
        start, lead, n = place >> 16, place >> 8 & 255, place & 255
        later = later_windows(np.concatenate([[0], np.cumsum(h[1:] != h[:-1])]), lead, n, segments)
        who, o = np.nonzero(later[:, ::-1])  # greater offsets are earlier starts
        at = start[who] + lead[who] - (LEADS - 1 - o)
        cut = np.flatnonzero((np.diff(who) != 0) | (np.diff(at) != 1)) + 1
        first = np.concatenate([[0], cut])[: len(who)]
        count = np.diff(np.concatenate([first, [len(who)]]))
        return pa.RecordBatch.from_arrays([pa.array(rid[who[first]]), pa.array(at[first]), pa.array(count)], names=["rid", "start", "n"])

    held: list[list] = [[], [], [], []]
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(4)]
        for row in zip(*columns):
            if len(held[0]) >= BATCH and row[0] != held[0][-1]:
                yield found(*held)
                held = [[], [], [], []]
            for column, value in zip(held, row):
                column.append(value)
    if held[0]:
        yield found(*held)


def earlier_repeats(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """(rid, start, n): windows from start on, n in number, whose bytes also start earlier."""
    found = repeated_runs(scratch, docs, WINDOW, GRAM, words=False)
    runs = functools.reduce(DataFrame.union, found).withColumn("at", where())
    kinds = scratch.save(runs.groupBy(F.col("h").alias("h_"), F.col("s").alias("s_")).agg(F.min("at").alias("least")))
    marked = scratch.save(runs.join(kinds, (F.col("h") == F.col("h_")) & (F.col("s") == F.col("s_"))).select(
        "h", "rid", "place", "reps", "mixed", (F.col("at") == F.col("least")).alias("first")), kinds, *found)
    # of a first run that goes on, all but its beginning is a repeat
    skip = F.when(F.col("first"), 1).otherwise(0)
    whole = marked.filter("not first or reps > 1").select(
        "rid", (start() + windows() * skip).alias("start"), (windows() * (F.col("reps") - skip)).cast("long").alias("n"))
    firsts = marked.filter("first and mixed").select("h", "rid", "place")
    segments = with_text(docs, firsts, _segments, "h long, rid long, place long, bytes binary")
    segments = scratch.save(segments)
    shared = scratch.save(segments.groupBy(F.col("h").alias("h_")).count().filter("count > 1").select("h_"))
    several = segments.join(shared, segments["h"] == shared["h_"], "left_semi")
    parted = scratch.save(several.repartition("h").sortWithinPartitions("h", "rid", "place").mapInArrow(
        _judge, "rid long, start long, n long"), segments, shared)
    return scratch.save(whole.union(parted), marked, parted)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Bytes of each text that no 100-byte string which also starts earlier covers.

    (key, n_bytes, n_removed, n_spans, kept_sha256 and, with keep_text, kept: binary). "Earlier" is
    a smaller key, or the same document and an earlier start. Null text: as empty. Rows with the
    same key are documents of their own, in the order of their texts; null keys come first.
    Other columns are ignored, whatever their names. Cuts may fall inside a UTF-8 character, so
    `kept` is binary.
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    own = keyed(scratch, docs, key, text)
    spans = earlier_repeats(scratch, own).select("rid", F.col("start").alias("lo"), (F.col("start") + F.col("n") - 1 + WINDOW).alias("hi"))

    def of(batches):
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for t, spans in zip(batch.column(2), batch.column(3)):
                data, gone = t.as_py() or b"", merged(spans.as_py())
                edges = [0, *(e for s in gone for e in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                row = (len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept if keep_text else None)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, k) for c, k in zip(out, kinds))],
                                             names=["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    kind = own.schema["key"].dataType.simpleString()
    out = cut_spans(own, spans, of, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return (out if keep_text else out.drop("kept")).withColumnRenamed("key", key)


def op6_suffix_array(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs, keep_text=False)


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, '')))::BIGINT AS n FROM documents),
g AS (SELECT doc_id, i, substr(x, 2 * i - 1, 200) AS g FROM (SELECT doc_id, x, unnest(generate_series(1, n - 99)) AS i FROM d WHERE n >= 100)),
r AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k FROM g),
s AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new FROM r WHERE k > 1),
t AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s),
u AS (SELECT doc_id, min(i) AS lo, max(i) + 99 AS hi FROM t GROUP BY doc_id, run),
v AS (SELECT doc_id, sum(hi - lo + 1) AS gone, count(*) AS runs FROM u GROUP BY doc_id),
e AS (SELECT doc_id, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS a, lo AS b FROM u UNION ALL
      SELECT d.doc_id, coalesce(max(hi), 0), any_value(n) + 1 FROM d LEFT JOIN u ON d.doc_id = u.doc_id GROUP BY d.doc_id),
k AS (SELECT e.doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a - 1)), '' ORDER BY a, b) AS kept FROM e JOIN d ON e.doc_id = d.doc_id GROUP BY e.doc_id)
SELECT d.doc_id, n AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(runs, 0)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN k ON d.doc_id = k.doc_id LEFT JOIN v ON d.doc_id = v.doc_id
"""

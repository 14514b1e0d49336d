"""Substring dedup over words by De Bruijn compaction.

Edges of the graph are 35-word windows (token k-mers); a window that occurs twice anywhere is a
repeated edge. Most repeated edges lie on nonbranching paths, so they are compacted twice. While
reading, consecutive windows with one winnowing anchor become a piece with one label (winnow.py);
only where pieces with the same anchor differ are they opened into single edges. Then labels are
compacted through Spark joins: where every occurrence of a label is followed by the same other
one, and that one always preceded by it, the two are on one path. A path is laid out once, along
its earliest source; its other occurrences are found by its two ends alone, and count if both
ends are in the source at the path's distance. These verified spans are removed.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import winnow
from .common import Scratch, cut_spans, keyed, merged
from .repeats import repeated_runs, start, where, windows, with_text

WINDOW = 35
GRAM = 8


def _edges(batches):
    """The single edges of the runs given: (h, edge, rid, at)."""
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for rid, text, runs in zip(*(batch.column(i) for i in range(3))):
            runs = runs.as_py()
            tokens = winnow.word_tokens(np.frombuffer(text.as_py(), dtype=np.uint8))
            place = np.array([r["place"] for r in runs])
            n = place & 255
            at = np.repeat(place >> 16, n) + np.concatenate([np.arange(k) for k in n.tolist()])
            out[0].append(np.repeat(np.array([r["h"] for r in runs], dtype=np.int64), n))
            out[1].append(winnow.span_hashes(tokens, at, at + WINDOW).view(np.int64))
            out[2].append(np.full(len(at), rid.as_py()))
            out[3].append(at)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) if c else pa.array([], pa.int64()) for c in out],
                                         names=["h", "edge", "rid", "at"])


def repeated_pieces(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """(label, rid, start, n): path pieces of n consecutive repeated edges, from word `start` on."""
    found = repeated_runs(scratch, docs, WINDOW, GRAM, words=True)
    runs = functools.reduce(DataFrame.union, found).withColumn("at", where())
    kinds = scratch.save(runs.groupBy(F.col("h").alias("h_"), F.col("s").alias("s_")).agg(
        (F.sum("reps") > 1).alias("twice"), F.first("mixed").alias("mixed_"), F.min("at").alias("at_"),
        F.min_by("rid", "at").alias("rid_"), F.min_by("place", "at").alias("place_")))
    known = kinds.filter("twice").select("h_", "s_")
    whole = scratch.save(runs.join(known, (F.col("h") == F.col("h_")) & (F.col("s") == F.col("s_"))).select(
        F.xxhash64("h", "s", "reps").alias("label"), "rid", start().alias("start"), (windows() * F.col("reps")).cast("long").alias("n")), *found)
    # edges of runs that are alone in their class can still equal edges of runs in another
    # class; of each class one run is enough to tell
    least = kinds.filter("mixed_").select(F.col("h_").alias("h"), "twice", F.col("rid_").alias("rid"), F.col("place_").alias("place"))
    opened = scratch.save(with_text(docs, least, _edges, "h long, edge long, rid long, at long"))
    alone = least.filter("not twice").select("rid", F.explode(F.sequence(start(), start() + windows() - 1)).alias("at"))
    often = opened.groupBy(F.col("h").alias("h_"), F.col("edge").alias("edge_")).count().filter("count > 1").drop("count")
    often = scratch.save(often)
    single = opened.join(often, (F.col("h") == F.col("h_")) & (F.col("edge") == F.col("edge_"))).join(alone, ["rid", "at"], "left_semi")
    single = single.select(F.xxhash64("h", "edge").alias("label"), "rid", F.col("at").alias("start"), F.lit(1).cast("long").alias("n"))
    return scratch.save(whole.union(single), whole, kinds, opened, often)


def compacted(scratch: Scratch, found: DataFrame) -> DataFrame:
    """(head, tail, offset, total): each nonbranching path by the labels at its ends, how many edges the
    tail begins after the head, and how many edges there are. A path of one label is its own tail."""
    along = Window.partitionBy("rid").orderBy("start")
    steps = found.select("label", (F.col("start") + F.col("n")).alias("end"), F.lead("start").over(along).alias("next"),
                         F.lead("label").over(along).alias("then")).filter("end = next").groupBy("label", "then").agg(F.count("*").alias("c"))
    at = F.col("rid").cast("decimal(38,0)") * F.lit(1 << 60).cast("decimal(19,0)") + F.col("start")
    nodes = scratch.save(found.withColumn("at", at.cast("decimal(38,0)")).groupBy("label").agg(
        F.count("*").alias("often"), F.min("at").alias("at"), F.min_by("rid", "at").alias("rid"), F.min_by("start", "at").alias("start"), F.first("n").alias("n")))
    often = nodes.select("label", "often")
    links = steps.join(often, "label").filter("c = often").drop("often").join(often.toDF("then", "often"), "then").filter("c = often")
    links = scratch.save(links.select(F.col("then").alias("label"), F.lit(True).alias("linked")))
    # all labels of a path have their earliest occurrence in one source, one after another
    laid = nodes.join(links, "label", "left").withColumn("path", F.sum(F.when(F.col("linked"), 0).otherwise(1)).over(along))
    ends = laid.groupBy("rid", "path").agg(F.min_by("label", "start").alias("head"), F.max_by("label", "start").alias("tail"),
                                           F.max("start").alias("last"), F.min("start").alias("first"), F.sum("n").alias("total"))
    return scratch.save(ends.select("head", "tail", (F.col("last") - F.col("first")).alias("offset"), "total"), nodes, links)


def repeated_spans(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """(rid, lo, hi): verified spans of words, each an occurrence of one path of the compacted graph."""
    found = repeated_pieces(scratch, docs)
    paths = compacted(scratch, found)
    ends = scratch.save(paths.select(F.col("head").alias("end"), F.lit(0).cast("long").alias("back"), "head", "total", F.when(
        F.col("head") == F.col("tail"), 2).otherwise(1).alias("ends")).union(
            paths.filter("head <> tail").select("tail", "offset", "head", "total", F.lit(1))), paths)
    met = found.join(ends, F.col("label") == F.col("end")).select("rid", (F.col("start") - F.col("back")).alias("lo"), "head", "total", "ends")
    spans = met.groupBy("rid", "lo", "head").agg(F.sum("ends").alias("ends"), F.first("total").alias("total")).filter("ends = 2")
    return scratch.save(spans.select("rid", "lo", (F.col("lo") + F.col("total") - 1 + WINDOW).alias("hi")), found, ends)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """Words of each text that no repeated 35-word window covers.

    (key, n_words, n_removed, kept_sha256 and, with keep_text, kept: the words left, joined by one
    space). A window counts as repeated if its words also start anywhere else, be it in the same
    document. Null text: no words. Rows with the same key are documents of their own, so two equal
    rows of 35 words or more remove each other. Other columns are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "debruijn")
    own = keyed(scratch, docs, key, text)
    spans = repeated_spans(scratch, own)

    def of(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for t, spans in zip(batch.column(2), batch.column(3)):
                words = (t.as_py() or b"").split()
                edges = [0, *(e for s in merged(spans.as_py()) for e in s), len(words)]
                left = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]
                kept = b" ".join(left)
                row = (len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace") if keep_text else None)
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, k) for c, k in zip(out, kinds))],
                                             names=["key", "n_words", "n_removed", "kept_sha256", "kept"])

    kind = own.schema["key"].dataType.simpleString()
    out = cut_spans(own, spans, of, f"key {kind}, n_words long, n_removed long, kept_sha256 string, kept string")
    return (out if keep_text else out.drop("kept")).withColumnRenamed("key", key)


def op10_debruijn(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return without_repeats(docs, keep_text=False)


OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 34), ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)),
r AS (SELECT g FROM x GROUP BY g HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS p FROM x JOIN r USING (g)),
k AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
l AS (SELECT k.doc_id, count(*) AS n, count(c.p) AS gone, coalesce(string_agg(word, ' ' ORDER BY k.p) FILTER (WHERE c.p IS NULL), '') AS kept FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND k.p = c.p GROUP BY k.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN l ON d.doc_id = l.doc_id
"""

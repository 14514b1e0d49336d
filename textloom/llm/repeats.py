"""Spark side of the winnowed runs: which runs repeat, and the texts of those to compare."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import winnow
from .common import Scratch

#: place holds start << 16 | lead << 8 | n; n and lead are below 256.
RUN = "h long, s long, rid long, place long, reps int"
#: Parts of the anchors that are counted one after another, so that shuffle files of one part are there at a time.
PASSES = 4


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def find_runs(docs: DataFrame, window: int, gram: int, words: bool) -> DataFrame:
    """(h, s, rid, place, reps) of every run of every text, one task to an input split."""
    def data_of(text: pa.Scalar) -> np.ndarray:
        data = np.frombuffer(text.as_buffer(), dtype=np.uint8) if text.is_valid else np.zeros(0, dtype=np.uint8)
        return winnow.word_tokens(data) if words else data

    def of(batches):
        for batch in batches:
            rid, texts = batch.column(0).to_numpy(), batch.column(1)
            stream = ((i, data_of(texts[i])) for i in range(len(rid)))
            for tokens, lengths, who, offset in winnow.pieces(stream, window, None if words else winnow.BYTE_TOKENS.__getitem__):
                piece, start, lead, n, h, s, reps = winnow.runs(tokens, lengths, window, gram)
                place = (start + np.array(offset)[piece]) << 16 | lead << 8 | n
                yield pa.RecordBatch.from_arrays(
                    [_long(h), _long(s), pa.array(rid[np.array(who)[piece]]), pa.array(place), pa.array(reps.astype(np.int32))],
                    names=["h", "s", "rid", "place", "reps"])

    return docs.select("rid", "t").mapInArrow(of, RUN)


def repeated_runs(scratch: Scratch, docs: DataFrame, window: int, gram: int, words: bool) -> list[DataFrame]:
    """Saved tables of the runs whose anchor occurs more than once, with `mixed`: whether runs with that anchor differ.

    Counts are combined before the shuffle, and are a table of their own, so that Spark can split
    the join back where an anchor is hot: no anchor meets in one task.
    """
    every = scratch.save(find_runs(docs, window, gram, words))
    parts = []
    for k in range(PASSES):
        own = every.filter(F.shiftrightunsigned("h", 17).bitwiseAND(F.lit(PASSES - 1)) == k)
        often = own.groupBy(F.col("h").alias("h_")).agg(F.sum("reps").alias("c"), (F.min("s") != F.max("s")).alias("mixed")).filter("c > 1").drop("c")
        often = scratch.save(often)
        parts.append(scratch.save(own.join(often, own["h"] == often["h_"]).drop("h_"), often))
    scratch.drop(every)
    return parts


def where() -> Column:
    """A number by which runs (rid, place) are in the order of document and start."""
    spot = F.col("rid").cast("decimal(38,0)") * F.lit(1 << 60).cast("decimal(19,0)") + F.col("place")
    return spot.cast("decimal(38,0)")


def start() -> Column:
    return F.shiftright("place", 16)


def windows() -> Column:
    return F.col("place").bitwiseAND(F.lit(255))


def with_text(docs: DataFrame, runs: DataFrame, of, schema: str) -> DataFrame:
    """mapInArrow of `of` over the texts that have runs: (rid, t, runs: array of (h, place)), at most one run for two bytes."""
    lists = runs.groupBy(F.col("rid").alias("rid_")).agg(F.collect_list(F.struct("h", "place")).alias("runs"))
    return docs.join(lists, docs["rid"] == lists["rid_"]).select("rid", "t", "runs").mapInArrow(of, schema)

"""SimHash near-dedup by anchor-point covering.

Fingerprints are 64 bits. Bits 0-22 and 23-45 are two words of the perfect binary Golay code
[23,12,7], whose covering radius is 3: every word lies within 3 bits of exactly one codeword.
An anchor is a pair of codewords. Each fingerprint is at home at its own anchor and is
replicated to every anchor within covering radius plus threshold of it, so if two fingerprints
differ in at most `threshold` bits, each is replicated to the home anchor of the other, and one
comparison per anchor finds the pair. Anchors at which more than HOT_HOMES fingerprints are at
home are not compared pair by pair: their fingerprints meet at midpoints instead (two words
differ in at most 2 bits if and only if some word is within 1 bit of both), which is exact and
linear in their number.
"""

from __future__ import annotations

import functools
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, apart, components

SHINGLE = 3
SEED = 42
THRESHOLD = 2
#: Fingerprints at home at one anchor from which on midpoints replace comparison.
HOT_HOMES = 64
BLOCK = 23
RADIUS = 3
#: Generator polynomial of the binary Golay code: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101


def fingerprint(text: str | None, width: int = SHINGLE) -> int:
    """Unsigned fingerprint of one text; 0 where it has no words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words)] if len(words) < width else map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """(key, fp): one row per document, fp as a signed long."""
    def of(batches):
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["k", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(
        of, f"k {kind}, fp long").withColumnRenamed("k", key)


@functools.cache
def golay_cosets() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the words of weight up to 5 with that syndrome, and their weight above 3."""
    def rest(words: np.ndarray) -> np.ndarray:
        out = words.copy()
        for bit in range(BLOCK - 1, 10, -1):
            out ^= np.where(out >> np.uint64(bit) & np.uint64(1), np.uint64(GOLAY << (bit - 11)), np.uint64(0))
        return out

    found: list[list[tuple[int, int]]] = [[] for _ in range(2048)]
    for weight in range(RADIUS + THRESHOLD + 1):
        words = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(BLOCK), weight)], dtype=np.uint64)
        for word, syndrome in zip(words.tolist(), rest(words).tolist()):
            found[syndrome].append((word, max(0, weight - RADIUS)))
    most = max(map(len, found))
    table, over = np.zeros((2048, most), dtype=np.uint64), np.full((2048, most), 9, dtype=np.int8)
    for s, row in enumerate(found):
        table[s, : len(row)], over[s, : len(row)] = [w for w, _ in row], [e for _, e in row]
    return table, over


def _syndrome(words: np.ndarray) -> np.ndarray:
    out = words.copy()
    for bit in range(BLOCK - 1, 10, -1):
        out ^= np.where(out >> np.uint64(bit) & np.uint64(1), np.uint64(GOLAY << (bit - 11)), np.uint64(0))
    return out.astype(np.int64)


def anchors(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of fingerprint, anchor, whether it is the home) for every anchor to replicate to."""
    table, over = golay_cosets()
    mask = np.uint64((1 << BLOCK) - 1)
    low, high = fps & mask, fps >> np.uint64(BLOCK) & mask
    s1, s2 = _syndrome(low), _syndrome(high)
    total = over[s1][:, :, None] + over[s2][:, None, :]
    who, a, b = np.nonzero(total <= THRESHOLD)
    at = (low[who] ^ table[s1[who], a]) | (high[who] ^ table[s2[who], b]) << np.uint64(BLOCK)
    # the word of least weight comes first in each coset: the one within the radius
    return who, at, (a == 0) & (b == 0)


def links(scratch: Scratch, fps: DataFrame, hot_homes: int = HOT_HOMES) -> DataFrame:
    """(u, v): links that join fingerprints of the distinct column fp at THRESHOLD bits or fewer.

    Links between hot fingerprints run by way of their smallest fellow at a midpoint, so that
    components are kept though not all pairs are listed.
    """
    def spread(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for lo in range(0, len(values), 2048):
                who, at, home = anchors(values[lo : lo + 2048])
                own = values[lo : lo + 2048][who]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at.view(np.int64)), pa.array(own.view(np.int64)), pa.array(home)], names=["anchor", "fp", "home"])

    def home_of(batches):
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            mask = np.uint64((1 << BLOCK) - 1)
            table, _ = golay_cosets()
            low, high = values & mask, values >> np.uint64(BLOCK) & mask
            at = (low ^ table[_syndrome(low), 0]) | (high ^ table[_syndrome(high), 0]) << np.uint64(BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array(at.view(np.int64)), batch.column(0)], names=["anchor", "fp"])

    homes = fps.select("fp").mapInArrow(home_of, "anchor long, fp long")
    full = scratch.save(homes.groupBy("anchor").count().select("anchor", (F.col("count") > hot_homes).alias("hot")))
    homes = scratch.save(homes.join(apart(full), "anchor"), full)
    near = fps.select("fp").mapInArrow(spread, "anchor long, fp long, home boolean").select("anchor", F.col("fp").alias("v"))
    differ = F.expr("bit_count(u ^ v)")
    cold = homes.filter("not hot").select("anchor", F.col("fp").alias("u")).join(apart(near), "anchor").filter(
        (F.col("u") != F.col("v")) & (differ <= THRESHOLD)).select("u", "v")
    around = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")) for i in range(64)])
    middle = homes.filter("hot").select("fp", F.explode(around).alias("z"))
    least = middle.groupBy("z").agg(F.min("fp").alias("v"), F.count("*").alias("n")).filter("n > 1").drop("n")
    hot = middle.join(apart(least), "z").filter("fp <> v").select(F.col("fp").alias("u"), "v").distinct()
    return cold.union(hot)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """(key, fp, component): the smallest key that links of fingerprints reach, itself included. width: words of a shingle.

    A null or empty text has fingerprint zero and is linked like any other; equal rows link as
    equal fingerprints; a null key gets the component of its fingerprint's other keys, or null
    where there are none. Columns beside key and text are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    marked = scratch.save(fingerprints(docs, key, text, width))
    classes = scratch.save(marked.groupBy("fp").agg(F.min(key).alias("least")))
    roots = components(scratch, links(scratch, classes))
    tied = classes.join(apart(roots), classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = tied.groupBy("root").agg(F.min("least").alias("component"))
    # a table of its own, so that Spark can split the join where a fingerprint has many documents
    named = scratch.save(tied.join(apart(lowest), "root").select(F.col("fp").alias("fp_"), "component"))
    scratch.only(marked, named)
    return marked.join(apart(named), marked["fp"] == named["fp_"]).select(key, "fp", "component")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))

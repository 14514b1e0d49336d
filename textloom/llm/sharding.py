"""Sharding by extendible hashing, in DataFrame functions only.

A key's hash is the bits of the MD5 of its text form. The directory begins as one bucket; a
bucket that holds more than its limit of bytes, and no other, splits on the next bit. Sizes are
summed for LEVEL bits at a time, so a level costs one aggregation whatever its splits, and a
further level reads only the buckets that are still too large. The directory has one entry for
each prefix of that length; rows meet it in an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, ranked

SHARD_BYTES = 32 << 20
#: Bits of one level of the directory: four hexadecimal digits.
LEVEL = 16
LEVELS = 4


def _bits(number: Column, width: Column) -> Column:
    return F.when(width == 0, F.lit("")).otherwise(F.lpad(F.bin(number), width, "0"))


def directory(sizes: DataFrame, limit: int, level: int) -> DataFrame:
    """(entry, label, fits): for each prefix of level + 1 times four digits, the bucket that holds it.

    sizes: (entry, bytes), already summed by prefix; prefixes of one parent split together.
    """
    parent = F.substring("entry", 1, 4 * level)
    number = F.conv(F.substring("entry", 4 * level + 1, 4), 16, 10).cast("int")
    spread = sizes.select("entry", "bytes", parent.alias("parent"), F.explode(F.sequence(F.lit(0), F.lit(LEVEL))).alias("depth"), number.alias("number"))
    spread = spread.withColumn("prefix", F.expr(f"shiftright(number, {LEVEL} - depth)"))
    sums = spread.groupBy("parent", "depth", "prefix").agg(F.sum("bytes").alias("total"))
    fits = spread.join(sums.filter((F.col("total") <= limit) | (F.col("depth") == LEVEL)), ["parent", "depth", "prefix"])
    best = fits.groupBy("entry", "parent").agg(F.min(F.struct("depth", "prefix", "total")).alias("b"))
    above = F.when(F.lit(level) == 0, F.lit("")).otherwise(F.lpad(F.conv("parent", 16, 2), LEVEL * level, "0"))
    return best.select("entry", F.concat(F.lit("b"), above, _bits(F.col("b.prefix"), F.col("b.depth"))).alias("label"), (F.col("b.total") <= limit).alias("fits"))


def sharded(docs: DataFrame, carry: list[str], key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """carry's columns, bytes and shard: one row per row of docs.

    shard is "b" and the bucket's hash bits. A null text has no bytes; a null key hashes as the
    empty string. A text longer than the limit fits no shard and gets one of its own ("x", the
    hash, "/", its number among equal hashes). Rows whose hashes are all equal cannot be split by
    bits: they overflow into shards "b", all bits, "/" and a number, each within the limit.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    hashed = scratch.save(docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
                                      F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("bytes"),
                                      F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 16).alias("hash")))
    names = [f"_c{i}" for i in range(len(carry))]
    giant = hashed.filter(F.col("bytes") > limit)
    rest, done = hashed.filter(F.col("bytes") <= limit), []
    for level in range(LEVELS):
        entry = F.substring("hash", 1, 4 * (level + 1))
        sizes = rest.groupBy(entry.alias("entry")).agg(F.sum("bytes").alias("bytes"))
        made = scratch.save(directory(sizes, limit, level)).withColumnRenamed("entry", "entry_")
        placed = rest.join(made, entry == made["entry_"]).drop("entry_")
        if not made.filter("not fits").limit(1).count():
            done.append(placed.select(*names, "bytes", "label"))
            rest = None
            break
        done.append(placed.filter("fits").select(*names, "bytes", "label"))
        rest = scratch.save(placed.filter("not fits").select(*names, "bytes", "hash"))
    content = [F.xxhash64(*names), *[F.col(c) for c in names]]
    if rest is not None:
        most = rest.agg(F.max("bytes")).first()[0] or 0
        room = F.lit(max(1, limit - most))  # rows that begin within it end within the limit
        numbered = ranked(rest, ["hash"], content, content[0], "before", size=F.greatest("bytes", F.lit(1).cast("long")))
        done.append(numbered.select(*names, "bytes", F.concat(F.lit("b"), F.lpad(F.conv("hash", 16, 2), 64, "0"), F.lit("/"), F.floor(F.col("before") / room)).alias("label")))
    if giant.limit(1).count():
        numbered = ranked(giant, ["hash"], content, content[0], "before")
        done.append(numbered.select(*names, "bytes", F.concat(F.lit("x"), "hash", F.lit("/"), F.col("before")).alias("label")))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], "bytes", F.col("label").alias("shard"))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sharded(docs, ["doc_id"])


OP9_SQL = f"""
WITH d AS (SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) AS bytes, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 16) AS h FROM documents),
b AS (SELECT doc_id, bytes, list_aggregate([lpad(bin(CAST('0x' || substr(h, i, 4) AS INTEGER)), 16, '0') FOR i IN [1, 5, 9, 13]], 'string_agg', '') AS bits FROM d),
p AS (SELECT doc_id, bytes, depth, substr(bits, 1, depth) AS prefix FROM b, (SELECT unnest(generate_series(0, 64)) AS depth)),
s AS (SELECT depth, prefix FROM p GROUP BY depth, prefix HAVING sum(bytes) <= {SHARD_BYTES})
SELECT doc_id, any_value(bytes) AS bytes, 'b' || min_by(p.prefix, p.depth) AS shard
FROM p JOIN s ON p.depth = s.depth AND p.prefix = s.prefix GROUP BY doc_id
"""

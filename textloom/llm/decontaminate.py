"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A window of an item is contained in a document where all its shingles (3 words) are, one after
another. Shingles are ordered by rarity (how often they occur in all documents), and as
containment needs every shingle, the prefix of a window that must match is its rarest shingle
alone. The text is read once: a bitmap of the items' shingles keeps the document shingles that
may matter, with their places. Their counts give the order; a join on prefix shingles gives
candidates; the length bound and the positional bound (the window must begin and end inside the
kept shingles) go before the comparison of the whole window, shingle for shingle.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

WINDOW = 10
SHINGLE = 3
#: Bits of the bitmap of benchmark shingles; it is sent to every task and its size is fixed.
BITS = 1 << 22
#: Bytes that separate words, after A-Z became a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z (and no other letters) lower-cased; null text has none."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.filter(F.split(F.coalesce(low, F.lit("")), SEPARATORS), lambda w: w != "")


def shingle(hashes: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*[F.get(hashes, at + j) for j in range(width)])


def _places(n: Column) -> Column:
    """0 .. n-1, nothing where n < 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def item_windows(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(sh, width, items): each distinct window as its list of shingles, and the items that have it.

    Items of less than SHINGLE words have windows of one shingle of that width."""
    hashed = benchmark.select(F.col(item).cast("string").alias("item"), F.transform(words_of(F.col(text)), lambda w: F.xxhash64(w)).alias("h"))
    hashed = hashed.filter(F.size("h") > 0).withColumn("len", F.least(F.size("h"), F.lit(window)))
    cut = hashed.select("item", F.explode(F.transform(_places(F.size("h") - F.col("len") + 1), lambda i: F.slice("h", i + 1, F.col("len")))).alias("h"))
    n = F.size("h")
    lists = F.when(n == 1, F.array(shingle(F.col("h"), F.lit(0), 1))).when(n == 2, F.array(shingle(F.col("h"), F.lit(0), 2))).otherwise(
        F.transform(_places(n - SHINGLE + 1), lambda i: shingle(F.col("h"), i, SHINGLE)))
    return cut.select("item", F.least(n, F.lit(SHINGLE)).alias("width"), lists.alias("sh")).groupBy("sh", "width").agg(
        F.sort_array(F.collect_set("item")).alias("items"))


def bitmap(hashes: DataFrame) -> DataFrame:
    """One row: array of BITS/64 longs with the bits of column sh set."""
    spot = F.col("sh").bitwiseAND(F.lit(BITS - 1))
    held = hashes.select(F.shiftright(spot, 6).alias("i"), F.expr(f"shiftleft(1L, cast(sh & {BITS - 1} as int) & 63)").alias("b")).groupBy("i").agg(F.bit_or("b").alias("b"))
    every = hashes.sparkSession.range(BITS // 64).withColumnRenamed("id", "j")
    return every.join(held, F.col("i") == F.col("j"), "left").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("j", F.coalesce("b", F.lit(0).cast("long")).alias("b")))), lambda x: x["b"]).alias("bits"))


def contamination(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", item: str = "item_id",
                  item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(keys, n_words, n_hit, n_items, items_sha256, contaminated, items), one row per row of docs.

    n_hit counts words inside any occurrence of a window; items are the ids, as sorted strings, of
    items of which a window occurs. Null or empty text: no words, no hits. Repeated rows are
    judged each for itself. Empty benchmark: nothing is hit. Items with a null id mark words but
    are not listed. Other columns are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "decontaminate")
    windows = scratch.save(item_windows(benchmark, item, item_text, window))
    widths = sorted(r[0] for r in windows.select("width").distinct().collect())  # 1, 2 and 3 at most
    bits = scratch.save(bitmap(windows.select(F.explode("sh").alias("sh")))).scalar()

    def marked(width: int) -> Column:
        may = lambda i: F.getbit(
            F.get(F.col("bits"), F.shiftright(shingle(F.col("h"), i, width).bitwiseAND(F.lit(BITS - 1)), 6).cast("int")),
            shingle(F.col("h"), i, width).bitwiseAND(F.lit(63)).cast("int")) == 1
        return F.transform(F.filter(_places(F.size("h") - width + 1), may),
                           lambda i: F.struct(i.alias("pos"), shingle(F.col("h"), i, width).alias("sh"), F.lit(width).alias("width")))

    none = F.array().cast("array<struct<pos:int,sh:bigint,width:int>>")
    hashed = docs.select(*[F.col(k) for k in keys], F.transform(words_of(F.col(text).cast("string")), lambda w: F.xxhash64(w)).alias("h"), bits.alias("bits"))
    read = scratch.save(hashed.select(
        F.monotonically_increasing_id().alias("rid"), F.struct(*keys).alias("keys"), F.size("h").cast("long").alias("n_words"),
        F.concat(none, *[marked(w) for w in widths]).alias("arr")))
    spread = read.filter(F.size("arr") > 0).select("rid", F.posexplode("arr").alias("k", "e")).select("rid", "k", F.col("e.sh").alias("sh"))
    often = spread.groupBy("sh").agg(F.count("*").alias("n"))
    # the windows that can occur, each with the place of its rarest shingle
    parts = windows.select("sh", "width", "items", F.posexplode("sh").alias("off", "one"))
    often = often.withColumnRenamed("sh", "one_")
    rare = parts.join(often, parts["one"] == often["one_"], "left").groupBy("sh", "width", "items").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "one")).alias("rarest")).filter("rarest.n > 0")
    prefix = rare.select(F.col("sh").alias("win"), "width", "items", F.col("rarest.off").alias("off"), F.col("rarest.one").alias("one"))
    found = spread.join(prefix, spread["sh"] == prefix["one"]).filter("k >= off").groupBy("rid").agg(
        F.collect_list(F.struct((F.col("k") - F.col("off")).alias("k"), "win", "width", "items")).alias("found")).withColumnRenamed("rid", "rid_")
    both = read.join(found, read["rid"] == found["rid_"], "left")

    def verified(c: Column) -> Column:
        m = F.size(c["win"])
        part = F.slice(F.col("arr"), c["k"] + 1, m)
        return (c["k"] + m <= F.size("arr")) & (F.get(part, m - 1)["pos"] - F.get(part, F.lit(0))["pos"] == m - 1) & (
            F.transform(part, lambda e: e["sh"]) == c["win"])

    hits = F.transform(F.filter(F.coalesce("found", F.array().cast(found.schema["found"].dataType)), verified), lambda c: F.struct(
        F.get(F.col("arr"), c["k"])["pos"].alias("lo"), (F.get(F.col("arr"), c["k"])["pos"] + F.size(c["win"]) + c["width"] - 1).alias("hi"), c["items"].alias("items")))
    judged = both.select("keys", "n_words", F.sort_array(hits).alias("hits"))
    covered = F.aggregate("hits", F.struct(F.lit(0).alias("sum"), F.lit(0).alias("end")), lambda a, x: F.struct(
        (a["sum"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"], a["end"]))).alias("sum"),
        F.greatest(a["end"], x["hi"]).alias("end")), lambda a: a["sum"].cast("long"))
    out = judged.select("keys", "n_words", covered.alias("n_hit"),
                        F.sort_array(F.array_distinct(F.flatten(F.transform("hits", lambda x: x["items"])))).alias("items"))
    return out.select("keys.*", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "items")


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), ["doc_id"]).drop("items")


OP3_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM bs),
ds AS (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM ds),
hits AS (SELECT doc_id, dw.n AS n, i, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
spot AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spot USING (doc_id) LEFT JOIN items USING (doc_id)
"""

"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions only.

Every source is cut into blocks. Time is cut into slots, one block each; a source of weight w (all
weights together are one) is to have w of the slots. Its block i is released at slot
floor((i-1) / w) and due by slot ceil(i / w); in every slot the released block of earliest deadline
goes first. With all weights together at one, every block meets its deadline, so before every slot
each source is less than one block from its share, however many slots there are (Baruah and
others, 1996). When a source runs out, a new phase begins, in which the sources left share all
slots by their weights. All rows are kept: phases go on until the last block.

Weights are integers out of their sum, so that releases and deadlines are exact. Integers are taken
as they are, other weights to one in UNITS, which moves a share of n sources by less than
n slots / UNITS blocks. The schedule is one fold over all slots, of which there is one a block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, ranked

#: Slots that the fold adds to its list at once.
CHUNK = 1000
#: The sum of the integer weights, about; 10^6, 7 and 9 divide it, so that such weights stay exact.
UNITS = 2016 * 10**6
#: Rows in a block.
BLOCK_ROWS = 64
#: Exponent of a source's share of rows in its weight, where no weights are given.
TEMPERATURE = 0.5


def _let(value: Column, of) -> Column:
    """of(value), with value evaluated once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def schedule(totals: DataFrame) -> DataFrame:
    """(source, block, phase, slot): the slot of every block, all from 0.

    totals: (source, weight, blocks), of a size bounded by the number of sources.
    """
    rows = totals.filter("blocks > 0").agg(F.array_sort(F.collect_list(F.struct("source", "weight", "blocks"))).alias("all")).filter("size(all) > 0")
    whole = F.aggregate("all", F.lit(0.0), lambda a, x: a + x["weight"])
    given = F.forall("all", lambda x: (x["weight"] == F.floor(x["weight"])) & (x["weight"] <= UNITS)) & (whole <= UNITS)
    scale = F.when(given, F.lit(1.0)).otherwise(UNITS / whole)
    rows = rows.withColumn("scale", scale).select(
        F.transform("all", lambda x: x["source"]).alias("names"), F.transform("all", lambda x: x["blocks"]).alias("blocks"),
        F.transform("all", lambda x: F.greatest(F.lit(1).cast("long"), F.round(x["weight"] * F.col("scale")).cast("long"))).alias("units"))
    rows = rows.withColumn("slots", F.aggregate("blocks", F.lit(0).cast("long"), lambda a, x: a + x))
    zeros = F.transform("blocks", lambda _: F.lit(0).cast("long"))
    sums = lambda units: F.aggregate(units, F.lit(0).cast("long"), lambda a, x: a + x)
    # left: blocks to come; units: of the sources that have any; done and t: blocks and slots of the phase
    kind = "struct<left:array<bigint>,units:array<bigint>,total:bigint,done:array<bigint>,t:bigint,phase:int,out:array<struct<i:int,left:bigint,phase:int>>>"
    first = F.struct(F.col("blocks").alias("left"), F.col("units").alias("units"), sums(F.col("units")).alias("total"), zeros.alias("done"),
                     F.lit(0).cast("long").alias("t"), F.lit(0).alias("phase"), F.array().alias("out")).cast(kind)

    def step(a: Column, _: Column) -> Column:
        # of sources whose next block (done + 1) is released by t: the one of earliest deadline
        total = a["total"]
        ready = F.transform(F.arrays_zip(a["done"].alias("d"), a["units"].alias("u")), lambda x, i: F.when(
            (x["u"] > 0) & (x["d"] * total < (a["t"] + 1) * x["u"]),
            F.struct(F.call_function("div", (x["d"] + 1) * total + x["u"] - 1, x["u"]).alias("due"), i.alias("i"))))
        return _let(F.array_min(ready)["i"], lambda i: chosen(a, i))

    def chosen(a: Column, i: Column) -> Column:
        left = F.transform(a["left"], lambda x, k: F.when(k == i, x - 1).otherwise(x))
        part = F.concat(a["out"], F.array(F.struct(i.alias("i"), F.get(a["left"], i).alias("left"), a["phase"].alias("phase"))))
        rest = F.transform(a["units"], lambda x, k: F.when(k == i, F.lit(0).cast("long")).otherwise(x))
        done = F.transform(a["done"], lambda x, k: F.when(k == i, x + 1).otherwise(x))
        on = F.struct(left.alias("left"), a["units"].alias("units"), a["total"].alias("total"), done.alias("done"), (a["t"] + 1).alias("t"), a["phase"].alias("phase"), part.alias("out"))
        new = F.struct(left.alias("left"), rest.alias("units"), sums(rest).alias("total"), F.transform(a["done"], lambda _: F.lit(0).cast("long")).alias("done"),
                       F.lit(0).cast("long").alias("t"), (a["phase"] + 1).alias("phase"), part.alias("out"))
        return F.when(F.get(a["left"], i) == 1, new.cast(kind)).otherwise(on.cast(kind))

    def chunk(a: Column, k: Column) -> Column:
        begin = a["now"].withField("out", F.array().cast("array<struct<i:int,left:bigint,phase:int>>")).cast(kind)
        some = F.sequence(k * CHUNK, F.least((k + 1) * CHUNK, F.col("slots")) - 1)
        return _let(F.aggregate(some, begin, step), lambda now: F.struct(now.alias("now"), F.concat(a["parts"], F.array(now["out"])).alias("parts")))

    start = F.struct(first.alias("now"), F.array().cast("array<array<struct<i:int,left:bigint,phase:int>>>").alias("parts"))
    chunks = F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / CHUNK))
    folded = rows.select("names", "blocks", F.aggregate(chunks, start, chunk, lambda a: a["parts"]).alias("parts"))
    folded = folded.select("names", "blocks", F.posexplode("parts").alias("at", "part")).select("names", "blocks", "at", F.posexplode("part").alias("slot", "s"))
    return folded.select(F.get("names", F.col("s.i")).alias("source"), (F.get("blocks", F.col("s.i")) - F.col("s.left")).alias("block"),
                         F.col("s.phase").alias("phase"), (F.col("at").cast("long") * CHUNK + F.col("slot")).alias("slot"))


def mixed(docs: DataFrame, weights: DataFrame | None = None, source: str = "source", key: str = "doc_id",
          block_rows: int = BLOCK_ROWS, carry: list[str] = ()) -> DataFrame:
    """carry's columns, source, block, phase, slot and place: one row per row of docs, all kept.

    In the order (slot, place) the sources are mixed to their weights. weights: (source, weight);
    sources without a positive weight come with the least positive one. Without weights a
    source's weight is its share of rows to the power TEMPERATURE. The rows of a source are put in
    the order of their key's hash, ties by key. A null source is a source of its own. No rows: no
    rows. Columns beside these are ignored, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    own = docs.select(F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")).alias("src"), F.col(key).alias("key"),
                      *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    mixed_hash = F.xxhash64(F.col("key"), F.lit(1))
    placed = scratch.save(ranked(own, ["src"], [mixed_hash, F.col("key"), *[F.col(f"_c{i}") for i in range(len(carry))]],
                                 F.shiftrightunsigned(mixed_hash, 40), "rank"))
    counts = placed.groupBy("src").agg(F.count("*").alias("rows"))
    if weights is None:
        named = counts.select("src", "rows", F.pow(F.col("rows").cast("double"), F.lit(TEMPERATURE)).alias("weight"))
    else:
        given = weights.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("src_"), F.col("weight").cast("double").alias("weight"))
        given = given.filter("weight > 0").groupBy("src_").agg(F.max("weight").alias("weight"))
        named = counts.join(given, counts["src"] == given["src_"], "left").select("src", "rows", "weight")
        named = named.select("src", "rows", F.coalesce("weight", F.min("weight").over(Window.partitionBy()), F.lit(1.0)).alias("weight"))
    totals = named.select(F.col("src").alias("source"), "weight", F.ceil(F.col("rows") / F.lit(block_rows)).cast("long").alias("blocks"))
    slots = scratch.save(schedule(totals)).withColumnsRenamed({"source": "src_", "block": "block_"})
    block = F.floor(F.col("rank") / F.lit(block_rows)).cast("long")
    out = placed.withColumn("block", block).join(slots, (F.col("src") == F.col("src_")) & (F.col("block") == F.col("block_")))
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], F.expr("nullif(substring(src, 2), case when src = '' then '' end)").alias("mix_source"),
                      "block", "phase", "slot", (F.col("rank") % block_rows).alias("place"))


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return mixed(docs, carry=["doc_id"]).select("doc_id", F.col("mix_source").alias("source"), "block", "phase", "slot", "place")

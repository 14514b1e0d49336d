"""Shared helpers: tables in the cluster's shared folder, row keys, ranks, components."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Hash buckets that a two-level rank sorts apart from one another.
RANK_BUCKETS = 1024
#: Setting by which Spark drops an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. Where it is unset, a new one in
    local mode (tests), and an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="textloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Executions inside drop their shuffle files when they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


class Scratch:
    """Tables that cut lineage: written to the shared folder as Parquet and read again."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0
        self.held: set[str] = set()

    def save(self, df: DataFrame, *done: DataFrame) -> DataFrame:
        """Write and reread; then delete the saved tables `done`, which no later step reads."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}"
        schema = df.schema
        with shuffles_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out._scratch = path
        self.held.add(path)
        for old in done:
            self.drop(old)
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a saved table that no later step reads."""
        self._delete(df._scratch)

    def only(self, *kept: DataFrame | None) -> None:
        """Delete all saved tables but these; frames that are no saved tables are passed over."""
        names = {df.__dict__.get("_scratch") for df in kept if df is not None}
        for path in self.held - names:
            self._delete(path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        self.held.discard(path)


def ranked(df: DataFrame, group: list[str], order: list[Column], salt: Column, out: str,
           size: Column | None = None, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Number the rows of each group from 0 without bringing a group into one task.

    Rows are ordered by (bucket of salt, order); counts per (group, bucket) are summed up
    before a bucket, so a group of any size is ranked in `buckets` pieces. With size, `out`
    is the sum of size over the rows before, instead of their number.
    """
    amount = F.lit(1).cast("long") if size is None else size
    cut = df.withColumn("_b", F.pmod(salt, F.lit(buckets)).cast("int")).withColumn("_a", amount)
    keys = [*group, "_b"]
    totals = cut.groupBy(*keys).agg(F.sum("_a").alias("_t"))
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_s"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("_r", F.coalesce(F.sum("_a").over(inside), F.lit(0)))
    on = [local[k].eqNullSafe(starts[k]) for k in keys]
    return local.join(starts, on, "left").select(*[local[c] for c in df.columns],
                                                 (local["_r"] + starts["_s"]).alias(out))


def apart(df: DataFrame) -> DataFrame:
    """df, for a join whose sides both grow with the input: it is not sent through the driver to all tasks.

    Spark takes a table's size from its compressed files and does not see that a function makes many rows
    of one, so that it would broadcast tables of many times the size that it allows.
    """
    return df.hint("merge")


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node that edges(u, v) reach; nodes without edges are absent.

    Alternating large-star and small-star steps (Kiveris and others, 2014) until nothing changes;
    each round is a table in the shared folder. All groups are reduced with min, none is collected;
    the minima are a table of their own, so that Spark can split the join at a root of many nodes.
    """
    def normal(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    now = scratch.save(normal(edges))
    mark = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.save(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = normal(both.filter("v > u").join(apart(low), "u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(apart(least), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
        now = scratch.save(normal(small), now, low)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return scratch.save(now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root").union(
                now.select("v", "v").distinct()), now)
        mark = seen


def _ordered(scratch: Scratch, docs: DataFrame, key: str, text: str) -> DataFrame:
    """docs in the order of (key, text), nulls first. Equal rows are salted for the range bounds only:
    they may lie in several partitions, one after another, as any of them may come first."""
    salt = F.rand(7)
    return docs.withColumn("_salt", salt).repartitionByRange(key, text, "_salt").sortWithinPartitions(key, text).drop("_salt")


def _is_unique(docs: DataFrame, key: str) -> bool:
    """Whether the key is a whole number that no two rows share and none lacks."""
    if docs.schema[key].dataType.typeName() not in ("long", "integer", "short", "byte"):
        return False
    return not docs.groupBy(key).count().filter((F.col("count") > 1) | F.col(key).isNull()).limit(1).count()


def keyed(scratch: Scratch, docs: DataFrame, key: str, text: str) -> DataFrame:
    """(rid, key, t): rid numbers the rows in the order of (key, text), t is the text's UTF-8 bytes.

    Where keys are unique, rid is the key. Else (repeated or null keys; nulls come first) the rows
    are written once in that order and numbered; equal rows are then rows of their own.
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("t"))
    if _is_unique(own, "key"):
        return own.select(F.col("key").cast("long").alias("rid"), "key", "t")
    return scratch.save(_ordered(scratch, own, "key", "t").select(F.monotonically_increasing_id().alias("rid"), "key", "t"))


def cut_spans(docs: DataFrame, spans: DataFrame, of, schema: str) -> DataFrame:
    """mapInArrow of `of` over docs (rid, key, t), each with its array `spans` of (lo, hi) or null."""
    lists = spans.groupBy(F.col("rid").alias("rid_")).agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return docs.join(lists, docs["rid"] == lists["rid_"], "left").select("rid", "key", "t", "spans").mapInArrow(of, schema)


def merged(spans: list | None) -> list[tuple[int, int]]:
    """Half-open spans in order, with overlapping and touching ones made one."""
    out: list[list[int]] = []
    for s in sorted((s["lo"], s["hi"]) for s in spans or []):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [(a, b) for a, b in out]


def numbered(scratch: Scratch, docs: DataFrame, key: str = "doc_id", text: str = "text", out: str = "rid_") -> DataFrame:
    """docs with a unique long: the key where keys are unique, else the row's place in the order of
    (key, text), for which the rows are written once."""
    if _is_unique(docs, key):
        return docs.withColumn(out, F.col(key).cast("long"))
    return scratch.save(_ordered(scratch, docs, key, text).withColumn(out, F.monotonically_increasing_id()))

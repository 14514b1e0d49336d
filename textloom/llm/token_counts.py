"""Token counts as delta-maintained rollups.

A ledger is a folder of batches. A batch of changes is reduced to signed sums by source,
language and tokenizer version and written under its id; totals are the sums over all batches.
Inserts add, deletes subtract, revised counts subtract the old and add the new. A batch is
written aside and put in place by one rename, and an id that is in place is not written again,
so a batch may be committed any number of times.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

#: Vocabulary file (token in base64 and rank in each line), and the version that it stands for.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
VERSION = "byte_bpe_50k"
#: How text is cut before merging: contractions, letters, digits, others, white space.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters a token, where no count is known yet.
GUESS = 4
DIMENSIONS = ("source", "lang", "tokenizer")
MEASURES = ("docs", "tokens", "chars", "bytes")
SCHEMA = ", ".join([f"{d} string" for d in DIMENSIONS] + [f"{m} long" for m in MEASURES])


def token_counts(docs: DataFrame, carry: list[str], text: str = "text", vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """carry's columns and n_tokens; a null text has none. Whole texts are encoded, in Arrow batches."""
    with open(vocabulary, "rb") as file:  # read by the driver, sent with the tasks: under 1 MB, whatever the corpus
        ranks_file = file.read()

    def of(batches):
        import tiktoken

        ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in ranks_file.splitlines() if line)}
        encoder = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        for batch in batches:
            counts = [len(encoder.encode_ordinary(t)) if t else 0 for t in batch.column(len(carry)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(carry))), pa.array(counts, pa.int64())],
                                             names=[f"c{i}" for i in range(len(carry))] + ["n_tokens"])

    kinds = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    out = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)], F.col(text).cast("string").alias("t")).mapInArrow(of, f"{kinds}, n_tokens long")
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carry)})


def state(source: Column, lang: Column, tokenizer: Column, tokens: Column, chars: Column, size: Column) -> Column:
    """What a document counts for."""
    return F.struct(source.cast("string").alias("source"), lang.cast("string").alias("lang"), tokenizer.cast("string").alias("tokenizer"),
                    tokens.cast("long").alias("tokens"), chars.cast("long").alias("chars"), size.cast("long").alias("bytes"))


def signed(changes: DataFrame) -> DataFrame:
    """Sums of a batch: changes have the states old and new; an insert has no old, a delete no new."""
    both = F.filter(F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("s")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("s"))), lambda x: x["s"].isNotNull())
    rows = changes.select(F.explode(both).alias("x"))
    value = lambda m: F.sum(F.col("x.sign") * F.coalesce(F.col(f"x.s.{m}"), F.lit(0))).cast("long").alias(m)
    return rows.groupBy(*[F.col(f"x.s.{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("x.sign").cast("long").alias("docs"), *[value(m) for m in MEASURES[1:]])


class Ledger:
    """Batches under root, a folder that all executors and the driver share."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _folder(self, batch: str) -> str:
        name = batch if re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]{0,63}", batch) else hashlib.sha256(batch.encode()).hexdigest() + "-h"
        return f"{self.root}/batches/{name}"

    def committed(self, batch: str) -> bool:
        return self._fs.exists(self._path(f"{self._folder(batch)}/_SUCCESS"))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Whether the batch was new. A batch that failed half way can be committed again."""
        if self.committed(batch):
            return False
        aside = f"{self.root}/aside/{uuid.uuid4().hex}"
        signed(changes).coalesce(1).write.parquet(aside)  # as many rows as there are groups
        self._fs.mkdirs(self._path(f"{self.root}/batches"))
        # a folder that another writer put in place meanwhile is kept: then this one nests in it or fails, and is dropped
        if self.committed(batch) or not self._fs.rename(self._path(aside), self._path(self._folder(batch))):
            self._fs.delete(self._path(aside), True)
            return False
        nested = self._path(f"{self._folder(batch)}/{aside.rpartition('/')[2]}")
        if self._fs.exists(nested):
            self._fs.delete(nested, True)
            return False
        return True

    def totals(self) -> DataFrame:
        """Sums over all batches, by DIMENSIONS; groups that nothing is left of are absent."""
        folder = self._path(f"{self.root}/batches")
        found = [s.getPath() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        paths = [str(p) for p in found if self._fs.exists(self._path(p, "_SUCCESS"))]
        rows = self.spark.read.schema(SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        sums = rows.groupBy(*DIMENSIONS).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return sums.filter(" or ".join(f"{m} <> 0" for m in MEASURES))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    """Three batches: every document with a guess, the true counts as revisions, and labelled toxic
    documents taken down and put back. The first is committed twice, which changes nothing."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "tokens")
    sized = docs.withColumn("chars", F.coalesce(F.length("text"), F.lit(0))).withColumn("bytes", F.coalesce(F.octet_length("text"), F.lit(0)))
    counted = scratch.save(token_counts(sized, ["doc_id", "source", "lang", "chars", "bytes"]))
    own = lambda tokens: state(F.col("source"), F.col("lang"), F.lit(VERSION), tokens, F.col("chars"), F.col("bytes"))
    guess, true = own(F.ceil(F.col("chars") / GUESS)), own(F.col("n_tokens"))
    nothing = F.lit(None)
    ledger = Ledger(spark, f"{scratch.root}/ledger")
    for _ in range(2):
        ledger.commit("load", counted.select(nothing.alias("old"), guess.alias("new")).withColumn("old", F.col("old").cast(counted.select(guess.alias("g")).schema["g"].dataType)))
    ledger.commit("revise", counted.select(guess.alias("old"), true.alias("new")))
    toxic = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("toxic = 1").select("doc_id").distinct()
    kind = counted.select(true.alias("g")).schema["g"].dataType
    marked = counted.join(toxic, "doc_id", "left_semi")
    ledger.commit("take down", marked.select(true.alias("old"), nothing.cast(kind).alias("new")))
    ledger.commit("put back", marked.select(nothing.cast(kind).alias("old"), true.alias("new")))
    return ledger.totals()

"""Readers: raw texts, catalogs, works, analyses and judgments as DataFrames."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X

CATALOG = ("work_id", "person_id", "title", "subtitle", "author", "path")
ENCODINGS = ("cp932", "shift_jis", "utf-8")
#: Bytes of a file that the catalog is built from.
HEAD = 4096
META = ("work_id string, person_id string, title string, subtitle string, author string, path string, source string, card string, mirror string, "
        "encoding_original string, ruby string, colophon string, characters bigint, fetched_on string")
ANALYSIS = """
work_id string, person_id string, title string, author string, card string, path string,
stats struct<characters:bigint,paragraphs:bigint,sentences:bigint,sentence_length_mean:double,sentence_length_median:double,sentence_length_stdev:double,
  sentence_length_max:bigint,dialogue_ratio:double,quoted_narration_ratio:double,quote_span_mean:double,dialogue_paragraph_ratio:double,orthography:string,
  kanji_ratio:double,hiragana_ratio:double,katakana_ratio:double,comma_per_sentence:double,dash_per_1000:double,ellipsis_per_1000:double,
  exclaim_per_1000:double,question_per_1000:double,simile_count:bigint,simile_per_1000:double>,
headings array<struct<index:bigint,label:string,characters:bigint>>,
tension_curve array<struct<segment:bigint,sentences:bigint,sentence_length_mean:double,dialogue_ratio:double,exclaim_question_per_1000:double,dash_ellipsis_per_1000:double>>,
exclaim_peak_segment bigint, dialogue_peak_segment bigint, similes array<struct<markers:array<string>,position:double,text:string>>,
reduplications map<string,bigint>, vocabulary map<string,bigint>, opening array<string>, closing array<string>,
repetitions array<struct<head:string,count:bigint,sample:array<string>>>
"""


@F.pandas_udf(T.StringType())
def decoded(content: pd.Series) -> pd.Series:
    """The first of ENCODINGS that fits; the first one with replacements where none does."""
    def one(data):
        if data is None:
            return None
        for name in ENCODINGS:
            try:
                return bytes(data).decode(name)
            except UnicodeDecodeError:
                continue
        return bytes(data).decode(ENCODINGS[0], errors="replace")

    return content.map(one)


@F.pandas_udf(T.StringType())
def folded(text: pd.Series) -> pd.Series:
    """NFKC, lower case: Spark has no normal forms among its functions."""
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).lower())


def raw_texts(spark: SparkSession, path: str, head: int | None = None) -> DataFrame:
    """(path, raw) of the text files below a path; head: only so many bytes of each are decoded."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    content = F.substring("content", 1, head) if head else F.col("content")
    return files.select("path", decoded(content).alias("raw"))


def works(raw: DataFrame, text: str = "raw", keep_ruby: bool = False) -> DataFrame:
    """raw with body, title, subtitle, author and colophon."""
    return X.with_plain_text(raw, text, keep_ruby)


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a tab-separated catalog that have exactly its six fields; the first line names them."""
    lines = spark.read.text(path).withColumn("f", F.split("value", "\t", -1)).filter((F.size("f") == len(CATALOG)) & (F.get("f", F.lit(0)) != CATALOG[0]))
    return lines.select(*[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(CATALOG)])


def build_catalog(spark: SparkSession, root: str) -> DataFrame:
    """A catalog of files root/<person>/files/<work>/<name>.txt, by their first HEAD bytes."""
    parts = F.split("path", "/")
    at = lambda i: F.element_at(parts, i)
    found = works(raw_texts(spark, root, HEAD).filter(at(-3) == "files"))
    return catalog_order(found.select(F.regexp_extract(at(-2), r"^([^_]+)", 1).alias("work_id"), at(-4).alias("person_id"), "title", "subtitle", "author",
                                      F.array_join(F.slice(parts, -5, 5), "/").alias("path")))


def catalog_order(rows: DataFrame) -> DataFrame:
    number = F.col("work_id").try_cast("bigint")
    return rows.orderBy(number.isNull(), number, "work_id", "person_id")


def search(catalog_: DataFrame, title: str = "", author: str = "", limit: int = 20) -> DataFrame:
    """Rows whose folded title and author contain the folded terms, in catalog order."""
    fold = lambda t: unicodedata.normalize("NFKC", t).lower()
    return catalog_order(catalog_.filter(F.contains(folded("title"), F.lit(fold(title))) & F.contains(folded("author"), F.lit(fold(author))))).limit(limit)


def same_id(left: Column, right: Column) -> Column:
    """Equal but for leading zeros."""
    return F.ltrim(left, F.lit("0")) == F.ltrim(right, F.lit("0"))


def find_works(catalog_: DataFrame, wanted: DataFrame, key: str = "work_id") -> DataFrame:
    """wanted with the first catalog row of each id; columns are null where there is none."""
    order = Window.partitionBy("_id").orderBy(F.col("work_id").try_cast("bigint"), "work_id", "person_id")
    rows = catalog_.withColumn("_id", F.ltrim("work_id", F.lit("0"))).withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n")
    asked = wanted.select(F.col(key).alias("wanted"))
    return asked.join(rows, F.ltrim("wanted", F.lit("0")) == F.col("_id"), "left").drop("_id")


def with_files(catalog_: DataFrame, texts: DataFrame, root: str) -> DataFrame:
    """Catalog rows whose file is there."""
    held = texts.select(F.regexp_replace("path", "^" + X.literal(root) + "/?", "").alias("path")).distinct()
    return catalog_.join(held, "path", "left_semi")


def meta(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(META).option("multiLine", "true").json(path)


def work_files(root: str, name: str, work_id: str | None = None) -> str:
    """The path of a file in all folders root/<person>/<work>, or in those of one work, whose names are its id or begin
    with it and an underscore; others are not listed at all."""
    if work_id is not None and not re.fullmatch(r"\w[^_/*?{}\[\],\\]*", work_id):
        raise ValueError(f"no work id: {work_id!r}")
    return f"{root.rstrip('/')}/*/{'*' if work_id is None else f'{{{work_id},{work_id}_*}}'}/{name}"


def with_meta(texts: DataFrame, meta_: DataFrame, key: str = "work_id") -> DataFrame:
    """texts (path, more) with the fields of the work in whose folder each lies; those without, and works without texts, are left out.
    Fields that texts have too are the texts'."""
    folder = F.regexp_extract("path", r"([^/_]+)[^/]*/[^/]+$", 1)
    fields = [c for c in meta_.columns if c not in texts.columns]
    return texts.withColumn("_work", folder).join(meta_.select(F.col(key).alias("_id"), *fields), F.col("_work") == F.col("_id")).drop("_work", "_id")


#: Orders of works, as SQL over analyses.
ORDERS = {
    "author": ("author", "title"),
    "path": ("_path",),
    "longest": ("-stats.characters", "author", "title"),
    "shortest sentences": ("stats.sentence_length_mean", "author", "title"),
}


def analyses(spark: SparkSession, path: str, order: str = "author") -> DataFrame:
    """Analyses in folders that are named by digits, in one of ORDERS."""
    found = spark.read.schema(ANALYSIS).option("multiLine", "true").json(path).withColumn("_path", F.input_file_name())
    return found.filter(F.element_at(F.split("_path", "/"), -2).rlike(r"^\d+$")).orderBy(*map(F.expr, ORDERS[order])).drop("_path")


def plots(stories: DataFrame, meta_text: DataFrame, key: str) -> DataFrame:
    """stories with the plot of their side file, null where the file or its JSON is bad or missing."""
    side = meta_text.select(F.col(key), F.get_json_object("meta", "$.plot").alias("plot"))
    return stories.join(side, key, "left")


def addresses(base: str, card: str, rows: DataFrame) -> DataFrame:
    """rows with raw_url and card_url; card has places for person and work."""
    return rows.withColumn("raw_url", F.concat_ws("/", F.lit(base), "path")).withColumn("card_url", F.format_string(card, "person_id", "work_id"))

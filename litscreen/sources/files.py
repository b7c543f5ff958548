"""Files: query lists, landed articles, extracted texts and CSV data sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litscreen import schemas
from litscreen.functions import text

ARTICLES = "*/*.xml"
ABSTRACTS = "*/txt_abstracts/*_abstract.txt"


def read_queries(spark: SparkSession, path: str) -> DataFrame:
    """One query per line; blank lines are dropped."""
    line = text.strip(F.col("value"))
    lines = spark.read.text(path).select(line.alias("query_text")).filter(F.col("query_text") != "")
    key = text.query_key(F.col("query_text"))
    return lines.select(key.alias("query_id"), "query_text", key.alias("folder")).distinct()


#: Where a path names query folder and id: ``<root>/<query folder>/<id>.xml``.
FOLDER_IN_PATH = r"([^/]+)/[^/]+\z"
ID_IN_PATH = r"([^/]+?)(?:\.[^./]*)?\z"


def as_articles(files: DataFrame, folder: str = FOLDER_IN_PATH, name: str = ID_IN_PATH) -> DataFrame:
    """Rows of the binaryFile source, batch or stream, as raw articles."""
    return files.select(
        F.regexp_extract("path", folder, 1).alias("query_folder"),
        F.regexp_extract("path", name, 1).alias("id"),
        "content",
        F.col("modificationTime").alias("fetched_at"),
    )


def read_articles(
    spark: SparkSession, root: str, glob: str = ARTICLES, folder: str = FOLDER_IN_PATH, name: str = ID_IN_PATH
) -> DataFrame:
    """All articles landed below ``root``: as a rule files ``*.xml`` exactly one folder deep."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", False)
    return as_articles(reader.load(f"{root.rstrip('/')}/{glob}").select(*schemas.BINARY_FILE.names), folder, name)


def decode(articles: DataFrame, strict: bool = False) -> DataFrame:
    """Add ``page``: the content as text, NULL where it is not UTF-8 (an error if strict).

    Line ends become plain line feeds.
    """
    raw = F.col("content").cast("string")
    valid = F.validate_utf8(raw) if strict else F.try_validate_utf8(raw)
    return articles.withColumn("page", F.regexp_replace(valid, r"\r\n?", "\n")).drop("content")


def rejects(decoded: DataFrame) -> DataFrame:
    """The articles that could not be decoded."""
    return decoded.filter(F.col("page").isNull()).drop("page")


def read_extracted(
    spark: SparkSession,
    root: str,
    glob: str = ABSTRACTS,
    folder: str = r"([^/]+)/txt_abstracts/[^/]+\z",
    name: str = r"([^/_]*)_[^/]*\z",
) -> DataFrame:
    """Abstract texts that lie as files; the id is as a rule the file name up to its first ``_``."""
    files = spark.read.text(f"{root.rstrip('/')}/{glob}", wholetext=True)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return files.select(
        F.regexp_extract(path, folder, 1).alias("query_folder"),
        F.regexp_extract(path, name, 1).alias("id"),
        F.col("value").alias("abstract_text"),
        F.col("_metadata.file_modification_time").alias("fetched_at"),
    )


def read_records(spark: SparkSession, root: str, schema: T.StructType = schemas.ARTICLES_RAW) -> DataFrame:
    """Rows that lie as lines of JSON below ``query_folder=<name>``; lines are split as they are read."""
    return spark.read.schema(schema).json(root).select(*schema.names)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV file with header, quotes doubled, line breaks inside quotes allowed."""
    return (
        spark.read.schema(schema)
        .options(header=True, multiLine=True, escape='"', mode="FAILFAST", enforceSchema=False,
                 ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )


def read_abstracts_csv(spark: SparkSession, path: str) -> DataFrame:
    return _with_clean_id(read_csv(spark, path, schemas.ABSTRACT_DATASET))


def read_training_csv(spark: SparkSession, path: str) -> DataFrame:
    return _with_clean_id(read_csv(spark, path, schemas.TRAINING_DATASET))


def _with_clean_id(df: DataFrame) -> DataFrame:
    return df.withColumn("ID", text.clean_id(F.col("ID")))

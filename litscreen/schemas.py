"""Schemas of the tables that the jobs read and write."""

from pyspark.sql import types as T

QUERIES = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("query_text", T.StringType()),
    T.StructField("folder", T.StringType()),
])

QUERY_TERMS = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("clause", T.IntegerType()),
    T.StructField("term", T.StringType()),
    T.StructField("field", T.StringType()),
])

RUN_STATE = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("last_fetch", T.DateType()),
])

ARTICLES_RAW = T.StructType([
    T.StructField("query_folder", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("fetched_at", T.TimestampType()),
])

BODIES = T.StructType([
    T.StructField("query_folder", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("body_html", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])

ABSTRACTS = T.StructType([
    T.StructField("query_folder", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("abstract_text", T.StringType()),
    T.StructField("abstract_html", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])

EXTRACTED = T.StructType([
    T.StructField("query_folder", T.StringType()),
    T.StructField("id", T.StringType()),
    T.StructField("abstract_text", T.StringType()),
    T.StructField("fetched_at", T.TimestampType()),
])

# What the binaryFile source gives; a stream has to be told.
BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

ABSTRACT_DATASET = T.StructType([
    T.StructField("Abstract", T.StringType()),
    T.StructField("ID", T.StringType()),
])

TRAINING_DATASET = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("AwT_score", T.DoubleType()),
    T.StructField("SoE_score", T.DoubleType()),
    T.StructField("ID", T.StringType()),
])

PREDICTIONS = T.StructType([
    T.StructField("Abstract", T.StringType()),
    T.StructField("ID", T.StringType()),
    T.StructField("Predicted_AwT_score", T.DoubleType()),
    T.StructField("Predicted_SoE_score", T.DoubleType()),
])

FILTERED = T.StructType([
    T.StructField("ID", T.StringType()),
    T.StructField("Predicted_AwT_score", T.DoubleType()),
    T.StructField("Predicted_SoE_score", T.DoubleType()),
])

HEADS = T.StructType([
    T.StructField("member", T.IntegerType()),
    T.StructField("target", T.StringType()),
    T.StructField("bias", T.DoubleType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
])

EPOCHS = T.StructType([
    T.StructField("epoch", T.IntegerType()),
    T.StructField("loss", T.DoubleType()),
    T.StructField("target", T.StringType()),
    T.StructField("bias", T.DoubleType()),
    T.StructField("weights", T.ArrayType(T.DoubleType())),
])

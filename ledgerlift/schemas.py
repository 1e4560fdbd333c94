"""Explicit schemas: no inference pass, stable types, and required by file streams."""

from pyspark.sql import types as T

# Transactions as they land in CSV files.  ``age`` arrives quoted in real
# feeds ('4'), so it is kept as text.
TRANSACTIONS = T.StructType([
    T.StructField("step", T.IntegerType(), True),
    T.StructField("customer", T.StringType(), True),
    T.StructField("age", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("zipcodeOri", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
    T.StructField("zipMerchant", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("amount", T.DoubleType(), True),
    T.StructField("fraud", T.IntegerType(), True),
])

# Customer importance dimension; logical key (Source, typeTrans).
IMPORTANCE = T.StructType([
    T.StructField("Source", T.StringType(), True),
    T.StructField("Target", T.StringType(), True),
    T.StructField("Weight", T.DoubleType(), True),
    T.StructField("typeTrans", T.StringType(), True),
    T.StructField("fraud", T.IntegerType(), True),
])
IMPORTANCE_REQUIRED = ["Source", "Target", "Weight", "typeTrans", "fraud"]
IMPORTANCE_KEY = ["Source", "typeTrans"]

DETECTIONS = T.StructType([
    T.StructField("YStartTime", T.StringType(), True),
    T.StructField("detectionTime", T.StringType(), True),
    T.StructField("patternId", T.StringType(), True),
    T.StructField("ActionType", T.StringType(), True),
    T.StructField("customer", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
])
DETECTION_COLUMNS = [f.name for f in DETECTIONS.fields]

CUSTOMER_STATS = T.StructType([
    T.StructField("customer", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
    T.StructField("transaction_count", T.LongType(), True),
    T.StructField("merchant_rank", T.DoubleType(), True),
])

IMPORTANCE_SCORES = T.StructType([
    T.StructField("customer", T.StringType(), True),
    T.StructField("merchant", T.StringType(), True),
    T.StructField("avg_weight", T.DoubleType(), True),
    T.StructField("weight_rank", T.DoubleType(), True),
])

ELIGIBLE_MERCHANTS = T.StructType([
    T.StructField("merchant", T.StringType(), True),
    T.StructField("total_transactions", T.LongType(), True),
])

PROCESSING_LOG = T.StructType([
    T.StructField("query_id", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("file_name", T.StringType(), True),
    T.StructField("processing_status", T.StringType(), True),
    T.StructField("detections_found", T.LongType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("processed_at", T.TimestampType(), True),
])

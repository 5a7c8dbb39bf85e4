"""Scans with an explicit schema; nothing is inferred from the data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TRANSACTIONS = "invoice_no string, stock_code string, description string, quantity int, invoice_date string, unit_price double, customer_id double, country string"

CHUNKS = "chunk_id string, doc_name string, text string, tokens int, char_len int"
QUESTIONS = "id string, category string, topic string, question string, expected_keywords array<string>, relevant_docs array<string>, ground_truth_answer string, notes string"
RECORDS = ("id string, question string, category string, relevant_docs array<string>, expected_keywords array<string>, ground_truth string, answer string, query_type string, "
                               "grade string, kw_pct double, retrieved_chunks array<struct<chunk_id:string,doc_name:string,similarity:double,text:string>>, source string")


def latin1_csv(spark: SparkSession, path: str, schema: str, timestamps: dict[str, str] | None = None) -> DataFrame:
    """Header CSV in latin-1; ``timestamps`` maps string columns to their format."""
    df = spark.read.schema(schema).option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return df.withColumns({c: F.to_timestamp_ntz(c, F.lit(f)) for c, f in (timestamps or {}).items()}) if timestamps else df


def typed_csv(spark: SparkSession, path: str, schema: str, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Header CSV whose schema already has timestamp columns."""
    return spark.read.schema(schema).option("header", True).option("timestampNTZFormat", timestamp_format).option("timestampFormat", timestamp_format).csv(path)


def daily_csv(spark: SparkSession, path: str, date_format: str = "M/d/yyyy") -> DataFrame:
    """Two-column daily file; the columns are renamed by position to ds and y."""
    raw = spark.read.schema("a string, b double").option("header", True).option("enforceSchema", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    return raw.toDF("ds", "y").withColumn("ds", F.to_date("ds", date_format))


def json_documents(spark: SparkSession, path: str, schema: str, multi_line: bool = False) -> DataFrame:
    """Nested records, one per line, or one array per file."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    """First path that exists on the cluster file system."""
    jvm = spark.sparkContext._jvm
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hp):
            return p
    return None

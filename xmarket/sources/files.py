"""File sources and sinks: CSV, JSON and JSON lines with explicit schemas, guarded loads, append logs, digests (IO6 to IO14, IO18 to IO20)."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LFS_HEAD = "version https://git-lfs"


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def text_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """IO6: all columns as text, no inference; of the wanted columns those that the header has.

    Files may be split by Spark at line ends, so quoted line breaks need multiLine; it is on, as descriptions have them.
    """
    df = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("inferSchema", False).csv(path)
    return df if columns is None else df.select(*(f"`{c}`" for c in columns if c in df.columns))


def load_snapshot(spark: SparkSession, path: str, columns: list[str], key: str = "Bet ID") -> DataFrame:
    """IO7: a snapshot with its schema, empty where the file is absent, a pointer, without the key or unreadable."""
    from xmarket.operators.sync import align

    empty = spark.createDataFrame([], text_schema(columns))
    if not _exists(spark, path):
        return empty
    head = spark.read.text(path).limit(1).collect()
    if not head or head[0]["value"].startswith(LFS_HEAD):
        return empty
    df = read_csv(spark, path)
    return align(df, columns) if key in df.columns else empty


def read_json_list(spark: SparkSession, path: str, schema: str | StructType, required: bool = False) -> DataFrame:
    """IO8: a whole-file JSON list; empty if absent, unless it is required."""
    if not _exists(spark, path):
        if required:
            raise FileNotFoundError(path)
        kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        return spark.createDataFrame([], kind)
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """IO9: one object per line; malformed lines are dropped."""
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if not _exists(spark, path):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).option("mode", "DROPMALFORMED").json(path)


def parse_token_list(c):
    """IO10: a Python-literal list of texts as an array; an unreadable one is empty."""
    inner = F.regexp_extract(F.trim(c), r"^[\[{(](.*)[\])}]$", 1)
    items = F.regexp_extract_all(inner, F.lit(r"'((?:[^'\\]|\\.)*)'|\"((?:[^\"\\]|\\.)*)\""), F.lit(0))
    return F.coalesce(F.transform(items, lambda s: F.substring(s, F.lit(2), F.length(s) - 2)), F.array().cast("array<string>"))


def write_csv(df: DataFrame, path: str) -> None:
    """IO11: overwrite; nested columns must be text by then."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_json(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """IO12 and IO13: overwrite through the commit protocol; with an order the rows are globally sorted by range."""
    (df if order is None else df.orderBy(*order)).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str, run_id: str) -> None:
    """IO14: append decisions with the run's id and time, partitioned by month."""
    stamped = df.withColumn("run_id", F.lit(run_id)).withColumn("ts", F.current_timestamp()).withColumn("month", F.date_format("ts", "yyyy-MM"))
    stamped.write.mode("append").partitionBy("month").json(path)


def write_requests(df: DataFrame, path: str, model_col: str = "model") -> int:
    """IO18: one JSON request a line; an empty batch or one with several models is refused.  Returns the rows."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(model_col).alias("models")).first()
    if row["n"] == 0 or row["models"] != 1:
        raise ValueError(f"a batch needs rows of one model, not {row['n']} rows of {row['models']}")
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)
    return row["n"]


def purge(spark: SparkSession, paths: list[str]) -> list[str]:
    """IO19: delete a fixed list of artifacts; returns those that were there."""
    gone = []
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(target):
            fs.delete(target, True)
            gone.append(path)
    return gone


def digests(spark: SparkSession, path: str) -> DataFrame:
    """IO20: (path, sha256) of every file below a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def config_fingerprint(folder: str, names: list[str], label: str = "keyword-config") -> str:
    """IO20: 16 hex digits over names and bytes of small config files on the driver."""
    import hashlib

    h = hashlib.sha256(label.encode())
    for name in names:
        h.update(name.encode())
        path = Path(folder) / name
        if path.exists():
            h.update(path.read_bytes())
    return h.hexdigest()[:16]


def load_keywords(folder: str, name: str) -> dict[str, dict]:
    """IO8: a dictionary of keywords or entities from a JSON file; empty if absent."""
    path = Path(folder) / f"{name}.json"
    return json.loads(path.read_text()) if path.exists() else {}


def safe_name(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]+", "_", text)

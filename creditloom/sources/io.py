"""Scans, sinks, stored schemas and stored feature lists."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.columns import tokens_to_null
from creditloom.operators.cleaning import for_modelling
from creditloom.operators.profiling import narrow
from creditloom.operators.rollup import columns_of


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, null_tokens: Sequence[str] = (),
             max_rows: int | None = None) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred (one more pass; store the schema
    after the first read). `null_tokens` apply to every text column, also where several are given."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    if null_tokens:
        texts = set(columns_of(df, "string"))
        df = df.select(*[tokens_to_null(F.col(c), tuple(null_tokens)).alias(c) if c in texts else F.col(c) for c in df.columns])
    return df.limit(max_rows) if max_rows is not None else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def save_split(df: DataFrame, path: str, flag: str = "in_sample") -> None:
    """Both parts in one write, one folder per part, so a reader of one part prunes the other."""
    write_parquet(df, path, partition_by=[flag])


def read_train(spark: SparkSession, path: str, features: Sequence[str] = (), key: str = "SK_ID_CURR", target: str = "TARGET",
               optimise: bool = False, clean_types: bool = False) -> DataFrame:
    """Training frame: key, target and the chosen features only; X and y stay one frame."""
    df = spark.read.parquet(path)
    if features:
        df = df.select(key, target, *features)
    if optimise:
        df = narrow(df, exclude=(key, target))
    return for_modelling(df, exclude=(key, target)) if clean_types else df


def schema_table(df: DataFrame) -> DataFrame:
    """(feature, dtype, position)."""
    rows = [(n, t, i) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "feature string, dtype string, position int")


def save_schema(df: DataFrame, path: str) -> None:
    """The full schema as one JSON text."""
    df.sparkSession.createDataFrame([(df.schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path, wholetext=True).first()["value"]))


def read_with_schema(spark: SparkSession, path: str, schema: T.StructType, drop: Sequence[str] = ("TARGET",), fmt: str = "csv") -> DataFrame:
    """Scan under a stored schema, without the target."""
    reader = spark.read.schema(schema)
    df = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return df.drop(*drop)


def sorted_ids(df: DataFrame, key: str = "SK_ID_CURR") -> DataFrame:
    """Only the key column reaches the scan."""
    return df.select(key).orderBy(key)


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """(file, bytes) of the files that match a glob, from file metadata alone."""
    folder, _, name = pattern.rpartition("/")
    files = spark.read.format("binaryFile").option("pathGlobFilter", name).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("bytes"))


def feature_list_rows(spark: SparkSession, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """(list_name, pos, feature)."""
    rows = [(n, i, f) for n, fs in lists.items() for i, f in enumerate(fs)]
    return spark.createDataFrame(rows, "list_name string, pos int, feature string")


def load_feature_list(spark: SparkSession, path: str, name: str) -> list[str]:
    rows = spark.read.parquet(path).filter(F.col("list_name") == name).orderBy("pos").collect()
    return [r["feature"] for r in rows]

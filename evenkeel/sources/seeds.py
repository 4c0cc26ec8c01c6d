"""CSV configuration: validation tests and named compare-column lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evenkeel.functions.columns import split_names_col

# The columns of the two configuration files, all text.
TEST_CONFIG_COLUMNS = [
    "model_name",
    "test_type",
    "key_column",
    "test_query_model",
    "compare_columns_ref",
    "compare_columns",
    "base_model",
    "clone_suffix",
    "config_set",
]
COLUMN_LIST_COLUMNS = ["compare_columns_ref", "compare_columns"]
# Defaults derived from a model's name and test type.
SLICE_SUFFIX = "_delta_slice"
SNAPSHOT_SUFFIX = "_BEFORE_DELTA"
DELTA_COMPARE = "delta_compare"
DELTA_LOAD = "DELTA"
FULL_LOAD = "FULL_LOAD"


def text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns, found by the header ignoring case; absent ones and missing fields are null."""
    found = spark.read.csv(path, header=True, mode="PERMISSIVE")
    present = {c.strip().lower(): c for c in found.columns}
    return found.select(
        *[(found[f"`{present[c]}`"] if c in present else F.lit(None).cast("string")).alias(c) for c in columns]
    )


def read_test_config(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, TEST_CONFIG_COLUMNS)


def read_column_lists(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, COLUMN_LIST_COLUMNS)


def filter_config(
    config: DataFrame,
    model_name: str | None = None,
    model_name_like: str | None = None,
    test_type: str | None = None,
) -> DataFrame:
    """Keep the configured tests that match every given filter."""
    if model_name:
        config = config.where(F.col("model_name") == model_name)
    if model_name_like:
        config = config.where(F.col("model_name").like(model_name_like))
    if test_type:
        config = config.where(F.col("test_type") == test_type)
    return config


def parse_config(config: DataFrame, column_lists: DataFrame | None = None) -> DataFrame:
    """Configured tests with their lists split and their defaults filled in.

    Adds ``keys`` and ``columns`` (arrays), ``resolved_base_model``, ``snapshot_suffix`` and ``load_type``.
    Columns named in the row win over a named list.
    """
    names = F.when(F.length("compare_columns") > 0, F.col("compare_columns"))
    if column_lists is not None:
        listed = column_lists.groupBy("compare_columns_ref").agg(F.min("compare_columns").alias("_ek_listed"))
        config = config.join(listed, "compare_columns_ref", "left").select(*config.columns, "_ek_listed")
        names = F.coalesce(names, F.col("_ek_listed"))

    def given(name: str) -> Column:
        return F.when(F.length(name) > 0, F.col(name))

    base_of_slice = F.when(
        F.col("model_name").endswith(SLICE_SUFFIX), F.replace(F.col("model_name"), F.lit(SLICE_SUFFIX), F.lit(""))
    )
    default_load = F.when(F.col("test_type") == DELTA_COMPARE, DELTA_LOAD).otherwise(FULL_LOAD)
    return config.select(
        "model_name",
        "test_type",
        split_names_col(F.col("key_column")).alias("keys"),
        given("test_query_model").alias("test_query_model"),
        split_names_col(names).alias("columns"),
        F.coalesce(given("base_model"), base_of_slice).alias("resolved_base_model"),
        F.coalesce(given("clone_suffix"), F.lit(SNAPSHOT_SUFFIX)).alias("snapshot_suffix"),
        F.coalesce(given("config_set"), default_load).alias("load_type"),
    )

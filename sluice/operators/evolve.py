"""Schema inference and evolution for JSON payloads.

Types are inferred per payload key with one grouped aggregate over the
exploded key/value pairs (partial per key on the map side). A key's type is
the narrowest shape every non-null value has.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import casts
from sluice.functions.json_fields import parse_object
from sluice.operators.spec import TableSpec


def infer_key_types(df: DataFrame, value: str = "value", dates_as_text: bool = False) -> DataFrame:
    """Per payload key: its inferred SQL type and how many non-null values
    it has. ``dates_as_text`` is the client-side rule (date-like text stays
    VARCHAR)."""
    kv = df.select(F.explode(parse_object(F.col(value))).alias("key", "v")).where(F.col("v").isNotNull())
    v = F.col("v")
    all_ = lambda cond: F.every(cond)
    agg = kv.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_values"),
        all_(v.rlike(casts.LONG_SHAPE)).alias("is_long"),
        all_(v.rlike(casts.DECIMAL_SHAPE)).alias("is_dec"),
        all_(v.rlike(casts.BOOLEAN_SHAPE)).alias("is_bool"),
        all_(v.rlike(casts.DATE_SHAPE) & casts.to_date(v).isNotNull()).alias("is_date"),
        all_(v.rlike(casts.TIMESTAMP_SHAPE) & casts.to_timestamp_ntz(v).isNotNull()).alias("is_ts"),
        all_(v.startswith("{")).alias("is_obj"),
        all_(v.startswith("[")).alias("is_arr"),
    )
    date_t = F.lit("VARCHAR") if dates_as_text else F.lit("DATE")
    ts_t = F.lit("VARCHAR") if dates_as_text else F.lit("TIMESTAMP")
    t = (F.when(F.col("is_long"), F.lit("BIGINT"))
         .when(F.col("is_dec"), F.lit("DECIMAL"))
         .when(F.col("is_bool"), F.lit("BOOLEAN"))
         .when(F.col("is_date"), date_t)
         .when(F.col("is_ts"), ts_t)
         .when(F.col("is_obj"), F.lit("OBJECT"))
         .when(F.col("is_arr"), F.lit("ARRAY"))
         .otherwise(F.lit("VARCHAR")))
    return agg.select("key", t.alias("inferred_type"), "n_values")


SPARK_TYPE = {"BIGINT": "bigint", "DECIMAL": "decimal(38,9)", "BOOLEAN": "boolean", "DATE": "date",
              "TIMESTAMP": "timestamp_ntz", "OBJECT": "string", "ARRAY": "string", "VARCHAR": "string"}


def evolved_columns(df: DataFrame, spec: TableSpec, value: str = "value") -> DataFrame:
    """The table after evolution: declared columns plus one new column per
    unknown key (lower-cased), typed by inference. Keys differing only by case
    fold into one column; its type is the widest of theirs (VARCHAR wins)."""
    declared = {c.name for c in spec.columns}
    inferred = infer_key_types(df, value)
    new = (inferred.select(F.lower("key").alias("column_name"), "inferred_type")
           .where(~F.col("column_name").isin(*declared))
           .groupBy("column_name")
           .agg(F.when(F.count_distinct("inferred_type") == 1, F.first("inferred_type"))
                .otherwise(F.lit("VARCHAR")).alias("data_type"))
           .withColumn("is_new", F.lit(True)))
    spark = df.sparkSession
    old = spark.createDataFrame([(c.name, c.type.upper(), False) for c in spec.columns],
                                "column_name string, data_type string, is_new boolean")
    return old.unionByName(new)

"""Daily transactions file: ``;``-delimited text with a header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudmart import schemas
from fraudmart.functions import file_date_from_name, source_name

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_options(sep: str = ";") -> dict:
    return {"sep": sep, "header": True, "encoding": "UTF-8", "mode": "PERMISSIVE"}


def header_names(spark: SparkSession, path, schema: T.StructType, options: dict) -> dict[str, str]:
    """Names in the header by their lower-case form; an error if one of ``schema`` lacks.
    Only the header line is looked at (no inference over the data)."""
    names = {c.strip().lower(): c for c in spark.read.options(**options).csv(path).columns}
    missing = [f.name for f in schema.fields if f.name.lower() not in names]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    return names


def typed(names: dict[str, str], schema: T.StructType, decimal_comma: bool = False) -> list[Column]:
    """Columns of ``schema`` from text columns; values that do not parse become NULL."""
    return [_typed(F.col(f"`{names[f.name.lower()]}`"), f, decimal_comma) for f in schema.fields]


def read_delimited(spark: SparkSession, path, schema: T.StructType = schemas.TRANSACTIONS_FILE,
                   sep: str = ";", decimal_comma: bool = False, with_file: bool = True) -> DataFrame:
    """Read delimited files (a path, glob or list), columns by their header names.

    Only the header line is looked at before the job;
    a file whose header differs from the first one's is an error, never shifted
    columns. Decimals may have a point or a comma (``decimal_comma`` is kept for
    callers that state it: then a point is no decimal mark). Values that do not
    parse become NULL. ``with_file`` adds ``file_name`` and the batch day
    ``file_dt`` taken from ``<kind>_DDMMYYYY.<ext>``.
    """
    options = read_options(sep)
    names = header_names(spark, path, schema, options)
    text = T.StructType([T.StructField(c, T.StringType()) for c in names.values()])
    raw = spark.read.schema(text).options(**options, enforceSchema=False).csv(path)
    df = raw.select(*typed(names, schema, decimal_comma),
                    *([F.col("_metadata.file_path").alias("__file")] if with_file else []))
    if with_file:
        df = (df.withColumn("file_name", source_name(F.col("__file"))).drop("__file")
                .withColumn("file_dt", file_date_from_name("file_name")))
    return df


def _typed(value: Column, field: T.StructField, decimal_comma: bool) -> Column:
    if isinstance(field.dataType, T.DecimalType):
        value = F.when(F.lit(decimal_comma) & value.contains("."), F.lit(None)).otherwise(F.replace(value, F.lit(","), F.lit(".")))
    return value.try_cast(field.dataType).alias(field.name)


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """The same layout back out (exports and file-based tests)."""
    (df.write.mode("overwrite").option("sep", sep).option("header", True)
       .option("timestampNTZFormat", TIMESTAMP_FORMAT).csv(path))

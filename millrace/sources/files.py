"""CSV, text and JSON readers with the options the jobs rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COLUMN = "_corrupt_record"
#: Place of a record in its input line, from 0; the record at 0 stands for the line.
PLACE_COLUMN = "_place_in_line"


def read_csv(
    spark: SparkSession, path: str, schema: str | StructType | None = None, header: bool = True
) -> DataFrame:
    """CSV with a fixed schema, or with inferred types, which costs another pass.

    A schema binds by position and overrules the names in the header. A field that does
    not parse becomes null.
    """
    reader = spark.read.option("header", header)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line in the column ``value``."""
    return spark.read.text(path)


def read_json_documents(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Files that each hold one pretty-printed JSON document or array.

    A file is read by one task; ``json_arrays.read_json_array`` divides large ones.
    """
    return spark.read.schema(schema).json(path, multiLine=True)


def read_json_lines(
    spark: SparkSession, path: str, schema: str | StructType, mode: str = "PERMISSIVE", placed: bool = False
) -> DataFrame:
    """One JSON record, or one array of records, per line; blank lines do not count.

    ``PERMISSIVE`` keeps broken records and puts their raw text into ``_corrupt_record``
    if the schema has it; ``DROPMALFORMED`` leaves them out; ``FAILFAST`` raises. A broken
    record in an array makes the whole line broken, as with Spark's own reader. ``placed`` adds
    ``_place_in_line``, so that what concerns a line can be told once however many records it
    holds, and equal lines stay apart.

    Every field is parsed whatever a query selects. Spark's own JSON reader parses only
    the selected fields, so which records it calls broken changes with the query, unless
    the whole result is cached first; and it refuses to return the broken text alone.
    """
    if mode not in ("PERMISSIVE", "DROPMALFORMED", "FAILFAST"):
        raise ValueError(f"unknown mode {mode}")
    asked = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    checked = asked
    if CORRUPT_COLUMN not in asked.names:
        checked = StructType([*asked.fields, StructField(CORRUPT_COLUMN, StringType())])
    options = {
        "mode": "FAILFAST" if mode == "FAILFAST" else "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    }
    lines = spark.read.text(path).filter(F.col("value").rlike(r"\S") & ~F.col("value").rlike(r"^\s*\[\s*\]\s*$"))
    # The texts of the records of an array; a line that is no array of records is taken as one record.
    elements = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", "array<string>"))
    whole = F.coalesce(F.forall(elements, lambda text: F.coalesce(text.startswith("{"), F.lit(False))), F.lit(False))
    lines = lines.withColumn("elements", elements).withColumn("elements", F.when(whole, F.col("elements")).otherwise(F.array("value")))
    parsed = lines.select("value", F.transform("elements", lambda text: F.from_json(text, checked, options)).alias("records"))
    broken = F.when(F.exists("records", lambda record: record[CORRUPT_COLUMN].isNotNull()), F.col("value"))
    # An array of one, so that ``broken`` is found once for all records of a line.
    line = F.array(F.struct(F.col("records").alias("records"), broken.alias("broken")))
    marked = F.flatten(
        F.transform(
            line,
            lambda one: F.transform(
                one["records"], lambda record, place: record.withField(CORRUPT_COLUMN, one["broken"]).withField(PLACE_COLUMN, place)
            ),
        )
    )
    # A filter on the fields is not moved below a generator of them; the outer form keeps Catalyst
    # from inferring one on the array. So each line is parsed once, and no array is empty here.
    records = parsed.select(F.inline_outer(marked))
    if mode == "DROPMALFORMED":
        records = records.filter(F.col(CORRUPT_COLUMN).isNull())
    return records.select(*(f"`{name}`" for name in asked.names), *([PLACE_COLUMN] if placed else []))

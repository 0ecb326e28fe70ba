"""CSV in and out, and the clean-up a CSV load needs."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlane.schemas import INGESTED_AT
from ledgerlane.sources.csv_records import read_records

CORRUPT = "_corrupt_record"


# Texts that stand for a missing value.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def _value(name: str, kind: T.DataType) -> Column:
    """A cell's text as its declared type, NULL where it does not fit."""
    text = F.col(f"`{name}`")
    if isinstance(kind, T.LongType):
        # whole numbers may come with a decimal point and zeros behind it
        return F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("long")
    if isinstance(kind, T.BooleanType):
        lower = F.lower(F.trim(text))
        return F.when(lower == "true", True).when(lower == "false", False)
    if isinstance(kind, T.DateType):
        return F.when(F.trim(text).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.trim(text)).try_cast("date")
    return text if isinstance(kind, T.StringType) else F.trim(text).try_cast(kind)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    keep_bad_rows: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Scan a headed UTF-8 CSV (a leading byte-order mark is skipped) with a declared schema.

    Cells are read as text; words for a missing value become NULL in every column, and the rest is
    cast to the declared type. Header names are checked against the schema, so swapped columns fail
    instead of being read into each other. A row that does not fit fails the load, or is kept with
    its text in ``_corrupt_record`` when asked for. ``multi_line`` allows line breaks inside fields;
    it reads a file twice, by as many tasks as without (see ``csv_records``).
    """
    texts = T.StructType([T.StructField(field.name, T.StringType()) for field in schema.fields])
    read = T.StructType([*texts.fields, T.StructField(CORRUPT, T.StringType())]) if keep_bad_rows else texts
    options = {
        "escape": '"', "mode": "PERMISSIVE" if keep_bad_rows else "FAILFAST", "columnNameOfCorruptRecord": CORRUPT,
    }
    if multi_line:
        found = read_records(spark, path, texts.fieldNames())
        # taken out of an array, cells are no expression that a filter above is written out in: a record
        # would be parsed again for each time its cells are named
        cells = F.inline(F.array(F.from_csv("record", ", ".join(f"`{f.name}` string" for f in read.fields), options)))
        open_end = F.concat(F.lit("quotes do not pair up: "), F.substring("record", 1, 200))
        if keep_bad_rows:
            rows = found.select(cells, F.when(~F.col("whole"), open_end).alias("_open"))
            rows = rows.withColumn(CORRUPT, F.coalesce("_open", CORRUPT)).drop("_open")
        else:
            sure = F.when(F.col("whole"), True).otherwise(F.raise_error(open_end).cast("boolean"))
            rows = found.where(sure).select(cells)
    else:
        rows = (
            spark.read.option("header", True).option("encoding", "UTF-8").option("enforceSchema", False)
            .options(**options).schema(read).csv(path)
        )
    rows = rows.withColumns({
        name: F.when(~F.col(f"`{name}`").isin(*MISSING_WORDS), F.col(f"`{name}`"))
        for name in texts.fieldNames()
    })
    # each value is named where it is tested and where it is given, so it is made by a step of its own
    kinds = {field.name: field.dataType for field in schema.fields if not isinstance(field.dataType, T.StringType)}
    prefix, taken = "_", {name.lower() for name in rows.columns}
    while any(f"{prefix}{name}".lower() in taken for name in kinds):
        prefix += "_"
    typed_as = {name: f"{prefix}{name}" for name in kinds}
    rows = rows.withColumns({typed_as[name]: _value(name, kind) for name, kind in kinds.items()})
    unfit = reduce(
        lambda a, b: a | b,
        [F.col(f"`{name}`").isNotNull() & F.col(f"`{typed_as[name]}`").isNull() for name in kinds], F.lit(False),
    )
    whole = F.concat_ws(",", *[F.coalesce(f"`{name}`", F.lit("")) for name in texts.fieldNames()])
    typed = [F.col(f"`{typed_as.get(name, name)}`").alias(name) for name in texts.fieldNames()]
    if keep_bad_rows:
        corrupt = F.coalesce(F.col(CORRUPT), F.when(unfit, whole)).alias(CORRUPT)
        return rows.select(*typed, corrupt)
    problem = F.raise_error(F.concat(F.lit("malformed row: "), whole)).cast("boolean")
    return rows.where(F.when(unfit, problem).otherwise(True)).select(*typed)


def write_csv(rows: DataFrame, path: str) -> None:
    """One directory of headed CSV parts, no index column. Blanks are written as they are, and a
    missing value and an empty text alike as nothing."""
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def with_ingest_time(rows: DataFrame, loaded: datetime) -> DataFrame:
    """Stamp every row of a load with the same UTC text; the caller gives it, so loads repeat."""
    return rows.withColumn(INGESTED_AT, F.lit(loaded.strftime("%Y-%m-%d %H:%M:%S")))


def nan_to_null(rows: DataFrame) -> DataFrame:
    """Not-a-number becomes NULL in every floating-point column."""
    return rows.withColumns({
        field.name: F.nanvl(F.col(field.name), F.lit(None).cast(field.dataType))
        for field in rows.schema.fields
        if isinstance(field.dataType, (T.DoubleType, T.FloatType))
    })


# What a text must look like to count as each type.
_INTEGER = r"^[+-]?\d+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_BOOLEAN = r"^(True|False|TRUE|FALSE|true|false)$"
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def infer_types(texts: DataFrame) -> DataFrame:
    """Column types of an all-text table, from every value and in one pass.

    Returns ``(column, type)``. As in a frame of numpy columns, whole numbers with a gap become
    DOUBLE PRECISION, booleans with a gap TEXT, and a column without values DOUBLE PRECISION.
    """

    def all_match(name: str, pattern: str):
        return F.coalesce(F.bool_and(F.col(name).rlike(pattern)), F.lit(False))

    facts = texts.agg(*[
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("present"),
            F.count_if(F.col(name).isNull()).alias("missing"),
            all_match(name, _BOOLEAN).alias("boolean"),
            all_match(name, _INTEGER).alias("integer"),
            all_match(name, _NUMBER).alias("number"),
            all_match(name, _ISO_DATE).alias("iso_date"),
        ).alias(name)
        for name in texts.columns
    ])
    fact = facts.select(F.explode(F.array(*[F.col(f"`{n}`") for n in texts.columns])).alias("f"))
    whole = F.col("f.missing") == 0
    return fact.select(
        F.col("f.column").alias("column"),
        F.when(F.col("f.present") == 0, "DOUBLE PRECISION")
        .when(F.col("f.boolean") & whole, "BOOLEAN")
        .when(F.col("f.integer") & whole, "BIGINT")
        .when(F.col("f.number"), "DOUBLE PRECISION")
        .when(F.col("f.iso_date"), "DATE")
        .otherwise("TEXT")
        .alias("type"),
    )

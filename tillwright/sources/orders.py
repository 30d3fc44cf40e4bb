"""Raw order lines and their staged form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.contract import RAW_SCHEMA, STAGED_CASTS, STAGED_NAMES

_RECORD = "_record"
WHOLE_LINE = "*"


def read_raw_orders(
    spark: SparkSession, path: str, fmt: str = "parquet", date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Raw order lines from parquet (own types) or CSV (declared schema, header checked)."""
    if fmt == "csv":
        return (
            spark.read.schema(RAW_SCHEMA)
            .option("header", True)
            .option("enforceSchema", False)
            .option("dateFormat", date_format)
            .option("mode", "FAILFAST")
            .csv(path)
        )
    return spark.read.format(fmt).load(path)


def _coerced(text: Column, kind: T.DataType, date_format: str) -> Column:
    """The text as a value of its type, NULL where it is none."""
    if isinstance(kind, T.DateType):
        return F.try_to_timestamp(text, F.lit(date_format)).cast("date")
    return text if isinstance(kind, T.StringType) else text.try_cast(kind)


def read_coerced_orders(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> tuple[DataFrame, DataFrame]:
    """Raw order lines of a CSV file with dirty values, and the lines that do not hold what they should.

    The first frame has every line, with the declared types: a date or number that can't be read is NULL, as is a field
    that is absent or empty. The second has `Row ID`, `faults`, the columns that could not be read in their order, and
    `record`, the whole line, which is set only where the number of fields is wrong; such a line's `faults` begin with
    `*`. Missing values are no fault. A header that differs from the declared one fails the read. A file without lines
    gives two empty frames. Numbers may be NaN or infinite, as in any CSV that Spark reads.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in RAW_SCHEMA] + [T.StructField(_RECORD, T.StringType())])
    lines = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RECORD)
        .option("columnPruning", False)  # the number of fields is checked whatever columns are asked for
        .csv(path)
    )
    values = {f.name: _coerced(F.col(f"`{f.name}`"), f.dataType, date_format) for f in RAW_SCHEMA}
    unread = [
        F.when(F.col(f"`{name}`").isNotNull() & value.isNull(), F.lit(name))
        for name, value in values.items()
        if not isinstance(RAW_SCHEMA[name].dataType, T.StringType)
    ]
    whole = F.when(F.col(_RECORD).isNotNull(), F.lit(WHOLE_LINE))
    faults = F.array_compact(F.array(whole, *unread))
    rejects = lines.select("Row ID", faults.alias("faults"), F.col(_RECORD).alias("record")).filter(F.size("faults") > 0)
    return lines.select(*(value.alias(name) for name, value in values.items())), rejects


def stage(raw: DataFrame, pruned: bool = False) -> DataFrame:
    """Snake-case names, cast measures, and only lines with an order date and sales.

    All raw columns must be there, unless the frame was `pruned` on purpose.
    """
    absent = [name for name in STAGED_NAMES if name not in raw.columns]
    if absent and not pruned:
        raise ValueError(f"raw order lines lack columns: {absent}")
    kept = raw.filter(F.col("`Order Date`").isNotNull() & F.col("Sales").isNotNull())
    return kept.select(
        *(
            (F.col(f"`{name}`").cast(STAGED_CASTS[to]) if to in STAGED_CASTS else F.col(f"`{name}`")).alias(to)
            for name, to in STAGED_NAMES.items()
            if name in raw.columns
        )
    )


def read_daily_revenue(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd", lenient: bool = False) -> DataFrame:
    """`date` and `revenue` of a CSV file with a header, whatever other columns it has.

    A value that can't be read fails the read, or is NULL with `lenient`.
    """
    lines = spark.read.option("header", True).csv(path)
    if lenient:
        date, revenue = _coerced(F.col("date"), T.DateType(), date_format), _coerced(F.col("revenue"), T.DoubleType(), "")
    else:
        date, revenue = F.to_date("date", date_format), F.col("revenue").cast("double")
    return lines.select(date.alias("date"), revenue.alias("revenue"))

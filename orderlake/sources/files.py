"""File scans: JSON lines, delimited text, columnar files.

Every reader takes one path, a glob or a list of them. Give an explicit schema where there is
one: inference reads all files once more and lets the types follow the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from orderlake.operators.columns import quote
from orderlake.schemas import order_schema
from orderlake.sinks.quarantine import set_apart

CORRUPT = "_corrupt_record"

Paths = str | Sequence[str]


def read_json(
    spark: SparkSession,
    path: Paths,
    options: Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """JSON lines (or `multiLine` documents by option); schema inferred unless given."""
    reader = spark.read.options(**(options or {}))
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_order_documents(
    spark: SparkSession, path: Paths, options: Mapping[str, str] | None = None
) -> DataFrame:
    """Order documents with the declared schema: no inference job, stable types."""
    return read_json(spark, path, {"multiLine": "false", **(options or {})}, order_schema())


def read_csv_inferred(
    spark: SparkSession,
    path: Paths,
    header: bool = True,
    delimiter: str = ",",
    infer_schema: bool = True,
) -> DataFrame:
    return spark.read.options(header=header, delimiter=delimiter, inferSchema=infer_schema).csv(path)


def read_csv(
    spark: SparkSession, path: Paths, options: Mapping[str, str], schema: StructType | str
) -> DataFrame:
    return spark.read.options(**options).schema(schema).csv(path)


def read_csv_split_bad(
    spark: SparkSession,
    path: Paths,
    schema: StructType,
    header: bool = True,
    delimiter: str = ",",
    multiline: bool = True,
    bad_path: str | None = None,
    run_id: str | None = None,
    options: Mapping[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw text of those that do not.

    With `bad_path` the bad rows are set apart there as JSON, in the folder of `run_id` if one is
    given (`sinks.quarantine.set_apart`). Both frames are lazy over one scan definition. Quoted line breaks need `multiline`, which makes each file one task; set it off
    for large files without them.
    """
    rows = (
        spark.read.schema(StructType(schema.fields).add(CORRUPT, StringType()))
        .options(
            header=header,
            delimiter=delimiter,
            multiLine=multiline,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT,
        )
        .options(**(options or {}))
        .csv(path)
    )
    # Only columns that a query reads are parsed, so a query of few columns would take rows with
    # faults in the others for good. Tying the record to all columns (it takes no characters of
    # them) makes every use of either frame parse whole rows.
    everything = F.concat_ws("", *[F.col(quote(c)).cast("string") for c in schema.names])
    corrupt = F.col(CORRUPT)
    record = F.when(corrupt.isNotNull(), F.concat(corrupt, F.substring(everything, 1, 0)))
    good = rows.filter(record.isNull()).drop(CORRUPT)
    bad = rows.filter(record.isNotNull()).select(record.alias("record"))
    if bad_path is not None:
        set_apart(bad, bad_path, run_id, "json")
    return good, bad


def read_parquet(spark: SparkSession, path: Paths) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


def read_path(spark: SparkSession, path: Paths, fmt: str = "parquet") -> DataFrame:
    """A table by its path, in any installed table format."""
    return spark.read.format(fmt).load(path)


def landing_path(base: str, table: str, day: str | None = None) -> str:
    """Glob over one landing day of a table, or over all of them."""
    return f"{base.rstrip('/')}/{table}/{day}/*" if day else f"{base.rstrip('/')}/{table}/*"

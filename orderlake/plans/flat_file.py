"""Flat file to silver, and silver lookup to gold dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from orderlake.operators.columns import add_audit, drop
from orderlake.sinks.quarantine import set_apart
from orderlake.sinks.tables import overwrite_table
from orderlake.sources.files import landing_path, read_csv_inferred, read_csv_split_bad, read_path


def flat_file_rows(df: DataFrame, load_date: str) -> DataFrame:
    return add_audit(df, "load_date", load_date)


def run_flat_file(
    spark: SparkSession,
    bronze: str,
    file_table: str,
    day: str,
    silver_path: str,
    silver_table: str,
    bad_path: str | None = None,
) -> None:
    """Load one landing day of a delimited file into its silver table, replacing it.

    Without `bad_path` every day's types are inferred anew and may change the table's. With it, the table
    keeps the types of its first day: later days are read by them, without an inference pass, and rows
    that do not fit are set apart below `bad_path`, in the folder of the day. Columns may come in
    another order; a day that lacks columns or has others is refused, as no row of it could be right.
    """
    path = landing_path(bronze, file_table, day)
    pinned = table_schema(spark, silver_table) if bad_path is not None else None
    if pinned is None:
        rows = read_csv_inferred(spark, path)
    else:
        header = spark.read.option("header", "true").csv(path).columns
        if sorted(header) != sorted(pinned.names):
            raise ValueError(f"{path} has columns {header}, {silver_table} has {pinned.names}")
        # Files of the day with another header than the first one fail the job.
        ordered = StructType([pinned[c] for c in header])
        rows, bad = read_csv_split_bad(spark, path, ordered, multiline=False, options={"enforceSchema": "false"})
        set_apart(bad, bad_path, day)
        rows = rows.select(*pinned.names)
    overwrite_table(flat_file_rows(rows, day), silver_table, silver_path)


def table_schema(spark: SparkSession, silver_table: str) -> StructType | None:
    """The schema of a silver table's files, or None if there is no such table."""
    if not spark.catalog.tableExists(silver_table):
        return None
    return StructType([f for f in spark.table(silver_table).schema.fields if f.name != "load_date"])


def dimension_rows(silver: DataFrame, at_load_date: str) -> DataFrame:
    return add_audit(drop(silver, ["load_date"]), "at_load_date", at_load_date)


def run_dimension(
    spark: SparkSession, silver_path: str, gold_path: str, gold_table: str, at_load_date: str
) -> None:
    """Copy a silver lookup table into its gold dimension, replacing it."""
    silver = read_path(spark, silver_path)
    overwrite_table(dimension_rows(silver, at_load_date), gold_table, gold_path)

"""Writers for external tables: overwrite, guarded overwrite, slice replacement, upsert.

Tables are parquet folders registered in the catalog. No writer changes the session's
configuration. Parquet tables have no transaction log: readers that run during the last step
of a write can see parts of it, and two writers on one table must not run together.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from functools import reduce
from operator import and_
from urllib.parse import unquote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from orderlake.operators.columns import quote
from orderlake.operators.counts import observed
from orderlake.operators.joins import left_join
from orderlake.operators.quality import any_missing, require_present
from orderlake.operators.upsert import conformed, matched_rows, merged_type, one_source_row, upsert
from orderlake.scratch import delete_paths, staging


def ensure_database(spark: SparkSession, table: str) -> None:
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(table.rsplit('.', 1)[0])}")


def overwrite_table(
    df: DataFrame,
    table: str,
    path: str,
    partition_by: Sequence[str] = (),
    schema_mode: str = "replace",
    fmt: str = "parquet",
) -> None:
    """Replace an external table.

    `schema_mode="replace"` takes the new schema as it is; `"merge"` keeps columns that only
    the old table has, as nulls.
    """
    spark = df.sparkSession
    ensure_database(spark, table)
    df = storable(df, partition_by)
    if schema_mode == "merge":
        if attach_table(spark, table, path, partition_by, df.schema):
            df = _with_columns_of(df, spark.table(table).schema)
    elif schema_mode != "replace":
        raise ValueError("schema_mode must be 'replace' or 'merge'")
    writer = _few_files(df, partition_by).write.mode("overwrite").format(fmt).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def guarded_overwrite(
    df: DataFrame,
    table: str,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    schema_mode: str = "merge",
    counts: bool = False,
) -> dict[str, int] | None:
    """Replace a table with the distinct rows that have no null key.

    With `counts` it returns how many rows came (`rows`), how many had a null key (`missing`) and how
    many were written (`written`). They are counted in passing, without a second pass; only the key
    filter can then not move below the count of what came.
    """
    if not counts:
        overwrite_table(guarded(df, keys), table, path, partition_by, schema_mode)
        return None
    rows = F.count(F.lit(1))
    df, came = observed(df, rows=rows, missing=F.count_if(any_missing(keys)))
    df, left = observed(guarded(df, keys), written=rows)
    overwrite_table(df, table, path, partition_by, schema_mode)
    return {**came.get, **left.get}


def swap_table(df: DataFrame, table: str, path: str, schema_mode: str = "replace") -> None:
    """Replace a table without partitions so that readers by name see the old rows or the new ones.

    The rows go to a new folder below `path`, and the table's location is set to it when they are all
    there; a write that fails leaves the table as it was. Folders of versions before the one replaced are
    deleted, so a query that began on that one can end. Read such a table by its name, not by path.
    A schema that lacks or changes columns of the table's needs the table to be entered anew, between
    which a reader may not find it.
    """
    if schema_mode not in ("replace", "merge"):
        raise ValueError("schema_mode must be 'replace' or 'merge'")
    spark = df.sparkSession
    ensure_database(spark, table)
    known = spark.catalog.tableExists(table)
    before = None
    if known:
        _refuse_other_layout(spark, table, path, ())
        before = _location(spark, table)
        if schema_mode == "merge":
            df = _with_columns_of(df, spark.table(table).schema)
    fresh = f"{path.rstrip('/')}/{_VERSION}{uuid4().hex}"
    df.write.parquet(fresh)
    if known:
        add_columns(spark, table, df.schema)
    if known and _same_columns(spark.table(table).schema, df.schema):
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_literal(fresh)}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        enter_table(spark, table, fresh, (), df.schema)
    spark.catalog.refreshTable(table)
    _delete_versions(spark, path, keep=(fresh, before))


_VERSION = "version-"


def _same_columns(a: StructType, b: StructType) -> bool:
    return {f.name.lower(): f.dataType for f in a.fields} == {f.name.lower(): f.dataType for f in b.fields}


def _delete_versions(spark: SparkSession, path: str, keep: Sequence[str | None]) -> None:
    every = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{_VERSION}*")
    found = every.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(every)
    kept = {_place(p) for p in keep if p}
    delete_paths(spark, [p for f in found or () if _place(p := f.getPath().toString()) not in kept])


def guarded(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct rows without a null key. Spark moves the key filter below the distinct."""
    return require_present(df.dropDuplicates(), keys)


def storable(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Partition columns as a folder table gives them back: an empty text is stored as null.

    Every writer does this before it works out which partitions it touches.
    """
    texts = [c for c in partition_by if isinstance(df.schema[c].dataType, StringType)]
    return df.withColumns({c: F.nullif(F.col(quote(c)), F.lit("")) for c in texts}) if texts else df


def replace_slice(df: DataFrame, table: str, path: str, slice_values: Mapping[str, int | str]) -> None:
    """Replace the one partition named by `slice_values` (such as year, month and day).

    A row outside the slice fails the write, and a failed write replaces nothing: the new files
    take the place of the old ones when the job commits. (`INSERT OVERWRITE` of a named partition
    would delete first and then compute.) Other partitions stay as they are; no rows at all leave
    the slice empty.
    """
    spark = df.sparkSession
    parts = list(slice_values)
    df = storable(df, parts)
    slice_values = {c: None if v == "" else v for c, v in slice_values.items()}
    inside = reduce(and_, [F.col(quote(c)).eqNullSafe(F.lit(v)) for c, v in slice_values.items()])
    checked = df.filter(
        F.when(inside, F.lit(True)).otherwise(
            F.raise_error(F.lit(f"row outside the slice {dict(slice_values)}")).cast("boolean")
        )
    )
    ensure_database(spark, table)
    if not attach_table(spark, table, path, parts, df.schema):
        overwrite_table(checked, table, path, parts)
        return
    with staging(spark) as staged:
        # Computed once: the copy is asked whether it has rows and is then what is written.
        checked = staged(checked, "slice")
        if checked.isEmpty():
            _empty_partition(spark, table, slice_values)
            return
        add_columns(spark, table, df.schema)
        _overwrite_partitions(checked, table, path, parts)


def upsert_table(
    df: DataFrame, table: str, path: str, keys: Sequence[str], partition_by: Sequence[str] = (), swap: bool = False
) -> None:
    """Create the table, or update and insert by key (`operators.upsert`).

    The distinct source rows without a null key are taken. New source columns are added to the
    table. With partitions, only those that hold matched rows or receive source rows are read for
    the update and rewritten, in one job whose new files take the place of the old ones when it
    commits; a write that fails replaces nothing. Without, the result is staged in the shared folder
    and then written over the table, because such a folder cannot be read and overwritten in one job;
    if that last step fails, the staged table is whole. A table without partitions may be swapped
    instead (`swap_table`), which needs no staged result.
    """
    spark = df.sparkSession
    keys, parts = list(keys), list(partition_by)
    if swap and parts:
        raise ValueError("a table with partitions is not swapped: its partitions are replaced at the commit of a job")
    source = storable(guarded(df, keys), parts)
    ensure_database(spark, table)
    if swap and not spark.catalog.tableExists(table):
        swap_table(source, table, path)
        return
    if not attach_table(spark, table, path, parts, df.schema):
        overwrite_table(source, table, path, parts)
        return

    with staging(spark) as staged:
        # The source and the matched keys are used several times below; staged copies are computed once.
        source = staged(source, "upsert-source")
        target = spark.table(table)
        matched = staged(matched_rows(target, source, keys, parts), "upsert-matched")
        repeated = not matched.filter(one_source_row()).groupBy(*map(quote, keys)).count().filter("count > 1").isEmpty()
        if not parts and swap:
            swap_table(upsert(target, source, keys, matched, repeated), table, path)
            return
        if parts:
            received = _values(source, parts, target.schema)
            touched = _values(matched, parts) | received
            if not touched:
                return
            target = _in_partitions(target, touched, parts)
        result = upsert(target, source, keys, matched, repeated)
        if not parts:
            result = staged(result, "upsert-result")

        add_columns(spark, table, result.schema)
        widen_structs(spark, table, path, parts, result.schema)
        if not parts:
            _in_table_schema(result, table).write.mode("overwrite").parquet(path)
            refresh_table(spark, table, parts)
            return
        _replace_partitions(result, table, path, parts, touched, received)


def upsert_files(
    df: DataFrame, table: str, path: str, keys: Sequence[str], partition_by: Sequence[str] = ()
) -> list[str]:
    """`upsert_table` that rewrites only the files which hold matched rows, and names them.

    For few changes to large partitions: other files of a touched partition stay as they are. The keys of
    the table are read once, with their files; the files found are read whole, their rows updated,
    and written with the inserted rows beside the others; then the old files are deleted. The driver
    holds the names of these files only. Readers between the two steps see updated rows twice, and so
    does a table whose job was stopped there: the error says which files were to go.
    """
    spark = df.sparkSession
    keys, parts = list(keys), list(partition_by)
    source = storable(guarded(df, keys), parts)
    ensure_database(spark, table)
    if not attach_table(spark, table, path, parts, df.schema):
        overwrite_table(source, table, path, parts)
        return []

    with staging(spark) as staged:
        source = staged(source, "upsert-source")
        target = spark.table(table)
        matched = target.select(*map(quote, keys), F.col("_metadata.file_path").alias("__file"))
        matched = matched.join(source.select(*map(quote, keys)), keys, "left_semi")
        files = sorted(r[0] for r in matched.select("__file").distinct().collect())
        if files:
            reader = spark.read.schema(target.schema).option("basePath", path)
            result = upsert(reader.parquet(*map(unescaped, files)), source, keys)
        else:
            result = upsert(target.limit(0), source, keys)
        result = staged(_few_files(result, parts), "upsert-result")
        add_columns(spark, table, result.schema)
        widen_structs(spark, table, path, parts, result.schema)
        writer = _in_table_schema(result, table).write.mode("append")
        (writer.partitionBy(*parts) if parts else writer).parquet(path)
        try:
            delete_paths(spark, map(unescaped, files))
        except Exception as e:
            raise RuntimeError(f"{table} has these rows twice; delete {files}") from e
        refresh_table(spark, table, parts)
    return files


def unescaped(uri: str) -> str:
    """A file's path from `_metadata.file_path`, whose special characters are escaped once more."""
    return unquote(uri)


def replace_keys(
    df: DataFrame, changed: DataFrame, table: str, path: str, keys: Sequence[str], partition_by: Sequence[str]
) -> None:
    """Replace all rows of the keys in `changed` by the rows of `df`; create the table if it is not there.

    Only partitions that hold rows of these keys or receive rows are read and written. `changed` may
    have keys of which `df` has no row: their rows go. Rows with a null key stay.
    """
    spark = df.sparkSession
    keys, parts = list(keys), list(partition_by)
    ensure_database(spark, table)
    df = storable(df, parts)
    if not attach_table(spark, table, path, parts, df.schema):
        overwrite_table(df, table, path, parts)
        return
    with staging(spark) as staged:
        df = staged(df, "replace-rows")
        changed = staged(changed.select(*map(quote, keys)).distinct(), "replace-keys")
        target = spark.table(table)
        received = _values(df, parts, target.schema)
        columns = list(dict.fromkeys([*keys, *parts]))
        touched = _values(target.select(*map(quote, columns)).join(changed, keys, "left_semi"), parts) | received
        if not touched:
            return
        kept = left_join(_in_partitions(target, touched, parts), changed, keys, how="left_anti")
        result = kept.unionByName(df, allowMissingColumns=True)
        add_columns(spark, table, result.schema)
        _replace_partitions(result, table, path, parts, touched, received)


def _replace_partitions(
    result: DataFrame, table: str, path: str, parts: list[str], touched: set[tuple], received: set[tuple]
) -> None:
    """Write `result` over the touched partitions, from which it may be read; those in `received` are known to have rows."""
    emptied = touched - received
    if emptied:
        # those from which all rows move to other partitions: nothing is written over them
        emptied -= _values(_in_partitions(result, emptied, parts), parts)
    _overwrite_partitions(_few_files(result, parts), table, path, parts)
    for values in emptied:
        _empty_partition(result.sparkSession, table, dict(zip(parts, values)))


def attach_table(
    spark: SparkSession, table: str, path: str, partition_by: Sequence[str], like: StructType
) -> bool:
    """Whether the table exists; data at the path without a catalog entry is registered first.

    Partition values get the types of `like`: read from folder names alone, `'01'` would
    become the number 1.
    """
    if spark.catalog.tableExists(table):
        _refuse_other_layout(spark, table, path, partition_by)
        return True
    try:
        found = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    data = [f for f in found.fields if f.name not in partition_by]
    schema = StructType([*data, *[like[c] for c in partition_by]])
    enter_table(spark, table, path, partition_by, schema)
    return True


def _refuse_other_layout(spark: SparkSession, table: str, path: str, partition_by: Sequence[str]) -> None:
    """An error if the catalog has the table at another place or partitioned in another way."""
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if sorted(c.lower() for c in parts) != sorted(c.lower() for c in partition_by):
        raise ValueError(f"{table} is partitioned by {parts}, not by {list(partition_by)}")
    location = _location(spark, table)
    if location is not None and re.sub(f"/{_VERSION}[0-9a-f]+$", "", _place(location)) != _place(path):
        raise ValueError(f"{table} is at {location}, not at {path}")


def _location(spark: SparkSession, table: str) -> str | None:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    return None if described is None else described.data_type


def _place(path: str) -> str:
    """A path without what one spelling of the same place may have and another lacks."""
    return re.sub(r"^file:/+", "/", path).rstrip("/")


def widen_structs(spark: SparkSession, table: str, path: str, partition_by: Sequence[str], schema: StructType) -> None:
    """Let the table's structs have the new fields of `schema`; they are null in the rows it has.

    A catalog changes no column's type, so the table is entered anew over the same files.
    """
    old = spark.table(table).schema
    new = {f.name.lower(): f for f in schema.fields}
    wide = StructType()
    for field in old.fields:
        other = new.get(field.name.lower())
        wide.add(field.name, merged_type(field.dataType, other.dataType) if other else field.dataType)
    if [f.dataType for f in wide.fields] == [f.dataType for f in old.fields]:
        return
    spark.sql(f"DROP TABLE {table}")
    enter_table(spark, table, path, partition_by, wide)


def enter_table(spark: SparkSession, table: str, path: str, partition_by: Sequence[str], schema: StructType) -> None:
    """Name the files at a path, if there are any, in the catalog."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)
    partitioned = f"PARTITIONED BY ({_names(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({schema.toDDL()}) USING parquet {partitioned} LOCATION {_literal(path)}")
    if partition_by:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def add_columns(spark: SparkSession, table: str, schema: StructType) -> None:
    """Add the columns that the table lacks; they are null in the rows it has."""
    known = {c.lower() for c in spark.table(table).columns}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({StructType(new).toDDL()})")


def _in_table_schema(df: DataFrame, table: str) -> DataFrame:
    schema = df.sparkSession.table(table).schema
    df = _with_columns_of(df, schema)
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    return df.select(
        *[conformed(F.col(quote(f.name)), types[f.name.lower()], f.dataType).alias(f.name) for f in schema.fields]
    )


def _with_columns_of(df: DataFrame, schema: StructType) -> DataFrame:
    there = {c.lower() for c in df.columns}
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name.lower() not in there}
    return df.withColumns(missing) if missing else df


def _few_files(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, so that not every task writes every partition.

    The rebalance hint splits a large partition value over several tasks and joins small ones.
    """
    return df.hint("rebalance", *partition_by) if partition_by else df


def _values(rows: DataFrame, parts: Sequence[str], types: StructType | None = None) -> set[tuple]:
    """Partition values of the rows, in the table's types if these are given.

    As many as partitions are rewritten, whose folders the driver lists in any case.
    """
    columns = [F.col(quote(c)).cast(types[c].dataType).alias(c) if types else F.col(quote(c)) for c in parts]
    return {tuple(r) for r in rows.select(*columns).distinct().collect()}


def _in_partitions(target: DataFrame, values: Collection[tuple], parts: Sequence[str]) -> DataFrame:
    """The rows of some partitions. A filter per column prunes folders, for however many values.

    With several partition columns that keeps some combinations too many, which a semi join
    takes out.
    """
    for place, c in enumerate(parts):
        own = {row[place] for row in values}
        column = F.col(quote(c))
        named = column.isin(sorted(own - {None}))
        target = target.filter(named | column.isNull() if None in own else named)
    if len(parts) == 1:
        return target
    schema = StructType([target.schema[c] for c in parts])
    wanted = target.sparkSession.createDataFrame(list(values), schema).toDF(*[f"__{c}" for c in parts])
    same = reduce(and_, [F.col(quote(c)).eqNullSafe(F.col(quote(f"__{c}"))) for c in parts])
    return target.join(wanted, same, "left_semi")


def _overwrite_partitions(df: DataFrame, table: str, path: str, parts: Sequence[str]) -> None:
    """Replace the partitions that the rows fall in, at the commit of the job; until then they can be read."""
    writer = _in_table_schema(df, table).write.mode("overwrite").partitionBy(*parts)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    refresh_table(df.sparkSession, table, parts)


def _empty_partition(spark: SparkSession, table: str, values: Mapping[str, object]) -> None:
    data = [f for f in spark.table(table).schema.fields if f.name not in values]
    partition = ", ".join(f"{quote(c)} = {_literal(v)}" for c, v in values.items())
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION ({partition}) SELECT * FROM {{nothing}}",
        nothing=spark.createDataFrame([], StructType(data)),
    )


def refresh_table(spark: SparkSession, table: str, parts: Sequence[str]) -> None:
    """Let the catalog see files that were written by path."""
    spark.catalog.refreshTable(table)
    if parts:
        spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def _names(columns: Sequence[str]) -> str:
    return ", ".join(quote(c) for c in columns)


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

"""What an upsert shuffles and writes, and that its rows are those of a plain one."""

from uuid import uuid4

import pytest
from pyspark.errors import PySparkException

from orderlake.operators.upsert import matched_rows, upsert
from orderlake.sinks import tables
from orderlake.sinks.tables import upsert_table
from orderlake.sources.tables import read_table

DDL = "k int, v string, c string"
STORED = [(1, "a", "x"), (2, "b", "x"), (2, "b2", "y"), (2, "b3", "y"), (3, "c", "z"), (4, "d", "w"), (None, "n", "x"), (5, "e", None)]
# two of a key that the table lacks, one for three stored rows, one that moves and leaves a partition empty
SENT = [(2, None, "x"), (4, "D", "v"), (7, "p", "v"), (7, "q", "x"), (1, "A", "x")]
WANT = [(1, "A", "x"), *[(2, None, "x")] * 3, (3, "c", "z"), (4, "D", "v"), (7, "p", "v"), (7, "q", "x"), (None, "n", "x"), (5, "e", None)]


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def stored(spark, tmp_path):
    spark.createDataFrame(STORED, DDL).write.partitionBy("c").parquet(str(tmp_path / "t"))
    return f"upsert_tests.t_{uuid4().hex}", str(tmp_path / "t")


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_upserts_of_whole_rows(spark, tmp_path, threshold):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        table, path = stored(spark, tmp_path)
        target, source = spark.createDataFrame(STORED, DDL), spark.createDataFrame(SENT, DDL)
        matched = matched_rows(target, source, ["k"], ["c"])
        assert rows(matched.select("k", "c")) == sorted([(1, "x"), (2, "x"), (2, "y"), (2, "y"), (4, "w")])
        assert rows(upsert(target, source, ["k"])) == sorted(WANT, key=repr)
        assert rows(upsert(target, source, ["k"], matched)) == sorted(WANT, key=repr)
        upsert_table(source, table, path, ["k"], ["c"])
        assert rows(read_table(spark, table)) == sorted(WANT, key=repr)
        assert not spark.read.parquet(path).filter("c = 'w'").count()
        twice = spark.createDataFrame([(3, "x", "z"), (3, "y", "z")], DDL)
        with pytest.raises(PySparkException, match="several source rows"):
            upsert_table(twice, table, path, ["k"], ["c"])
        assert rows(read_table(spark, table)) == sorted(WANT, key=repr)
    finally:
        spark.conf.set(name, before)


def test_only_the_target_is_shuffled_whole(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        target, source = spark.createDataFrame(STORED, DDL), spark.createDataFrame(SENT, DDL)
        result = upsert(target, source, ["k"], matched_rows(target, source, ["k"]), repeated=False)
        plan = result._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set(name, before)
    kept, added = plan.split("\n", 1)[1].rsplit("\n+- ", 1)
    assert "LeftAnti" in kept and "Join" not in added


def test_the_result_is_written_once(spark, tmp_path, monkeypatch):
    table, path = stored(spark, tmp_path)
    copies, staging = [], tables.staging

    def listed(session):
        manager = staging(session)
        staged = manager.__enter__()

        class Listing:
            def __enter__(self):
                return lambda df, purpose: copies.append(purpose) or staged(df, purpose)

            def __exit__(self, *error):
                return manager.__exit__(*error)

        return Listing()

    monkeypatch.setattr(tables, "staging", listed)
    upsert_table(spark.createDataFrame(SENT, DDL), table, path, ["k"], ["c"])
    assert copies == ["upsert-source", "upsert-matched"]
    assert rows(read_table(spark, table)) == sorted(WANT, key=repr)

"""Documents that do not fit, landing by day, quarantine by run, swapped tables, upserts by file, counts."""

import json
import subprocess
import sys
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake.operators.counts import observed
from orderlake.operators.joins import lookup_join
from orderlake.plans.flat_file import run_flat_file
from orderlake.plans.gold_orders import run_orders_fact, run_orders_fact_changes
from orderlake.plans.silver_orders import run_orders_silver, run_orders_silver_daily
from orderlake.scratch import delete_paths, staging
from orderlake.sinks.quarantine import quarantine_missing, set_apart
from orderlake.sinks.tables import guarded_overwrite, overwrite_table, replace_keys, swap_table, upsert_files, upsert_table
from orderlake.sources.documents import RECORD, all_fitting, fitting, read_checked_documents, unfit
from orderlake.sources.landing import land_new_days, landed_days
from orderlake.sources.tables import read_table
from tests.test_plans import document, entry, promotion


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


@pytest.fixture
def table():
    return f"landing_tests.t_{uuid4().hex}"


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def land(base, day, lines, name="part.json", table="orders"):
    folder = base / table / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


# --- documents that do not fit -------------------------------------------------------------

FAULTY = [
    '{"code":"text for a number","entries":[{"entryNumber":"1"}]}',
    '{"code":"deep","entries":[{"entryNumber":1,"parentEntry":{"entryNumber":"x"}}]}',
    '{"code":"outside","totalPrice":"n/a"}',
    '{"code":"fraction","entries":[{"entryNumber":1.5}]}',
    '{"code":"too large","entries":[{"entryNumber":99999999999999999999}]}',
    '{"code":"object for an array","entries":{"entryNumber":1}}',
    '{"code":"no end"',
    "no document",
]
FITTING = ['{"code":7,"entries":[{"entryNumber":1}],"unknown":"field"}', '{"code":"O2","totalPrice":2}', "{}"]


def test_documents_that_do_not_fit_are_set_apart_whole(spark, tmp_path):
    land(tmp_path, "d", [*FAULTY, *FITTING])
    found = read_checked_documents(spark, str(tmp_path / "orders" / "d"))
    assert rows(fitting(found).select("code")) == [("7",), ("O2",), (None,)]
    assert rows(unfit(found)) == sorted([(line,) for line in FAULTY], key=repr)
    # every narrower use sees the same split
    assert fitting(found).count() == 3 and unfit(found).count() == len(FAULTY)
    assert found.filter(F.col("code") == "outside").select(RECORD).first()[0] == FAULTY[2]
    with pytest.raises(PySparkException, match="does not fit the schema"):
        all_fitting(found).select("code").collect()
    assert read_checked_documents(spark, str(tmp_path / "orders" / "d")).limit(0).collect() == []


@pytest.mark.parametrize("copied", [True, False])
def test_the_silver_job_quarantines_or_refuses_misfits(spark, tmp_path, table, copied):
    land(tmp_path, "2024-01-05", [document("O1", 0, [entry(0, "P0")]), *FAULTY])
    landed, silver, bad = str(tmp_path / "orders" / "*"), str(tmp_path / "silver"), str(tmp_path / "bad")
    with pytest.raises(PySparkException, match="does not fit the schema"):
        run_orders_silver(spark, landed, silver, table, "2024-01-05", land=copied)
    for _ in range(2):
        run_orders_silver(spark, landed, silver, table, "2024-01-05", land=copied, bad_path=bad)
        assert [r.order_number for r in read_table(spark, table).collect()] == ["O1"]
        assert rows(spark.read.parquet(bad).select("record")) == sorted([(line,) for line in FAULTY], key=repr)


# --- landing by day ------------------------------------------------------------------------


def test_new_days_are_copied_once(spark, tmp_path, table, path):
    base = tmp_path / "orders" / "bronze"  # the table's name stands in the path more than once
    land(base, "2024-01-05", ['{"code":"O1"}', "no document"])
    land(base, "2024-01-06/part", ['{"code":"O2"}'])
    land(base, "2024-01-07", ['{"code":"other"}'], table="refunds")
    assert rows(landed_days(spark, str(base), "orders")) == [("2024-01-05",), ("2024-01-06",)]
    assert land_new_days(spark, str(base), "orders", path, table) == ["2024-01-05", "2024-01-06"]
    first = set(read_table(spark, table).inputFiles())

    land(base, "2024-01-05", ['{"code":"late"}'], "late.json")
    land(base, "2024-01-08", ['{"code":"O3"}'])
    # the second run must not read the old days: their files are no longer readable as JSON
    (base / "orders" / "2024-01-06" / "part" / "part.json").write_bytes(b"\xff\xfe\x00")
    assert land_new_days(spark, str(base), "orders", path, table) == ["2024-01-08"]
    assert land_new_days(spark, str(base), "orders", path, table) == []
    found = read_table(spark, table)
    assert rows(found.select("code", "landing_day", RECORD)) == sorted(
        [("O1", "2024-01-05", None), (None, "2024-01-05", "no document"), ("O2", "2024-01-06", None), ("O3", "2024-01-08", None)],
        key=repr,
    )
    assert first < set(found.inputFiles())
    spark.sql(f"DROP TABLE {table}")  # a catalog that forgot the table finds its days again
    assert land_new_days(spark, str(base), "orders", path, table) == []


def test_the_daily_job_computes_touched_orders_from_all_their_documents(spark, tmp_path, table):
    base, paths = tmp_path / "bronze", {n: str(tmp_path / n) for n in ("copy", "silver", "bad", "whole")}
    land(base, "2024-01-05", [
        document("O1", 0, [entry(0, "P0")], allPromotionResults=[promotion("", "EARLY")]),
        document("O2", 0, [entry(0, "P1")]),
    ])
    job = (spark, str(base), "orders", paths["copy"], f"{table}_bronze", paths["silver"], table)
    assert run_orders_silver_daily(*job, "2024-01-05", bad_path=paths["bad"]) == ["2024-01-05"]
    land(base, "2024-01-06", [document("O1", 86400000, [entry(0, "P0")], allPromotionResults=[promotion("", "LATE")]), "no document"])
    assert run_orders_silver_daily(*job, "2024-01-06", bad_path=paths["bad"]) == ["2024-01-06"]
    assert run_orders_silver_daily(*job, "2024-01-07", bad_path=paths["bad"]) == []
    got = read_table(spark, table).select("order_number", "event_date", "cart_level_promotions", "load_date")
    assert rows(got) == [
        ("O1", "1970-01-01 00:00:00", ["EARLY", "LATE"], "2024-01-06"),
        ("O1", "1970-01-02 00:00:00", ["EARLY", "LATE"], "2024-01-06"),
        ("O2", "1970-01-01 00:00:00", None, "2024-01-05"),
    ]
    assert rows(spark.read.parquet(paths["bad"]).select("landing_day", "record")) == [("2024-01-06", "no document")]
    run_orders_silver(spark, str(base / "orders" / "*"), paths["whole"], f"{table}_whole", "x", bad_path=paths["bad"])
    whole, daily = read_table(spark, f"{table}_whole").drop("load_date"), read_table(spark, table).drop("load_date")
    assert rows(whole.select(*sorted(whole.columns))) == rows(daily.select(*sorted(daily.columns)))


# --- flat files with one schema ------------------------------------------------------------


def test_flat_files_keep_the_first_days_types(spark, tmp_path, table, path):
    bad = str(tmp_path / "bad")
    land(tmp_path, "1", ["k,v,day", "1,1.5,2024-01-05", "2,,2024-01-06"], "a.csv", "shops")
    land(tmp_path, "2", ["day,v,k", "2024-01-07,n/a,3", "2024-01-08,2,4", "soon,3,5", "2024-01-09,4"], "a.csv", "shops")
    land(tmp_path, "3", ["k,v,colour", "1,1,red"], "a.csv", "shops")
    run_flat_file(spark, str(tmp_path), "shops", "1", path, table, bad)
    types = [f.dataType for f in read_table(spark, table).schema]
    for _ in range(2):
        run_flat_file(spark, str(tmp_path), "shops", "2", path, table, bad)
        assert [(r.k, r.v, str(r.day), r.load_date) for r in read_table(spark, table).collect()] == [(4, 2.0, "2024-01-08", "2")]
        assert [f.dataType for f in read_table(spark, table).schema] == types
        assert rows(spark.read.parquet(bad).select("record")) == [("2024-01-07,n/a,3",), ("2024-01-09,4",), ("soon,3,5",)]
    with pytest.raises(ValueError, match="colour"):
        run_flat_file(spark, str(tmp_path), "shops", "3", path, table, bad)
    assert read_table(spark, table).count() == 1
    run_flat_file(spark, str(tmp_path), "shops", "3", path, table)  # without a bad path, types and names are inferred anew
    assert "colour" in read_table(spark, table).columns


# --- quarantine, counts, staging -----------------------------------------------------------


def test_a_run_replaces_its_own_quarantine(spark, path):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k int, v string")
    for _ in range(2):
        assert rows(quarantine_missing(df, ["k", "v"], path, "run-1")) == [(1, "a")]
    quarantine_missing(df.filter("k = 3"), ["v"], path, "run-2")
    assert rows(spark.read.parquet(path)) == sorted([(None, "b", "run-1"), (3, None, "run-1"), (3, None, "run-2")], key=repr)
    quarantine_missing(df.filter("k = 1"), ["v"], path, "run-2")
    assert {r.run_id for r in spark.read.parquet(path).collect()} == {"run-1"}
    with pytest.raises(ValueError, match="no name"):
        set_apart(df, path, "../other")


def test_counts_come_with_the_write(spark, table, path):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, "c")], "k int, v string").repartition(3)
    found = guarded_overwrite(df, table, path, ["k"], counts=True)
    assert found == {"rows": 4, "missing": 1, "written": 2}
    assert rows(read_table(spark, table)) == [(1, "a"), (2, "c")]
    assert guarded_overwrite(df, table, path, ["k"]) is None


def test_counting_adds_no_job(spark, path):
    jobs = spark.sparkContext.statusTracker()

    def run(name, df):
        spark.sparkContext.setJobGroup(name, name)
        df.write.parquet(f"{path}-{name}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(jobs.getJobIdsForGroup(name))

    df = spark.range(1000).toDF("k")
    seen, counts = observed(df, rows=F.count(F.lit(1)), odd=F.count_if(F.col("k") % 2 == 1))
    assert run("observed", seen) == run("plain", df) == 1
    assert counts.get == {"rows": 1000, "odd": 500}


def test_a_missing_part_of_the_library_is_no_left_out_subpackage():
    """Without the subpackage, or something that only it needs, the other queries are there."""
    code = """
import importlib.abc, sys
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
print(len(e.queries()), any(n.startswith('op') for n in e.queries()))
"""
    root = Path(__file__).resolve().parent.parent

    def run(name):
        return subprocess.run([sys.executable, "-c", code.format(name=name)], cwd=root, capture_output=True, text=True)

    for name in ("orderlake.llm", "corpus_pipeline", "tokenizers_of_old", "public_tokenizers"):
        out = run(name)
        assert out.returncode == 0 and int(out.stdout.split()[0]) > 70, out.stderr
        assert out.stdout.split()[1] == str(name == "tokenizers_of_old")
    assert "ModuleNotFoundError" in run("orderlake.operators.joins").stderr


def test_staged_copies_go_unless_the_work_fails(spark):
    with staging(spark) as staged:
        kept = staged(spark.range(3), "x")
        files = kept.inputFiles()
        assert kept.count() == 3
    with pytest.raises(PySparkException):
        spark.read.parquet(*files)
    with pytest.raises(ZeroDivisionError), staging(spark) as staged:
        files = staged(spark.range(3), "x").inputFiles()
        raise ZeroDivisionError
    assert spark.read.parquet(*files).count() == 3
    delete_paths(spark, [*files, "/no/such/place"])


# --- swapped tables ------------------------------------------------------------------------


def test_a_swap_that_fails_midway_leaves_the_old_rows(spark, table, path):
    swap_table(spark.range(10).toDF("k"), table, path)
    broken = spark.range(1000).repartition(4).select(
        F.when(F.col("id") == 999, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")).alias("k")
    )
    reader = read_table(spark, table)
    for write in (lambda: swap_table(broken, table, path), lambda: upsert_table(broken, table, path, ["k"], swap=True)):
        with pytest.raises(PySparkException, match="broken"):
            write()
        assert read_table(spark, table).count() == 10 == reader.count()


def test_swaps_follow_schemas_and_delete_old_versions(spark, table, path, tmp_path):
    swap_table(spark.createDataFrame([(1, "a")], "k int, v string"), table, path)
    old = read_table(spark, table)
    upsert_table(spark.createDataFrame([(1, 2.5), (2, 3.5)], "k int, w double"), table, path, ["k"], swap=True)
    assert rows(read_table(spark, table).select("k", "v", "w")) == [(1, "a", 2.5), (2, None, 3.5)]
    assert len(list((tmp_path / "table").iterdir())) == 2 and old.inputFiles()
    swap_table(spark.createDataFrame([("x",)], "k string"), table, path)
    assert read_table(spark, table).dtypes == [("k", "string")] and rows(read_table(spark, table)) == [("x",)]
    assert len(list((tmp_path / "table").iterdir())) == 2
    swap_table(spark.createDataFrame([(1,)], "n int"), table, path, "merge")
    assert rows(read_table(spark, table).select("k", "n")) == [(None, 1)]
    with pytest.raises(ValueError, match="is at"):
        swap_table(spark.range(1), table, path + "_other")
    with pytest.raises(ValueError, match="not swapped"):
        upsert_table(spark.range(1), table, path, ["id"], ["id"], swap=True)


# --- upserts by file, replaced keys --------------------------------------------------------


@pytest.mark.parametrize("parts", [["c"], []])
def test_upsert_rewrites_matched_files_only(spark, table, path, parts):
    ddl = "k int, v string, c string"
    first = [(k, "old", "a b" if k % 2 else None) for k in range(40)]
    stored = spark.createDataFrame(first, ddl).repartitionByRange(5, "k")
    (stored.write.partitionBy(*parts) if parts else stored.write).parquet(path)
    changes = spark.createDataFrame([("n", 3, "new", "a b"), ("n", 1, "moved", None), ("n", 99, "added", "z")], f"note string, {ddl}")
    files = upsert_files(changes, table, path, ["k"], parts)
    assert len(files) == 1
    found = read_table(spark, table)
    want = {k: (k, v, c, None) for k, v, c in first} | {3: (3, "new", "a b", "n"), 1: (1, "moved", None, "n"), 99: (99, "added", "z", "n")}
    assert rows(found.select("k", "v", "c", "note")) == sorted(want.values(), key=repr)
    others = set(found.filter("k between 12 and 38").select("_metadata.file_path").distinct().collect())
    assert len(others) >= 4
    holding = sorted(r[0] for r in found.filter("k in (1, 3, 99)").select("_metadata.file_path").distinct().collect())
    assert upsert_files(changes, table, path, ["k"], parts) == holding
    assert rows(read_table(spark, table).select("k", "v", "c", "note")) == sorted(want.values(), key=repr)
    assert set(read_table(spark, table).filter("k between 12 and 38").select("_metadata.file_path").distinct().collect()) == others
    assert upsert_files(changes.limit(0), table, path, ["k"], parts) == []


def test_replaced_keys(spark, table, path):
    ddl = "k string, v int, c string"
    first = [("a", 1, "x"), ("a", 2, "y"), ("b", 3, "x"), ("d", 4, "z"), (None, 5, "x")]
    replace_keys(spark.createDataFrame(first, ddl), spark.createDataFrame([], "k string"), table, path, ["k"], ["c"])
    untouched = set(read_table(spark, table).filter("c = 'z'").inputFiles())
    changed = spark.createDataFrame([("a",), ("e",), ("none",)], "k string")
    for _ in range(2):
        replace_keys(spark.createDataFrame([("a", 7, "x"), ("e", 8, "")], ddl), changed, table, path, ["k"], ["c"])
        want = [("a", 7, "x"), ("b", 3, "x"), ("d", 4, "z"), ("e", 8, None), (None, 5, "x")]
        assert rows(read_table(spark, table)) == sorted(want, key=repr)
        assert set(read_table(spark, table).filter("c = 'z'").inputFiles()) == untouched
    replace_keys(spark.createDataFrame([], ddl), spark.createDataFrame([("d",)], "k string"), table, path, ["k"], ["c"])
    assert read_table(spark, table).filter("k = 'd'").count() == 0


def test_the_fact_of_changed_orders_equals_the_whole_one(spark, tmp_path, table):
    base, paths = tmp_path / "bronze", {n: str(tmp_path / n) for n in ("silver", "gold", "whole", "rates", "consumers", "bad")}
    overwrite_table(spark.createDataFrame([("EUR", 2.0)], "ref_currency string, rate double"), f"{table}_rates", paths["rates"])
    overwrite_table(spark.createDataFrame([("a@shop.example", 7)], "emai_hash string, customer_id int"), f"{table}_people", paths["consumers"])
    land(base, "2024-01-05", [document(f"O{k}", 0, [entry(0, "P0")], site={"uid": f"{'de' if k % 2 else 'fr'}-shop"}) for k in range(4)])
    # O1 moves to another country with a later event, O2 gets another price, O4 is new
    land(base, "2024-01-06", [
        document("O1", 5000, [entry(0, "P0")], site={"uid": "it-shop"}),
        document("O2", 0, [entry(0, "P0")], site={"uid": "fr-shop"}, totalPrice=55.0),
        document("O4", 0, [entry(0, "P0")], site=None),
    ])
    tables = (table, f"{table}_rates", f"{table}_people")
    run_orders_silver(spark, str(base / "orders" / "2024-01-05"), paths["silver"], table, "2024-01-05")
    run_orders_fact(spark, *tables, paths["gold"], f"{table}_gold", "2024-01-06")
    run_orders_silver(spark, str(base / "orders" / "2024-01-06"), paths["silver"], table, "2024-01-06")
    run_orders_fact_changes(spark, *tables, paths["gold"], f"{table}_gold", "2024-01-06", "2024-01-06")
    run_orders_fact(spark, *tables, paths["whole"], f"{table}_whole", "2024-01-06")
    got, want = read_table(spark, f"{table}_gold"), read_table(spark, f"{table}_whole")
    assert rows(got.select(*sorted(got.columns))) == rows(want.select(*sorted(want.columns)))
    assert rows(got.select("order_number", "country_code", "total_price")) == sorted(
        [("O0", "fr", 100.0), ("O1", "it", 100.0), ("O2", "fr", 55.0), ("O3", "de", 100.0), ("O4", None, 100.0)], key=repr
    )


def test_lookup_join_may_refuse_repeated_keys(spark):
    left, right = spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "c string, n int")
    assert lookup_join(left, right, "k", "c").count() == 2
    with pytest.raises(ValueError, match="several rows"):
        lookup_join(left, right, "k", "c", unique_right=True)
    assert lookup_join(left, right.filter("n <> 2"), "k", "c", unique_right=True).count() == 1

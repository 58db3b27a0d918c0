import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlake.operators import columns
from orderlake.operators.aggregates import distinct_rows, distinct_values, joined_values
from orderlake.operators.joins import left_join, lookup_join
from orderlake.operators.latest import latest_rows
from orderlake.operators.nested import flatten, last_element, split_to_rows
from orderlake.operators.quality import (
    both_nonempty,
    cart_level,
    nonempty_or_null,
    require_present,
    split_missing,
)
from orderlake.operators.upsert import upsert


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


# --- columns -------------------------------------------------------------------------------


def test_rename_keeps_order_and_refuses_unknown_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert columns.rename(df, {"c": "a", "a": "c"}).columns == ["c", "b", "a"]
    assert tuple(columns.rename(df, {"c": "a", "a": "c"}).first()) == (1, 2, 3)
    with pytest.raises(ValueError, match="nope"):
        columns.rename(df, {"nope": "x"})


def test_clean_and_lower_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "`a b` int, `c/d` int, `e-f` int, `g(h)` int, `i.j` int")
    assert columns.clean_columns(df).columns == ["a_b", "c_d", "e_f", "g_h", "ij"]
    assert columns.lower_columns(df.toDF("A", "Bc", "d", "E", "F")).columns == list("a") + ["bc", "d", "e", "f"]
    clash = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="a_b"):
        columns.clean_columns(clash)


# --- quality -------------------------------------------------------------------------------


def test_split_missing_covers_all_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (None, None)], "k int, v string")
    good, bad = split_missing(df, ["k", "v"])
    assert rows(good) == [(1, "a")]
    assert good.count() + bad.count() == df.count()
    assert rows(require_present(df, ["k"])) == [(1, "a"), (3, None)]


def test_both_nonempty(spark):
    df = spark.range(3)
    empty = df.filter("id < 0")
    assert both_nonempty(df, df) == (df, df)
    assert both_nonempty(df, empty) is None
    assert both_nonempty(empty, df) is None


def test_promotion_predicates(spark):
    df = spark.createDataFrame(
        [("", "p"), ("", None), (None, "p"), (None, None), ("1", "p")], "e string, p string"
    )
    assert rows(df.filter(cart_level("e", "p"))) == sorted([("", "p"), ("", None), (None, "p")], key=repr)
    assert rows(df.filter(nonempty_or_null("e"))) == sorted(
        [(None, "p"), (None, None), ("1", "p")], key=repr
    )


# --- nested --------------------------------------------------------------------------------


def test_flatten_keeps_plain_types_and_order(spark):
    df = spark.sql(
        """select 1 as a, named_struct('x', 1, 'y', named_struct('z', 'deep')) as s,
                  array('p', 'q') as tags, map('k', 1) as m, date'2024-01-05' as d,
                  cast(1.5 as decimal(4, 2)) as amount, named_struct('w', 2) as t"""
    )
    flat = flatten(df)
    assert flat.columns == ["a", "tags", "m", "d", "amount", "s_x", "t_w", "s_y_z"]
    assert flat.first().s_y_z == "deep"


def test_flatten_outer_rows_and_product(spark):
    ddl = "id int, a array<struct<x: int>>, b array<struct<y: int>>, s struct<v: int>"
    df = spark.createDataFrame(
        [
            (1, [(1,), (2,)], [(3,), (4,), (5,)], (9,)),
            (2, None, [], None),
            (3, [(1,)], None, (8,)),
        ],
        ddl,
    )
    flat = flatten(df)
    assert flat.columns == ["id", "a_x", "b_y", "s_v"]
    assert [flat.filter(f"id = {i}").count() for i in (1, 2, 3)] == [6, 1, 1]
    assert rows(flat.filter("id = 2")) == [(2, None, None, None)]


def test_flatten_row_count_is_the_product_of_outer_sizes(spark):
    df = spark.range(30).select(
        "id",
        F.expr("transform(sequence(1, cast(id % 5 as int)), i -> struct(i as v))").alias("a"),
        F.expr("if(id % 4 = 0, null, transform(sequence(1, cast(id % 3 as int) + 1), i -> struct(i as v)))").alias("b"),
    )
    df = df.withColumn("a", F.when(F.col("id") % 5 != 0, F.col("a")))
    expected = df.selectExpr(
        "sum(greatest(coalesce(size(a), 1), 1) * greatest(coalesce(size(b), 1), 1)) as n"
    ).first().n
    assert flatten(df).count() == expected


def test_flatten_structs_in_arrays_and_arrays_of_arrays(spark):
    df = spark.createDataFrame(
        [(1, [(("p",), [("q1",), ("q2",)])], [[(1,), (2,)], [], [(3,)]])],
        "id int, a array<struct<s: struct<v: string>, l: array<struct<w: string>>>>,"
        " g array<array<struct<n: int>>>",
    )
    flat = flatten(df)
    assert set(flat.columns) == {"id", "a_s_v", "a_l_w", "g_n"}
    assert flat.count() == 2 * 4
    assert {r.g_n for r in flat.collect()} == {1, 2, 3, None}


def test_flatten_dotted_names_and_kept_columns(spark):
    df = spark.createDataFrame([((1,), [(2,)])], "`a.b` struct<`c.d`: int>, e array<struct<f: int>>")
    assert flatten(df).columns == ["a.b_c.d", "e_f"]
    assert flatten(df, keep=["e"]).columns == ["e", "a.b_c.d"]


def test_flatten_refuses_clashes(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b: int>")
    with pytest.raises(ValueError, match=r"a_b and a\.b"):
        flatten(df)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_last_element(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([([1],), ([1, 2, 3],), ([],), (None,)], "a array<int>")
        assert [r.v for r in df.select(last_element("a").alias("v")).collect()] == [1, 3, None, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_split_to_rows(spark):
    texts = [(0, None), (1, ""), (2, "1"), (3, "1|2"), (4, "1|"), (5, "1||2")]
    df = split_to_rows(spark.createDataFrame(texts, "i int, v string"), "v")
    assert rows(df) == sorted(
        [(0, None), (1, ""), (2, "1"), (3, "1"), (3, "2"), (4, "1"), (4, ""), (5, "1"), (5, ""), (5, "2")],
        key=repr,
    )


# --- joins ---------------------------------------------------------------------------------


def test_left_join_null_keys_and_fan_out(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, w string")
    assert rows(left_join(left, right, ["k"])) == sorted(
        [(1, "a", "x"), (1, "a", "y"), (None, "b", None), (3, "c", None)], key=repr
    )
    with pytest.raises(ValueError, match="several rows"):
        left_join(left, right, ["k"], unique_right=True)
    once = right.filter("w <> 'y'")
    assert left_join(left, once, ["k"], unique_right=True).count() == 3


def test_lookup_join_salted_equals_broadcast(spark):
    left = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 7 == 0, None).otherwise(
            (F.col("id") % 11).cast("string")).alias("code")
    )
    right = spark.createDataFrame(
        [("HOT", 1), ("HOT", 2), ("3", 3), (None, 4)], "ref string, rate int"
    )
    small = lookup_join(left, right, "code", "ref")
    salted = lookup_join(left.withColumn("m", F.create_map(F.lit("a"), "id")), right, "code", "ref", salts=4).drop("m")
    assert salted.columns == small.columns
    assert rows(salted) == rows(small)
    assert small.filter("code = 'HOT'").count() == 2 * left.filter("code = 'HOT'").count()


@pytest.fixture
def small_skew(spark):
    """Broadcasts off, and partitions count as skewed from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.files.maxPartitionBytes": "100k",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=40_000):
    return spark.range(0, n, 1, 8).selectExpr(
        "if(id % 10 < 9, 1, id) k", "id", "sha2(cast(id as string), 256) pad"
    )


def test_a_hot_key_is_split_beside_an_aggregated_side(spark, small_skew):
    left = hot(spark)
    right = left.groupBy("k").agg(F.count("*").alias("n"))
    joined = left_join(left, right, ["k"])
    assert "skew=true" in final_plan(joined)
    assert joined.filter("k = 1").agg(F.sum("n")).first()[0] == 36_000**2


def test_hot_keys_are_split_in_an_upsert(spark, small_skew):
    target = hot(spark).selectExpr("k", "id", "pad")
    source = spark.range(1, 20_000, 1, 4).selectExpr("id k", "-id id", "sha2(cast(id as string), 512) pad")
    result = upsert(target, source, ["k"])
    plan = final_plan(result)
    assert plan.count("skew=true") >= 1
    assert result.filter("k = 1").groupBy("id").count().collect() == [(-1, 36_000)]


# --- aggregates, latest --------------------------------------------------------------------


def test_collected_values(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None), (None, "z")], "k int, v string"
    )
    assert rows(distinct_values(df, ["k"], "v", "vs")) == sorted(
        [(1, ["a", "b"]), (2, []), (None, ["z"])], key=repr
    )
    assert rows(joined_values(df, ["k"], "v", "vs")) == sorted(
        [(1, "a|b|b"), (2, ""), (None, "z")], key=repr
    )


def test_joined_values_of_a_hot_group(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.concat(F.lit("v"), F.col("id") % 2).alias("v"),
    )
    hot = joined_values(df, ["k"], "v", "vs").filter("k = 0").first().vs.split("|")
    assert (len(hot), hot.count("v0"), hot.count("v1")) == (3000, 1500, 1500)


def test_distinct_rows_with_arrays(spark):
    df = spark.createDataFrame([(1, ["a"]), (1, ["a"]), (1, ["b"])], "k int, v array<string>")
    assert distinct_rows(df).count() == 2


def test_latest_rows_equal_the_ranked_ones(spark):
    df = spark.createDataFrame(
        [
            ("a", "2024-01-02 00:00:00", 1),
            ("a", "2024-01-02 00:00:00", 2),
            ("a", "2024-01-01 00:00:00", 3),
            ("a", None, 4),
            ("b", "", 5),
            ("b", None, 6),
            ("c", None, 7),
            ("c", None, 8),
            (None, "2024-01-01 00:00:00", 9),
            (None, "2023-01-01 00:00:00", 10),
        ],
        "k string, t string, i int",
    )
    df.createOrReplaceTempView("latest_input")
    ranked = spark.sql(
        "select k, t, i from (select *, rank() over (partition by k order by t desc) as r"
        " from latest_input) where r = 1"
    )
    assert rows(latest_rows(df, "k", "t")) == rows(ranked)
    assert {r.i for r in latest_rows(df, "k", "t").collect()} == {1, 2, 5, 7, 8, 9}


# --- upsert --------------------------------------------------------------------------------


def test_upsert_columns_and_nulls(spark):
    target = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t2")], "k int, v string, old string")
    source = spark.createDataFrame([(2, None, 7), (3, "c", 8)], "k int, v string, new int")
    once = upsert(target, source, ["k"])
    assert once.columns == ["k", "v", "old", "new"]
    assert rows(once) == [(1, "a", "t1", None), (2, None, "t2", 7), (3, "c", None, 8)]
    assert rows(upsert(once, source, ["k"])) == rows(once)


def test_upsert_takes_the_target_type(spark):
    target = spark.createDataFrame([(1, 1.5)], "k bigint, v double")
    source = spark.createDataFrame([(1, 2), (2, 3)], "k int, v int")
    result = upsert(target, source, ["k"])
    assert result.schema.simpleString() == "struct<k:bigint,v:double>"
    assert rows(result) == [(1, 2.0), (2, 3.0)]


def test_upsert_duplicate_source_keys(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    unmatched = spark.createDataFrame([(2, "x"), (2, "y"), (None, "n")], "k int, v string")
    assert rows(upsert(target, unmatched, ["k"])) == sorted(
        [(1, "a"), (2, "x"), (2, "y"), (None, "n")], key=repr
    )
    matched = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, matched, ["k"]).collect()
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(target, matched, ["k"]).select(F.count("k")).collect()


def test_upsert_against_brute_force(spark):
    target = {(i % 40, i % 3): (f"t{i}", i) for i in range(100)}
    source = {(i % 50, i % 3): (f"s{i}", None if i % 4 == 0 else i) for i in range(0, 120, 2)}
    ddl = "a int, b int, v string, n int"
    frame = lambda d: spark.createDataFrame([(*k, *v) for k, v in d.items()], ddl)
    expected = sorted([(*k, *v) for k, v in {**target, **source}.items()], key=repr)
    assert rows(upsert(frame(target), frame(source), ["a", "b"])) == expected

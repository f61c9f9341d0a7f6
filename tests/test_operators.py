import random

import pytest
from pyspark.sql import functions as F

from larder.functions.columns import bucket_of, event_instant, filled, try_bool, try_int, utc_date
from larder.operators import quality as q
from larder.operators.dedupe import distinct_rows, first_pair_per_key, first_per_key
from larder.operators.metrics import auc_by_rank, confusion
from larder.operators.ranking import ranked_lists, top_k
from larder.operators.running import running_totals
from larder.sources.storage import Scratch
from tests.conftest import plan_of, rows


def read_counter(spark, df):
    """An accumulator of the rows that were computed, and ``df`` with that count on the way."""
    read = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    return read, df.mapInArrow(run, df.schema)


def test_casts_give_null_instead_of_failing(spark):
    df = spark.createDataFrame(
        [("1", "t", None), (" 2 ", "0", "1.5"), ("x", "maybe", "x"), ("9999999999", "TRUE", "7")],
        "a string, b string, c string",
    )
    got = df.select(try_int("a"), try_bool("b"), filled("c", 0.0)).collect()
    assert [tuple(r) for r in got] == [(1, True, 0.0), (2, False, 1.5), (None, None, None), (None, True, 7.0)]


def test_bucket_is_a_non_negative_int(spark):
    df = spark.createDataFrame([(-7,), (205,), (None,)], "id long")
    out = df.select(bucket_of(F.col("id")).alias("b"))
    assert out.schema["b"].dataType.simpleString() == "int"
    assert [r["b"] for r in out.collect()] == [93, 5, None]


def test_event_time_and_its_utc_date(spark, settings):
    df = spark.createDataFrame([("2024-01-15T23:30:00Z",), ("bad",), (None,)], "t string")
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        settings(spark__sql__session__timeZone=zone)
        got = df.select(utc_date(event_instant("t")).cast("string").alias("d")).collect()
        assert [r["d"] for r in got] == ["2024-01-15", None, None]


def test_first_per_key_is_the_smallest_row_with_nulls_last(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 2, "z"), (1, 2, "b"), (None, 5, "n"), (None, 4, "m")],
        "k int, v int, w string",
    )
    assert rows(first_per_key(df, ["k"])) == [(1, 2, "b"), (None, 4, "m")]
    assert first_per_key(df.limit(0), ["k"]).isEmpty()


def test_packed_pairs_choose_as_whole_rows_do(spark):
    rng = random.Random(3)
    values = [None, -(2**31), -5, -1, 0, 1, 7, 2**31 - 1]
    data = [(rng.choice([None, 1, 2, 3]), rng.randint(1, 9), rng.choice(values), rng.choice([None, True, False])) for _ in range(400)]
    df = spark.createDataFrame(data, "a int, b int, n int, f boolean")
    packed = first_pair_per_key(df, ["a", "b"], "n", "f")
    assert rows(packed) == rows(first_per_key(df, ["a", "b"]))
    assert packed.dtypes == df.dtypes
    assert "SortAggregate" not in plan_of(packed) and "Sort [" not in plan_of(packed)


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    plan = plan_of(first_per_key(df, ["k"]))
    assert "Partial" in plan[plan.index("Exchange"):]
    top = plan_of(top_k(df, ["k"], [F.col("v")], 5))
    assert "Partial" in top[top.index("Exchange"):]


def test_distinct_rows(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, 2, 4)], "a int, b int, c int")
    assert rows(distinct_rows(df, ["a", "b"])) == [(1, 2)]


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_running_totals_equal_a_plain_loop(spark, bits):
    rng = random.Random(bits)
    # User 0 holds a third of all rows; orders repeat and have gaps.
    data = [(0 if i % 3 == 0 else rng.randint(1, 9), rng.randint(-5, 60), rng.randint(0, 9)) for i in range(900)]
    df = spark.createDataFrame(data, "u int, n int, v int")
    got = running_totals(df, ["u"], "n", {"v": F.col("v"), "c": F.lit(1)}, bits)
    expected = set()
    for u, n, _ in data:
        own = [(m, v) for w, m, v in data if w == u]
        upto = [v for m, v in own if m <= n]
        expected.add((u, n, sum(upto), len(upto), sum(v for _, v in own), len(own)))
    assert rows(got, "u", "n", "v_running", "c_running", "v_total", "c_total") == sorted(expected, key=repr)


def test_running_totals_compute_their_input_once(spark, settings):
    read, df = read_counter(spark, spark.range(5000).selectExpr("int(id % 7) AS u", "int(id) AS n", "id AS v"))
    got = running_totals(df, ["u"], "n", {"v": F.col("v")}, 4)
    assert len(got.collect()) == 5000 and read.value == 5000


def test_running_totals_keep_rows_without_a_user(spark):
    df = spark.createDataFrame([(None, 1, 5), (1, None, 2), (1, 1, 3)], "u int, n int, v int")
    got = running_totals(df, ["u"], "n", {"v": F.col("v")})
    assert got.count() == 3
    assert (1, 1, 3) in rows(got, "u", "n", "v_running")


def test_top_k_and_lists(spark):
    df = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.9), (1, 12, 0.5), (2, 13, 0.1)], "u int, p int, s double")
    best = top_k(df, ["u"], [F.col("s").desc(), F.col("p")], 2)
    lists = ranked_lists(best, ["u"], {"p": "products", "s": "scores"})
    assert rows(lists) == [(1, [11, 10], [0.9, 0.5]), (2, [13], [0.1])]


def test_auc_equals_pair_counting(spark):
    rng = random.Random(1)
    data = [(round(rng.random(), 1), int(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(data, "s double, y int")
    wins = [
        1.0 if a > b else 0.5 if a == b else 0.0
        for a, y in data if y == 1 for b, z in data if z == 0
    ]
    got = auc_by_rank(df, "s", "y").first()
    assert got["auc"] == round(sum(wins) / len(wins), 6)
    assert got["positives"] + got["negatives"] == 300


@pytest.mark.parametrize("range_scores", [1, 7, 65_536])
def test_auc_computes_its_input_once_at_any_number_of_ranges(spark, range_scores):
    data = [((i * 37 % 101) / 7, int(i % 5 == 0 or i % 101 > 70)) for i in range(600)]
    data += [(None, 1), (0.5, None), (float("nan"), 0)]
    read, df = read_counter(spark, spark.createDataFrame(data, "s double, y int"))
    got = auc_by_rank(df, "s", "y", range_scores).first()
    good = [(s, y) for s, y in data[:600]]
    wins = [1.0 if a > b else 0.5 if a == b else 0.0 for a, y in good if y for b, z in good if not z]
    assert got["auc"] == round(sum(wins) / len(wins), 6) and read.value == len(data)


def test_auc_and_f1_of_one_class_only(spark):
    df = spark.createDataFrame([(0.2, 0)], "s double, y int")
    assert tuple(auc_by_rank(df, "s", "y").first()) == (0, 1, None)
    assert tuple(confusion(df, "s", "y", 0.5).first()) == (0, 0, 0, 1, None)
    assert tuple(auc_by_rank(df.limit(0), "s", "y").first()) == (0, 0, None)


def test_confusion(spark):
    df = spark.createDataFrame([(0.9, 1), (0.9, 0), (0.1, 1), (0.1, 0), (0.5, 1)], "s double, y int")
    assert tuple(confusion(df, "s", "y", 0.5).first()) == (2, 1, 1, 1, round(4 / 6, 6))


def test_quality_rules_count_nulls_as_broken_unless_told(spark):
    df = spark.createDataFrame([(7, "prior"), (None, None), (3, "odd")], "dow int, eval_set string")
    got = q.count_broken(
        df,
        {
            "range": q.not_between("dow", 0, 6),
            "range, NULL passes": q.not_between("dow", 0, 6, null_passes=True),
            "low": q.below("dow", 4),
            "set": q.not_in("eval_set", ["prior"]),
            "null": q.not_null("dow"),
            "long": q.longer_than("eval_set", 4),
        },
    )
    assert {r["rule"]: r["violations"] for r in got.collect()} == {
        "range": 2, "range, NULL passes": 1, "low": 2, "set": 2, "null": 1, "long": 1,
    }


def test_column_sets(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert q.has_exactly(df, ["b", "a"]) and not q.has_exactly(df, ["a"])
    assert q.has_all(df, ["a"]) and not q.has_all(df, ["a", "c"])


def test_duplicates_and_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (9,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    assert rows(q.duplicate_keys(child, ["fk"])) == [(1, 2)]
    assert rows(q.orphan_keys(child, "fk", parent, "id")) == [(9, 1), (None, 1)]


def test_split_keeps_every_row_once(spark):
    df = spark.createDataFrame([(1, 1), (None, 1), (None, None)], "a int, b int")
    read, df = read_counter(spark, df)
    accepted, rejected = q.drop_null_keys(df, ["b", "a"], Scratch(spark))
    assert rows(accepted) == [(1, 1)]
    assert rows(rejected, "reason") == [("a is NULL",), ("b is NULL",)]
    assert read.value == 3


def test_reconcile_names_missing_tables(spark):
    source = spark.createDataFrame([("a", 3), ("b", 2)], "table_name string, n long")
    landed = spark.createDataFrame([("a", 3), ("c", 1)], "table_name string, n long")
    assert rows(q.reconcile(source, landed)) == [("a", 3, 3, 0), ("b", 2, 0, -2), ("c", 0, 1, 1)]

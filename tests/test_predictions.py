from pathlib import Path

import pytest

from checks.queries import Lake
from larder.operators.contract import Contract
from larder.plans import medallion, model
from larder.sources import tables as t
from larder.sources.storage import Scratch
from tests.conftest import plan_of, rows

GIVEN = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not GIVEN.exists(), reason="given tables not here")
def test_predictions_of_the_whole_run(spark):
    lake = Lake(spark, str(GIVEN))
    root = lake.land_orders()
    lake.land_catalog(complete=True)
    written = medallion.build_silver(spark, root)
    assert set(written) == {"orders", "order_products", "products", "order_products_train"}
    medallion.build_gold(spark, root)
    got = medallion.build_predictions(spark, root, k=3, rounds=3)
    assert 0 <= got["auc"] <= 1 and 0 <= got["f1"] <= 1
    predictions = t.read_table(
        spark, f"{root}/{t.GOLD_PREDICTIONS}", Contract.named("gold/predictions")
    )
    assert predictions.count() == got["users"] > 0
    assert predictions.filter("size(scores) > 3 OR size(scores) <> size(recommended_product_ids)").isEmpty()
    # The stored model scores as the one that was trained.
    loaded = model.load(spark, f"{root}/{t.GOLD_MODEL}")
    features = t.read_table(spark, f"{root}/{t.GOLD_FEATURES}", Contract.named("gold/user_product_features"))
    orders = medallion.silver_table(spark, root, "orders")
    again = model.recommend(model.score(loaded, model.candidates(features, orders, "test")), 3)
    assert rows(again) == rows(predictions.select(again.columns))


def test_training_set_labels_and_split(spark):
    orders = spark.createDataFrame(
        [(1, 5, "prior"), (2, 5, "train"), (3, 6, "prior"), (4, 6, "train"), (5, 7, "prior"), (6, 7, "test")],
        "order_id int, user_id int, eval_set string",
    )
    features = spark.createDataFrame([(5, 1), (5, 2), (6, 1), (7, 1)], "user_id int, product_id int")
    train = spark.createDataFrame([(2, 1), (2, 9), (4, 3)], "order_id int, product_id int")
    assert rows(model.training_set(features, orders, train)) == [
        (5, 1, 1, True), (5, 2, 0, True), (6, 1, 0, False),
    ]
    assert rows(model.candidates(features, orders, "test")) == [(7, 1)]


def test_names_become_rates_at_any_number_of_names(spark):
    schema = "aisle_name string, department_name string, label int, user_id int"
    for names in (1000, 1001):
        rows = [(f"a{i}", "d", i % 2, i) for i in range(names)] * 2 + [(None, "d", 1, None)]
        rates = model.name_rates(spark.createDataFrame(rows, schema))
        assert rates.filter("feature = 'aisle_name' AND fold IS NULL").count() == names
        asked = spark.createDataFrame([("a1", "d"), ("new", None)], "aisle_name string, department_name string")
        got = model.with_rates(asked, rates)
        overall = sum(r[2] for r in rows) / len(rows)
        by_name = {r["aisle_name"]: r for r in got.collect()}
        assert by_name["new"]["aisle_name_rate"] == by_name["new"]["department_name_rate"] == overall
        assert abs(by_name["a1"]["aisle_name_rate"] - (2 + 20 * overall) / 22) < 1e-12


def test_a_training_pair_does_not_see_its_own_label(spark):
    """Whatever the labels of a user are, the rates of the user's own pairs stay the same."""
    schema = "user_id int, product_id int, aisle_name string, department_name string, label int"

    def rates_of(label):
        rows = [(u, p, f"a{p % 3}", None if p == 4 else "d", label if u == 7 else (u + p) % 2) for u in range(1, 40) for p in range(6)]
        pairs = spark.createDataFrame(rows, schema)
        rated = model.with_rates(pairs, model.name_rates(pairs), in_training=True)
        assert rated.count() == len(rows)
        mine = rated.filter("user_id = 7").select("product_id", "aisle_name_rate", "department_name_rate")
        others = rated.filter("user_id = 12").select("product_id", "aisle_name_rate")
        return sorted(map(tuple, mine.collect())), sorted(map(tuple, others.collect()))

    (mine, others), (mine_now, others_now) = rates_of(0), rates_of(1)
    assert mine == mine_now and others != others_now


def test_rates_without_training_pairs(spark):
    schema = "user_id int, aisle_name string, department_name string, label int"
    empty = spark.createDataFrame([], schema)
    asked = spark.createDataFrame([(3, "a", None, 0)], schema)
    for in_training in (False, True):
        got = model.with_rates(asked, model.name_rates(empty), in_training).first()
        assert (got["aisle_name_rate"], got["department_name_rate"]) == (0.0, 0.0)


def test_a_failed_save_keeps_the_old_model(spark, tmp_path, monkeypatch):
    from larder.sources import versions
    from larder.sources.storage import Scratch

    schema = "user_id int, product_id int, aisle_name string, department_name string, label int, " + ", ".join(
        f"{c} double" for c in model.NUMERIC_FEATURES
    )
    rows_of = [(u, p, "a", "d", (u + p) % 2, *[float(u * p % 7 + k) for k in range(6)]) for u in range(12) for p in range(8)]
    pairs, path = spark.createDataFrame(rows_of, schema), str(tmp_path / "model")
    first = model.fit(pairs, Scratch(spark), rounds=1, depth=2)
    model.save(first, path)
    second = model.fit(pairs.withColumn("label", 1 - pairs["label"]), Scratch(spark), rounds=2, depth=2)
    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", lambda *a, **k: (_ for _ in ()).throw(OSError("no")))
        with pytest.raises(OSError):
            model.save(second, path)
    scores = [model.score(m, pairs).select("score").collect() for m in (first, model.load(spark, path), second)]
    assert scores[0] == scores[1] != scores[2]
    model.save(second, path)
    assert model.score(model.load(spark, path), pairs).select("score").collect() == scores[2]


def test_candidates_do_not_shuffle_the_pairs(spark, tmp_path, settings):
    """The ids of users are stored as bits, so small that the pairs stay where they are."""
    settings(spark__sql__autoBroadcastJoinThreshold="20k")
    ids = [-2**31, -65, -1, None, *range(0, 60_000, 3), 2**31 - 1]
    orders = spark.createDataFrame([(i, "test") for i in ids] + [(1, "prior"), (0, "test")], "user_id int, eval_set string")
    orders.write.parquet(str(tmp_path / "orders"))
    pairs = spark.range(-70, 60_000).selectExpr("cast(id as int) as user_id", "1 as product_id")
    edges = spark.createDataFrame([(-2**31, 2), (2**31 - 1, 2), (2**31 - 2, 2), (None, 2), (3, 2), (3, 2)], "user_id int, product_id int")
    pairs.union(edges).write.parquet(str(tmp_path / "pairs"))
    stored = [spark.read.parquet(str(tmp_path / n)) for n in ("pairs", "orders")]
    found = model.candidates(*stored, "test", Scratch(spark))
    assert "SortMergeJoin" not in plan_of(found) and "hashpartitioning" not in plan_of(found)
    plain = [(i, 1) for i in (-65, -1, *range(0, 60_000, 3))] + [(-2**31, 2), (2**31 - 1, 2), (3, 2), (3, 2)]
    assert rows(found) == rows(model.candidates(*stored, "test")) == sorted(plain, key=repr)


def test_trees_learn_from_all_pairs(spark, monkeypatch):
    """No hash picks the pairs, and a value that one pair in 40,000 has is among the split points."""
    pairs = spark.range(40_000, numPartitions=4).selectExpr(
        "cast(id % 100 as int) AS user_id", "cast(id as int) AS product_id", "'a' AS aisle_name", "'d' AS department_name",
        "cast(id % 6000 = 77 AND id < 36000 as int) AS label",
        *[f"cast(id = {6000 * k + 77} as double) AS {c}" for k, c in enumerate(model.NUMERIC_FEATURES)],
    )
    learned = []
    fit = model.Pipeline.fit
    monkeypatch.setattr(model.Pipeline, "fit", lambda self, rows: learned.append(rows) or fit(self, rows))
    fitted = model.fit(pairs, Scratch(spark), rounds=8)
    assert learned[0].count() == 40_000 and "xxhash64" not in plan_of(learned[0])
    scored = {r["product_id"]: r["score"] for r in model.score(fitted, pairs.filter("product_id % 6000 < 100")).collect()}
    rare = [scored.pop(6000 * k + 77) for k in range(6)]
    assert min(rare) > max(scored.values()) + 0.05


def test_cut_points_are_those_of_all_rows(spark):
    rows_of = [(float(k % 7), 1 / (1 + k), 3.0, float(k < 9000)) for k in range(10_000)] + [(None, float("nan"), 3.0, 5.0)]
    frame = spark.createDataFrame(rows_of, "few double, many double, one double, heavy double")
    got = model.cut_points(frame, frame.columns, Scratch(spark), bins=8, range_values=600)
    assert got == model.cut_points(frame, frame.columns, Scratch(spark), bins=8)
    assert got["few"] == [0.5, 1.5, 2.5, 3.5, 4.5, 5.5] and got["one"] == [] and got["heavy"] == [0.5, 3.0]
    values = sorted(r[1] for r in rows_of[:-1])
    assert got["many"] == [values[k - 1] / 2 + values[k] / 2 for k in range(1250, 10_000, 1250)]
    assert model.cut_points(frame.limit(0), ["few"], Scratch(spark)) == {"few": []}

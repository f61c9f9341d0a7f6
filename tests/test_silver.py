import gzip
import json

import pytest

from larder.operators.contract import Contract, ContractViolation
from larder.plans import landing, medallion, silver
from larder.sources import tables as t
from larder.sources.storage import Scratch
from tests.conftest import rows

ORDERS = "order_id string, user_id string, eval_set string, order_number string, order_dow string, " \
    "order_hour_of_day string, days_since_prior_order string"


def test_silver_columns_and_rules_are_the_contracts(spark):
    """Another contract gives another table; no second copy of its rules is in the jobs."""
    body = {
        "name": "x",
        "fields": [
            {"name": "id", "type": "long"},
            {"name": "twice", "type": "integer"},
            {"name": "day", "type": "date"},
            {"name": "text", "type": "string"},
        ],
        "transformations": [{"field": "text", "rule": "upper(trim(text))"}, {"field": "twice", "rule": "id * 2"}],
    }
    contract = Contract.from_dict(body)
    raw = spark.createDataFrame([("7", " a", "2024-01-02", 1), ("x", None, "soon", 2)], "ID string, text string, day string, more int")
    typed = contract.typed(raw)
    assert typed.dtypes == [("id", "bigint"), ("day", "date"), ("text", "string")]
    whole = contract.with_added(typed)
    assert whole.dtypes == [("id", "bigint"), ("twice", "int"), ("day", "date"), ("text", "string")]
    assert [tuple(map(str, r)) for r in whole.orderBy("id").collect()] == [
        ("None", "None", "None", "None"), ("7", "14", "2024-01-02", "A"),
    ]
    orders = Contract.named("silver/orders")
    assert silver.clean_orders(spark.createDataFrame([], ORDERS)).columns == [f.name for f in orders.fields]


def test_clean_orders(spark):
    bronze = spark.createDataFrame(
        [
            ("510", "41", "prior", "1", "5", "19", None),
            ("510", "41", "prior", "1", "5", "19", None),
            ("511", "-41", "train", "6", "1", "22", "9.5"),
            ("512", "41", "prior", "2", "6", "0", "soon"),
            ("five", "8", "test", "4", "0", "11", "12"),
            ("9999999999", "8", "test", "4", "0", "11", "13"),
        ],
        ORDERS,
    )
    got = silver.clean_orders(bronze)
    assert rows(got) == [
        (510, 41, "prior", 1, 5, 19, 0.0, 41),
        (511, -41, "train", 6, 1, 22, 9.5, 59),
        (512, 41, "prior", 2, 6, 0, None, 41),
        (None, 8, "test", 4, 0, 11, 12.0, 8),
    ]
    contract = Contract.named("silver/orders")
    assert [f.dataType for f in got.schema] == [f.dataType for f in contract.schema()]
    # Gaps that cannot be read are reported, not taken for a first order.
    assert [(v.field, v.violations) for v in contract.check(got)] == [("order_id", 1), ("days_since_prior_order", 1)]


def test_clean_lines_take_both_spellings(spark):
    bronze = spark.createDataFrame(
        [("1", "5", "2", "1"), ("1", "5", "1", "false"), ("2", "5", "1", "true"), ("3", "5", "1", "?")],
        "order_id string, product_id string, add_to_cart_order string, reordered string",
    )
    assert rows(silver.clean_order_products(bronze)) == [
        (1, 5, 1, False, 1),
        (2, 5, 1, True, 2),
        (3, 5, 1, None, 3),
    ]


def test_products_keep_unknown_aisles_and_break_the_contract(spark):
    products = spark.createDataFrame(
        [("1", "Salt", "1", "1"), ("1", "Salt", "1", "1"), ("2", "Tea", "99", "1"), ("3", "Ice", None, "1")],
        "product_id string, product_name string, aisle_id string, department_id string",
    )
    aisles = spark.createDataFrame([("1", "spices"), ("1", "spices"), (None, "none")], "aisle_id string, aisle string")
    departments = spark.createDataFrame([("1", "pantry")], "department_id string, department string")
    got = silver.build_products(products, aisles, departments)
    assert rows(got) == [
        (1, "Salt", 1, "spices", 1, "pantry"),
        (2, "Tea", 99, None, 1, "pantry"),
        (3, "Ice", None, None, 1, "pantry"),
    ]
    broken = Contract.named("silver/products").check(got)
    assert {(v.field, v.violations) for v in broken} == {("aisle_id", 1), ("aisle_name", 2)}


def test_files_with_differing_headers_are_read_by_name(spark, tmp_path):
    contract = Contract.named("bronze/order_products")
    (tmp_path / "a.csv").write_text("order_id,product_id,add_to_cart_order,reordered\n1,5,2,0\n")
    (tmp_path / "b.csv").write_text("product_id,reordered,order_id,add_to_cart_order,note\n6,1,3,4,\"x\ny\"\n")
    with gzip.open(tmp_path / "c.csv.gz", "wt") as f:
        f.write("PRODUCT_ID,order_id,reordered,add_to_cart_order\n7,8,0,1\n")
    (tmp_path / "d.csv").write_text("")
    got = t.read_csv(spark, str(tmp_path), contract)
    assert rows(got) == [("1", "5", "2", "0"), ("3", "6", "4", "1"), ("8", "7", "1", "0")]


def test_a_large_plain_file_is_read_by_several_tasks(spark, tmp_path, settings):
    contract = Contract.named("bronze/order_products")
    settings(spark__sql__files__maxPartitionBytes="20000", spark__sql__files__openCostInBytes="0")
    lines = [f'{i},{i % 7},"{i % 3}",0' for i in range(20_000)]
    head = "order_id,product_id,add_to_cart_order,reordered\n"
    for name, more in {"plain": "", "spans lines": '"9\n",1,1,1\n'}.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "a b.csv").write_text(head + more + "\n".join(lines) + "\n")
        (folder / "small.csv").write_text("product_id,order_id,add_to_cart_order,reordered\n5,-1,1,\"\"\n")
        got = t.read_csv(spark, str(folder), contract)
        assert got.count() == 20_001 + (more != "")
        assert got.filter("order_id = '-1'").collect()[0]["product_id"] == "5"
        assert rows(got.filter("order_id = '7'")) == [("7", "0", "1", "0")]
        assert (got.rdd.getNumPartitions() > 5) == (name == "plain")


def test_first_lines_are_read_in_tasks_and_not_the_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for i in range(7):
        (tmp_path / f"{i}.csv").write_text(f"a,b{i % 2}\n" + "1,2\n" * 50_000)
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("b0,a\n" + "1,2\n" * 50_000)
    heads = t.file_heads(spark, str(tmp_path))
    assert [h.line for h in heads] == ["a,b0", "a,b1"] * 3 + ["a,b0", "b0,a"]
    assert [h.is_compressed for h in heads] == [False] * 7 + [True]
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_csv_by_name_by_position_and_with_extra_columns(spark, tmp_path):
    contract = Contract.named("bronze/orders")
    folder = tmp_path / "named"
    folder.mkdir()
    with gzip.open(folder / "a.csv.gz", "wt") as f:
        f.write("USER_ID,order_id,eval_set,order_number,order_dow,order_hour_of_day,load_ts\n7,1,prior,1,2,8,now\n")
    got = t.read_csv(spark, str(folder), contract)
    assert rows(got) == [("1", "7", "prior", "1", "2", "8", None)]
    plain = tmp_path / "plain"
    plain.mkdir()
    (plain / "a.csv").write_text("1,7,prior,1,2,8,,now\n2,7,prior,2,2,8,3.0,now\n")
    got = t.read_csv(spark, str(plain), contract, header=False, spread=3)
    assert rows(got) == [("1", "7", "prior", "1", "2", "8", None), ("2", "7", "prior", "2", "2", "8", "3.0")]
    assert got.rdd.getNumPartitions() == 3


def test_json_in_dated_folders_with_quoted_and_plain_ids(spark, tmp_path):
    for i, (folder, body) in enumerate(
        [
            ("product/2024/01/15", {"product_id": "1", "product_name": "Salt", "aisle_id": "2", "department_id": "3"}),
            ("type=product/year=2024", {"product_id": 2, "product_name": "Tea", "aisle_id": 2, "department_id": 3}),
        ]
    ):
        d = tmp_path / "bronze/api" / folder
        d.mkdir(parents=True)
        (d / f"{i}.json").write_text(json.dumps({**body, "type": "product"}))
    got = t.read_bronze_products(spark, str(tmp_path))
    assert rows(got, "product_id", "aisle_id") == [("1", "2"), ("2", "2")]


def test_optional_source_hides_only_a_missing_path(spark, tmp_path):
    assert t.read_bronze_order_products_train(spark, str(tmp_path)) is None
    folder = tmp_path / t.BRONZE_ORDER_PRODUCTS_TRAIN
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("other\n1\n")
    with pytest.raises(Exception) as caught:
        t.read_bronze_order_products_train(spark, str(tmp_path)).select("order_id").collect()
    assert "order_id" in str(caught.value)


def orders(spark, n, number=1):
    return spark.range(n).selectExpr(
        "int(id) AS order_id", "int(id % 5) AS user_id", "'prior' AS eval_set", f"{number} AS order_number",
        "0 AS order_dow", "0 AS order_hour_of_day", "0.0D AS days_since_prior_order", "int(id % 5) AS user_id_bucket",
    )


def test_checked_write_replaces_only_with_good_rows(spark, tmp_path):
    contract, path = Contract.named("silver/orders"), str(tmp_path / "silver/orders")
    assert t.write_checked(orders(spark, 20), path, contract) == 20
    with pytest.raises(ContractViolation) as caught:
        t.write_checked(orders(spark, 30, number=0), path, contract)
    assert [(v.field, v.violations) for v in caught.value.broken] == [("order_number", 30)]
    assert t.read_table(spark, path, contract).count() == 20
    with pytest.raises(ContractViolation):
        t.write_checked(orders(spark, 3).drop("user_id"), path, contract)
    assert t.write_checked(t.read_table(spark, path, contract), path, contract) == 20
    assert [p.name for p in (tmp_path / "silver").iterdir()] == ["orders"]
    assert t.write_checked(orders(spark, 0), path, contract) == 0


def test_checked_write_of_some_buckets(spark, tmp_path):
    contract, path = Contract.named("silver/orders"), str(tmp_path / "silver/orders")
    t.write_checked(orders(spark, 20), path, contract)
    some = orders(spark, 40).filter("user_id = 1")
    assert t.write_checked(some, path, contract, only_touched_partitions=True) == 8
    assert t.read_table(spark, path, contract).count() == 16 + 8
    with pytest.raises(ContractViolation):
        t.write_checked(orders(spark, 40, number=0), path, contract, only_touched_partitions=True)
    assert t.read_table(spark, path, contract).count() == 16 + 8


def test_partition_overwrite_can_keep_other_buckets(spark, tmp_path):
    path = str(tmp_path / "o")
    assert t.write_table(orders(spark, 20), path, ["user_id_bucket"]) == 20
    t.write_table(orders(spark, 20).filter("user_id = 1").limit(1), path, ["user_id_bucket"], True)
    back = t.read_stored(spark, path)
    assert back.count() == 17
    assert dict(back.dtypes)["user_id_bucket"] == "int"


def test_one_id_reads_one_bucket(spark, tmp_path):
    path = str(tmp_path / "o")
    t.write_table(orders(spark, 20), path, ["user_id_bucket"])
    one = t.read_table(spark, path, Contract.named("silver/orders")).filter(t.in_bucket("user_id", "user_id_bucket", 3))
    assert one.count() == 4
    assert len(one.inputFiles()) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(user_id_bucket" in plan and "= 3)]" in plan.split("PartitionFilters")[1]


def test_seed_skips_a_populated_table(spark, tmp_path):
    path = str(tmp_path / "seeded")
    assert not landing.is_populated(spark, path)
    spark.range(0).write.parquet(path)
    assert not landing.is_populated(spark, path)
    assert landing.seed_table(spark.range(3), path)
    assert not landing.seed_table(spark.range(9), path)
    assert t.read_stored(spark, path).count() == 3
    assert landing.seed_table(spark.range(9), path, force=True)
    assert t.read_stored(spark, path).count() == 9


def test_whole_run_on_hand_made_files(spark, tmp_path, caplog):
    root = str(tmp_path)
    public = tmp_path / "bronze/historical/public"
    (public / "orders").mkdir(parents=True)
    (public / "order_products").mkdir()
    (public / "orders/a.csv").write_text(
        "order_id,user_id,eval_set,order_number,order_dow,order_hour_of_day,days_since_prior_order\n"
        "71,1,prior,1,4,18,\n72,1,prior,2,5,20,6.5\n73,1,train,3,1,9,4.0\n74,3,prior,1,0,13,\n74,3,prior,1,0,13,\n"
    )
    (public / "order_products/a.csv").write_text(
        "order_id,product_id,add_to_cart_order,reordered\n71,5,1,0\n72,5,3,1\n72,6,1,0\n74,5,1,0\n"
    )
    for kind, bodies in {
        "product": [{"product_id": str(i), "product_name": f"p{i}", "aisle_id": "1", "department_id": "1"} for i in (5, 6)],
        "aisle": [{"aisle_id": "1", "aisle": "cheese"}],
        "department": [{"department_id": "1", "department": "dairy"}],
    }.items():
        d = tmp_path / f"bronze/api/{kind}/2024/01/15"
        d.mkdir(parents=True)
        for i, body in enumerate(bodies):
            (d / f"{i}.json").write_text(json.dumps({**body, "type": kind}))
    with caplog.at_level("INFO", "larder"):
        written = medallion.build_silver(spark, root)
    assert written == {"orders": 4, "order_products": 4, "products": 2}
    assert "orders: 5 rows read, 4 rows written" in caplog.text
    assert "products: 2, 1, 1 rows read, 2 rows written" in caplog.text
    assert "order_products_train: no source, skipped" in caplog.text
    assert medallion.build_gold(spark, root) == 3
    got = t.read_table(spark, f"{root}/{t.GOLD_FEATURES}", Contract.named("gold/user_product_features"))
    assert rows(got.drop("aisle_name", "department_name")) == [
        (1, 5, 2, 0.5, 2.0, 4.0, 2, 3, 1),
        (1, 6, 1, 0.0, 1.0, 4.0, 2, 1, 1),
        (3, 5, 1, 0.0, 1.0, 0.0, 1, 3, 3),
    ]
    # A bad aisle stops the run at the product table and leaves the old one in place.
    (tmp_path / "bronze/api/product/2024/01/15/9.json").write_text(
        json.dumps({"product_id": "7", "product_name": "p7", "aisle_id": "99", "department_id": "1", "type": "product"})
    )
    with pytest.raises(ContractViolation):
        medallion.build_silver(spark, root)
    assert medallion.silver_table(spark, root, "products").count() == 2


def test_rows_without_keys_are_set_aside(spark, tmp_path):
    bronze = spark.createDataFrame(
        [("1", "5", "1", "0"), ("x", "6", "1", "0"), ("x", "7", "1", "0"), (None, "y", "2", "1"), ("2", "6", "1", "0")],
        "order_id string, product_id string, add_to_cart_order string, reordered string",
    )
    contract, path = Contract.named("silver/order_products"), str(tmp_path / "lines")
    with pytest.raises(ContractViolation):
        medallion.clean_and_write("order_products", [bronze], silver.clean_order_products, path, contract)
    aside = str(tmp_path / "rejected")
    written = medallion.clean_and_write("order_products", [bronze], silver.clean_order_products, path, contract, aside)
    assert written == 2
    assert rows(t.read_stored(spark, f"{aside}/order_products"), "order_id", "product_id", "reason") == [
        ("x", "6", "order_id is no id"),
        ("x", "7", "order_id is no id"),
        (None, "y", "order_id is no id, product_id is no id"),
    ]


def test_a_run_without_products_writes_an_empty_table(spark, tmp_path):
    text = "product_id string, product_name string, aisle_id string, department_id string"
    products = spark.createDataFrame([("1", "Salt", "1", "1")], text).filter("product_id > '5'")
    aisles = spark.createDataFrame([("1", "spices")], "aisle_id string, aisle string")
    departments = spark.createDataFrame([("1", "pantry")], "department_id string, department string")
    contract, path = Contract.named("silver/products"), str(tmp_path / "products")
    sources = [products, aisles, departments]
    assert medallion.clean_and_write("products", sources, silver.build_products, path, contract) == 0
    assert t.read_table(spark, path, contract).count() == 0


def test_scratch_lives_in_the_shared_folder(spark):
    scratch = Scratch(spark)
    assert scratch.root.startswith(spark.conf.get("spark.checkpoint.dir"))
    staged = scratch.stage(spark.range(3), "x")
    assert staged.count() == 3
    scratch.remove()

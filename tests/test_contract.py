import pytest
from pyspark.sql import functions as F

from larder.operators.contract import Contract, ContractViolation

SHELVES = {
    "name": "shelves",
    "fields": [
        {"name": "shelf", "type": "integer", "nullable": False},
        {"name": "goods", "type": "string", "nullable": False},
        {"name": "load_kg", "type": "double", "min_value": 2, "max_value": 640},
    ],
}
SHELF_COLUMNS = "shelf int, goods string, load_kg double"
GOOD = [(11, "flour", 2.0), (12, "rice", 640.0), (40, "empty jars", None)]


def contract(*fields, name="t"):
    return Contract.from_dict({"name": name, "fields": list(fields)})


def messages(c, df):
    ok, errors = c.validate(df)
    assert ok == (not errors)
    return errors


def test_a_table_that_keeps_its_contract(spark):
    df = spark.createDataFrame(GOOD, SHELF_COLUMNS)
    assert messages(Contract.from_dict(SHELVES), df) == []
    Contract.from_dict(SHELVES).require(df)


def test_missing_required_and_optional_columns(spark):
    df = spark.createDataFrame([(11, "left")], "shelf int, side string")
    errors = messages(Contract.from_dict(SHELVES), df)
    assert len(errors) == 1 and "Missing required field" in errors[0] and "goods" in errors[0]


def test_wrong_type_is_reported_once_and_not_compared(spark):
    c = contract({"name": "aisle", "type": "integer", "nullable": False, "min_value": 3})
    for kind, value in (("string", "A7"), ("long", 1), ("double", 0.5)):
        errors = messages(c, spark.createDataFrame([(value,)], f"aisle {kind}"))
        assert len(errors) == 1 and "has type" in errors[0] and "expected integer" in errors[0]


def test_each_rule_counts_its_own_rows(spark):
    df = spark.createDataFrame(
        [
            (None, "chilled", 1.5),
            (None, "frozen", 2.0),
            (7, "warm", 640.5),
            (8, "wet", 9000.0),
            (9, None, None),
            (10, "dry", -3.0),
            (13, "hot", 700.0),
        ],
        "shelf int, climate string, load_kg double",
    )
    c = contract(
        {"name": "shelf", "type": "integer", "nullable": False},
        {"name": "climate", "type": "string", "allowed_values": ["dry", "chilled", "frozen"]},
        {"name": "load_kg", "type": "double", "min_value": 2, "max_value": 640},
    )
    assert {(v.field, v.rule): v.violations for v in c.check(df)} == {
        ("shelf", "not_null"): 2,
        ("climate", "allowed_values"): 3,
        ("load_kg", "min_value"): 2,
        ("load_kg", "max_value"): 3,
    }
    text = "\n".join(messages(c, df))
    for part in ("NULL values", "NOT NULL", "below minimum", "above maximum", "not in allowed values"):
        assert part in text


def test_names_match_in_any_case_and_quotes_are_literal(spark):
    df = spark.createDataFrame([("baker's",), ("other",)], "KIND string")
    c = contract({"name": "kind", "type": "string", "allowed_values": ["baker's"]})
    assert len(messages(c, df)) == 1
    assert "not in allowed values" in messages(c, df)[0]


def test_all_rules_take_one_job(spark):
    df = spark.createDataFrame(GOOD, SHELF_COLUMNS)
    spark.sparkContext.setJobGroup("contract", "one aggregate")
    Contract.from_dict(SHELVES).check(df)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("contract")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Adaptive execution submits the shuffle of the single aggregate as its own job.
    assert len(jobs) <= 2


def test_violations_carry_what_was_broken(spark):
    df = spark.createDataFrame([(None, "salt", 5.0)], SHELF_COLUMNS)
    c = Contract.from_dict(SHELVES)
    with pytest.raises(ContractViolation) as caught:
        c.require(df)
    assert [(v.field, v.rule, v.violations) for v in caught.value.broken] == [("shelf", "not_null", 1)]
    assert [r["field"] for r in c.violations(df).collect()] == ["shelf"]


def test_empty_table_breaks_only_schema_rules(spark):
    c = Contract.from_dict(SHELVES)
    assert messages(c, spark.createDataFrame([], SHELF_COLUMNS)) == []
    assert len(messages(c, spark.createDataFrame([], "shelf int, load_kg double"))) == 1


def test_row_reasons_and_derived_columns(spark):
    c = Contract.named("silver/orders")
    df = spark.createDataFrame(
        [(1, -7, "prior", 1, 0, 0, None), (2, 5, "other", 0, 0, 0, 1.0)],
        "order_id int, user_id int, eval_set string, order_number int, order_dow int, "
        "order_hour_of_day int, days_since_prior_order double",
    )
    derived = c.apply_derived(df)
    assert [tuple(r) for r in derived.select("days_since_prior_order", "user_id_bucket").collect()] == [
        (0.0, 93),
        (1.0, 5),
    ]
    assert [r["reason"] for r in c.with_reason(df).collect()] == [
        "days_since_prior_order:not_null",
        "eval_set:allowed_values",
    ]
    assert c.fill_defaults(df).filter(F.col("days_since_prior_order").isNull()).isEmpty()


@pytest.mark.parametrize(
    "body",
    [
        None,
        {"fields": []},
        {"name": "x"},
        {"name": "x", "fields": {}},
        {"name": "x", "fields": [{"name": "a"}]},
        {"name": "x", "fields": [{"name": "a", "type": "unknown_type"}]},
    ],
)
def test_incomplete_contracts_are_refused(body):
    with pytest.raises(ValueError):
        Contract.from_dict(body)


def test_contract_files(tmp_path):
    with pytest.raises(FileNotFoundError):
        Contract.load(tmp_path / "none.yml")
    file = tmp_path / "c.yml"
    file.write_text("name: n\nfields:\n  - {name: a, type: Bool}\n  - {name: b, type: long, nullable: false}\n")
    schema = Contract.load(file).schema()
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in schema] == [
        ("a", "boolean", True),
        ("b", "bigint", False),
    ]


def test_every_shipped_contract_loads():
    for name in (
        "bronze/orders bronze/order_products bronze/products bronze/aisles bronze/departments "
        "bronze/stream silver/orders silver/order_products silver/products silver/stream_events "
        "gold/user_product_features gold/predictions"
    ).split():
        assert Contract.named(name).fields

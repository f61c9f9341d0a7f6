"""Every query over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.driver_tables import DriverTables
from larder.operators import quality as q
from larder.operators.contract import Contract
from larder.operators.dedupe import distinct_rows
from larder.operators.metrics import auc_by_rank, confusion
from larder.operators.ranking import ranked_lists, top_k
from larder.plans import gold, landing, medallion, model, silver
from larder.sources import tables as t
from larder.sources.storage import Scratch
from larder.streaming import catalog_events, order_events

# Fixed arrival and load time, so that results can be repeated.
ARRIVAL = "2024-01-15 10:30:00"


def arrival():
    return F.lit(ARRIVAL).cast("timestamp")


class Lake:
    """Bronze and Silver frames over one folder of given tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.scratch = Scratch(spark)
        self.given = DriverTables(spark, folder, self.scratch)

    def orders(self) -> DataFrame:
        return silver.clean_orders(self.given.bronze_orders())

    def lines(self) -> DataFrame:
        return silver.clean_order_products(self.given.bronze_order_products("prior"))

    def train_lines(self) -> DataFrame:
        return silver.clean_order_products(self.given.bronze_order_products("train"))

    def products(self, complete: bool = True) -> DataFrame:
        g = self.given
        return silver.build_products(
            g.bronze_products(), g.bronze_aisles(complete), g.bronze_departments()
        )

    def features(self) -> DataFrame:
        lines = self.lines()
        orders = self.stored_orders()
        return gold.user_product_features(orders, lines, self.products(), self.scratch)

    def stored_orders(self) -> DataFrame:
        """Silver orders as a stored table: they are read several times."""
        return self.given.once("silver_orders", self.orders)

    def training_set(self) -> DataFrame:
        lines = self.lines()
        orders = self.stored_orders()
        pairs = gold.user_product_stats(orders, lines)
        return model.training_set(pairs, orders, self.train_lines())

    def land_orders(self) -> str:
        """Write the historical Bronze folders as the full load would; the root."""
        g, root = self.given, self.scratch.root
        public = f"{root}/bronze/historical/public"
        loads = {"order_products": g.bronze_order_products("prior"), "orders": g.bronze_orders()}
        landing.land_full_load(loads, public, arrival())
        self.land_train_lines(root)
        return root

    def land_train_lines(self, root: str) -> None:
        lines = {"order_products_train": self.given.bronze_order_products("train")}
        landing.land_full_load(lines, f"{root}/bronze/historical/manual", arrival())

    def land_catalog(self, complete: bool = True) -> str:
        """Write the catalog folders as the event landing would; the root."""
        g, root = self.given, self.scratch.root
        for name, rows in {
            "product": g.bronze_products(),
            "aisle": g.bronze_aisles(complete),
            "department": g.bronze_departments(),
        }.items():
            bodies = landing.catalog_records(rows, name)
            bodies.write.text(f"{root}/bronze/api/{name}/2024/01/15")
        return root


def _rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


# ---- Silver -----------------------------------------------------------------


def orders_clean(spark, folder):
    return Lake(spark, folder).orders()


def order_products_clean(spark, folder):
    return Lake(spark, folder).lines()


def products_wide(spark, folder):
    return Lake(spark, folder).products()


def train_labels_clean(spark, folder):
    return Lake(spark, folder).train_lines()


def products_distinct(spark, folder):
    lake = Lake(spark, folder)
    path = lake.scratch.path("products")
    t.write_table(lake.products(), path)
    back = t.read_stored(spark, path)
    return distinct_rows(back, back.columns)


def eval_set_split(spark, folder):
    orders = Lake(spark, folder).orders()
    return orders.groupBy("eval_set").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("days_since_prior_order").alias("days"),
    )


# ---- sources and sinks ------------------------------------------------------


def orders_roundtrip(spark, folder):
    lake = Lake(spark, folder)
    root = lake.scratch.root
    landing.land_full_load(
        {"orders": lake.given.bronze_orders()}, f"{root}/bronze/historical/public", arrival()
    )
    contract = Contract.named("silver/orders")
    path = f"{root}/{t.SILVER_ORDERS}"
    t.write_checked(silver.clean_orders(t.read_bronze_orders(spark, root)), path, contract)
    return t.read_table(spark, path, contract)


def lines_roundtrip(spark, folder):
    lake = Lake(spark, folder)
    root = lake.scratch.root
    landing.land_full_load(
        {"order_products": lake.given.bronze_order_products("prior")},
        f"{root}/bronze/historical/public",
        arrival(),
    )
    contract = Contract.named("silver/order_products")
    path = f"{root}/{t.SILVER_ORDER_PRODUCTS}"
    cleaned = silver.clean_order_products(t.read_bronze_order_products(spark, root))
    t.write_checked(cleaned, path, contract)
    return t.read_table(spark, path, contract)


def catalog_json_scan(spark, folder):
    root = Lake(spark, folder).land_catalog()
    return silver.build_products(
        t.read_bronze_products(spark, root),
        t.read_bronze_aisles(spark, root),
        t.read_bronze_departments(spark, root),
    )


def orders_per_bucket(spark, folder):
    lake = Lake(spark, folder)
    path = lake.scratch.path("orders")
    t.write_table(lake.orders(), path, ["user_id_bucket"])
    stored = t.read_table(spark, path, Contract.named("silver/orders"))
    return stored.groupBy("user_id_bucket").agg(
        F.count(F.lit(1)).alias("orders"), F.max("order_number").alias("last_order_number")
    )


def optional_source_missing(spark, folder):
    lake = Lake(spark, folder)
    there, gone = lake.scratch.path("there"), lake.scratch.path("gone")
    lake.land_train_lines(there)
    found = t.read_bronze_order_products_train(spark, there)
    missing = t.read_bronze_order_products_train(spark, gone)
    counted = landing.table_counts({"there": found})
    skipped = _rows(spark, [("gone", 0)] if missing is None else [], "table_name string, n long")
    return counted.unionAll(skipped)


def landing_reconciliation(spark, folder):
    lake = Lake(spark, folder)
    sources = {
        "order_products": lake.given.bronze_order_products("prior"),
        "orders": lake.given.bronze_orders(),
    }
    public = lake.scratch.path("public")
    written = landing.land_full_load(sources, public, arrival())
    return landing.reconcile_load(spark, written, public)


def csv_of_two_headers(spark, folder):
    """Orders from two sets of files whose columns stand in another order."""
    lake = Lake(spark, folder)
    bronze, place = lake.given.bronze_orders(), lake.scratch.path("mixed")
    even = F.col("order_id").cast("int") % 2 == 0
    back = [c for c in reversed(bronze.columns)]
    for part in (bronze.filter(even), bronze.filter(~even).select(*back)):
        part.write.mode("append").option("header", True).option("compression", "gzip").csv(place)
    return silver.clean_orders(t.read_csv(spark, place, Contract.named("bronze/orders")))


def orders_incremental(spark, folder):
    """Buckets of later users are written first as they were, then replaced by themselves with new rows."""
    lake, contract = Lake(spark, folder), Contract.named("silver/orders")
    path, orders = lake.scratch.path("incremental"), lake.stored_orders()
    late = F.col("user_id_bucket") >= 50
    t.write_checked(orders.filter(~late | (F.col("order_number") == 1)), path, contract)
    t.write_checked(orders.filter(late), path, contract, only_touched_partitions=True)
    return t.read_table(spark, path, contract)


def seed_load_skip_force(spark, folder):
    lake = Lake(spark, folder)
    files, target = lake.scratch.path("files"), lake.scratch.path("seeded")
    landing.land_full_load({"orders": lake.given.bronze_orders()}, files, arrival())
    seed = t.read_csv(spark, f"{files}/orders", Contract.named("bronze/orders"))
    steps = []
    for step, (rows, force) in enumerate(
        [(seed, False), (lake.orders(), False), (lake.orders(), True)], start=1
    ):
        loaded = landing.seed_table(rows, target, force)
        steps.append((step, loaded, t.read_stored(spark, target).count()))
    return _rows(spark, steps, "step int, loaded boolean, n long")


def medallion_features(spark, folder):
    lake = Lake(spark, folder)
    root = lake.land_orders()
    lake.land_catalog()
    medallion.build_silver(spark, root)
    medallion.build_gold(spark, root)
    contract = Contract.named("gold/user_product_features")
    return t.read_table(spark, f"{root}/{t.GOLD_FEATURES}", contract)


# ---- contracts and data quality ---------------------------------------------


def contract_violations_orders(spark, folder):
    bronze = Lake(spark, folder).given.bronze_orders()
    return Contract.named("silver/orders").rule_counts(bronze)


def lines_without_keys_set_aside(spark, folder):
    """Every 10th line loses its order id, every 14th its product id; kept and set-aside rows by reason."""
    lake = Lake(spark, folder)
    number = F.col("product_id").cast("long") * 31 + F.col("order_id").cast("long")
    lines = lake.given.bronze_order_products("prior").withColumn("n", number).withColumns(
        {
            "order_id": F.when(F.col("n") % 10 == 0, "none").otherwise(F.col("order_id").cast("string")),
            "product_id": F.when(F.col("n") % 14 == 0, None).otherwise(F.col("product_id").cast("string")),
        }
    )
    aside = lake.scratch.path("aside")
    kept = medallion.set_aside_bad_keys(lines, "order_products", aside, lake.scratch)
    apart = t.read_stored(spark, f"{aside}/order_products")
    both = kept.select(F.lit("ok").alias("reason")).unionAll(apart.select("reason"))
    return both.groupBy("reason").agg(F.count("*").alias("n"))


def dirty_orders(lake: Lake) -> DataFrame:
    """Orders made to break every rule: some rows each."""
    number = F.col("order_id")

    def broken(every, column, value):
        return F.when(number % every == 0, value).otherwise(F.col(column))

    return lake.orders().withColumns(
        {
            "eval_set": broken(19, "eval_set", "odd"),
            "order_number": broken(17, "order_number", 0),
            "order_dow": F.when(number % 11 == 0, 7).otherwise(broken(29, "order_dow", -1)),
            "order_hour_of_day": F.when(number % 13 == 0, 24).otherwise(broken(31, "order_hour_of_day", -1)),
            "days_since_prior_order": F.when(number % 7 == 0, None).otherwise(
                broken(23, "days_since_prior_order", -1.0)
            ),
            "user_id": broken(37, "user_id", None),
        }
    )


def contract_violations_dirty_orders(spark, folder):
    dirty = dirty_orders(Lake(spark, folder))
    return Contract.named("silver/orders").rule_counts(dirty.drop("user_id_bucket"))


def dq_rules_on_dirty_orders(spark, folder):
    """Every quality rule of a row, on rows that break it."""
    dirty = dirty_orders(Lake(spark, folder))
    return q.count_broken(
        dirty,
        {
            "no user": q.not_null("user_id"),
            "dow": q.not_between("order_dow", 0, 6),
            "hour": q.not_between("order_hour_of_day", 0, 23),
            "order_number": q.below("order_number", 1),
            "days": q.not_between("days_since_prior_order", 0, 30),
            "days, NULL passes": q.below("days_since_prior_order", 0, True),
            "eval_set": q.not_in("eval_set", ["prior", "train", "test"]),
            "eval_set length": q.longer_than("eval_set", 4),
        },
    )


def column_sets(spark, folder):
    """Which tables have exactly, and at least, the columns of their contract."""
    lake = Lake(spark, folder)
    names = {n: [f.name for f in Contract.named(f"silver/{n}").fields] for n in ("orders", "order_products", "products")}
    found = {
        "orders": (lake.orders(), "orders"),
        "orders with one more": (lake.orders().withColumn("more", F.lit(1)), "orders"),
        "orders without one": (lake.orders().drop("user_id"), "orders"),
        "order_products": (lake.lines(), "order_products"),
        "products": (lake.products(), "products"),
    }
    rows = [(n, df.count(), q.has_exactly(df, names[c]), q.has_all(df, names[c])) for n, (df, c) in found.items()]
    return _rows(spark, rows, "table_name string, n long, exactly boolean, at_least boolean")


def rows_read_and_written(spark, folder):
    """What the Silver jobs observe: rows read of each source, and rows written."""
    lake = Lake(spark, folder)
    g, root, rows = lake.given, lake.scratch.root, []
    jobs = {
        "orders": ([g.bronze_orders()], silver.clean_orders),
        "order_products": ([g.bronze_order_products("prior")], silver.clean_order_products),
        "products": ([g.bronze_products(), g.bronze_aisles(), g.bronze_departments()], silver.build_products),
    }
    for name, (sources, clean) in jobs.items():
        read, written = medallion.clean_and_count(
            name, sources, clean, f"{root}/silver/{name}", Contract.named(f"silver/{name}")
        )
        rows += [(name, place, n, written) for place, n in enumerate(read)]
    return _rows(spark, rows, "table_name string, source int, rows_read long, rows_written long")


def landed_load_times(spark, folder):
    """The load time in the landed files of each table."""
    lake = Lake(spark, folder)
    public = f"{lake.land_orders()}/bronze/historical/public"
    found = None
    for name in ("orders", "order_products"):
        landed = spark.read.option("header", True).csv(f"{public}/{name}")
        times = landed.groupBy(F.to_timestamp("load_ts").cast("string").alias("load_time")).agg(F.count("*").alias("n"))
        times = times.select(F.lit(name).alias("table_name"), "load_time", "n")
        found = times if found is None else found.unionAll(times)
    return found


def contract_violations_dirty_lines(spark, folder):
    """Order lines at place 0 in the cart, and without a mark of reordering."""
    dirty = Lake(spark, folder).lines().withColumns(
        {
            "add_to_cart_order": F.when(F.col("order_id") % 5 == 0, 0).otherwise(F.col("add_to_cart_order")),
            "reordered": F.when(F.col("order_id") % 9 == 0, None).otherwise(F.col("reordered")),
        }
    )
    return Contract.named("silver/order_products").rule_counts(dirty.drop("order_id_bucket"))


def contract_violations_lines(spark, folder):
    bronze = Lake(spark, folder).given.bronze_order_products("prior")
    return Contract.named("bronze/order_products").rule_counts(bronze)


def contract_violations_products(spark, folder):
    return Contract.named("silver/products").violations(Lake(spark, folder).products(complete=False))


def contract_schema(spark, folder):
    """Declared and actual types of a Silver table, with its non-NULL values."""
    orders = Lake(spark, folder).orders()
    contract = Contract.named("silver/orders")
    filled = orders.agg(*[F.count(f.name).alias(f.name) for f in contract.fields])
    entries = [
        F.struct(
            F.lit(f.name).alias("field"),
            F.lit(f.dataType.simpleString()).alias("declared"),
            F.lit(orders.schema[f.name].dataType.simpleString()).alias("actual"),
            F.col(f.name).alias("filled_rows"),
        )
        for f in contract.schema().fields
    ]
    return filled.select(F.inline(F.array(*entries)))


def contract_declared_rules(spark, folder):
    contract = Contract.named("silver/orders")
    bronze = Lake(spark, folder).given.bronze_orders()
    return contract.apply_derived(bronze).select(*[f.name for f in contract.fields])


def contract_default_values(spark, folder):
    bronze = Lake(spark, folder).given.bronze_orders()
    return Contract.named("silver/orders").fill_defaults(bronze)


def dq_null_ids(spark, folder):
    bronze = Lake(spark, folder).given.bronze_orders()
    rules = {c: q.not_null(c) for c in bronze.columns}
    return q.count_broken(bronze, rules | {"eval_set length": q.longer_than("eval_set", 10)})


def dq_duplicate_ids(spark, folder):
    return q.duplicate_keys(Lake(spark, folder).given.bronze_orders(), ["order_id"])


def dq_duplicate_composite_key(spark, folder):
    lines = Lake(spark, folder).given.bronze_order_products("prior")
    return q.duplicate_keys(lines, ["order_id", "product_id"])


def dq_orphan_lines(spark, folder):
    """Train lines do not belong to prior orders; aisle 13 is not known."""
    lake = Lake(spark, folder)
    train_lines = lake.train_lines()
    prior = gold.of_set(lake.orders(), "prior")
    lines = q.orphan_keys(train_lines, "order_id", prior, "order_id")
    g = lake.given
    aisles = q.orphan_keys(g.bronze_products(), "aisle_id", g.bronze_aisles(complete=False), "aisle_id")
    return lines.select(F.lit("order_id").alias("fk"), F.col("order_id").alias("key"), "n").union(
        aisles.select(F.lit("aisle_id"), F.col("aisle_id").cast("int"), "n")
    )


def dq_range_rules(spark, folder):
    bronze = Lake(spark, folder).given.bronze_orders()
    return q.count_broken(
        bronze,
        {
            "dow": q.not_between("order_dow", 0, 6),
            "hour": q.not_between("order_hour_of_day", 0, 23),
            "order_number": q.below("order_number", 1),
            "days": q.not_between("days_since_prior_order", 0, 30),
            "days, NULL passes": q.not_between("days_since_prior_order", 0, 30, True),
        },
    )


def dq_allowed_values(spark, folder):
    g = Lake(spark, folder).given
    flags = q.count_broken(
        g.bronze_order_products("prior"), {"reordered": q.not_in("reordered", ["0", "1"])}
    )
    sets = q.count_broken(
        g.bronze_orders(), {"eval_set": q.not_in("eval_set", ["prior", "train", "test"])}
    )
    return sets.union(flags)


def rows_split_valid_rejected(spark, folder):
    """Every Bronze order with the first Silver rule it breaks."""
    bronze = Lake(spark, folder).given.bronze_orders()
    marked = Contract.named("silver/orders").with_reason(bronze)
    return marked.select("order_id", "user_id", F.coalesce("reason", F.lit("ok")).alias("reason"))


def drop_null_keys(spark, folder):
    lake = Lake(spark, folder)
    bronze = lake.given.bronze_orders()
    accepted, rejected = q.drop_null_keys(bronze, ["order_id", "days_since_prior_order"], lake.scratch)
    columns = ["order_id", "order_number"]
    return accepted.select(*columns, F.lit("ok").alias("reason")).union(
        rejected.select(*columns, "reason")
    )


# ---- catalog and order events -----------------------------------------------


def catalog_events_routed(spark, folder):
    events = Lake(spark, folder).given.catalog_events()
    return landing.parse_catalog_events(events, arrival())


def catalog_event_counts(spark, folder):
    return landing.event_counts(catalog_events_routed(spark, folder))


def catalog_events_landed(spark, folder):
    lake = Lake(spark, folder)
    incoming, landed = lake.scratch.path("incoming"), lake.scratch.path("landed")
    lake.given.catalog_events().write.text(incoming)
    catalog_events.land_catalog_events(
        catalog_events.read_bodies(spark, incoming),
        landed,
        lake.scratch.path("rejected"),
        lake.scratch.path("checkpoint"),
        arrival(),
    ).awaitTermination()
    return catalog_events.read_landed(spark, landed)


def land_order_events(lake: Lake, arrived: Column | None = None) -> str:
    """Order events as gzip JSON in one folder per arrival date; the root folder."""
    incoming = lake.scratch.path("incoming")
    events = lake.given.order_events(with_arrival=True)
    if arrived is not None:
        events = events.filter(arrived)
    writer = events.write.mode("append").partitionBy("arrived")
    writer.option("compression", "gzip").json(incoming)
    return incoming


def run_order_stream(lake: Lake, incoming: str) -> DataFrame:
    """Silver rows after all input so far; run again, it goes on where it stopped."""
    spark, path = lake.scratch.spark, lake.scratch.path("events")
    order_events.build_stream_silver(spark, incoming, path, lake.scratch.path("bad"), lake.scratch.path("state"))
    return order_events.read_stream_silver(spark, path).select(
        "order_id",
        "user_id",
        F.coalesce("position", F.lit(0)).alias("position"),
        F.coalesce("product_id", F.lit(-1)).alias("product_id"),
        "source",
        F.col("event_date").cast("string").alias("event_date"),
    )


def stream_events_silver(spark, folder):
    lake = Lake(spark, folder)
    return run_order_stream(lake, land_order_events(lake))


def stream_late_events(spark, folder):
    """The second half of the month arrives first; the first half is late and counts all the same."""
    lake = Lake(spark, folder)
    run_order_stream(lake, land_order_events(lake, F.col("arrived") >= "2024-01-16"))
    return run_order_stream(lake, land_order_events(lake, F.col("arrived") < "2024-01-16"))


def stream_differing_copies(spark, folder):
    """Copies of an order that differ: at once, in two runs with the later part first, and file by file."""
    cuts = {"at once": [(0, 1, 2, 3)], "two runs": [(3, 2), (1, 0)], "file by file": [(2, 0, 1, 3)]}
    found = None
    for cut, deliveries in cuts.items():
        lake = Lake(spark, folder)
        incoming, path = lake.scratch.path("incoming"), lake.scratch.path("events")
        events = lake.scratch.stage(lake.given.differing_events(), "differing")
        for parts in deliveries:
            for part in parts:
                events.filter(F.col("part") == part).drop("part").write.mode("append").json(incoming)
            order_events.build_stream_silver(
                spark, incoming, path, lake.scratch.path("bad"), lake.scratch.path("state"),
                1 if cut == "file by file" else None,
            )
        rows = order_events.read_stream_silver(spark, path).withColumn("cut", F.lit(cut))
        found = rows if found is None else found.unionAll(rows)
    seconds = F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")
    return found.select("cut", "order_id", "user_id", "position", "product_id", seconds.alias("event_second"))


def stream_bad_rows(spark, folder):
    lake = Lake(spark, folder)
    run_order_stream(lake, land_order_events(lake))
    schema = "event_time string, order_id int, user_id int, reason string"
    return spark.read.schema(schema).json(lake.scratch.path("bad")).drop("batch")


# ---- Gold -------------------------------------------------------------------


def user_order_timeline(spark, folder):
    return gold.user_timeline(Lake(spark, folder).stored_orders())


def user_product_stats(spark, folder):
    lake = Lake(spark, folder)
    lines = lake.lines()
    return gold.user_product_stats(lake.stored_orders(), lines)


def user_totals(spark, folder):
    return gold.user_totals(Lake(spark, folder).orders())


def product_popularity(spark, folder):
    return gold.product_popularity(user_product_stats(spark, folder))


def days_since_last_order(spark, folder):
    stats = user_product_stats(spark, folder)
    return stats.select("user_id", "product_id", "days_since_last_order")


def user_product_features(spark, folder):
    return Lake(spark, folder).features()


def department_reorder_rate(spark, folder):
    lake = Lake(spark, folder)
    lines = lake.lines()
    return gold.department_reorder_rate(lake.stored_orders(), lines, lake.products())


# ---- model ------------------------------------------------------------------


def training_set_labelled(spark, folder):
    rows = Lake(spark, folder).training_set()
    return rows.select("user_id", "product_id", "order_count", "label", "is_validation")


def topk_by_order_count(spark, folder):
    stats = user_product_stats(spark, folder).select("user_id", "product_id", "order_count")
    best = top_k(
        stats, ["user_id"], [F.col("order_count").desc(), F.col("product_id")], model.DEFAULT_TOP
    )
    lists = ranked_lists(best, ["user_id"], {"product_id": "products", "order_count": "counts"})
    return lists.select(
        "user_id",
        F.array_join("products", ",").alias("products"),
        F.array_join("counts", ",").alias("counts"),
    )


def auc_by_reorder_rate(spark, folder):
    return auc_by_rank(Lake(spark, folder).training_set(), "reorder_rate", "label")


def confusion_f1(spark, folder):
    return confusion(Lake(spark, folder).training_set(), "reorder_rate", "label", 0.5)


def auc_by_order_count(spark, folder):
    """Scores far above one."""
    return auc_by_rank(Lake(spark, folder).training_set(), "order_count", "label")


def auc_by_close_scores(spark, folder):
    """Scores that differ in the ninth decimal only."""
    rows = Lake(spark, folder).training_set()
    return auc_by_rank(rows.withColumn("s", F.col("order_count") / F.lit(1e9)), "s", "label")


def model_scores_topk(spark, folder):
    """Train on train users, save and load, recommend to test users: what any model must give."""
    lake = Lake(spark, folder)
    features = lake.scratch.stage(lake.features(), "features")
    orders = lake.stored_orders()
    labelled = lake.scratch.stage(
        model.training_set(features, orders, lake.train_lines(), lake.scratch), "labelled"
    )
    path = lake.scratch.path("model")
    fitted = model.fit(labelled.filter(~F.col("is_validation")), lake.scratch, rounds=5, depth=4)
    model.save(fitted, path)
    users = lake.scratch.stage(model.candidates(features, orders, "test", lake.scratch), "candidates")
    lists = lake.scratch.stage(model.recommend(model.score(model.load(spark, path), users)), "lists")
    again = model.recommend(model.score(fitted, users)).select(
        "user_id", F.col("recommended_product_ids").alias("p"), F.col("scores").alias("s")
    )
    known = users.groupBy("user_id").agg(F.collect_set("product_id").alias("known"))
    ids, scores = F.col("recommended_product_ids"), F.col("scores")
    return lists.join(again, "user_id").join(known, "user_id").select(
        "user_id",
        F.size(F.array_distinct(ids)).cast("long").alias("products"),
        (F.size(F.array_except(ids, "known")) == 0).alias("all_known"),
        (F.sort_array(scores, asc=False) == scores).alias("sorted"),
        F.forall(scores, lambda x: (x >= 0) & (x <= 1)).alias("probabilities"),
        ((ids == F.col("p")) & (scores == F.col("s"))).alias("same_after_load"),
    )


def named_pairs(lake: Lake) -> DataFrame:
    """Labelled pairs with the names of their products, stored."""
    names = lake.products().select("product_id", "aisle_name", "department_name")
    return lake.scratch.stage(lake.training_set().join(names, "product_id", "left"), "named_pairs")


def name_rates_by_fold(spark, folder):
    """Rates of names over all training pairs, and over those outside each fold."""
    training = named_pairs(Lake(spark, folder)).filter(~F.col("is_validation"))
    return model.name_rates(training).withColumn("rate", F.round("rate", 9))


def training_pairs_with_rates(spark, folder):
    """Every training pair with the rates it is taught with: none holds its own label."""
    training = named_pairs(Lake(spark, folder)).filter(~F.col("is_validation"))
    rated = model.with_rates(training, model.name_rates(training), in_training=True)
    columns = [F.round(f"{c}_rate", 9).alias(f"{c}_rate") for c in model.NAME_FEATURES]
    return rated.select("user_id", "product_id", "label", *columns)


def model_quality(spark, folder):
    """The fitted model against its best single feature, on the pairs it learned from; a constant score fails."""
    lake = Lake(spark, folder)
    features = lake.scratch.stage(lake.features(), "features")
    pairs = lake.scratch.stage(
        model.training_set(features, lake.stored_orders(), lake.train_lines(), lake.scratch).filter(~F.col("is_validation")),
        "labelled",
    )
    fitted = model.fit(pairs, lake.scratch, rounds=8)
    scored = lake.scratch.stage(model.score(fitted, pairs), "scored")
    quality = auc_by_rank(scored, "score", "label").first()
    single = max(auc_by_rank(pairs, c, "label").first()["auc"] or 0 for c in ("reorder_rate", "order_count"))
    best = scored.agg(F.avg("label")).first()[0]
    f1 = confusion(scored, "score", "label", best).first()["f1"]
    row = (quality["positives"], quality["negatives"], quality["auc"] > max(single, 0.5), f1 > 0)
    return _rows(spark, [row], "positives long, negatives long, beats_single_features boolean, finds_reorders boolean")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        department_reorder_rate,
        orders_clean,
        order_products_clean,
        products_wide,
        train_labels_clean,
        products_distinct,
        eval_set_split,
        orders_roundtrip,
        lines_roundtrip,
        catalog_json_scan,
        orders_per_bucket,
        optional_source_missing,
        landing_reconciliation,
        csv_of_two_headers,
        orders_incremental,
        seed_load_skip_force,
        medallion_features,
        contract_violations_orders,
        lines_without_keys_set_aside,
        contract_violations_dirty_orders,
        dq_rules_on_dirty_orders,
        column_sets,
        rows_read_and_written,
        landed_load_times,
        contract_violations_dirty_lines,
        contract_violations_lines,
        contract_violations_products,
        contract_schema,
        contract_declared_rules,
        contract_default_values,
        dq_null_ids,
        dq_duplicate_ids,
        dq_duplicate_composite_key,
        dq_orphan_lines,
        dq_range_rules,
        dq_allowed_values,
        rows_split_valid_rejected,
        drop_null_keys,
        catalog_events_routed,
        catalog_event_counts,
        catalog_events_landed,
        stream_events_silver,
        stream_late_events,
        stream_differing_copies,
        stream_bad_rows,
        user_order_timeline,
        user_product_stats,
        user_totals,
        product_popularity,
        days_since_last_order,
        user_product_features,
        training_set_labelled,
        topk_by_order_count,
        auc_by_reorder_rate,
        confusion_f1,
        auc_by_order_count,
        auc_by_close_scores,
        model_scores_topk,
        name_rates_by_fold,
        training_pairs_with_rates,
        model_quality,
    )
}

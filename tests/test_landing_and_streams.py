import gzip
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from larder.operators.contract import Contract
from larder.plans import landing
from larder.sources import versions
from larder.streaming import catalog_events, order_events
from tests.conftest import rows

BODIES = [
    ('{"type":"product","product_id":"1"}', None),
    ('{"type":"aisle","extra":{"a":[1]}}', None),
    ('{"type":"store"}', landing.INVALID_TYPE),
    ('{"type":5}', landing.INVALID_TYPE),
    ('{"type":null}', landing.INVALID_TYPE),
    ('{"a":1}', landing.INVALID_TYPE),
    ("", landing.INVALID_TYPE),
    (None, landing.INVALID_TYPE),
    ("{bad", landing.INVALID_JSON),
    ('{"type":"product"} tail', landing.INVALID_JSON),
    ('{"type":"product"},{"type":"aisle"}', landing.INVALID_JSON),
    ('"product"', landing.INVALID_JSON),
    ("[1]", landing.INVALID_JSON),
    ("7", landing.INVALID_JSON),
    ("\t", landing.INVALID_JSON),
    ("[]", landing.INVALID_JSON),
    ('{"type":"product"', landing.INVALID_JSON),
    ('{"type":"product",}', landing.INVALID_JSON),
    ("{'type':'product'}", landing.INVALID_JSON),
]


def now():
    return F.lit("2024-01-15 23:59:59").cast("timestamp")



def test_events_are_accepted_or_rejected_with_a_reason(spark):
    df = spark.createDataFrame([(b,) for b, _ in BODIES], "body string")
    got = landing.parse_catalog_events(df, now()).collect()
    assert [r["reason"] for r in got] == [reason for _, reason in BODIES]
    assert (got[0]["year"], got[0]["month"], got[0]["day"]) == (2024, 1, 15)
    counts = landing.event_counts(landing.parse_catalog_events(df, now()))
    assert sum(r["n"] for r in counts.collect()) == len(BODIES)


def test_bodies_stay_whole_on_one_line(spark):
    df = spark.createDataFrame([('{"type":"product",\n "x":"1"}',)], "body string")
    got = landing.accepted_events(landing.parse_catalog_events(df, now())).first()
    assert "\n" not in got["body"] and json.loads(got["body"]) == {"type": "product", "x": "1"}


def test_catalog_rows_become_bodies_of_text(spark):
    df = spark.createDataFrame([(1, "cheese")], "aisle_id int, aisle string")
    body = landing.catalog_records(df, "aisle").first()["body"]
    assert json.loads(body) == {"aisle_id": "1", "aisle": "cheese", "type": "aisle"}


def test_catalog_stream_routes_by_type_and_date(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "a.txt").write_text("\n".join(b for b, _ in BODIES if b))
    catalog_events.land_catalog_events(
        catalog_events.read_bodies(spark, str(incoming)),
        str(tmp_path / "api"), str(tmp_path / "bad"), str(tmp_path / "cp"), now(),
    ).awaitTermination()
    assert (tmp_path / "api/type=product/year=2024/month=1/day=15").is_dir()
    assert spark.read.text(str(tmp_path / "api")).count() == 2
    assert spark.read.json(str(tmp_path / "bad")).count() == len(BODIES) - 4


def test_a_catalog_batch_is_read_once_and_its_rerun_adds_nothing(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    bodies = spark.createDataFrame([(b,) for b, _ in BODIES], "body string").mapInArrow(counted, "body string")
    sink = catalog_events.CatalogSink(str(tmp_path / "api"), str(tmp_path / "bad"), now())
    sink(bodies, 0)
    assert reads.value == len(BODIES)
    sink(bodies, 0)
    sink(bodies.limit(1), 1)
    assert catalog_events.read_landed(spark, str(tmp_path / "api")).count() == 3
    assert catalog_events.read_landed(spark, str(tmp_path / "api")).columns == ["body", "type", "year", "month", "day"]
    assert spark.read.json(str(tmp_path / "bad/batch=0")).count() == len(BODIES) - 2


def event(order, minute, products, time=None):
    return {
        "event_time": time or f"2024-01-15T14:{minute:02d}:00Z",
        "order_id": order, "user_id": 1, "product_ids": products, "source": "s",
    }


def write_events(folder, name, events):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / f"{name}.json.gz", "wt") as f:
        f.write("\n".join(json.dumps(e) for e in events))


def run(spark, tmp_path, **options):
    order_events.build_stream_silver(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "cp"), **options
    )
    out = order_events.read_stream_silver(spark, str(tmp_path / "out"))
    return rows(out, "order_id", "position", "product_id")


def test_order_events_are_deduplicated_exploded_and_dated(spark, tmp_path):
    hour = tmp_path / "in/2024/01/15/14"
    write_events(hour, "a", [event(1, 5, [10, 11]), event(1, 5, [10, 11]), event(2, 6, []), event(3, 7, None)])
    write_events(hour, "b", [event(1, 5, [10, 11]), event(4, 8, [12], "bad"), event(None, 9, [13])])
    assert run(spark, tmp_path) == [(1, 1, 10), (1, 2, 11), (2, None, None), (3, None, None)]
    assert list(versions.current(spark, str(tmp_path / "out")).parts) == ["event_date=2024-01-15"]
    bad = spark.read.json(str(tmp_path / "bad"))
    assert rows(bad, "reason") == [("no order_id",), ("unreadable event_time",)]


def test_copies_and_late_events_of_a_later_run(spark, tmp_path):
    hour = tmp_path / "in/2024/01/15/14"
    write_events(hour, "a", [event(1, 30, [10]), event(2, 31, [11])])
    assert run(spark, tmp_path) == [(1, 1, 10), (2, 1, 11)]
    # A copy is dropped; a new order counts, however late it comes.
    write_events(hour, "b", [event(1, 30, [10]), event(3, 10, [12])])
    assert run(spark, tmp_path) == [(1, 1, 10), (2, 1, 11), (3, 1, 12)]
    write_events(hour, "c", [event(4, 0, [13], "2023-01-15T11:00:00Z"), event(5, 40, [14])])
    assert run(spark, tmp_path) == [(1, 1, 10), (2, 1, 11), (3, 1, 12), (4, 1, 13), (5, 1, 14)]


def test_any_cut_into_batches_gives_the_same_rows(spark, tmp_path):
    times = [f"2024-01-15T{h:02d}:00:00Z" for h in (20, 14, 10, 20)]
    for name, order in {"new": (0, 1, 2, 3), "old": (3, 2, 1, 0)}.items():
        for files in (None, 1, 2):
            place = tmp_path / f"{name}{files}"
            for i, k in enumerate(order):
                write_events(place / "in/2024", f"f{i}", [event(k % 3, 0, [k % 3], times[k])])
            assert run(spark, place, max_files_per_trigger=files) == [(0, 1, 0), (1, 1, 1), (2, 1, 2)]


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    sink = order_events.BatchSink(*(str(tmp_path / n) for n in ("out", "bad", "state")))
    schema = Contract.named("bronze/stream").schema()
    first = spark.createDataFrame([("2024-01-15T10:00:00Z", 1, 1, [5], "s"), ("x", 2, 1, [6], "s")], schema)
    for number in (0, 0, 1, 1):
        sink(first, number)
    assert rows(order_events.read_stream_silver(spark, str(tmp_path / "out")), "order_id", "product_id") == [(1, 5)]
    assert spark.read.json(str(tmp_path / "bad/batch=0")).count() == 1


def test_one_file_per_batch_gives_the_same_rows(spark, tmp_path):
    hour = tmp_path / "in/2024/01/15/14"
    for i in range(3):
        write_events(hour, f"f{i}", [event(i, i, [i]), event(9, 1, [7])])
    assert run(spark, tmp_path, max_files_per_trigger=1) == [(0, 1, 0), (1, 1, 1), (2, 1, 2), (9, 1, 7)]


def copy(order, user, day, products):
    return event(order, 0, products, f"2024-01-{day:02d}T10:00:00Z") | {"user_id": user}


def silver(spark, folder):
    out = order_events.read_stream_silver(spark, str(folder))
    return rows(out, "order_id", "user_id", "position", "product_id", "event_date")


def test_differing_copies_give_the_same_rows_in_any_order_and_cut(spark, tmp_path):
    files = [
        [copy(1, 9, 15, [1, 2, 3]), copy(2, 5, 15, [4])],
        [copy(1, 2, 15, [1]), copy(3, 5, 16, [])],
        [copy(2, 7, 14, [5, 6]), copy(3, 1, 16, None), copy(70_000, 1, 16, [8])],
        [copy(2, 1, 17, [7]), copy(3, 1, 16, [9]), copy(70_000, 1, 16, [8])],
    ]
    found = {}
    for order in ((0, 1, 2, 3), (2, 0, 3, 1)):
        for per_batch in (None, 1):
            place = tmp_path / f"{order}{per_batch}"
            for i, k in enumerate(order):
                write_events(place / "in/2024", f"f{i}", files[k])
            run(spark, place, max_files_per_trigger=per_batch)
            found[order, per_batch] = silver(spark, place / "out")
    whole = set(map(str, found.values()))
    assert len(whole) == 1, found
    assert [r[:4] for r in next(iter(found.values()))] == [
        (1, 2, 1, 1), (2, 7, 1, 5), (2, 7, 2, 6), (3, 1, 1, 9), (70_000, 1, 1, 8),
    ]


SCHEMA = "event_time string, order_id int, user_id int, product_ids array<int>, source string"


def batch(spark, events):
    return spark.createDataFrame([tuple(e[c.split()[0]] for c in SCHEMA.split(", ")) for e in events], SCHEMA)


def test_a_batch_opens_only_its_blocks_and_dates_hold_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(order_events, "FAN", 3)
    sink = order_events.BatchSink(*(str(tmp_path / n) for n in ("out", "bad", "state")))
    opened, kept = [], sink.kept
    monkeypatch.setattr(sink, "kept", lambda s, blocks: opened.append((blocks, kept(s, blocks))) or opened[-1][1])
    sizes = []
    for number in range(14):
        order = number << order_events.BLOCK_BITS
        sink(batch(spark, [copy(order, 1, 15, [number]), copy(order + 1, 1, 15 + number % 2, [1])]), number)
        again = batch(spark, [copy(0, 1, 15, [0]), copy(5, 1, 15, [2])])
        if number % 5 == 4:
            sink(again, number)  # older than what is published: nothing to do
        sizes.append(max(len(r) for r in versions.current(spark, sink.folder).parts.values()))
    assert all(len(df.inputFiles()) <= 2 for _, df in opened if df.schema.fields)
    assert all(blocks == [n] for n, (blocks, _) in enumerate(opened))
    assert max(sizes) <= 2 * 3
    assert order_events.read_stream_silver(spark, sink.folder).count() == 28
    found = order_events.read_stream_silver(spark, sink.folder)
    assert len(found.inputFiles()) <= 2 * sum(map(len, versions.current(spark, sink.folder).parts.values()))
    # A block that comes again is written anew, once.
    sink(batch(spark, [copy(2, 1, 15, [7]), copy(0, 1, 1, [8])]), 14)
    state = versions.current(spark, sink.state)
    assert len(state.parts["block=0"]) == 1 and len(state.parts) == 14
    assert rows(order_events.read_stream_silver(spark, sink.folder).filter("order_id < 3"), "order_id", "product_id") == [
        (0, 8), (1, 1), (2, 7),
    ]


def test_two_hundred_batches_leave_few_runs(spark, tmp_path, monkeypatch):
    """The rule of merging, without rows: runs are named only."""
    path, part = str(tmp_path / "t"), "event_date=2024-01-15"
    written = []
    monkeypatch.setattr(order_events, "write_run", lambda rows, folder, run: written.append(run))
    monkeypatch.setattr(versions, "read", lambda *a, **k: None)
    most = 0
    for number in range(200):
        before = versions.current(spark, path)
        runs = (*before.parts.get(part, ()), versions.new_run())
        versions.publish(spark, path, before.following({part: runs}, batch=number))
        order_events.merge_small_runs(spark, path)
        most = max(most, len(versions.current(spark, path).parts[part]))
    assert most <= 3 * (order_events.FAN - 1) and len(written) == 200 // 8 + 200 // 64
    assert versions.current(spark, path).notes == {"batch": 199}


@pytest.mark.parametrize("step", range(1, 5))
def test_a_batch_that_failed_anywhere_is_finished_by_its_rerun(spark, tmp_path, monkeypatch, step):
    sink = order_events.BatchSink(*(str(tmp_path / n) for n in ("out", "bad", "state")))
    sink(batch(spark, [copy(1, 9, 15, [1]), copy(2, 1, 15, [2])]), 0)
    events, calls, publish = batch(spark, [copy(1, 2, 14, [3]), copy(3, 1, 15, [4])]), [], versions.publish

    def failing(*args):
        calls.append(1)
        if len(calls) * 2 - 1 == step:
            raise OSError("before")
        publish(*args)
        if len(calls) * 2 == step:
            raise OSError("after")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "publish", failing)
        with pytest.raises(OSError):
            sink(events, 1)
    sink(events, 1)
    sink(batch(spark, []), 2)
    assert [r[:4] for r in silver(spark, tmp_path / "out")] == [(1, 2, 1, 3), (2, 1, 1, 2), (3, 1, 1, 4)]


def test_load_timestamp_is_landed_but_not_read_back(spark, tmp_path):
    source = spark.createDataFrame([(1, 2.5), (2, None)], "id int, x double")
    written = landing.land_full_load({"things": source}, str(tmp_path), F.lit(datetime(2024, 1, 15)))
    files = list((tmp_path / "things").glob("*.csv.gz"))
    assert files and spark.read.option("header", True).csv(str(tmp_path / "things")).columns == ["id", "x", "load_ts"]
    assert rows(landing.reconcile_load(spark, written, str(tmp_path))) == [("things", 2, 2, 0)]


def test_line_breaks_in_landed_texts(spark, tmp_path):
    source = spark.createDataFrame([(1, 'two\nlines "quoted"'), (2, "a\r\nb"), (3, None), (4, "x")], "product_id int, product_name string")
    written = landing.land_full_load({"notes": source}, str(tmp_path), now())
    assert rows(landing.reconcile_load(spark, written, str(tmp_path))) == [("notes", 4, 4, 0)]


def test_scattered_orders_make_few_files_and_old_stores_keep_their_blocks(spark, tmp_path, monkeypatch):
    events = batch(spark, [copy(number << 16, 1, 15, [1]) for number in range(20)])
    sink = order_events.BatchSink(*(str(tmp_path / n) for n in ("out", "bad", "state")))
    sink(events, 0)
    assert len(versions.current(spark, sink.state).parts) == 2
    old = order_events.BatchSink(*(str(tmp_path / f"old-{n}") for n in ("out", "bad", "state")))
    with monkeypatch.context() as patch:
        patch.setattr(order_events, "BLOCK_BITS", 16)
        old(events, 0)
    begun = versions.current(spark, old.state)
    for state in (begun, versions.Version(begun.number, begun.parts, {"batch": 0})):
        assert order_events.bits_of(state) == 16 and len(state.parts) == 20
    old(batch(spark, [copy(3 << 16, 0, 14, [2])]), 1)
    sink(batch(spark, [copy(3 << 16, 0, 14, [2])]), 1)
    assert len(versions.current(spark, old.state).parts) == 20
    assert silver(spark, old.folder) == silver(spark, sink.folder)
    assert [r[1:4] for r in silver(spark, sink.folder) if r[0] == 3 << 16] == [(0, 1, 2)]

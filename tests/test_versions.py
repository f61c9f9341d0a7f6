"""Tables change at once: whatever fails, a reader sees the version before or after."""

import pytest
from pyspark.sql import functions as F

from larder.operators.contract import Contract
from larder.plans import landing
from larder.sources import storage, versions
from larder.sources import tables as t
from tests.conftest import rows
from tests.test_silver import orders

CONTRACT = "silver/orders"


def content(spark, path):
    back = t.read_table(spark, path, Contract.named(CONTRACT))
    return rows(back.groupBy("user_id_bucket").agg(F.count("*"), F.max("order_number")))


STEPS = ["write", "draft", "rename", "after_rename", "clean"]


def broken_at(step, monkeypatch, error):
    """Let one step of a publish fail, before or after it has done its work."""

    def fail(*_, **__):
        raise error

    if step == "write":
        monkeypatch.setattr(versions, "partitions_of", fail)
    elif step == "draft":
        monkeypatch.setattr(versions, "publish", fail)
    elif step == "rename":
        whole = versions.file_system

        def without_rename(spark, path):
            fs, target = whole(spark, path)
            if path.rsplit("/", 1)[-1][0].isdigit() and path.endswith(".json"):
                raise error
            return fs, target

        monkeypatch.setattr(versions, "file_system", without_rename)
    elif step == "after_rename":
        monkeypatch.setattr(versions, "clean", fail)
    else:
        whole_delete = versions.delete
        monkeypatch.setattr(versions, "delete", lambda s, p: fail() if "run=" in p else whole_delete(s, p))


@pytest.mark.parametrize("only_touched", [False, True])
@pytest.mark.parametrize("error", [OSError("no"), SystemExit("the driver ends")])
@pytest.mark.parametrize("step", STEPS)
def test_old_or_new_and_never_both(spark, tmp_path, monkeypatch, step, error, only_touched):
    contract, path = Contract.named(CONTRACT), str(tmp_path / "silver/orders")
    for n in (20, 20):
        t.write_checked(orders(spark, n), path, contract)
    before = content(spark, path)
    new = orders(spark, 60, number=2).filter("user_id < 3" if only_touched else "true")
    with monkeypatch.context() as patch:
        broken_at(step, patch, error)
        with pytest.raises((OSError, SystemExit)):
            t.write_checked(new, path, contract, only_touched_partitions=only_touched)
    after = [(b, 12, 2) for b in range(3)] + [(b, 4, 1) for b in (3, 4)] if only_touched else [(b, 12, 2) for b in range(5)]
    published = step in ("after_rename", "clean")
    assert before == [(b, 4, 1) for b in range(5)]
    assert content(spark, path) == (after if published else before)
    # The next write goes through, and leaves no run behind that no version names.
    t.write_checked(new, path, contract, only_touched_partitions=only_touched)
    assert content(spark, path) == after


def test_buckets_change_together(spark, tmp_path, monkeypatch):
    """A reader in the middle of a write of many buckets sees none of them."""
    contract, path = Contract.named(CONTRACT), str(tmp_path / "o")
    t.write_checked(orders(spark, 20), path, contract)
    seen, publish = [], versions.publish

    def look_first(s, p, version):
        seen.append(content(spark, path))
        publish(s, p, version)

    monkeypatch.setattr(versions, "publish", look_first)
    t.write_checked(orders(spark, 40, number=3), path, contract, only_touched_partitions=True)
    assert seen == [[(b, 4, 1) for b in range(5)]]
    assert content(spark, path) == [(b, 8, 3) for b in range(5)]


def test_a_reader_that_has_begun_is_not_disturbed(spark, tmp_path):
    path = str(tmp_path / "t")
    t.write_table(spark.range(10), path)
    begun = t.read_stored(spark, path)
    t.write_table(spark.range(20), path)
    assert begun.count() == 10 and t.read_stored(spark, path).count() == 20


def test_only_two_versions_are_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 6):
        t.write_table(spark.range(n * 10).withColumn("k", F.col("id") % n), path, ["k"], only_touched_partitions=n > 3)
    assert len(list((tmp_path / "t/_versions").glob("0*.json"))) == versions.KEPT
    named = {run for v in (4, 5) for run, _ in versions._load(spark, path, v).folders()}
    assert {p.name.removeprefix("run=") for p in (tmp_path / "t").glob("run=*")} == named
    assert t.read_stored(spark, path).count() == 50


def test_second_writer_of_a_version_gives_way(spark, tmp_path):
    path = str(tmp_path / "t")
    t.write_table(spark.range(3), path)
    start = versions.current(spark, path)
    versions.publish(spark, path, start.following(start.parts, by=1))
    with pytest.raises(versions.Superseded):
        versions.publish(spark, path, start.following({}, by=2))
    assert versions.current(spark, path).notes == {"by": 1} and t.read_stored(spark, path).count() == 3


def test_a_failed_forced_seed_keeps_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "seeded")
    assert landing.seed_table(spark.range(3), path)
    failing = spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error("lost")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        landing.seed_table(failing, path, force=True)
    assert t.read_stored(spark, path).count() == 3
    assert [p.name for p in (tmp_path / "seeded").glob("run=*")] == [f"run={versions.current(spark, path).parts[''][0]}"]


def test_plain_folders_are_read_and_not_patched(spark, tmp_path):
    path = str(tmp_path / "plain")
    orders(spark, 20).write.partitionBy("user_id_bucket").parquet(path)
    assert len(content(spark, path)) == 5
    with pytest.raises(ValueError):
        t.write_table(orders(spark, 5), path, ["user_id_bucket"], only_touched_partitions=True)
    assert len(content(spark, path)) == 5
    t.write_table(orders(spark, 40), path, ["user_id_bucket"])
    assert content(spark, path) == [(b, 8, 1) for b in range(5)]


def test_empty_tables(spark, tmp_path):
    contract, path = Contract.named(CONTRACT), str(tmp_path / "o")
    t.write_checked(orders(spark, 0), path, contract)
    assert t.read_table(spark, path, contract).count() == 0 and storage.exists(spark, path)
    t.write_checked(orders(spark, 10), path, contract)
    t.write_checked(orders(spark, 0), path, contract, only_touched_partitions=True)
    assert t.read_table(spark, path, contract).count() == 10

"""Neighbours against brute force, archives against their pages, the pipeline as a whole."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from larder.llm import multi_index, warc
from larder.llm.queries import QUERIES
from larder.sources.storage import Scratch


def brute(rows, every, keep=5):
    sound = {}
    for vec_id, v in rows:
        if vec_id is None or not v or len(v) != 8 or any(x is None or not np.isfinite(x) for x in v):
            continue
        x = np.array(v, np.float32).astype(float)
        if x.any():
            sound[vec_id] = x
    out = {}
    for q, x in sound.items():
        if q % every == 0:
            scores = sorted((-(x @ y) / np.sqrt((x @ x) * (y @ y)), i) for i, y in sound.items() if i != q)
            out[q] = [(i, -s) for s, i in scores[:keep]]
    return out


@pytest.fixture(scope="module")
def vectors():
    dice = np.random.default_rng(7)
    middles = dice.normal(size=(12, 8))
    rows = [(k, [float(x) for x in middles[k % 12] + 0.3 * dice.normal(size=8)]) for k in range(600)]
    rows += [(600 + k, rows[0][1]) for k in range(150)]  # many copies of one vector
    rows += [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [float("nan")] * 8), (1004, [None] + [1.0] * 7)]
    rows += [(1005, [float("inf")] + [1.0] * 7), (1006, [1.0] * 3), (None, rows[1][1]), rows[2], (1050, [2 * x for x in rows[50][1]])]
    return rows


def test_neighbours_reach_brute_force(spark, vectors):
    table = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(4)
    got = multi_index.neighbours(table, 50, Scratch(spark)).collect()
    truth = brute(vectors, 50)
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(truth)
    hits = 0
    for q, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == [1, 2, 3, 4, 5]
        assert all(r.vec_id != q for r in rows)
        order = [(-round(r.score, 12), r.vec_id) for r in rows]
        assert order == sorted(order)
        hits += len({r.vec_id for r in rows} & {i for i, _ in truth[q]})
        known = dict(truth[q])
        assert all(abs(r.score - known[r.vec_id]) < 1e-12 for r in rows if r.vec_id in known)
    assert hits >= 0.9 * 5 * len(truth)
    # All copies are as near as can be, so the smallest ids win.
    assert [r.vec_id for r in found[650]] == [0, 600, 601, 602, 603]


@pytest.mark.parametrize("size", [1.0, 1e200, 1e-200])
def test_vectors_of_one_direction_are_ties_whatever_their_length(spark, size):
    """Rounding differs with the length; the smallest ids win all the same. Other columns may clash."""
    dice = np.random.default_rng(5)
    x = dice.normal(size=(300, 8))
    same = sorted(dice.choice(np.arange(1, 300), 12, replace=False).tolist())
    for k in same:
        x[k] = x[0] * dice.uniform(0.1, 9)
    rows = [(k, (size * v).tolist(), "score", -1.0) for k, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string, v double").repartition(3)
    got = [r for r in multi_index.neighbours(table, 50, Scratch(spark)).collect() if r.query_id == 0]
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == same[:5]
    assert all(abs(r.score - 1) < 1e-12 for r in got)


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], schema)
    got = multi_index.neighbours(few, 50, Scratch(spark)).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [(0, 1, 1), (0, 2, 2)]
    assert multi_index.neighbours(few.limit(0), 50, Scratch(spark)).count() == 0
    assert multi_index.neighbours(few.filter("vec_id = 0"), 50, Scratch(spark)).count() == 0


def test_walk_visits_cells_in_order_of_distance():
    dice = np.random.default_rng(3)
    index = multi_index.MultiIndex((dice.normal(size=(6, 2)), dice.normal(size=(6, 2))))
    index.sizes[:] = 1
    first, second = (d[0] for d in index.distances(dice.normal(size=(1, 4))))
    seen = [cell for cell, _ in index.walk(first, second, 36)]
    sums = (first[:, None] + second[None, :]).ravel()
    assert sorted(seen) == list(range(36))
    assert np.allclose(sums[seen], np.sort(sums))


def page_rows():
    long = "<p>" + "grocery list " * 120 + "</p>"
    return [
        (1, "http://a.example/1", long), (2, "http://a.example/2", long), (9, None, long), (4, "u\r\nx: y", long + "!"),
        (5, "u", None), (6, "u", ""), (7, "u", "short"), (8, "u", "short"), (None, "u", "no id"), (10, "u", "é日\U0001f600\r\n\r\n"),
        (11, "u", "x" * 200_000), (9, None, long), (None, "u", long),
    ]


def test_archives_give_back_their_pages(spark):
    rows = page_rows()
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    scratch = Scratch(spark)
    best = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= warc.REVISIT_BYTES and page is not None:
            best[html] = max(best.get(html, page), page)
    wanted, payloads = Counter(), Counter()
    for page, _, html in rows:
        data = (html or "").encode()
        target = best.get(html) if sum(h == html for *_, h in rows) > 1 else None
        revisit = target is not None and target != page
        wanted[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", target if revisit else None] += 1
        payloads[page, None if revisit else data] += 1
    assert Counter(map(tuple, warc.round_trip(pages, scratch).collect())) == wanted
    back = warc.read_archives(spark, scratch.path("archives"))
    assert Counter((r.page_id, None if r.payload is None else bytes(r.payload)) for r in back.collect()) == payloads


def test_archive_files_are_plain_zstandard(spark):
    import zstandard

    html = [(k, f"http://b.example/{k}", f"<html><title>Shop {k}</title>" + "<li>apples and pears</li>" * (k % 40)) for k in range(300)]
    scratch = Scratch(spark)
    warc.write_archives(spark.createDataFrame(html, "page_id long, url string, html string").coalesce(1), scratch.path("a"))
    (data,) = [bytes(r.content) for r in spark.read.format("binaryFile").load(scratch.path("a")).filter("length > 0").collect()]
    number, size = int.from_bytes(data[:4], "little"), int.from_bytes(data[4:8], "little")
    assert number == warc.DICTIONARY_FRAME and size > 0
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    whole = reader.stream_reader(data[8 + size :], read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 300 and whole.startswith(b"WARC/1.1\r\nWARC-Type: response")


def test_archives_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(empty, Scratch(spark)).count() == 0


def test_pipeline_stages_take_effect(spark):
    folder = "/root/testdata/sf0.001"
    docs, scratch = spark.read.parquet(f"{folder}/documents.parquet"), Scratch(spark)
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.stage(stage(spark, docs, folder), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] <= counts[1] and counts[3] == counts[2] and counts[4] <= counts[3]
    parts = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    lengths = {r.doc_id: (r.n, r.total) for r in parts.groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).toDF("doc_id", "n", "total").collect()}
    assert len(lengths) == counts[4] and all(n == total for n, total in lengths.values())


def test_every_operator_is_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))

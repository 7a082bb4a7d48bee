import os

import pytest

from docketry.session import work_path
from docketry.sources.tables import VersionedTable
from docketry.streaming.append import append_stream, json_stream, merge_stream
from docketry.operators.usage import latency_sketches, merged_sketches, sketch_quantiles
from docketry.streaming.usage import count_requests, current_totals, keep_changes, latency_quantiles

TYPE = "Name string, Amount int"


def put(folder, name, text):
    (folder / name).write_text(text + "\n")


@pytest.fixture
def folder(tmp_path):
    for i, name in enumerate(("Alice", "Bob", "Alice", "Eve")):
        put(tmp_path, f"data{i}.json", f'{{"Name": "{name}", "Amount": {i}}}')
    return tmp_path


def test_append_resumes_where_it_stopped(spark, folder):
    out, offsets = work_path(spark, "sink"), work_path(spark, "offsets")

    def run():
        append_stream(json_stream(spark, str(folder), TYPE, 1), out, offsets, available_now=True).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(TYPE).parquet(out).collect())

    assert run() == [("Alice", 0), ("Alice", 2), ("Bob", 1), ("Eve", 3)]
    assert len(run()) == 4
    put(folder, "data9.json", '{"Name": "Zoe", "Amount": 9}')
    assert run()[-1] == ("Zoe", 9) and len(run()) == 5


def merged(spark, folder, table, offsets, per_batch=10):
    stream = json_stream(spark, str(folder), TYPE, per_batch)
    merge_stream(stream, table, ["Name"], ["Amount"], offsets, available_now=True).awaitTermination()
    return sorted(tuple(r) for r in table.read().collect())


def test_merge_skips_replayed_batches(spark, folder):
    table, offsets = VersionedTable(spark, work_path(spark, "merged")), work_path(spark, "offsets")
    want = [("Alice", 2), ("Bob", 1), ("Eve", 3)]
    assert merged(spark, folder, table, offsets) == want and table.latest() == 0
    # as after a crash before the batch was committed: the same query plays it again
    os.remove(f"{offsets}/commits/0")
    os.remove(f"{offsets}/commits/.0.crc")
    assert merged(spark, folder, table, offsets) == want and table.latest() == 0
    put(folder, "data9.json", '{"Name": "Zoe", "Amount": 9}')
    assert merged(spark, folder, table, offsets) == [*want, ("Zoe", 9)] and table.latest() == 1


def test_merge_with_a_renewed_checkpoint_loses_nothing(spark, tmp_path):
    """The same path with a new checkpoint in it is another query; its batch 0 has not been played."""
    table, offsets, files = VersionedTable(spark, work_path(spark, "merged")), work_path(spark, "offsets"), tmp_path / "in"
    files.mkdir()
    put(files, "a.json", '{"Name": "a", "Amount": 1}')
    assert merged(spark, files, table, offsets) == [("a", 1)]
    os.rename(offsets, f"{offsets}-before")
    put(files, "b.json", '{"Name": "b", "Amount": 2}')
    assert merged(spark, files, table, offsets) == [("a", 1), ("b", 2)]


def test_two_streams_merge_into_one_table(spark, tmp_path):
    table = VersionedTable(spark, work_path(spark, "merged"))
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        put(tmp_path / name, "d.json", f'{{"Name": "{name}", "Amount": 1}}')
        stream = json_stream(spark, str(tmp_path / name), TYPE, 10)
        merge_stream(stream, table, ["Name"], ["Amount"], work_path(spark, "offsets"), available_now=True).awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == [("a", 1), ("b", 1)]


def test_update_mode(spark, tmp_path):
    for i in range(3):
        put(tmp_path, f"r{i}.json", f'{{"method": "GET", "endpoint": "/{i % 2}"}}')
    out, offsets = work_path(spark, "totals"), work_path(spark, "offsets")

    def run():
        stream = json_stream(spark, str(tmp_path), "method string, endpoint string", 1)
        keep_changes(count_requests(stream), out, offsets, available_now=True).awaitTermination()
        return {r.endpoint: r.n_requests for r in current_totals(spark, out, ["method", "endpoint"]).collect()}

    assert run() == {"/0": 2, "/1": 1}
    put(tmp_path, "r9.json", '{"method": "GET", "endpoint": "/1"}')
    assert run() == {"/0": 2, "/1": 2}
    # a batch holds only what it changed
    assert spark.read.parquet(out).where("batch = 3").count() == 1


def counted(spark, folder, out, offsets, per_batch):
    stream = json_stream(spark, str(folder), "method string, endpoint string", per_batch)
    keep_changes(count_requests(stream), out, offsets, available_now=True).awaitTermination()
    return {r.endpoint: r.n_requests for r in current_totals(spark, out, ["method", "endpoint"]).collect()}


def test_totals_after_a_renewed_checkpoint(spark, tmp_path):
    """Three batches of the old query, one of the new one: the new one counts, though its number is lower."""
    for i in range(3):
        put(tmp_path, f"r{i}.json", '{"method": "GET", "endpoint": "/"}')
    out, offsets = work_path(spark, "totals"), work_path(spark, "offsets")
    assert counted(spark, tmp_path, out, offsets, 1) == {"/": 3}
    os.rename(offsets, f"{offsets}-before")
    for i in range(3, 5):
        put(tmp_path, f"r{i}.json", '{"method": "GET", "endpoint": "/"}')
    assert counted(spark, tmp_path, out, offsets, 10) == {"/": 5}
    # and goes on after a restart
    put(tmp_path, "r5.json", '{"method": "GET", "endpoint": "/"}')
    assert counted(spark, tmp_path, out, offsets, 10) == {"/": 6}


def test_streamed_quantiles(spark, tmp_path):
    """Sketches as running totals and as merged parts, within the stated error of the exact ranks."""
    for part in range(4):
        put(tmp_path, f"p{part}.json", "\n".join(f'{{"ms": {i * 7919 % 20_011}}}' for i in range(part * 5_000, part * 5_000 + 5_000)))
    out = work_path(spark, "sketches")
    stream = json_stream(spark, str(tmp_path), "ms double", 1)
    keep_changes(latency_quantiles(stream, ["ms"]), out, work_path(spark, "offsets"), available_now=True).awaitTermination()
    rows = spark.read.schema("ms double").json(str(tmp_path))
    parts = [latency_sketches(rows.where(f"ms % 3 = {k}"), ["ms"]) for k in range(3)]
    values = sorted(r.ms for r in rows.collect())
    for sketches in (current_totals(spark, out, ["metric"]), merged_sketches(parts[0].unionAll(parts[1]).unionAll(parts[2]))):
        got = sketch_quantiles(sketches).first()
        assert got.n == 20_000
        for share, found in ((0.5, got.p50), (0.95, got.p95), (0.99, got.p99)):
            assert abs((values.index(found) + 1) / len(values) - share) <= 0.002 + 1e-4

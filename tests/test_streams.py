"""Streams: batches that fail and run again, sessions with numbers of their own, compaction."""

import random

import pytest
from pyspark.sql import functions as F

from ionweave.operators import extract, joins
from ionweave.sources.scratch import folders
from ionweave.streaming import streams

EDIT = "session string, mz_rt_uid string, edit_seq long, ms1_notes string"


def run(spark, table, rows, tmp_path, name, checkpoint=None):
    source = str(tmp_path / name)
    spark.createDataFrame(rows, EDIT).write.mode("append").parquet(source)
    stream = spark.readStream.schema(EDIT).parquet(source)
    streams.stream_curation_updates(stream, table, str(tmp_path / (checkpoint or f"check-{name}"))).awaitTermination()


def notes(table):
    return {r.mz_rt_uid: r.ms1_notes for r in table.read().collect()}


@pytest.fixture
def table(spark, tmp_path):
    t = streams.CurationTable(spark, str(tmp_path / "table"), ("ms1_notes",))
    t.create(spark.createDataFrame([(f"u{i}", "old", i) for i in range(200)], "mz_rt_uid string, ms1_notes string, other int"))
    return t


def test_sessions_have_numbers_of_their_own(spark, tmp_path, table):
    run(spark, table, [("x", "u1", 50, "x50"), ("x", "u1", 40, "x40"), ("x", "u2", 3, None)], tmp_path, "a")
    assert (notes(table)["u1"], notes(table)["u2"], notes(table)["u3"]) == ("x50", None, "old")
    # the other session's low numbers aren't stale, its own are; an edit of no known compound changes nothing
    run(spark, table, [("y", "u1", 2, "y2"), ("x", "u2", 3, "again"), ("y", "gone", 1, "?")], tmp_path, "b")
    assert (notes(table)["u1"], notes(table)["u2"]) == ("y2", None) and len(notes(table)) == 200
    run(spark, table, [("x", "u1", 49, "late"), ("x", "u1", 51, "x51")], tmp_path, "c")
    assert notes(table)["u1"] == "x51"
    # what a batch writes is its accepted edits, not the table
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{table.path}/changes").count() == 5
    assert table.read().columns == ["mz_rt_uid", "ms1_notes", "other"]


def test_state_goes_on_with_its_checkpoint(spark, tmp_path, table):
    run(spark, table, [("x", "u1", 5, "five")], tmp_path, "a", "one")
    run(spark, table, [("x", "u1", 4, "four"), ("x", "u7", 1, "seven")], tmp_path, "a", "one")
    assert (notes(table)["u1"], notes(table)["u7"]) == ("five", "seven")


def test_compaction_keeps_values_and_numbers(spark, tmp_path, table):
    for k in range(3):
        run(spark, table, [("x", f"u{k}", k, f"x{k}"), ("x", "u9", k, f"nine{k}")], tmp_path, f"s{k}")
        before = notes(table)
        table.compact()
        assert notes(table) == before
    table.compact()
    assert len(table.bases()) == 2 and len(folders(spark, f"{table.path}/changes")) == 1
    # a new stream still knows the numbers of changes that are gone
    run(spark, table, [("x", "u0", 0, "stale"), ("x", "u9", 1, "stale"), ("y", "u0", 0, "other")], tmp_path, "late")
    assert (notes(table)["u0"], notes(table)["u9"]) == ("other", "nine2")


def test_an_edit_batch_that_fails_runs_again(spark, tmp_path, table, monkeypatch):
    append, left = streams.CurationTable.append, [1]

    def failing(self, edits, batch):
        append(self, edits, batch)
        if left:
            left.pop()
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(streams.CurationTable, "append", failing)
    with pytest.raises(Exception, match="lost after the write"):
        run(spark, table, [("x", "u1", 1, "one"), ("x", "u2", 1, "two")], tmp_path, "a", "check")
    run(spark, table, [("x", "u3", 1, "three")], tmp_path, "a", "check")
    assert [notes(table)[u] for u in ("u1", "u2", "u3")] == ["one", "two", "three"]
    assert spark.read.option("recursiveFileLookup", True).parquet(f"{table.path}/changes").count() == 3


def test_an_extracted_batch_that_fails_replaces_itself(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    rows = [(f"f{k % 6}", 100.0 + rng.randrange(3), rng.random() * 4, float(k), 1) for k in range(600)]
    points = spark.createDataFrame(rows, "filename string, mz float, rt float, i float, polarity short")
    for f in range(3):
        points.where(f"cast(substr(filename, 2) as int) % 3 = {f}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    atlas = spark.createDataFrame([("a", 100.0, 1.0, 2.0), ("b", 101.0, 0.0, 4.0)], "mz_rt_uid string, mz double, rt_min double, rt_max double")
    targets = joins.expand_atlas_windows(atlas)
    want = {(r.mz_rt_uid, r.filename): r.points for r in extract.widen_ms1(joins.join_ms1_to_atlas(points, targets)).collect()}
    widen, calls = extract.widen_ms1, []

    def failing(df):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost between the writes")
        return widen(df)

    monkeypatch.setattr(extract, "widen_ms1", failing)

    def stream():
        streams.stream_extract(spark, str(tmp_path / "in"), targets, str(tmp_path / "out"), str(tmp_path / "check"), files_per_batch=1).awaitTermination()

    with pytest.raises(Exception, match="lost between the writes"):
        stream()
    stream()
    assert len(calls) == 4
    got = {(r.mz_rt_uid, r.filename): r.points for r in streams.read_extracted(spark, str(tmp_path / "out")).collect()}
    assert got == want
    assert spark.read.parquet(str(tmp_path / "out/points")).count() == sum(map(len, want.values()))


def test_a_run_in_several_batches_is_put_together(spark, tmp_path):
    for k in range(3):
        spark.createDataFrame([("f", 100.0, float(3 - k), 1.0, 1)], "filename string, mz float, rt float, i float, polarity short").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    targets = joins.expand_atlas_windows(spark.createDataFrame([("a", 100.0, 1.0, 2.0)], "mz_rt_uid string, mz double, rt_min double, rt_max double"))
    streams.stream_extract(spark, str(tmp_path / "in"), targets, str(tmp_path / "out"), str(tmp_path / "check"), files_per_batch=1).awaitTermination()
    (r,) = streams.read_extracted(spark, str(tmp_path / "out")).collect()
    assert [(p.rt, p.in_feature) for p in r.points] == [(1.0, True), (2.0, True), (3.0, False)]


def test_last_edits(spark):
    df = spark.createDataFrame([("x", "u", 1, "a"), ("x", "u", 3, "c"), ("y", "u", 2, "b")], EDIT)
    assert {(r.session, r.ms1_notes) for r in streams.last_edits(df).collect()} == {("x", "c"), ("y", "b")}
    assert streams.last_edits(df).where(F.col("session") == "x").count() == 1


def test_edits_are_chosen_without_a_call_for_each_key(spark, tmp_path):
    edits = spark.readStream.schema(EDIT).parquet(str(tmp_path))
    fresh = streams.newest_edits(edits, spark.createDataFrame([], "session string, mz_rt_uid string, edit_seq long"), ("ms1_notes",))
    assert "Python" not in fresh._jdf.queryExecution().analyzed().toString() and fresh.isStreaming


def test_a_single_batch_is_read_without_a_shuffle(spark, tmp_path):
    for batch in range(2):
        spark.createDataFrame([("a", "f", [(1.0 + batch, 100.0, 1.0, True)])], "mz_rt_uid string, filename string, points array<struct<rt float, mz float, i float, in_feature boolean>>").write.parquet(str(tmp_path / f"ms1/batch={batch}"))
        read = streams.read_extracted(spark, str(tmp_path))
        assert ("Exchange" in read._jdf.queryExecution().executedPlan().toString()) == (batch == 1)
        (r,) = read.collect()
        assert read.columns == ["mz_rt_uid", "filename", "points"] and [p.rt for p in r.points] == [1.0, 2.0][: batch + 1]

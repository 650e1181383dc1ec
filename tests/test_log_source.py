"""The message log and its stream source."""

import json

import pytest
from helpers import at, rows

from candlewick.schema import MESSAGES
from candlewick.sources import message_log
from candlewick.streaming import jobs
from candlewick.streaming.log_source import MessageLogReader, shared_out


def made(spark, *places):
    """Messages (topic, partition, first offset, number)."""
    data = [
        (f"k{o}", f"{t}-{p}-{o}", t, p, o, at("2024-01-01")) for t, p, first, n in places for o in range(first, first + n)
    ]
    return spark.createDataFrame(data, MESSAGES)


def places(df):
    return rows(df, "topic", "partition", "offset")


def reader(path, **options):
    return MessageLogReader({"path": path, **{k: str(v) for k, v in options.items()}})


def test_log_keeps_appends_once(spark, folder):
    first, second = made(spark, ("a", 0, 0, 30), ("a", 1, 5, 3)), made(spark, ("a", 0, 30, 4), ("b", 0, 0, 2))
    assert message_log.read_messages(spark, folder).count() == 0 and message_log.ends(spark, folder).count() == 0
    assert message_log.append_messages(first, folder, "one", slices=4)
    assert not message_log.append_messages(first, folder, "one")  # a repeated append
    assert message_log.append_messages(second, folder, "two")
    assert rows(message_log.read_messages(spark, folder)) == rows(first.unionByName(second))
    assert message_log.segments(spark, folder).filter("topic = 'a' and partition = 0").count() > 2  # a busy partition is cut
    assert rows(message_log.ends(spark, folder)) == [("a", 0, 0, 34, 34), ("a", 1, 5, 8, 3), ("b", 0, 0, 2, 2)]


def test_of_two_commits_of_one_append_the_first_counts(spark, folder):
    message_log.append_messages(made(spark, ("a", 0, 0, 3)), folder, "one")
    index = spark.read.parquet(f"{folder}/index")
    raced = index.selectExpr("append", "regexp_replace(file, 'segments/[^/]+', 'segments/zzz') file", "topic", "partition", "first", "last", "rows")
    raced.write.mode("append").parquet(f"{folder}/index")
    assert message_log.segments(spark, folder).count() == index.count()
    assert reader(folder).latestOffset() == {"a/0": 3}


def test_positions(spark, folder):
    message_log.append_messages(made(spark, ("a", 0, 10, 30), ("a", 1, 0, 10), ("b", 0, 0, 5)), folder)
    assert reader(folder).initialOffset() == {"a/0": 10, "a/1": 0, "b/0": 0}
    assert reader(folder, startingOffsets="latest").initialOffset() == {"a/0": 40, "a/1": 10, "b/0": 5}
    named = json.dumps({"a": {"0": 25}})
    assert reader(folder, startingOffsets=named).initialOffset() == {"a/0": 25, "a/1": 0, "b/0": 0}
    assert reader(folder, subscribe="b").latestOffset() == {"b/0": 5}
    limited = reader(folder, maxOffsetsPerTrigger=9)
    taken = [limited.latestOffset() for _ in range(6)]
    assert [sum(o.values()) - 10 for o in taken] == [9, 18, 27, 36, 45, 45] and taken[-1] == {"a/0": 40, "a/1": 10, "b/0": 5}
    parts = limited.partitions(taken[0], taken[1])
    assert sorted(sum((b["offset"].to_pylist() for p in parts for b in limited.read(p)), [])) == sorted(
        o for place in taken[0] for o in range(taken[0][place], taken[1][place])
    )


def test_positions_go_on_after_a_restart(spark, folder, tmp_path):
    message_log.append_messages(made(spark, ("a", 0, 0, 30)), folder)
    options = {"maxOffsetsPerTrigger": 10, "position": str(tmp_path / "p" / "at.json")}
    assert reader(folder, **options).latestOffset() == {"a/0": 10}
    again = reader(folder, **options)
    assert [again.latestOffset() for _ in range(3)] == [{"a/0": 20}, {"a/0": 30}, {"a/0": 30}]


def test_a_batch_waits_until_it_is_full_or_old(spark, folder, monkeypatch):
    clock = [100.0]
    monkeypatch.setattr("candlewick.streaming.log_source.time.monotonic", lambda: clock[0])
    message_log.append_messages(made(spark, ("a", 0, 0, 25)), folder)
    waiting = reader(folder, maxOffsetsPerTrigger=10, minOffsetsPerTrigger=10, maxTriggerDelay=5)
    assert [waiting.latestOffset()["a/0"] for _ in range(4)] == [10, 20, 20, 20]  # full, full, waiting
    clock[0] += 4.9
    assert waiting.latestOffset() == {"a/0": 20}
    clock[0] += 0.2
    assert waiting.latestOffset() == {"a/0": 25}  # five rows that are old enough
    message_log.append_messages(made(spark, ("a", 0, 25, 12)), folder)
    assert waiting.latestOffset() == {"a/0": 35}


def test_rows_are_dealt_in_proportion():
    assert shared_out(10, {"a": 3, "b": 4}) == {"a": 3, "b": 4}
    assert shared_out(10, {"a": 30, "b": 10, "c": 1}) == {"a": 7, "b": 3, "c": 0}
    for room in range(1, 40):
        shares = shared_out(room, {"a": 17, "b": 5, "c": 30})
        assert sum(shares.values()) == min(room, 52) and all(v <= {"a": 17, "b": 5, "c": 30}[p] for p, v in shares.items())


def test_stream_is_resumed_without_loss_or_repeat(spark, folder, tmp_path):
    out, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    first, second = made(spark, ("a", 0, 0, 20), ("a", 1, 0, 7)), made(spark, ("a", 0, 20, 5), ("c", 3, 0, 4))
    message_log.append_messages(first, folder)
    progress = jobs.ProgressLog(spark)
    stream = lambda: jobs.logged_messages(spark, folder, max_rows=10, position=f"{mark}/at.json")
    query = jobs.drained(jobs.write_stream(stream(), out, mark, every="0 seconds"), folder)
    sizes = [r.input_rows for r in progress.throughput(query).orderBy("batch_id").collect()]
    assert [n for n in sizes if n] == [10, 10, 7]
    message_log.append_messages(second, folder)
    jobs.drained(jobs.write_stream(stream(), out, mark, every="0 seconds"), folder)
    assert places(spark.read.parquet(out)) == places(first.unionByName(second))
    progress.close()


def test_progress_rows_leave_the_memory(spark, folder, tmp_path):
    message_log.append_messages(made(spark, ("a", 0, 0, 20)), folder)
    progress = jobs.ProgressLog(spark, str(tmp_path / "progress"), keep=2)
    stream = jobs.logged_messages(spark, folder, max_rows=4)
    query = jobs.drained(jobs.write_stream(stream, str(tmp_path / "out"), every="0 seconds"), folder)
    held = progress.throughput(query)
    assert sorted(r.input_rows for r in held.collect() if r.input_rows) == [4] * 5 and len(progress.rows) < 2
    progress.close()


@pytest.mark.parametrize("starting, expected", [("earliest", 25), ("latest", 0)])
def test_bounded_run_takes_what_is_there(spark, folder, tmp_path, starting, expected):
    message_log.append_messages(made(spark, ("a", 0, 0, 25)), folder)
    stream = jobs.logged_messages(spark, folder, starting=starting)
    jobs.run_bounded(jobs.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "mark")))
    message_log.append_messages(made(spark, ("a", 0, 25, 3)), folder)
    jobs.run_bounded(jobs.write_stream(jobs.logged_messages(spark, folder, starting=starting), str(tmp_path / "out"), str(tmp_path / "mark")))
    assert spark.read.parquet(str(tmp_path / "out")).count() == expected + 3

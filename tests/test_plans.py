"""The plans are the ones wanted at scale."""

import re

import pytest

import __spark_entry__ as entry
from freshet.catalog import all_queries, streams
from freshet.operators import state
from freshet.sources import events as src

DATA = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<([^\n]*)>", text)]


@pytest.mark.parametrize(
    "name", ["global_count_trigger", "connect_ratio", "late_events", "changing_threshold_stream", "session_count"]
)
def test_only_aggregates_go_to_one_partition(spark, name):
    lines = plan(entry.queries()[name](spark, DATA)).splitlines()
    for line, below in zip(lines, lines[1:]):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[" in below or "Project" in below and "HashAggregate(keys=[" in lines[lines.index(below) + 1]


@pytest.mark.parametrize("name", [n for n in all_queries() if not n.startswith(("stream_", "sink_"))])
def test_no_cross_join_and_no_nested_loop(spark, data, name):
    text = plan(entry.queries()[name](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_plans_of_the_streams_themselves(spark, data, monkeypatch):
    """What each drained stream runs, planned before it is started."""
    seen = {}

    def planned(spark, df, label):
        seen[label] = df._jdf.queryExecution().analyzed().toString()
        return spark.createDataFrame([], df.schema)

    monkeypatch.setattr(streams, "drained_table", planned)
    for name, query in streams.QUERIES.items():
        if name not in BATCHED:
            query(spark, data)
    assert len(seen) >= 14
    for label, text in seen.items():
        for line in text.splitlines():
            # Every join of two streams has an equality to be dealt out by.
            assert not re.search(r"Join (Inner|LeftOuter)\s*$", line), label
            if "Join" in line:
                assert " = " in line, label


def test_streams_meet_on_time_buckets(spark, data, monkeypatch):
    seen = []
    monkeypatch.setattr(streams, "drained_table", lambda spark, df, label: seen.append(df) or spark.createDataFrame([], df.schema))
    streams.stream_interval_join(spark, data)
    assert re.search(r"Join Inner, .*bucket#\d+L? = __bucket#\d+L?", seen[0]._jdf.queryExecution().analyzed().toString())


BATCHED = {
    "stream_connect_ratio",
    "stream_global_count_trigger",
    "stream_count_below_threshold",
    "stream_changing_threshold",
    "stream_count_trigger",
    "stream_purging_trigger",
    "sink_stream_text",
}


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("tumble_count", {"ts", "event_type"}),
        ("state_value", {"event_id", "ts", "user_id"}),
        ("session_by_user", {"ts", "user_id"}),
        ("tumble_ingest", {"event_id", "ts"}),
        ("window_join", {"event_id", "ts", "user_id", "event_type"}),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    found = read_columns(plan(entry.queries()[name](spark, DATA)))
    assert found and all(read == columns for read in found)


@pytest.mark.parametrize("name", ["filter_type", "window_join", "interval_join", "best_window", "side_tagged"])
def test_filters_reach_the_scan(spark, name):
    pushed = re.findall(r"PushedFilters: \[([^\n]*?)\]", plan(entry.queries()[name](spark, DATA)))
    assert pushed and all("event_type" in filters for filters in pushed)


def test_state_without_hot_keys_shuffles_once(spark):
    counted = state.count_so_far(src.events(spark, DATA).select("event_id", "ts", "user_id"), ["user_id"], ["ts", "event_id"])
    assert plan(counted).count("Exchange ") == 1


def test_hot_keys_are_partitioned_with_their_slot(spark):
    text = plan(entry.queries()["reduce_running"](spark, DATA))
    assert re.search(r"Exchange hashpartitioning\(even#\d+, __slot#\d+", text)


def test_python_stays_out_of_batch_operators(spark, data):
    for name, query in all_queries().items():
        if name in ("map_lifecycle", "agg_accumulator") or name.startswith(("stream_", "sink_")):
            continue
        text = plan(query(spark, data))
        assert "InPandas" not in text and "EvalPython" not in text, name


def test_window_aggregates_are_combined_before_the_shuffle(spark):
    for name in ("tumble_count", "tumble_by_type", "slide_count", "session_by_user", "agg_count_if"):
        lines = plan(entry.queries()[name](spark, DATA)).splitlines()
        first = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
        assert "partial_" in lines[first + 1], name


def test_no_broadcast_hint_in_the_package():
    import glob
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for path in glob.glob(f"{root}/freshet/**/*.py", recursive=True):
        if os.path.relpath(path, root).startswith(os.path.join("freshet", "llm")):
            continue
        with open(path) as source:
            text = source.read()
        assert "broadcast(" not in text and "crossJoin" not in text and "localCheckpoint" not in text, path

"""Windows over the twelve-event game fixture with worked results."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from freshet.operators import windows as win
from freshet.sources.events import literal

BASE = datetime(2022, 2, 2)

# Fixed values: (offset in seconds, type, player).
EVENTS = [
    (2, "registered", "bob"),
    (2, "online", "bob"),
    (3, "registered", "sam"),
    (4, "online", "sam"),
    (4, "registered", "rob"),
    (4, "registered", "alice"),
    (6, "registered", "mary"),
    (6, "online", "mary"),
    (8, "registered", "carl"),
    (10, "online", "rob"),
    (10, "online", "alice"),
    (10, "online", "carl"),
]


@pytest.fixture(scope="module")
def game(spark):
    rows = [(i, BASE + timedelta(seconds=s), kind, player) for i, (s, kind, player) in enumerate(EVENTS)]
    return literal(spark, rows, "id bigint, ts timestamp_ntz, event_type string, player string").cache()


def registered():
    return F.col("event_type") == "registered"


def spans(df, *columns, start="window_start", end="window_end"):
    out = {}
    for row in df.collect():
        key = ((row[start] - BASE).total_seconds(), (row[end] - BASE).total_seconds())
        out[key] = row[columns[0]] if len(columns) == 1 else tuple(row[c] for c in columns)
    return out


def test_tumbling(game):
    got = spans(win.tumbling(game, "ts", "3 seconds", {"n": win.count(registered())}), "n")
    assert got == {(0, 3): 1, (3, 6): 3, (6, 9): 2, (9, 12): 0}


def test_tumbling_by_type(game):
    counted = win.tumbling(game, "ts", "3 seconds", {"n": win.count()}, ["event_type"])
    assert spans(counted.where("event_type = 'registered'"), "n") == {(0, 3): 1, (3, 6): 3, (6, 9): 2}
    assert spans(counted.where("event_type = 'online'"), "n") == {(0, 3): 1, (3, 6): 1, (6, 9): 1, (9, 12): 3}


def test_sliding(game):
    got = spans(win.sliding(game, "ts", "3 seconds", "1 second", {"n": registered()}), "n")
    counts = [1, 2, 4, 3, 3, 1, 2, 1, 1, 0, 0]
    assert got == {(i, i + 3): n for i, n in enumerate(counts)}


def test_sliding_when_size_is_no_multiple_of_slide(game):
    got = spans(win.sliding(game, "ts", "3 seconds", "2 seconds", {"n": None}), "n")
    want = {}
    for start in range(-2, 12, 2):
        n = sum(start <= s < start + 3 for s, _, _ in EVENTS)
        if n:
            want[(start, start + 3)] = n
    assert got == want


@pytest.mark.parametrize("limit", [win.CELL_LIMIT, 0])
def test_session(game, monkeypatch, limit):
    monkeypatch.setattr(win, "CELL_LIMIT", limit)
    counted = win.sessions(game, "ts", "1 second", {"registrations": registered(), "n": None})
    got = spans(counted, "registrations", "n", start="session_start", end="session_end")
    assert got == {(2, 5): (4, 6), (6, 7): (1, 2), (8, 9): (1, 1), (10, 11): (0, 3)}


def test_session_per_player(game, monkeypatch):
    plain = win.sessions(game, "ts", "2 seconds", {"n": None}, ["player"]).collect()
    monkeypatch.setattr(win, "CELL_LIMIT", 0)
    assert sorted(plain) == sorted(win.sessions(game, "ts", "2 seconds", {"n": None}, ["player"]).collect())
    assert sum(row["n"] for row in plain) == 12


def test_global_count_trigger(game):
    fired = win.count_trigger(game, [], ["ts", "id"], 10, {"registrations": registered()}).collect()
    assert [(r["firing"], r["n"], r["registrations"]) for r in fired] == [(1, 10, 6)]


def test_busiest(game):
    best = win.busiest(win.sliding(game.where(registered()), "ts", "2 seconds", "1 second", {"n": None}))
    assert spans(best, "n") == {(3, 5): 3}


def test_whole_window_accumulator(game):
    counted = win.accumulate(
        win.with_window(game, "ts", "3 seconds").select("window_start", "event_type"),
        ["window_start"],
        add=lambda state, rows: (state or 0) + int((rows["event_type"] == "registered").sum()),
        merge=lambda a, b: a + b,
        result=lambda state: state,
        result_type="bigint",
        name="n",
        open_keys=1,
    )
    assert sorted(r["n"] for r in counted.collect()) == [0, 1, 2, 3]

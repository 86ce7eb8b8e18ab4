"""History from late changes and as-of joins, against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from leadlake.operators import history

DAY0 = datetime(2026, 1, 1)
OF = {"natural": "agent_name", "at": "seen_at", "tracked": ["profile", "team"]}
SEEN = "agent_name string, seen_at timestamp, profile string, team int"
DIM = "agent_key long, agent_name string, valid_from timestamp, valid_to timestamp, is_current boolean, profile string, team int"


def day(n):
    return DAY0 + timedelta(days=n)


def brute(changes):
    """Versions by member of (member, day, values) rows."""
    seen = {}
    for who, at, *values in changes:
        if who is not None and at is not None:
            order = [(v is not None, v if v is not None else 0) for v in values]
            old = seen.setdefault(who, {}).get(at)
            if old is None or order > old[0]:
                seen[who][at] = (order, tuple(values))
    out = []
    for who, by_time in seen.items():
        begins = []
        for at in sorted(by_time):
            if not begins or begins[-1][1] != by_time[at][1]:
                begins.append((at, by_time[at][1]))
        for i, (at, values) in enumerate(begins):
            until = begins[i + 1][0] if i + 1 < len(begins) else None
            out.append((who, at, until, until is None, *values))
    return sorted(out, key=repr)


def versions(dim):
    return sorted((tuple(r) for r in dim.select("agent_name", "valid_from", "valid_to", "is_current", "profile", "team").collect()), key=repr)


def changes(seed, n=60):
    rng = random.Random(seed)
    return [(rng.choice(["Ada", "Bob", "Cyd", None]), day(rng.randrange(25)), rng.choice(["strong", "weak", None]), rng.choice([1, 2])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_gives_the_same_history(spark, seed):
    rows = changes(seed)
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: repr(r[1:]))):
        dim, known = spark.createDataFrame([], DIM), spark.createDataFrame([], SEEN)
        for k in range(0, len(rows), 25):
            dim, known = history.merge_history(dim, known, spark.createDataFrame(order[k : k + 25], SEEN), "agent_key", **OF)
            keys = [r.agent_key for r in dim.collect()]
            assert len(keys) == len(set(keys)) and None not in keys
        assert versions(dim) == brute(rows)


def test_a_late_change_cuts_a_version_and_keys_stay(spark):
    def arrive(dim, known, *rows):
        return history.merge_history(dim, known, spark.createDataFrame(list(rows), SEEN), "agent_key", **OF)

    dim, known = spark.createDataFrame([], DIM), spark.createDataFrame([], SEEN)
    dim, known = arrive(dim, known, ("Ada", day(1), "weak", 1), ("Bob", day(2), "weak", 1), ("Ada", day(20), "strong", 1))
    before = {(r.agent_name, r.valid_from): r.agent_key for r in dim.collect()}
    assert sorted(before.values()) == [1, 2, 3]
    dim, known = arrive(dim, known, ("Ada", day(10), "middling", 1))
    after = {(r.agent_name, r.valid_from): r.agent_key for r in dim.collect()}
    assert {k: after[k] for k in before} == before and after["Ada", day(10)] == 4
    cut = {r.valid_from: r.valid_to for r in dim.where("agent_name = 'Ada'").collect()}
    assert cut == {day(1): day(10), day(10): day(20), day(20): None}
    # what told nothing new is remembered: a change before it makes it a version
    dim, known = arrive(dim, known, ("Bob", day(9), "weak", 1))
    assert dim.where("agent_name = 'Bob'").count() == 1
    dim, known = arrive(dim, known, ("Bob", day(5), "strong", 1))
    assert [r.valid_from for r in dim.where("agent_name = 'Bob'").orderBy("valid_from").collect()] == [day(2), day(5), day(9)]
    dim, _ = arrive(dim, known)
    assert dim.count() == 6


@pytest.mark.parametrize("period", ["month", "week", "day"])
def test_as_of_join_equals_brute_force(spark, period):
    rng = random.Random(7)
    made = [(rng.choice(["Ada", "Bob", None]), day(rng.randrange(0, 200)), k) for k in range(40)]
    made += [("Ada", day(50), 100 + k) for k in range(5)]  # ties
    facts = [(k, rng.choice(["Ada", "Ada", "Bob", "nobody", None]), day(rng.randrange(-20, 260)) + timedelta(hours=rng.choice([0, 5]))) for k in range(300)]
    facts += [(1000, "Ada", None), (1001, "Ada", day(50)), (1001, "Ada", day(50))]
    joined = history.as_of_join(
        spark.createDataFrame(facts, "id int, agent string, added timestamp").withColumn("profile", F.lit("own")),
        spark.createDataFrame(made, "agent string, valid_from timestamp, version int"),
        "agent", "added", "valid_from", ["version"], period,
    )
    assert joined.columns == ["id", "agent", "added", "profile", "version"]

    def valid(agent, at):
        some = [(v[1], v[2]) for v in made if v[0] == agent and agent is not None and at is not None and v[1] <= at]
        return max(some)[1] if some else None

    got = sorted(((r.id, r.version) for r in joined.collect()), key=repr)
    assert got == sorted(((i, valid(a, t)) for i, a, t in facts), key=repr)


def test_as_of_join_with_nothing(spark):
    facts = spark.createDataFrame([(1, "Ada", day(3))], "id int, agent string, added timestamp")
    none = spark.createDataFrame([], "agent string, valid_from timestamp, version int")
    assert [r.version for r in history.as_of_join(facts, none, "agent", "added", "valid_from", ["version"]).collect()] == [None]
    some = spark.createDataFrame([("Ada", day(1), 5)], none.schema)
    assert history.as_of_join(facts.limit(0), some, "agent", "added", "valid_from", ["version"]).count() == 0
    later = spark.createDataFrame([("Ada", day(90), 6), ("Ada", day(1), 5)], none.schema)  # begins after the last fact
    assert [r.version for r in history.as_of_join(facts, later, "agent", "added", "valid_from", ["version"]).collect()] == [5]


def test_as_of_join_is_an_equality_join(spark):
    facts = spark.range(10).selectExpr("id", "'Ada' || (id % 2) as agent", "timestamp_millis(id * 1000000000) as added")
    some = spark.createDataFrame([("Ada", day(1), 5)], "agent string, valid_from timestamp, version int")
    plan = history.as_of_join(facts, some, "agent", "added", "valid_from", ["version"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

"""Type-2 and type-1 merges: the listed cases, a model in plain Python, and the invariants."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from starloom.functions.scalar import ntz
from starloom.operators import quality, scd
from starloom.operators.scd import DimensionSpec
from tests.conftest import rows

SPEC = DimensionSpec("Dim", "Key", ("ID",), ("A", "B"))
PAIR = DimensionSpec("Pair", "Key", ("O", "R"), ("A",))
OPEN = datetime(9999, 12, 31)
D95, D00, D01, D90 = datetime(1995, 1, 1), datetime(2000, 1, 1), datetime(2001, 1, 1), datetime(1990, 1, 1)
TARGET = "Key long, ID int, A string, B int, StartDate timestamp_ntz, EndDate timestamp_ntz"
STAGED = "ID int, A string, B int, StartDate timestamp_ntz"


def frames(spark, target, staged):
    return spark.createDataFrame(target, TARGET), spark.createDataFrame(staged, STAGED)


def state(df):
    return sorted((tuple(r) for r in df.select("Key", "ID", "A", "B", "StartDate", "EndDate").collect()), key=repr)


@pytest.fixture()
def cases(spark):
    target = [(k, k, "a", k, D95, OPEN) for k in range(1, 9)] + [(9, 9, None, None, D95, OPEN), (10, 10, "x", 1, D90, D95)]
    staged = [
        (1, "changed", 1, D00),
        (2, "a", 2, D00),
        (3, None, 3, D00),
        (9, None, None, D00),
        (104, "new", 4, D00),
        (5, "older", 5, D00), (5, "newer", 5, D01),
        (6, "older", 6, D00), (6, "a", 6, D01),
        (7, "late", 7, D90),
        (10, "back", 1, D00),
    ]
    return frames(spark, target, staged)


def test_every_case(cases):
    target, staged = cases
    actions = {r.ID: r._action for r in scd.change_set(target, staged, SPEC).collect()}
    assert actions == {1: "change", 2: "same", 3: "change", 9: "same", 104: "insert", 5: "change", 6: "same", 7: "late", 10: "insert"}
    second = timedelta(seconds=1)
    merged = state(scd.scd2_merge(target, staged, SPEC))
    by_id = {}
    for row in merged:
        by_id.setdefault(row[1], []).append(row)
    assert sorted(by_id[1]) == [(1, 1, "a", 1, D95, D00 - second), (11, 1, "changed", 1, D00, OPEN)]
    assert [r[2:] for r in sorted(by_id[3])] == [("a", 3, D95, D00 - second), (None, 3, D00, OPEN)]
    assert [r[2:] for r in sorted(by_id[5])] == [("a", 5, D95, D01 - second), ("newer", 5, D01, OPEN)]
    for untouched in (2, 4, 6, 7, 8, 9):
        assert len(by_id[untouched]) == 1 and by_id[untouched][0][5] == OPEN
    assert [r[2:] for r in sorted(by_id[10])] == [("x", 1, D90, D95), ("back", 1, D00, OPEN)]
    assert sorted(r[0] for r in merged) == list(range(1, 16))
    stats = scd.merge_stats(scd.change_set(target, staged, SPEC)).first()
    assert tuple(stats) == (3, 5, 3, 1)


def test_merging_twice_changes_nothing_more(cases):
    target, staged = cases
    once = scd.scd2_merge(target, staged, SPEC)
    assert state(scd.scd2_merge(once, staged, SPEC)) == state(once)
    assert quality.multiple_current(once, ["ID"]).count() == 0
    assert quality.inverted_validity(once).count() == 0


def test_empty_delta_and_empty_target(spark, cases):
    target, staged = cases
    assert state(scd.scd2_merge(target, staged.limit(0), SPEC)) == state(target)
    first = scd.scd2_merge(target.limit(0), staged, SPEC)
    assert [r[0] for r in state(first)] and first.count() == 9
    assert sorted(r.Key for r in first.collect()) == list(range(1, 10))


def test_composite_key(spark):
    target = spark.createDataFrame([(1, 1, 1, "a", D95, OPEN), (2, 1, 2, "b", D95, OPEN)],
                                   "Key long, O int, R int, A string, StartDate timestamp_ntz, EndDate timestamp_ntz")
    staged = spark.createDataFrame([(1, 2, "c", D00), (2, 1, "d", D00)], "O int, R int, A string, StartDate timestamp_ntz")
    got = rows(scd.scd2_merge(target, staged, PAIR).select("Key", "O", "R", "A", "EndDate"))
    assert got == sorted([(1, 1, 1, "a", OPEN), (2, 1, 2, "b", D00 - timedelta(seconds=1)), (3, 1, 2, "c", OPEN), (4, 2, 1, "d", OPEN)], key=repr)


def test_type_1_overwrites_in_place(cases):
    target, staged = cases
    once = scd.scd1_merge(target, staged, SPEC)
    got = {r.ID: r for r in once.filter(F.col("EndDate") == ntz(OPEN)).collect()}
    assert (got[1].Key, got[1].A, got[1].StartDate) == (1, "changed", D00)
    assert (got[3].A, got[5].A, got[7].A) == (None, "newer", "a")  # a late row changes nothing
    assert (got[2].StartDate, got[6].StartDate) == (D95, D95)
    assert got[10].Key == 11 and got[104].Key == 12  # in business-key order
    assert state(scd.scd1_merge(once, staged, SPEC)) == state(once)


def model(target, staged):
    """The merge in plain Python."""
    newest = {}
    for row in staged:
        best = newest.get(row[0])
        rank = lambda r: (r[3], [(v is not None, v) for v in r[1:3]])
        if best is None or row[3] > best[3] or (row[3] == best[3] and rank(row)[1] < rank(best)[1]):
            newest[row[0]] = row
    out, top = [], max([r[0] for r in target], default=0)
    current = {r[1]: r for r in target if r[5] == OPEN}
    changed = {k: s for k, s in newest.items() if k in current and s[1:3] != current[k][2:4] and s[3] > current[k][4]}
    for r in target:
        ends = changed[r[1]][3] - timedelta(seconds=1) if r[1] in changed and r[5] == OPEN else r[5]
        out.append((*r[:5], ends))
    for k in sorted(k for k in newest if k in changed or k not in current):
        top += 1
        out.append((top, k, newest[k][1], newest[k][2], newest[k][3], OPEN))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_the_model(spark, seed):
    rnd = random.Random(seed)

    def value():
        return rnd.choice(["a", "b", None]), rnd.choice([1, 2, None])

    def when():
        return D95 + timedelta(days=rnd.randint(0, 2000))

    target, key = [], 0
    for i in range(1, 60):
        start = D95
        for version in range(rnd.randint(0, 3)):
            key += 1
            end = start + timedelta(days=rnd.randint(10, 300))
            target.append([key, i, *value(), start, end])
            start = end + timedelta(seconds=1)
        if target and target[-1][1] == i and rnd.random() < 0.8:
            target[-1][5] = OPEN
    target = [tuple(r) for r in target]
    staged = [(rnd.randint(1, 70), *value(), when()) for _ in range(150)]
    t, s = frames(spark, target, staged)
    assert state(scd.scd2_merge(t, s, SPEC)) == model(target, staged)


def test_a_hot_key_is_reduced_to_one_row(spark):
    """A third of the batch on one key."""
    t, _ = frames(spark, [(1, 1, "a", 1, D95, OPEN)], [])
    hot = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("ID"), F.lit("z").alias("A"),
        F.col("id").cast("int").alias("B"), (ntz("2000-01-01") + F.make_dt_interval((F.col("id") % 50).cast("int"))).alias("StartDate"),
    )
    merged = scd.scd2_merge(t, hot, SPEC)
    assert merged.filter("ID = 1").count() == 2
    assert quality.multiple_current(merged, ["ID"]).count() == 0
    assert [r.n for r in scd.staged_duplicates(hot, ["ID"]).filter("ID = 1").collect()] == [10001]

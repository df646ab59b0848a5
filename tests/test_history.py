"""Type-2 history, as-of join and ranking against brute force, with and without hot keys."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from basketry.contracts import FILE_MODIFIED, SOURCE_FILE
from basketry.operators import dedup, hotkeys as H, ranking, scd2

SCHEMA = "k string, t int, a string, note string"
COLUMNS = ["k", "a"]


def brute_history(rows):
    best = {}
    for k, t, a, note in rows:
        if t is not None:
            best[k, t] = max(best.get((k, t), ""), a)
    out = []
    for key in {k for k, _ in best}:
        times = sorted(t for k, t in best if k == key)
        kept = [t for i, t in enumerate(times)
                if i == 0 or best[key, t] != best[key, times[i - 1]]]
        ends = kept[1:] + [None]
        out += [(key, best[key, t], t, e) for t, e in zip(kept, ends)]
    return sorted(out, key=repr)


def history(spark, rows, **split):
    frame = spark.createDataFrame(rows, SCHEMA)
    got = scd2.versions(frame, ["k"], "t", COLUMNS, **split).collect()
    return sorted([tuple(r) for r in got], key=repr)


ROW = st.tuples(st.sampled_from("pq"), st.one_of(st.none(), st.integers(0, 30)),
                st.sampled_from("xyz"), st.just("n"))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=40), seed=st.integers(0, 99))
def test_history_matches_brute_force(spark, rows, seed):
    want = brute_history(rows)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    assert history(spark, rows) == want
    # A limit of three rows per task cuts both keys into slices.
    assert history(spark, shuffled, rows_per_task=3, max_slices=8) == want


def test_intervals_touch_and_one_is_open(spark):
    rng = random.Random(1)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}", rng.randrange(2000),
             rng.choice("xyz"), "n") for _ in range(3000)]
    got = history(spark, rows, rows_per_task=100, max_slices=16)
    assert got == brute_history(rows)
    for key in {r[0] for r in got}:
        mine = sorted((r for r in got if r[0] == key), key=lambda r: r[2])
        assert [r[3] for r in mine[:-1]] == [r[2] for r in mine[1:]]
        assert mine[-1][3] is None


def test_a_third_of_rows_in_one_key_is_split(spark):
    from basketry.operators import hotkeys as H

    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) as k", "id as t")
    points = H.split_points(rows, ["k"], "t", 100, 64)
    sizes = H.sliced(rows, ["k"], "t", points, 64).groupBy("k", H.SLICE).count()
    hot = sizes.filter("k = 'hot'").collect()
    assert len(hot) == 10 and max(r["count"] for r in hot) <= 130
    assert sizes.filter("k <> 'hot'").selectExpr("max(_slice)").first()[0] == 0


def test_untracked_columns_open_no_version(spark):
    rows = [("p", 1, "x", "first"), ("p", 2, "x", "second"), ("p", 3, "y", "third")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = scd2.versions(frame, ["k"], "t", ["k", "a", "note"], ["a"]).collect()
    assert sorted(tuple(r) for r in got) == [("p", "x", "first", 1, 3), ("p", "y", "third", 3, None)]


def test_null_is_a_value_of_its_own(spark):
    rows = [("p", 1, None, "n"), ("p", 2, None, "n"), ("p", 3, "x", "n"), ("p", 4, None, "n")]
    got = scd2.versions(spark.createDataFrame(rows, SCHEMA), ["k"], "t", COLUMNS).collect()
    assert sorted((r["__START_AT"], r["a"]) for r in got) == [(1, None), (3, "x"), (4, None)]


@pytest.mark.parametrize("split", [{}, {"rows_per_task": 10, "max_slices": 8}])
def test_as_of_join_matches_brute_force(spark, split):
    rng = random.Random(2)
    rows = [(rng.choice("ppq"), rng.randrange(10, 300), rng.choice("xyz"), "n") for _ in range(120)]
    facts = [(i, rng.choice(["p", "p", "q", "r", None]), rng.randrange(0, 320)) for i in range(200)]
    versions = brute_history(rows)
    want = sorted(
        [(i, k, t, next((a for key, a, s, e in versions
                         if key == k and s <= t and (e is None or t < e)), None))
         for i, k, t in facts],
        key=repr,
    )
    frame = spark.createDataFrame(facts, "id int, k string, at int")
    dim = scd2.versions(spark.createDataFrame(rows, SCHEMA), ["k"], "t", COLUMNS)
    got = scd2.as_of_join(frame, dim, ["k"], "at", ["a"], **split)
    assert sorted([tuple(r) for r in got.select("id", "k", "at", "a").collect()], key=repr) == want


def test_as_of_join_respects_gaps(spark):
    dim = spark.createDataFrame([("p", "x", 10, 20)], "k string, a string, __START_AT int, "
                                                      "__END_AT int")
    facts = spark.createDataFrame([(1, "p", 9), (2, "p", 10), (3, "p", 19), (4, "p", 20)],
                                  "id int, k string, at int")
    got = {r.id: r.a for r in scd2.as_of_join(facts, dim, ["k"], "at", ["a"]).collect()}
    assert got == {1: None, 2: "x", 3: "x", 4: None}


@pytest.mark.parametrize("rows_per_task", [1_000_000, 20])
def test_rank_with_ties_and_null_group(spark, rows_per_task):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "a", "b", None]), float(rng.randrange(40))) for i in range(400)]
    frame = spark.createDataFrame(rows, "id int, g string, v double")
    want = {i: 1 + sum(1 for _, h, w in rows if h == g and w > v) for i, g, v in rows}
    ranked = ranking.rank_in_group(frame, ["g"], "v", "r", rows_per_task, 16)
    assert {r.id: r.r for r in ranked.collect()} == want
    top = ranking.top_in_group(frame, ["g"], "v", "r", 3).collect()
    assert {r.id: r.r for r in top} == {i: r for i, r in want.items() if r <= 3}


def test_first_and_latest_per_key(spark):
    rows = [("p", 2, "b"), ("p", 1, "c"), ("p", 1, "a"), ("q", None, "z"), ("q", 5, "y")]
    frame = spark.createDataFrame(rows, "k string, t int, v string")
    first = {r.k: (r.t, r.v) for r in dedup.first_per_key(frame, ["k"], ["t"]).collect()}
    last = {r.k: (r.t, r.v) for r in dedup.latest_per_key(frame, ["k"], ["t"]).collect()}
    assert first == {"p": (1, "a"), "q": (5, "y")}
    assert last == {"p": (2, "b"), "q": (5, "y")}


def test_latest_state_equals_current_version(spark):
    rng = random.Random(4)
    rows = [(rng.choice("pqr"), t, rng.choice("xyz"), "n") for t in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    state = {tuple(r) for r in scd2.latest_state(frame, ["k"], "t", COLUMNS).collect()}
    versions = scd2.current(scd2.versions(frame, ["k"], "t", COLUMNS)).select(*COLUMNS)
    assert state == {tuple(r) for r in versions.collect()}


def test_of_tied_rows_the_later_file_counts(spark):
    rows = [("p", 1, "West", "a.csv", "2026-01-02"), ("p", 1, "East", "b.csv", "2026-01-01"),
            ("q", 1, "West", "a.csv", "2026-01-01"), ("q", 1, "East", "b.csv", "2026-01-01")]
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(
            order, "k string, t int, a string, _source_file string, m string"
        ).withColumn("_file_modified", F.col("m").cast("timestamp")).withColumnRenamed(
            "_file_modified", FILE_MODIFIED).withColumnRenamed("_source_file", SOURCE_FILE)
        got = scd2.versions(frame, ["k"], "t", COLUMNS).collect()
        assert sorted((r["k"], r["a"]) for r in got) == [("p", "West"), ("q", "East")]
        state = scd2.latest_state(frame, ["k"], "t", COLUMNS).collect()
        assert sorted((r["k"], r["a"]) for r in state) == [("p", "West"), ("q", "East")]


def test_rows_without_a_key_have_no_history(spark):
    rows = [(None, 1, "x", "n"), ("p", 1, "x", "n")]
    assert [r[0] for r in history(spark, rows)] == ["p"]


def test_text_gives_no_order_to_slice_by(spark):
    frame = spark.createDataFrame([("p", "1")], "k string, t string")
    with pytest.raises(ValueError, match="is text"):
        H.split_points(frame, ["k"], "t")


def test_as_of_join_of_many_facts_at_few_times(spark):
    facts = spark.range(3000).selectExpr("id", "'p' as k", "cast(id % 3 as int) as at")
    dim = spark.createDataFrame([("p", "x", 0, 2), ("p", "y", 2, None)],
                                "k string, a string, __START_AT int, __END_AT int")
    got = scd2.as_of_join(facts, dim, ["k"], "at", ["a"], rows_per_task=100)
    assert {(r["a"], r["count"]) for r in got.groupBy("a").count().collect()} == {("x", 2000), ("y", 1000)}

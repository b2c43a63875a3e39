import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from touchpoint.operators import joins, keys, reports


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_latest_per_key_limits_rows_before_the_shuffle(spark):
    rows = [("hot", i, f"v{i}") for i in range(500)] + [("cold", 1, "x"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    newest = keys.latest_per_key(df, ["k"], [F.desc("t")])
    assert values(newest) == [("cold", 1, "x"), ("hot", 499, "v499"), (None, 1, "n")]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


@pytest.mark.parametrize("block", [1, 7, 100, 5000])
def test_running_total_equals_one_pass(spark, monkeypatch, block):
    monkeypatch.setattr(keys, "MIN_BLOCK_ROWS", block)
    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice([1, None]), i, rng.choice([-3, 0, 5, None])) for i in range(1000)]
    total, expected = {}, set()
    for k, g, i, value in rows:
        total[k, g] = total.get((k, g), 0) + (value or 0)
        expected.add((k, g, i, value, total[k, g]))
    df = spark.createDataFrame(rows, "k string, g int, i int, v int").repartition(5)
    found = keys.running_total(df, ["k", "g"], ["i"], F.col("v"), "total")
    assert {tuple(r) for r in found.collect()} == expected
    assert keys.running_total(df.where("false"), ["k", "g"], ["i"], F.col("v"), "total").count() == 0


def test_batch_numbers(spark, monkeypatch):
    monkeypatch.setattr(keys, "MIN_BLOCK_ROWS", 9)
    df = spark.range(100).withColumn("k", F.lit("x"))
    rows = keys.batch_numbers(df, "k", ["id"], 35).groupBy("batch").count()
    assert values(rows) == [(0, 35), (1, 35), (2, 30)]
    assert (reports.batch_size(35), reports.batch_size(250), reports.batch_size(300)) == (35, 250, 249)


def test_resume_keeps_order_and_repeats(spark):
    ids = spark.createDataFrame([(1, "rec_1"), (2, "rec_2"), (3, "rec_3"), (4, "rec_3"), (5, None)], "n int, id string")
    done = spark.createDataFrame([("rec_2",), ("rec_4",), (None,)], "id string")
    assert [r.id for r in keys.resume(ids, done, "id").orderBy("n").collect()] == ["rec_1", "rec_3", "rec_3", None]
    assert values(keys.new_keys_only(ids, done, "id").select("id")) == [("rec_1",), ("rec_3",), ("rec_3",)]
    assert keys.resume(ids, done.where("false"), "id").count() == 5


def test_merge_rows_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, v string, t int")
    source = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1), (None, "x", 1)], "id int, v string, t int")
    once = keys.merge_rows(target, source, "id", [F.desc("t")])
    assert values(once) == [(1, "a", 0), (2, "new", 2), (3, "c", 1)]
    assert values(keys.merge_rows(once, source, "id", [F.desc("t")])) == values(once)
    assert values(keys.merge_rows(target.where("false"), source, "id", [F.desc("t")])) == [(2, "new", 2), (3, "c", 1)]


def test_next_id(spark):
    assert keys.next_id(spark.createDataFrame([(4,), (9,)], "id int"), "id").first()[0] == 10
    assert keys.next_id(spark.createDataFrame([(0,)], "id int"), "id").first()[0] == 1
    assert keys.next_id(spark.createDataFrame([], "id int"), "id").first()[0] == 1


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    first, again = values(keys.sample_rows(df, "id", "s", 7)), values(keys.sample_rows(df.repartition(5), "id", "s", 7))
    assert first == again and len(set(first)) == 7
    assert first != values(keys.sample_rows(df, "id", "other", 7))
    assert keys.sample_rows(spark.range(3), "id", "s", 7).count() == 3


def test_pages(spark):
    assert values(keys.page(spark.range(10), [F.col("id")], 4, 3)) == [(4,), (5,), (6,)]
    assert values(keys.page(spark.range(10), [F.col("id")], 9, 3)) == [(9,)]


def test_counts_by_source(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "source string")
    assert values(keys.counts_by_source(df, "source")) == [("a", 2, 1), ("b", 1, 1), (None, 3, 2)]


def test_only_small_frames_are_broadcast(spark, monkeypatch):
    df = spark.range(100).withColumn("v", F.repeat(F.lit("x"), 100))
    assert joins.is_small(df, 100, 1 << 20)
    assert not joins.is_small(df, 99, 1 << 20)
    assert not joins.is_small(df, 100, 1000)
    with pytest.raises(ValueError, match="nothing"):
        joins.is_small(df.where("false"), required="nothing")
    rows = spark.range(90, 110, 1, 4)
    expected = sorted((r.id, r.v) for r in rows.join(df, "id", "left").collect())
    for limit in (joins.BROADCAST_ROWS, 10):
        monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
        joined = joins.lookup_join(rows, df, "id")
        hinted = "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString()
        assert hinted == (limit > 10) and sorted((r.id, r.v) for r in joined.collect()) == expected


SPEAKERS = [
    (0, "John Doe", "first@example.com", ["JD", "Johnny"]),
    (1, "Alice", "alice@example.com", []),
    (2, "JOHN DOE", "last@example.com", ["al"]),
    (3, "Bob", "bob@example.com", ["alice", "jd"]),
]


@pytest.mark.parametrize("limit", [joins.BROADCAST_ROWS, 0])
def test_resolve_names(spark, monkeypatch, limit):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    speakers = spark.createDataFrame(SPEAKERS, "idx int, name string, email string, aliases array<string>")
    cases = {
        "john doe": "last@example.com", "JD": "bob@example.com", "johnny": "first@example.com", "Alice": "bob@example.com",
        "  John Doe  ": "  John Doe  ", "": "", "stranger": "stranger",
    }
    said = spark.createDataFrame([(n,) for n in cases], "said string")
    rows = joins.resolve_names(said, "said", speakers, "idx", "speaker").collect()
    assert {r.said: r.speaker for r in rows} == cases


def test_align_frames(spark):
    a = spark.createDataFrame([(1, "a1", "x"), (2, "a2", "y"), (None, "a0", "z")], "k int, p string, q string")
    b = spark.createDataFrame([(2, "b2", True), (3, "b3", False), (None, "b0", True)], "k int, q string, r boolean")
    c = spark.createDataFrame([(3, 1.0), (4, 2.0)], "k int, s double")
    rows = joins.align_frames([a, b, c]).select("k", "p", "q", "r", "s")
    assert values(rows) == sorted(
        [
            (1, "a1", "x", None, None), (2, "a2", "y", True, None), (3, None, "b3", False, 1.0), (4, None, None, None, 2.0),
            (None, "a0", "z", None, None), (None, None, "b0", True, None),
        ],
        key=str,
    )
    with pytest.raises(ValueError, match="share no column"):
        joins.align_frames([a, spark.range(1)])


def test_alignment_equals_chained_full_joins(spark):
    rng = random.Random(8)
    frames = [[(rng.choice([*range(8), None]), rng.choice(["u", "v", None]), f"{name}{n}") for n in range(14)] for name in "abc"]
    frames.append([(9, "u", "d0"), (1, "v", "d1")])

    def outer(left, right, width):
        out, used = [], set()
        for key, *values in left:
            met = [n for n, r in enumerate(right) if None not in key and r[0] == key]
            used.update(met)
            out += [(key, *values, right[n][1]) for n in met] or [(key, *values, None)]
        return out + [(r[0], *[None] * width, r[1]) for n, r in enumerate(right) if n not in used]

    keyed = [[((k, g), v) for k, g, v in f] for f in frames]
    expected = keyed[0]
    for width, right in enumerate(keyed[1:], 1):
        expected = outer(expected, right, width)
    df = joins.align_frames([spark.createDataFrame(f, f"k int, g string, v{i} string") for i, f in enumerate(frames)])
    assert values(df.select("k", "g", "v0", "v1", "v2", "v3")) == sorted(((*key, *rest) for key, *rest in expected), key=str)


def test_align_equal_headers(spark):
    a = spark.createDataFrame([("u1", "x"), ("u2", "y")], "URL string, t string")
    b = spark.createDataFrame([("u2", "y"), ("u3", "z")], "URL string, t string")
    assert values(joins.align_frames([a, b])) == values(joins.stack_frames([a, b]).distinct())


FAILURES = {
    "HTTP 429: Too many concurrent writes. Retry limit exceeded.": ("RATE_LIMITED", True),
    "RETRY LIMIT": ("RATE_LIMITED", True),
    "Request timeout: connection timed out after 30s": ("TIMEOUT", False),
    "Table 'users' already exists in database": ("EXISTS", False),
    "Table users was not found": ("NOT_FOUND", False),
    "The number of un-indexed rows exceeds the maximum": ("MAX_UNINDEXED_ROWS_EXCEEDED", False),
    "the number of un-indexed rows (5) exceeds the maximum": ("MAX_UNINDEXED_ROWS_EXCEEDED", False),
    "already exists, 429": ("EXISTS", False),
    "too Many things": ("UNEXPECTED", True),
    "disk full": ("UNEXPECTED", False),
}


def test_failure_classes(evaluate):
    assert evaluate(reports.failure_class, FAILURES) == [f[0] for f in FAILURES.values()]
    assert evaluate(reports.is_retryable, FAILURES) == [f[1] for f in FAILURES.values()]


def test_replay_redates_and_renumbers(spark):
    from touchpoint.plans.records import replayed

    history = spark.createDataFrame(
        [(i, i * 10, datetime(2024, 1, 1 + i % 14, i % 24, 5), "d", 3, 4, 5) for i in range(1, 60)],
        "id long, amount long, at timestamp, description string, user_id long, payer_id long, payee_id long",
    )
    rows = replayed(history, "2024-03-04", 1, "seed", 5).orderBy("id").collect()
    assert [r.id for r in rows] == [60, 61, 62, 63, 64]
    assert all(r["at"].date() == datetime(2024, 3, 4).date() and r["at"].minute == 5 and r.user_id == 1 for r in rows)
    assert replayed(history.where("false"), "2024-03-04", 1, "seed", 5).count() == 0

"""Bounded calls in flight: order, failures, back pressure, and the bound over all tasks."""

import threading
import time

import pytest

from touchpoint.operators import enrich
from touchpoint.operators.inflight import bounded, in_order
from touchpoint.paths import _resolve, qualified, write_object


class Slow:
    """Sleeps longer for earlier items, and knows how many calls overlapped."""

    def __init__(self):
        self.lock, self.now, self.most, self.asked = threading.Lock(), 0, 0, []

    def __call__(self, item):
        with self.lock:
            self.now += 1
            self.most = max(self.most, self.now)
            self.asked.append(item)
        time.sleep(0.03 if item % 3 == 0 else 0.002)
        with self.lock:
            self.now -= 1
        if item == 77:
            raise ValueError("item 77")
        return item * 2


@pytest.mark.parametrize("window", [1, 2, 7])
def test_answers_keep_their_order(window):
    slow = Slow()
    assert list(in_order(slow, range(50), window)) == [2 * i for i in range(50)]
    assert slow.most <= window and (window == 1 or slow.most > 1)
    assert list(in_order(slow, [], window)) == []


def test_items_are_taken_only_when_there_is_room():
    taken = []

    def items():
        for i in range(1000):
            taken.append(i)
            yield i

    answers = in_order(Slow(), items(), 4)
    assert taken == []
    for n in range(1, 10):
        next(answers)
        assert len(taken) <= n + 4
    answers.close()


def test_a_failure_stands_in_its_place():
    slow, got = Slow(), []
    with pytest.raises(ValueError, match="item 77"):
        for answer in in_order(slow, range(1000), 5):
            got.append(answer)
    assert got == [2 * i for i in range(77)] and len(slow.asked) <= 77 + 6


@pytest.mark.parametrize(("parallelism", "window", "parts", "each"), [(10, 4, 2, 4), (3, 8, 1, 3), (6, 1, 6, 1), (1, 1, 1, 1)])
def test_no_more_calls_than_allowed_in_all(spark, parallelism, window, parts, each):
    df, own = bounded(spark.range(100), parallelism, window)
    assert (df.rdd.getNumPartitions(), own) == (parts, each) and parts * each <= parallelism
    kept, own = bounded(spark.range(0, 100, 1, 3), None, 5)
    assert (kept.rdd.getNumPartitions(), own) == (3, 5)


def test_clients_are_called_side_by_side(spark, tmp_path):
    log = tmp_path / "log"

    def client(key):
        with log.open("a") as f:
            f.write(f"{time.time()} 1\n")
        time.sleep(0.02)
        with log.open("a") as f:
            f.write(f"{time.time()} -1\n")
        if key == "5":
            raise OSError("reset")
        return None if key == "6" else int(key)

    ids = spark.createDataFrame([(i,) for i in range(200)], "id int")
    rows = enrich.lookup_status(ids, "id", client, 6, 3).collect()
    assert sorted((int(r.id), r.status, r.ok) for r in rows) == [(i, None if i in (5, 6) else i, i not in (5, 6)) for i in range(200)]
    now = most = 0
    for _, step in sorted(line.split() for line in log.read_text().splitlines()):
        now += int(step)
        most = max(most, now)
    assert 1 < most <= 6


def test_embedding_and_texts_with_a_window(spark):
    rows = spark.createDataFrame([(i, f"text {i}" if i % 10 else " ") for i in range(100)], "id int, t string").repartition(2)
    one, many = (sorted((r.id, r.embedding) for r in enrich.embed_rows(rows, "t", enrich.HashingEmbedder(8), 7, None, w).collect()) for w in (1, 4))
    assert one == many and sum(v is None for _, v in many) == 10
    made = enrich.generate_text(rows, lambda row: row["t"] * 2 if row["id"] % 2 else None, "no {id}", "out", 4, 2).collect()
    assert {r.id: r.out for r in made} == {i: f"text {i}text {i}" if i % 2 else f"no {i}" for i in range(100)}


def test_paths_are_resolved_on_the_driver(spark, tmp_path):
    root = qualified(spark, str(tmp_path))
    assert root.startswith("file:/") and _resolve(f"{root}/a b%20.txt")[1] == f"{tmp_path}/a b%20.txt"
    write_object(root, "x/y.txt", b"1")
    assert (tmp_path / "x/y.txt").read_text() == "1"
    with pytest.raises(ValueError, match="without a scheme"):
        write_object(str(tmp_path), "z.txt", b"1")
    spark._jsc.hadoopConfiguration().set("fs.defaultFS", "viewfs://elsewhere/")
    try:
        with pytest.raises(Exception, match="(?i)viewfs|mount"):
            qualified(spark, "/data/out")
    finally:
        spark._jsc.hadoopConfiguration().unset("fs.defaultFS")

"""Calls to a slow service: several in flight per task, answers in the order of the requests."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame

Item, Answer = TypeVar("Item"), TypeVar("Answer")


def in_order(call: Callable[[Item], Answer], items: Iterable[Item], window: int) -> Iterator[Answer]:
    """``call`` of every item, in the order of the items, with at most ``window`` calls in flight.

    An item is taken from the iterator only when there is room for it, and at most ``window`` items and answers are held, so a
    slow reader or a slow service holds back the reading. The first failure is raised in its place; calls that have not begun
    are then dropped.
    """
    if window <= 1:
        yield from map(call, items)
        return
    pool = ThreadPoolExecutor(window)
    pending: deque[Future] = deque()
    try:
        for item in items:
            pending.append(pool.submit(call, item))
            if len(pending) >= window:
                yield pending.popleft().result()
        while pending:
            yield pending.popleft().result()
    finally:
        pool.shutdown(wait=True, cancel_futures=True)


def bounded(df: DataFrame, parallelism: int | None, window: int) -> tuple[DataFrame, int]:
    """The frame in so many partitions, and the calls in flight in each, that no more than ``parallelism`` calls are in flight in all.

    Without ``parallelism`` the partitioning is kept.
    """
    if parallelism is None:
        return df, max(window, 1)
    window = min(max(window, 1), parallelism)
    return df.repartition(max(parallelism // window, 1)), window

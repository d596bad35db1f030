"""Independent Spark actions submitted side by side from one driver."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable
from threading import BoundedSemaphore, Thread
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

#: Threads that help all callers of ``side_by_side`` together, those that call it from within included.
#: Every action under way keeps its plan, file lists, task states and a stack of threads in the driver.
HELPERS = 2
_helpers = BoundedSemaphore(HELPERS)


def side_by_side(work: Callable[[Item], Result], items: Iterable[Item]) -> list[Result]:
    """Results of ``work`` per item, in order; the first failure is raised.

    The caller works through the items, and threads that only submit jobs help it, so the cluster is
    not idle while the last tasks of one small job finish. Their number is ``HELPERS`` for the whole
    driver, however many items there are and however deep calls are nested: what the driver holds at
    once does not grow with the tables of a build. No caller waits for a helper to be free, so nested
    calls always go on. After a failure no further item begins.
    """
    todo = list(items)
    waiting = deque(enumerate(todo))
    results: dict[int, Result] = {}
    failures: dict[int, BaseException] = {}

    def drain() -> None:
        while not failures:
            try:
                place, item = waiting.popleft()
            except IndexError:
                return
            try:
                results[place] = work(item)
            except BaseException as error:
                failures[place] = error

    def help_out() -> None:
        try:
            drain()
        finally:
            _helpers.release()

    helping = []
    while len(helping) < len(todo) - 1 and _helpers.acquire(blocking=False):
        helping.append(Thread(target=inheritable_thread_target(SparkSession.active())(help_out)))
        helping[-1].start()
    drain()
    for thread in helping:
        thread.join()
    if failures:
        raise failures[min(failures)]
    return [results[place] for place in range(len(todo))]

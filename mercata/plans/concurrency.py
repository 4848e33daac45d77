"""Submit independent Spark jobs concurrently from driver threads.

Independent builds (the dimensions, the two facts, the seven marts) do not
depend on each other; submitting them together lets the scheduler fill idle
executor slots instead of running one small job at a time.

The jobs of a call carry a tag of its own: when one of its tasks fails, the jobs
of the others are cancelled instead of running on for a result that nobody gets.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_EXCEPTION, Future, ThreadPoolExecutor, wait
from typing import TypeVar

from pyspark import SparkContext

T = TypeVar("T")


class _Tagged:
    """Runs callables with a job tag, and cancels what carries it."""

    def __init__(self) -> None:
        self.tag = f"mercata-{uuid.uuid4().hex}"
        self.context = SparkContext._active_spark_context
        self.stopped = False

    def run(self, fn: Callable[[], T]) -> T:
        if self.stopped:
            raise RuntimeError("not started: another task of the call failed")
        if self.context is None:
            return fn()
        self.context.addJobTag(self.tag)  # of this thread
        try:
            return fn()
        finally:
            self.context.removeJobTag(self.tag)

    def results(self, futures: Mapping[str, Future]) -> dict[str, T]:
        """All results, or the first error after the other jobs are cancelled."""
        done, _ = wait(futures.values(), return_when=FIRST_EXCEPTION)
        failed = next((f for f in futures.values() if f in done and f.exception() is not None), None)
        if failed is None:
            return {name: f.result() for name, f in futures.items()}
        self.stopped = True
        for f in futures.values():
            f.cancel()
        while wait(futures.values(), timeout=0.2).not_done:  # a task may have been between two jobs
            if self.context is not None:
                self.context.cancelJobsWithTag(self.tag)
        raise failed.exception()


def run_concurrently(tasks: Mapping[str, Callable[[], T]], max_workers: int = 8) -> dict[str, T]:
    """Run independent callables on up to ``max_workers`` threads; results by name."""
    if len(tasks) <= 1 or max_workers <= 1:
        return {name: fn() for name, fn in tasks.items()}
    tagged = _Tagged()
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        return tagged.results({name: pool.submit(tagged.run, fn) for name, fn in tasks.items()})


def run_graph(tasks: Mapping[str, tuple[tuple[str, ...], Callable[[dict], T]]]) -> dict[str, T]:
    """Run every task as soon as the tasks it depends on have finished.

    ``tasks`` maps a name to (names it depends on, fn(results of those)); it must
    be listed in dependency order.  One thread per task, so a task waiting for its
    inputs never holds back one that could run.
    """
    seen: set[str] = set()
    for name, (deps, _) in tasks.items():
        missing = [d for d in deps if d not in seen]
        if missing:
            raise ValueError(f"{name} depends on {missing}, which are not listed before it")
        seen.add(name)
    futures: dict[str, Future] = {}
    tagged = _Tagged()

    def run(name: str):
        deps, fn = tasks[name]
        inputs = {d: futures[d].result() for d in deps}
        return tagged.run(lambda: fn(inputs))

    with ThreadPoolExecutor(max_workers=max(len(tasks), 1)) as pool:
        for name in tasks:
            futures[name] = pool.submit(run, name)
        return tagged.results(futures)

"""Pure-Python helpers: the dependency runner and landing path normalisation."""

import threading
import time

import pytest

from mercata.plans.concurrency import run_concurrently, run_graph


def test_run_graph_respects_dependencies_and_overlaps_independent_work():
    started = {}

    def task(name, delay, result):
        def fn(deps):
            started[name] = time.perf_counter()
            time.sleep(delay)
            return result(deps)
        return fn

    out = run_graph({
        "a": ((), task("a", 0.2, lambda d: 1)),
        "b": ((), task("b", 0.2, lambda d: 2)),
        "c": (("a", "b"), task("c", 0.0, lambda d: d["a"] + d["b"])),
    })
    assert out == {"a": 1, "b": 2, "c": 3}
    # independent tasks overlapped: each started before the other (0.2 s long) had finished
    assert abs(started["a"] - started["b"]) < 0.2
    assert started["c"] >= max(started["a"], started["b"]) + 0.19


def test_run_graph_rejects_bad_order_and_propagates_errors():
    with pytest.raises(ValueError, match="not listed before it"):
        run_graph({"c": (("a",), lambda d: 0), "a": ((), lambda d: 1)})

    def boom(_):
        raise RuntimeError("failed build")

    with pytest.raises(RuntimeError, match="failed build"):
        run_graph({"a": ((), boom), "b": (("a",), lambda d: 1)})


def test_run_concurrently_returns_by_name():
    names = set()
    out = run_concurrently({f"t{i}": (lambda i=i: names.add(threading.get_ident()) or i) for i in range(4)}, 4)
    assert out == {"t0": 0, "t1": 1, "t2": 2, "t3": 3}


def test_a_failure_cancels_the_jobs_of_the_others(spark):
    def wrong():
        time.sleep(1.0)
        raise RuntimeError("failed build")

    t0 = time.perf_counter()
    with pytest.raises(RuntimeError, match="failed build"):
        run_concurrently({"slow": lambda: spark.range(0, 4, 1, 4).rdd.map(lambda i: time.sleep(60)).count(), "wrong": wrong})
    assert time.perf_counter() - t0 < 40
    with pytest.raises(RuntimeError, match="failed build"):
        run_graph({"slow": ((), lambda _: spark.range(0, 4, 1, 4).rdd.map(lambda i: time.sleep(60)).count()), "wrong": ((), lambda _: wrong()),
                   "after": (("slow",), lambda _: 1)})
    assert time.perf_counter() - t0 < 80
    assert spark.range(3).count() == 3  # other jobs go on


def test_return_copies_are_made_last(spark, monkeypatch):
    import toy
    from mercata.operators import facts
    from mercata.plans.star import build_star

    monkeypatch.setattr(facts, "COPIES", 7)
    lines = [dict(order_id="O-1", product_id=f"P-{i % 3}") for i in range(9)] + [dict(order_id="O-2")]
    events = [("O-1", "Yes")] * 30 + [("O-2", "Yes")] * 2 + [("O-9", "Yes")] * 8 + [(None, "Yes")] * 3 + [("O-2", "No"), ("O-3", None)]
    star = build_star(toy.orders(spark, lines), toy.people(spark, []), toy.returns(spark, events))
    got = [(r.return_key, r.order_id, r.product_key) for r in star.fact_returns.collect()]
    assert sorted(k for k, _, _ in got) == list(range(1, 30 * 3 + 2 + 8 + 3 + 1))
    from collections import Counter

    want = Counter({("O-1", p): 30 for p in (1, 2, 3)}) + Counter({("O-2", 2): 2, ("O-9", None): 8, (None, None): 3})
    assert Counter((o, p) for _, o, p in got) == want
    by_key = [(o is not None, o or "", p is not None, p or 0) for _, o, p in sorted(got)]
    assert by_key == sorted(by_key)  # keys follow the natural order, missing values first

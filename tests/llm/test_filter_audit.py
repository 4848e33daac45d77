import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from mercata.llm import filter_audit as fa
from mercata.llm import registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FIELDS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """(doc_id, text, part) and (doc_id, quality, toxic) -> every order walked document by document."""
    docs = [(d, t or "", p or "") for d, t, p in docs]
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    fails = []
    for d, t, _ in docs:
        w = WORD.findall(t)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
             "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and any(x is not None and x < d and t == y for x, y, _ in docs)}
        fails.append({k for k, v in f.items() if v})
    out = {}
    for part in {p for _, _, p in docs}:
        mine = [(d, f) for (d, _, p), f in zip(docs, fails, strict=True) if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, x in enumerate(order):
                gone = [(d, f) for d, f in left if x in f]
                left = [(d, f) for d, f in left if x not in f]
                shapley[x] += len(gone)
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), sum(x in f for _, f in mine) - len(gone), sum(f == {x} for _, f in mine),
                    sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)]
        for (p, o, k), v in out.items():
            if p == part:
                v.append(shapley[o[k - 1]])
    return {k: tuple(v) for k, v in out.items()}


def rows_of(frame):
    got = [((r.part, r.filter_order, r.step), tuple(r[c] for c in FIELDS)) for r in frame.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def made_up(seed):
    r = random.Random(seed)
    docs = []
    for i in range(160):
        words = [r.choice(("one", "Two", "THREE", "é", "x#y", "w%d" % r.randint(0, 300))) if r.random() < 0.1 * (i % 4) else "w%d" % r.randint(0, 900)
                 for _ in range(r.choice((0, 3, 199, 200, 260)))]
        docs.append((i, "\t".join(words[:9]) + "\n".join(words[9:]), r.choice(("en", "de", None))))
    docs += [(r.randint(0, 400), docs[r.choice((0, 0, 0, 5, 9, r.randint(0, 150)))][1], r.choice(("en", "fr"))) for _ in range(200)]
    docs += [(None, docs[0][1], "en"), (None, "only here", "en"), (500, None, "en"), (501, "", None), (501, "", None), (502, "\x0b \x0c", "en"),
             (503, "  is no blank here \x1c", "en")]
    r.shuffle(docs)
    labels = [(r.choice((None, r.randint(0, 520))), r.choice((0, 1, None)), r.choice((0, 0, 1, None))) for _ in range(300)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_all_orders_equal_the_walk(spark, seed):
    docs, labels = made_up(seed)
    frame = spark.createDataFrame([(*x, 1, "k") for x in docs], "doc_id long, text string, lang string, mask int, key string").repartition(5)
    got = rows_of(fa.filter_audit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    assert got == brute(docs, labels)


def test_a_crowded_filter_only_costs_exact_work(spark, monkeypatch):
    """One cell: every text may repeat and is settled by the grouping of whole texts."""
    docs, labels = made_up(3)
    monkeypatch.setattr(fa, "CELLS", 0)
    frames = (spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rows_of(fa.filter_audit(*frames)) == brute(docs, labels)
    monkeypatch.setattr(fa, "HEAVY", 1)  # no heavy cell: by the joins
    monkeypatch.setattr(fa, "BITMAP_BITS", 64)  # every bit set: all texts pass
    assert rows_of(fa.filter_audit(*frames)) == brute(docs, labels)


def test_query_equals_its_sql_and_the_walk(spark, sf, rows):
    got = rows_of(registry.op12_filter_audit(spark, sf))
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    con.execute(registry.oracle_sql()["op12_filter_audit"])
    names = [c[0] for c in con.description]
    want = {(x["part"], x["filter_order"], x["step"]): tuple(x[c] for c in FIELDS) for x in (dict(zip(names, y, strict=True)) for y in con.fetchall())}
    assert got == want
    docs = con.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    assert got == brute(docs, con.execute("SELECT doc_id, quality, toxic FROM labels").fetchall())


def test_bitmap_holds_its_keys_over_several_segments(monkeypatch):
    monkeypatch.setattr(fa, "_SEGMENT", 64)
    r = random.Random(1)
    keys = [r.randbytes(16) for _ in range(40)]
    one = pa.RecordBatch.from_arrays([pa.array(keys[:25], pa.binary())], names=["key"])
    two = pa.RecordBatch.from_arrays([pa.array(keys[20:], pa.binary())], names=["key"])
    made = sorted((x for b in fa._segments(iter([one, two]), 1024) for x in b.to_pylist()), key=lambda x: x["segment"])
    bitmap = np.zeros(128, np.uint8)
    for b in fa._merged(iter([pa.RecordBatch.from_pylist(made)])):
        bitmap[b["segment"][0].as_py() * 8:][:8] = np.frombuffer(b["own"][0].as_py(), np.uint8)
    assert np.flatnonzero(np.unpackbits(bitmap, bitorder="little")).tolist() == np.unique(fa._spots(keys, 1024)).tolist()


def test_odd_rows_and_empty_table(spark, odd, nothing, odd_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = rows_of(fa.filter_audit(odd.withColumn("lang", odd["key"]), none))
    assert got == brute([(d, t, "x") for d, t in odd_rows], [])
    assert fa.filter_audit(nothing, none).collect() == []

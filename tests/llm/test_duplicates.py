import random
from collections import Counter

import numpy as np
import pyarrow as pa
from brute import components, repeats, shingles

from mercata.llm import jaccard, lpf_dedup, registry
from mercata.llm.common import pin
from mercata.llm.components import components as spark_components
from mercata.llm.jaccard import near_duplicates, shingle_sets
from mercata.llm.lpf_dedup import anchors, repeated_spans


def test_shingle_sets_have_the_sizes_of_the_plain_ones(rows):
    got = shingle_sets([t or "" for _, t in rows])
    assert [len(s) for s in got] == [len(shingles(t)) for _, t in rows]


def test_join_query_equals_all_pairs(spark, sf, rows):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry.op9_shingle_join(spark, sf).collect()}
    assert got == components(rows)


def test_join_of_edited_copies(spark):
    """Chains, groups of copies and pairs just above and below the limit."""
    r = random.Random(4)
    docs = []
    for g in range(6):
        words = [f"w{r.randint(0, 60)}" for _ in range(r.choice((7, 30, 60, 120)))]
        for _ in range(14):
            docs.append((len(docs), " ".join(words)))
            if r.random() < 0.7:
                words[r.randrange(len(words))] = f"x{r.randint(0, 9)}"
            if r.random() < 0.2:
                del words[-1]
    docs += [(len(docs) + i, t) for i, t in enumerate(["one two", "one two", "ONE two", "one", "", None, "É a b c d e f", "é a b c d e f"])]
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in
           near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    assert got == components(docs)


def test_join_odd_rows_and_empty_table(odd, nothing, odd_rows):
    got = near_duplicates(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in odd_rows)
    of = {(r.doc_id, r.n_shingles): (r.component_id, r.stays) for r in got}
    assert of[4, 1] == (4, True) and of[5, 1] == (4, False) and of[1, 0] == (1, True)
    assert sorted((r.component_id, r.stays) for r in got if r.doc_id == 9) == [(9, False), (9, True)]
    assert near_duplicates(nothing).collect() == []


def test_rows_without_ids_leave_one(spark):
    docs = [(None, "all of one text and without any id")] * 5 + [(None, "")] * 2
    got = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.n_shingles, r.stays) for r in got) == [(0, True)] * 2 + [(4, False)] * 4 + [(4, True)]


def test_cells_emit_links_in_proportion_to_a_group(spark, monkeypatch):
    """Near copies of one text: twice the copies, at most twice the links, and the same components as all pairs."""
    real = jaccard._confirmed
    made = []

    def counted(*a):
        out = pin(real(*a), "counted")
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_confirmed", counted)
    r = random.Random(8)
    words = [f"w{i}" for i in range(160)]
    docs = []
    for i in range(240):
        edited = list(words)
        for at in r.sample(range(160), r.randint(1, 5)):
            edited[at] = f"x{r.randint(0, 500)}"
        docs.append((i, " ".join(edited)))
    totals = []
    for n in (120, 240):
        made.clear()
        got = near_duplicates(spark.createDataFrame(docs[:n], "doc_id long, text string")).collect()
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == components(docs[:n])
        totals.append(sum(made))
        assert totals[-1] < n * (jaccard.ROUNDS + 1)
    assert totals[1] <= 2.5 * totals[0]


def test_bitmaps_of_large_sets_rule_pairs_out():
    """Bitmaps grow with the set, and are compared at the size of the smaller one."""
    r = np.random.default_rng(1)
    big, other = (np.unique(r.integers(0, 1 << 62, 6000).astype(np.uint64)) for _ in range(2))
    near = np.sort(np.concatenate([big[:5800], other[:100]]))
    rows = [{"digest": bytes([i]), "label": bytes([i]), "n": len(s), "bitmap": jaccard._parity(s), "block": 0, "home": True, "hashes": s.view(np.int64)}
            for i, s in enumerate((big, other, near, big[:5000], big[:300]))]
    cell = jaccard._Cell(rows, False, 80)
    assert [cell.may_link(i).tolist() for i in range(5)] == [[2, 3], [], [3], [], []]
    assert cell.candidates() == cell.links() == [(b"\x00", b"\x02"), (b"\x00", b"\x03")]


def test_small_cells_at_once_equal_row_by_row():
    r = np.random.default_rng(2)
    base = np.unique(r.integers(0, 1 << 62, 90).astype(np.uint64))
    rows = []
    for i in range(30):
        s = np.unique(np.concatenate([base[r.random(len(base)) < 0.9], r.integers(0, 1 << 62, int(r.integers(0, 9))).astype(np.uint64)]))
        rows.append({"digest": bytes([i]), "label": bytes([i // 2]), "n": len(s), "bitmap": jaccard._parity(s), "block": i % 3, "home": bool(i % 4),
                     "hashes": s.view(np.int64)})
    for crossing in (False, True):
        cell = jaccard._Cell(rows, crossing, 80)
        assert {i: js.tolist() for i, js in cell._all_pairs()} == {i: cell.may_link(i).tolist() for i in range(30) if len(cell.may_link(i))}


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(7, 7)]
    got = {r.node: r.label for r in spark_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in range(5, 40)}}


def test_every_window_has_its_anchor_and_equal_windows_equal_ones():
    r = random.Random(6)
    part = bytes(r.choice(b"abc ") for _ in range(260))
    texts = [part, b"zz" + part[30:200] + b"q", b"short", b"a" * 150]
    ends = np.cumsum([len(t) for t in texts])
    starts = ends - [len(t) for t in texts]
    data = b"".join(texts)
    place, h, first, last = anchors(data, starts, ends)
    of = {}
    for p, x, a, b in zip(place.tolist(), h.tolist(), first.tolist(), last.tolist(), strict=True):
        for i in range(a, b + 1):
            assert i not in of and i <= p <= i + 68
            of[i] = (x, p - i)
    windows = [i for s, e in zip(starts.tolist(), ends.tolist(), strict=True) for i in range(s, e - 99)]
    assert sorted(of) == windows
    same = {}
    for i in windows:
        assert same.setdefault(data[i:i + 100], of[i]) == of[i]


def test_repeats_query_equals_plain_removal(spark, sf, rows):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in registry.op2_repeated_passages(spark, sf).collect()}
    assert got == repeats(rows)


def test_repeats_of_shared_passages(spark):
    r = random.Random(5)
    base = ["".join(r.choice("ab é\n") for _ in range(r.randint(50, 400))) for _ in range(12)]
    docs = [(i, "".join(r.choice(base)[r.randint(0, 60):r.randint(61, 400)] for _ in range(r.randint(0, 5)))) for i in range(150)]
    docs += [(400, None), (401, ""), (402, "a" * 5000), (403, "ab" * 3000), (404, "a" * 99), (405, "a" * 100), (406, "\x00" * 300), (407, "x" + "\x00" * 150)]
    found = repeated_spans(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    got = {x.doc_id: (x.n_bytes, sum(s.end - s.start for s in x.spans), len(x.spans), x.kept_sha256) for x in found}
    assert got == repeats(docs)


def test_repeats_odd_rows_and_empty_table(odd, nothing, odd_rows):
    got = repeated_spans(odd).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in odd_rows)
    nine = [r for r in got if r.doc_id == 9]
    # one document in two rows: its own later windows go, the first hundred bytes stay, in both rows
    assert len(nine) == 2 and all([(s.start, s.end) for s in r.spans] == [(1, 3000)] for r in nine)
    assert repeated_spans(nothing).collect() == []


def test_suffixes_are_cut_between_hashes(monkeypatch):
    """Each batch of hashes is settled once the next begins; a hash over several batches stays whole."""
    r = random.Random(9)
    hashes = sorted([1] * 3 + [2] * 250 + [3] * 40 + [r.randint(4, 60) for _ in range(700)])
    texts = {h: [bytes(r.choice(b"ab") for _ in range(130)) for _ in range(3)] for h in hashes}
    rows = [(h, i, i.to_bytes(16, "big"), 0, 30, r.choice(texts[h])[:r.randint(100, 130)]) for i, h in enumerate(hashes)]
    names = ["hash", "__llm_doc", "__llm_key", "first", "offset", "bytes"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary()]
    fed = []

    def batches():
        for at in range(0, len(rows), 50):
            fed.append(at)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at:at + 50], strict=True), types, strict=True)], names=names)

    monkeypatch.setattr(lpf_dedup, "SORT_ROWS", 60)
    got, taken = set(), []
    for b in lpf_dedup._suffixes(batches(), 100):
        taken.append(len(fed))
        got |= {(x["__llm_key"], i) for x in b.to_pylist() for i in range(x["a"], x["b"] + 1)}
    seen, want = set(), set()
    for h, _, key, _, _, data in rows:
        mine = {(h, i, data[i:i + 100]) for i in range(len(data) - 99)}
        want |= {(key, i) for _, i, w in mine if (h, i, w) in seen}
        seen |= mine
    assert got == want and len(want) > 500
    assert taken[0] < 10 and len(set(taken)) > 4


def test_words_of_a_part_at_a_time_give_the_same_sets(monkeypatch):
    """A piece's words are not held all at once; its sets are those of the whole piece."""
    from mercata.llm import jaccard

    texts = ["", "One two", *[" ".join(f"w{(i * j) % 17}" for j in range(i)) for i in range(40)], ""]
    whole, calls = jaccard.shingle_sets(texts, 5), []
    monkeypatch.setattr(jaccard, "PART", 100)
    monkeypatch.setattr(jaccard, "shingle_sets", lambda part, k, real=jaccard.shingle_sets: calls.append(sum(map(len, part))) or real(part, k))
    parts = jaccard._sets_by_parts(texts, 5)
    assert len(parts) == len(whole) and all((a == b).all() and len(a) == len(b) for a, b in zip(parts, whole, strict=True))
    assert len(calls) > 10 and max(calls) < 100 + max(map(len, texts)) and jaccard._sets_by_parts([], 5) == []

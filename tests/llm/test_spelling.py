import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from mercata.llm import registry
from mercata.llm.spelling import crc_of_both, one_edit_apart, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs):
    seen = Counter()
    for d, t in docs:
        for run in RUN.findall(t or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            seen[w] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= 3}


def apart(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs):
    n = brute_words(docs)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if apart(w, x)] for w in n}
    form = {}
    for w, of in near.items():
        best = min(of, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def rows_of(frame):
    got = [((r.word), (r.form, r.root, r.n, r.n_near, r.form_n)) for r in frame.collect()]
    assert len(got) == len(dict(got))
    return dict(got)


def test_checksum_of_two_parts():
    r = random.Random(1)
    parts = [(r.randbytes(r.randint(0, 9)), r.randbytes(r.randint(0, 70))) for _ in range(500)]
    got = crc_of_both(np.array([zlib.crc32(a) for a, _ in parts], np.uint32), np.array([zlib.crc32(b) for _, b in parts], np.uint32),
                      np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


@pytest.mark.parametrize("seed", range(40))
def test_windows_find_every_pair_once(seed):
    r = random.Random(seed)
    m = r.randint(3, 8)
    words = list({"".join(r.choice("ab") for _ in range(r.choice((m, m + 1)))) for _ in range(60)})
    n = dict.fromkeys(words, 0)
    cut = r.randint(1, m - 1)
    for lo, hi in ((0, cut), (cut, m)):
        groups = {}
        for w in words:
            groups.setdefault((w[:lo], w[len(w) - (m - hi):]), []).append(w)
        for of in groups.values():
            count, best = one_edit_apart(of, m, lo, hi)
            for w, k, b in zip(of, count, best, strict=True):
                n[w] += k
                assert (b < 0) == (k == 0) and (b < 0 or apart(w, of[b]))
    # pairs of two long words meet at the next length
    assert n == {w: sum(apart(w, x) for x in words if min(len(w), len(x)) == m) for w in words}


def test_query_equals_brute_force(spark, sf, rows):
    assert rows_of(registry.op11_spelling_variants(spark, sf)) == brute(rows)


@pytest.mark.parametrize("group", [2, 7, 5000])
def test_large_groups_are_split_without_loss(spark, group):
    """Few letters and many words: every window is over the limit, down to one position."""
    r = random.Random(3)
    words = ["".join(r.choice("abé") for _ in range(r.randint(4, 8))) for _ in range(900)]
    words += ["prefix" + "".join(r.choice("xyz") for _ in range(r.randint(1, 4))) for _ in range(300)] + ["aaaaa", "aaaaaa", "aaaaaaa"] * 9
    docs = [(i, " ".join(r.choices(words, k=200)).title() if i % 9 == 0 else "-".join(r.choices(words, k=300))) for i in range(30)]
    got = rows_of(spelling_variants(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), group=group))
    assert got == brute(docs) and max(v[3] for v in got.values()) > 5


def test_chains_of_forms_end_at_their_root(spark):
    words = {"abcdefghij"[:i] + "xxxxxxxx"[i:] + "tail": 3 * 2 ** i for i in range(8)}
    docs = [(0, " ".join(w for w, n in words.items() for _ in range(n)))]
    want = brute(docs)
    assert rows_of(spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"))) == want
    assert len({v[1] for v in want.values()}) < len(want) - 4


def test_odd_rows_long_runs_and_empty_table(spark, odd, nothing, odd_rows):
    assert rows_of(spelling_variants(odd, min_count=1, min_length=1)).keys() >= {"mail", "same"}
    assert rows_of(spelling_variants(odd)) == brute(odd_rows)
    long = [(i, "q" * (20_000 + i % 2)) for i in range(8)] + [(None, "Ünder ünder Ünder"), (3, "À×÷ÿ AB×÷ÿ ab×÷ÿ aB×÷ÿ")]
    assert rows_of(spelling_variants(spark.createDataFrame(long, "doc_id long, text string"))) == brute(long)
    assert spelling_variants(nothing).collect() == []

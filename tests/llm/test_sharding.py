import zlib
from collections import Counter

import numpy as np
import pytest

from mercata.llm import registry
from mercata.llm.shard import communication_matrix, shard_sizes, shuffle_into_shards


def test_matrix_has_exact_sums_and_the_hypergeometric_mean():
    sizes = [40, 3, 0, 57]
    shards = shard_sizes(100, 3)
    total = np.zeros((4, 3))
    for seed in range(400):
        m = communication_matrix(sizes, shards, seed)
        assert m.sum(axis=1).tolist() == sizes and m.sum(axis=0).tolist() == shards and (m >= 0).all()
        total += m
    expected = np.outer(sizes, shards) / 100
    assert np.abs(total / 400 - expected).max() < 0.6


def test_query_covers_every_document_once(spark, sf, rows):
    got = registry.op1_hypergeometric_shards(spark, sf).collect()
    assert Counter(r.doc_id for r in got) == Counter(d for d, _ in rows)
    text = dict(rows)
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    per = Counter(r.shard for r in got)
    assert sorted(per) == list(range(8)) and max(per.values()) - min(per.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in per.items())
    again = registry.op1_hypergeometric_shards(spark, sf).collect()
    assert sorted((r.doc_id, r.shard, r.slot) for r in got) == sorted((r.doc_id, r.shard, r.slot) for r in again)


def test_shuffle_is_uniform_in_shard_and_slot(spark):
    df = spark.range(40)
    where = np.zeros((40, 4))
    for seed in range(60):
        for r in shuffle_into_shards(df, 4, seed=seed, bucket_rows=7).collect():
            where[r.id, r.shard] += 1
    assert where.min() >= 3 and where.max() <= 30  # 15 expected


def test_odd_rows_and_empty_table(odd, nothing, odd_rows):
    got = shuffle_into_shards(odd, 4).collect()
    assert len(got) == len(odd_rows) and {"key", "a.b"} <= set(got[0].asDict())
    assert Counter(r.text for r in got) == Counter(t for _, t in odd_rows)
    assert shuffle_into_shards(nothing, 4).collect() == []
    with pytest.raises(ValueError):
        shuffle_into_shards(odd, 0)

"""Counts that chunks ask for and get back."""

import numpy as np
import pytest

from footfall.llm import counting


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_every_chunk_gets_all_counts(spark, buckets):
    rng = np.random.default_rng(buckets)
    pool = rng.integers(0, 1 << 64, 60, np.uint64)
    pool[:4] = [0, 1, (1 << 64) - 1, (1 << 64) - 2]
    asked, own = [], {}
    for chunk in range(5):
        parts = []
        for n in (1, 2):
            keys = rng.choice(pool, 40 if chunk else 0)
            parts.append((n, *counting.counted(keys, rng.integers(0, 1 << 40, len(keys)))))
        own[chunk] = parts
        asked.append(counting.ask(chunk, buckets, parts))
    total = {}
    for parts in own.values():
        for n, keys, counts in parts:
            for key, count in zip(keys.tolist(), counts.tolist()):
                total[n, key] = total.get((n, key), 0) + count
    frame = spark.createDataFrame(
        [tuple(r.values()) for t in asked for r in t.to_pylist()], counting.ASKED
    )
    back = counting.answers(frame).toArrow()
    for chunk, parts in own.items():
        mine = back.filter(np.asarray(back.column("chunk")) == chunk)
        for n, keys, _ in parts:
            assert counting.answered(mine, n).tolist() == [total[n, k] for k in keys.tolist()]
    sums = counting.totals(frame).groupBy().sum("total", "distinct").first()
    assert tuple(sums) == (sum(total.values()), sum(v > 0 for v in total.values()))

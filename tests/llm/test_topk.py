"""op8 against all products."""

import numpy as np
import pytest

from racelake.llm import topk


LONG = 2**63 - 1


def brute(rows, k=5, every=50, scale=256):
    good = []
    for uid, (i, v) in enumerate(rows):
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        good.append((uid, i, [int(np.floor(scale * float(x))) for x in v]))
    out = []
    for uid, i, q in good:
        if i % every == 0:
            scores = sorted((-max(-LONG, min(LONG, sum(a * b for a, b in zip(q, v)))), j) for u, j, v in good if u != uid)[:k]  # noqa: B905
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int").repartition(4)


def result(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("bucket", [7, 64, 4096])
def test_top_k(spark, bucket):
    rng = np.random.default_rng(bucket)
    rows = [(int(i), [float(x) for x in np.float32(rng.normal(size=8) * rng.choice([0.1, 1, 3]))]) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)]                    # a group of equal vectors
    rows += [(2000, None), (2050, [1.0, None]), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8), (None, rows[0][1])]
    rows += [(2200, []), (2250, [0.0] * 8), (2300, [1.0, 2.0]), (-50, rows[5][1]), (50, rows[6][1])]
    assert result(topk.top_k(table(spark, rows), bucket=bucket)) == brute(rows)


def test_few_and_none(spark):
    rows = [(0, [1.0, 0.5]), (1, [2.0, -1.0]), (50, [1.0, 0.5])]
    assert result(topk.top_k(table(spark, rows))) == brute(rows)
    assert result(topk.top_k(table(spark, [(0, [1.0])]))) == []
    assert topk.top_k(table(spark, [])).count() == 0


@pytest.mark.parametrize("bucket", [2, 4096])
def test_large_components_take_part(spark, bucket):
    big = [float(2**22), float(2**31), 5e6, 2.0**54]
    rows = [(50, [1.0, 1.0]), (1, [5e6, 0.0]), (2, [1.0, 0.0]), (100, [2.0**22, -1.0]), (150, [0.0, 2.0**-8])]
    rows += [(10 + i, [b, -float(i)]) for i, b in enumerate(big)]
    assert result(topk.top_k(table(spark, rows), bucket=bucket)) == brute(rows)
    assert topk.top_k(table(spark, rows)).where("query_id = 50 and rank = 1").first()["vec_id"] == 13
    # scores beyond a long are held at its end, and tie there
    huge = [(50, [3e38]), (3, [3e38]), (2, [3e38]), (1, [-3e38]), (4, [0.0])]
    got = {(r.rank, r.vec_id): r.score for r in topk.top_k(table(spark, huge), bucket=bucket).collect()}
    assert got == {(1, 2): 2**63 - 1, (2, 3): 2**63 - 1, (3, 4): 0, (4, 1): -(2**63 - 1)}


def test_pruning_skips_short_vectors():
    rng = np.random.default_rng(0)
    m = np.sort(rng.integers(1, 50, 300))[::-1]
    lists = [[int(x), 0] for x in m]
    b = topk.Bucket(range(300), range(300), lists, [float(x) for x in m])
    assert b.best(-1, np.array([10, 0]), 10.0, 10 * int(m[4]), 5) == [(10 * int(x), i) for i, x in enumerate(m[:5])]
    assert b.best(-1, np.array([10, 0]), 10.0, 10 * int(m[0]) + 1000, 5) == []


def test_products_stay_exact_beyond_doubles():
    big = 2**30
    m = np.array([[big, 1], [big, 3]])
    assert topk.products(m, np.array([big, 1])).tolist() == [big * big + 1, big * big + 3]

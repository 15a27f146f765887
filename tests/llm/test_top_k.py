"""Exact top-k over blocks of packed vectors, against plain sums; what it moves."""

import random

import pytest

from cladegrid.llm import topk

SMALL = topk.Sizes(ring=16, strip=8, piece=(20, 40), block=(5, 12), first=7, blob=1 << 12, waiting=50)


def plain(rows, queries, k):
    """Rows and queries as (id, integers); repeated rows are repeated candidates."""
    out = []
    for q, v in queries:
        scored = sorted((-sum(a * b for a, b in zip(v, x)), i) for i, x in rows if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def found(spark, rows, queries, k, **build):
    frame = lambda x: spark.createDataFrame(x, "id long, vector array<long>")
    index = topk.build_index(frame(rows), **build)
    return sorted(tuple(r) for r in topk.search(index, frame(queries), k, SMALL).collect())


def shuffled_records(spark):
    context = spark.sparkContext
    store, jvm, gateway = context._jsc.sc().statusStore(), context._jvm, context._gateway
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = store.stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}


def test_queries_are_not_repeated_for_annuli(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-40, 40) for _ in range(24)]) for i in range(4000)]
    index = topk.build_index(spark.createDataFrame(rows, "id long, vector array<long>"))
    assert len(index.rings) > 150
    before = shuffled_records(spark)
    out = topk.search(index, index.rows.where("id % 20 = 0").select("id", "vector"), 3).collect()
    moved = sum(n for stage, n in shuffled_records(spark).items() if stage not in before)
    assert len(out) == 600 and moved < 4 * len(rows)


def test_small_pieces_blocks_and_bundles_with_equal_scores(spark):
    rng = random.Random(2)
    rows = [(i, [rng.randrange(-2, 3) for _ in range(5)]) for i in range(400)]
    rows += [(400 + i, [1, 1, 0, 0, 2]) for i in range(90)] + [(600 + i, [0] * 5) for i in range(30)]
    rows += [(40, [2, 2, 2, 2, 2])] * 9 + [(700, [3, 0, 0])] * 12 + [(20, [-1, 2])]
    queries = [(i, v) for i, v in rows[:390] if i % 10 == 0 and i not in (20, 40)] + rows[400:420] + [(600, [0] * 5), (40, [2] * 5), (5000, [9, 9, 300, 0, 1])]
    assert found(spark, rows, queries, 6, pivots=7, rings=5) == plain(rows, queries, 6)


@pytest.mark.parametrize("scale", [1, 1000, 10**6, 5 * 10**8])
def test_scores_are_exact_in_every_type(spark, scale):
    rng = random.Random(scale)
    rows = [(i, [rng.randrange(-scale, scale + 1) for _ in range(4)]) for i in range(120)]
    queries = [(i, v) for i, v in rows if i % 6 == 0]
    assert found(spark, rows, queries, 5, pivots=4, rings=4) == plain(rows, queries, 5)


def test_fewer_rows_than_asked_for_and_sums_beyond_a_long(spark):
    rows = [(1, [3, 4]), (2, [1, 0]), (3, [0, 2])]
    assert found(spark, rows, rows, 20) == plain(rows, rows, 20)
    assert found(spark, [(1, [3, 4])], [(1, [3, 4])], 20) == []
    assert found(spark, rows, [], 20) == []
    hollow = [(3, []), (1, []), (2, [])]
    assert found(spark, hollow, hollow[:1], 1) == [(3, 1, 1, 0)]
    with pytest.raises(ValueError):
        found(spark, [(1, [2**62, 2**62]), (2, [1, 1])], [(1, [2**62, 2**62])], 1)

import random

import pytest

from glotspark.functions.storage import Scratch
from glotspark.llm import mixing

DDL = "doc_id long, text string, source string, size long"


def targets(sizes):
    """Sources with sizes, by the rule as it is told: share, cap, share the excess again."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, list(order), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        above = [s for s in free if left * weight[s] / total >= 2 * sizes[s]]
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free = [s for s in free if s not in above]
    return target


def corpus(sources, docs, seed=1):
    draw = random.Random(seed)
    return [
        (i, " ".join("w" * draw.randint(1, 60) for _ in range(int(draw.paretovariate(1.2) * 20))),
         draw.choice(sources), 0)
        for i in range(docs)
    ]


@pytest.mark.parametrize("docs", [300, 3000])
def test_targets_and_balance(spark, docs):
    hot = ["a"] * 6 + ["b", "é", "", None]
    rows = corpus(hot, docs) + [(None, None, "a", 0), (-1, "", None, 0), (-2, " \t ", "zero", 0)]
    with Scratch(spark) as scratch:
        df = spark.createDataFrame(rows, DDL).repartition(7)
        got = mixing.mix(df, scratch).collect()
        again = mixing.mix(df.repartition(3), scratch).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.copy)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    by_id = {r.doc_id: r for r in sorted(got, key=key)}
    sizes, taken, sources = {}, {}, {row[0]: row[2] for row in rows}
    for row in got:
        source = sources[row.doc_id]
        sizes[source] = sizes.get(source, 0) + row.size
        taken[source] = taken.get(source, 0) + row.taken
        assert 0 <= row.taken <= 2 * row.size
        assert row.taken == row.times * row.size
    wanted = targets(sizes)
    for row in got:
        source = sources[row.doc_id]
        assert row.source_size == sizes[source]
        assert row.target == pytest.approx(wanted[source])
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 0.03 * target + 20, source
    assert by_id[-2].size == by_id[-1].size == by_id[None].size == 0


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c", "s", 0)] * 4 + [(2, "d e", "t", 0)]
    with Scratch(spark) as scratch:
        assert mixing.mix(spark.createDataFrame(rows, DDL), scratch).count() == 5
        assert mixing.mix(spark.createDataFrame([], DDL), scratch).count() == 0


def test_chances_stay_on_average():
    """The flight and the landing keep every document's inclusion probability."""
    sizes = [40, 13, 7, 22, 90, 5, 31, 3] * 6
    hits = [0] * len(sizes)
    for seed in range(600):
        flight = mixing.Flight(str(seed))
        block = [(i, size, "s", 0, 0.3) for i, size in enumerate(sizes)]
        for row, chance in flight.land(block):
            assert chance in (0.0, 1.0)
            hits[row[0]] += chance
    assert all(0.2 < hit / 600 < 0.4 for hit in hits)

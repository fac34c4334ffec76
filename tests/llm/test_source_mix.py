"""The mix's targets, schedule and takings."""

from collections import defaultdict

import pytest

from rentpulse.llm import source_mix


def targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    return {r.source: r for r in source_mix.source_targets(rows).collect()}


def plain_targets(sizes):
    """Share by weight, cap, share what is left again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        rate = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * rate > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * rate for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return out


@pytest.mark.parametrize(
    "sizes", [{"a": 100, "b": 100, "c": 100, None: 7}, {"z": 5, "é": 1000, "Z": 30, "y": 0}, {"only": 9}, {"a": 0, "b": 0}]
)
def test_targets(spark, sizes):
    got = targets(spark, sizes)
    assert {s: r.target for s, r in got.items()} == pytest.approx(plain_targets(sizes))


def test_schedule_is_complete_and_spread_out(spark):
    sizes = {"a": 60_000, "b": 30_000, "c": 9_000, "d": 40}
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    wanted = source_mix.source_targets(rows)
    slots = defaultdict(list)
    for r in source_mix.schedule(wanted, 16).collect():
        slots[r.sid].append((r["rank"], r.slot))
    total = sum(map(len, slots.values()))
    for r in wanted.collect():
        ranked = sorted(slots[r.sid])
        assert [rank for rank, _ in ranked] == list(range(-(-round(r.target) // 16)))
        assert [slot for _, slot in ranked] == sorted(slot for _, slot in ranked)
        if len(ranked) > 500:  # any stretch of the schedule has about the source's share
            share = len(ranked) / total
            in_first_half = sum(slot < total // 2 for _, slot in ranked)
            assert abs(in_first_half - share * (total // 2)) < 12


def test_awkward_rows(awkward):
    got = source_mix.mix(awkward.select("doc_id", "source", "text"), block_tokens=64).collect()
    assert len(got) == awkward.count()
    by_source = defaultdict(int)
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"]
        by_source[r.source_size, r.target] += r.taken
    for (_, target), taken in by_source.items():
        assert abs(taken - target) <= 1
    assert {r["size"] for r in got if r.doc_id in (1, 2, 3)} == {0}


def test_reruns_agree_whatever_the_partitions(documents):
    once = source_mix.mix(documents.select("doc_id", "source", "text"))
    again = source_mix.mix(documents.select("doc_id", "source", "text").repartition(7))
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))


def test_mixed_documents_keep_their_columns(awkward):
    got = source_mix.mixed_documents(awkward)
    assert got.columns == awkward.columns
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    assert {1, 2, 3} <= set(ids) and max(ids.count(i) for i in (4, 5, 6, 7)) <= 2


def test_no_rows(nothing):
    assert source_mix.mix(nothing).count() == 0
    assert source_mix.mixed_documents(nothing).count() == 0

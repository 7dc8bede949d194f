"""Mixing: targets by resharing, totals near targets, bounds, reruns."""

import random
import re

import pytest

from retally.llm.mixing import mix

SCHEMA = "doc_id long, text string, source string, size string, place string, copies string"


def slow_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    free, rest, found = set(names), sum(sizes.values()), {}
    while free:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            found.update(share)
            break
        for s in over:
            found[s] = most * sizes[s]
            free.discard(s)
            rest -= found[s]
    return found


def check(frame, near=0.01):
    got = mix(frame, ["doc_id"]).collect()
    words = {}
    for r in frame.collect():
        words.setdefault(r.source, []).append((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))))
    sizes = {s: sum(n for _, n in v) for s, v in words.items()}
    targets = slow_targets(sizes)
    source = {d: s for s, v in words.items() for d, _ in v}
    taken = dict.fromkeys(words, 0)
    assert sorted((r.doc_id, r["size"]) for r in got) == sorted(x for v in words.values() for x in v)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(targets[s], abs=1e-6)
        assert r.taken == r.copies * r["size"] and 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    for s, n in taken.items():
        assert abs(n - targets[s]) <= near * max(targets[s], 1) + 5, (s, n, targets[s])
    return sorted((r.doc_id, r.taken) for r in got)


def test_targets_are_met_with_hot_cells_and_capped_sources(spark):
    rng = random.Random(9)
    rows = [(i, "w " * 12, "hot", "", "", "") for i in range(1500)]                                  # one hot (source, size)
    rows += [(2000 + i, "w " * rng.randrange(1, 400), rng.choice(["b", "c", "d", None, "é"]), "", "", "") for i in range(500)]
    rows += [(3000, "w " * 60000, "c", "", "", ""), (3001, None, "b", "", "", ""), (3002, " \n", "zero", "", "", ""), (3003, "w", "a", "", "", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert check(frame.repartition(5)) == check(frame.repartition(3))


def test_whole_table(spark):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), near=0.03)


def test_edge_tables(spark):
    assert mix(spark.createDataFrame([], SCHEMA), ["doc_id"]).count() == 0
    blank = mix(spark.createDataFrame([(1, None, None, "", "", "")], SCHEMA), ["doc_id"]).collect()
    assert [(r["size"], r.target, r.taken) for r in blank] == [(0, 0.0, 0)]
    row = (1, "a b c", "s", "", "", "")
    twice = mix(spark.createDataFrame([row, row], SCHEMA), ["doc_id"]).collect()
    assert [r.taken for r in twice] == [3, 3]


def test_rates_equal_an_independent_solution(spark):
    """The dual solved by bisection in plain Python: same multipliers, and copies that follow the tilted rates."""
    import math

    from retally.llm.mixing import multipliers, source_targets

    rng = random.Random(21)
    rows = [(k, "w " * (rng.randrange(1, 60) if s else rng.randrange(1, 900)), s, "", "", "")
            for k, s in enumerate(rng.choice(["a", "b", "b", "c", None]) for _ in range(900))]
    frame = spark.createDataFrame(rows, SCHEMA)
    cells = {}
    for r in rows:
        n = len(r[1].split())
        cells.setdefault(r[2], {})[n] = cells.get(r[2], {}).get(n, 0) + 1
    counted = spark.createDataFrame([(s, x, n) for s, c in cells.items() for x, n in c.items()], "source string, size long, n long")
    sources = source_targets(counted.groupBy("source").agg((quality_sum(counted)).alias("source_size")))
    placed = counted.join(sources, counted["source"].eqNullSafe(sources["source"])).select("place", "size", "n")
    got = {r.place: r for r in multipliers(placed, sources).collect()}
    solved = 0
    for r in sources.collect():
        if not 0 < r.target < 3 * r.source_size * (1 - 1e-6):
            continue
        c = cells[r.source]
        mean = sum(x * n for x, n in c.items()) / sum(c.values())

        def words(m):
            return sum(n * x * 3 / (1 + 2 * math.exp(-m * x / mean)) for x, n in c.items())

        low, high = -50.0, 50.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if words(mid) < r.target else (low, mid)
        assert got[r.place]["multiplier"] == pytest.approx(low, abs=1e-5), r
        solved += 1
    assert solved >= 2
    # exponentially tilted rates: within a source the copies per document follow the solved rate of its size, to a rounding
    taken = {}
    for r in mix(frame, ["doc_id"]).collect():
        taken.setdefault((rows[r.doc_id][2], r["size"]), []).append(r.copies)
    for r in sources.collect():
        if r.place in got:
            for x, n in cells[r.source].items():
                want = n * 3 / (1 + 2 * math.exp(-got[r.place]["multiplier"] * x / got[r.place]["mean"]))
                carried = max(cells[r.source]) / x          # words owed by larger sizes, in copies of this one
                assert abs(sum(taken[r.source, x]) - want) <= 1 + carried


def quality_sum(counted):
    from pyspark.sql import functions as F
    return F.sum(F.col("size") * F.col("n"))


def test_an_unsolved_source_is_an_error(spark, monkeypatch):
    from retally.llm import mixing

    monkeypatch.setattr(mixing, "STEPS", 1)
    rows = [(k, "w " * (1 + k % 50), "ab"[k % 3 == 0], "", "", "") for k in range(300)]
    with pytest.raises(ArithmeticError):
        mix(spark.createDataFrame(rows, SCHEMA), ["doc_id"]).count()

from __future__ import annotations

import random

import pytest

from fathomgrid.operators.hierarchy import descendants, hierarchy
from fathomgrid.plans.corpus import ticket_parents


def brute(parents: dict[str, str | None]) -> set[tuple]:
    known = {k: (p if p in parents else None) for k, p in parents.items()}
    out = set()
    for k in known:
        way = [k]
        while known[way[-1]] is not None and known[way[-1]] not in way:
            way.append(known[way[-1]])
        end = known[way[-1]]
        if end is None:
            out.add((k, way[-1], len(way) - 1, 0))
        else:
            at = way.index(end)
            out.add((k, min(way[at:]), at, 2 if at else 1))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_forests_with_cycles(spark, seed):
    r = random.Random(seed)
    n = r.choice((5, 30, 60))
    parents = {f"k{i:03d}": (f"k{r.randrange(n + 3):03d}" if r.random() < 0.85 else None) for i in range(n)}
    got = hierarchy(spark.createDataFrame(list(parents.items()), "key string, parent string"))
    assert {tuple(x) for x in got.collect()} == brute(parents)


def test_long_chain_and_one_long_cycle(spark):
    parents = {f"a{i:03d}": f"a{i - 1:03d}" if i else None for i in range(130)} | {f"c{i:02d}": f"c{(i + 1) % 37:02d}" for i in range(37)} | {"t0": "c05", "t1": "t0"}
    got = hierarchy(spark.createDataFrame(list(parents.items()), "key string, parent string"))
    assert {tuple(x) for x in got.collect()} == brute(parents)


def test_paths_and_descendants(spark):
    links = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "b"), ("x", "y"), ("y", "x"), ("z", "x")], "key string, parent string")
    tree = hierarchy(links, with_path=True)
    assert {r.key: list(r.path) for r in tree.collect() if not r.in_cycle} == {"a": ["a"], "b": ["a", "b"], "c": ["a", "b", "c"], "d": ["a", "b", "d"]}
    below = {(r.ancestor, r.descendant, r.distance) for r in descendants(tree.where("in_cycle = 0")).collect()}
    assert ("a", "c", 2) in below and ("b", "d", 1) in below and ("a", "a", 0) in below and len(below) == 9
    assert [list(r.path) for r in tree.where("key = 'z'").collect()] == [["x", "z"]]


def test_nulls_repeats_extra_columns_and_empty(spark):
    links = spark.createDataFrame([("a", None, 1), ("a", None, 1), (None, "a", 2), ("b", "gone", 3), ("s", "s", 4)], "key string, parent string, depth int")
    assert {tuple(r) for r in hierarchy(links).collect()} == {("a", "a", 0, 0), ("b", "b", 0, 0), ("s", "s", 0, 1)}
    assert hierarchy(spark.createDataFrame([], "key string, parent string")).count() == 0


def test_latest_row_counts(spark):
    rows = [(1, "A-1", "B-1", "2026-01-01T00:00:00Z"), (2, " a-1\n", "", "1767225600000"), (3, "A-1", "C-1", None), (4, None, "A-1", None), (5, "B-1", "a-1 ", "2026-01-01 00:00:00")]
    got = ticket_parents(spark.createDataFrame(rows, "load_id long, key string, parent_key string, updated string"))
    assert {tuple(r) for r in got.collect()} == {("A-1", None), ("B-1", "A-1")}

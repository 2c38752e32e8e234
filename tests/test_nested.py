from __future__ import annotations

import json

from pyspark.sql import functions as F

from fathomgrid.operators import nested


def test_flatten_keeps_links_and_ordinals(spark):
    schema = "id long, name string, _label string, outer array<struct<a:string,inner:array<struct<b:int>>,s:struct<c:string>>>, tags array<string>, m map<string,int>"
    rows = [(1, "x", "clash", [("p", [(1,), None, (3,)], ("q",)), None, ("r", None, None)], ["t", None], {"k": 1}), (2, None, None, None, [], None)]
    tables = nested.flatten(spark.createDataFrame(rows, schema), "id")
    assert set(tables) == {"", "outer", "outer.inner", "tags", "m"}
    assert {(r._id, r.name, r["_label_"]) for r in tables[""].collect()} == {(1, "x", "clash"), (2, None, None)}
    outer = {(r._id, tuple(r._label), tuple(r._parent), r.a, r.s_c) for r in tables["outer"].collect()}
    assert outer == {(1, (0,), (), "p", "q"), (1, (2,), (), "r", None)}
    assert {(tuple(r._label), tuple(r._parent), r.b) for r in tables["outer.inner"].collect()} == {((0, 0), (0,), 1), ((0, 2), (0,), 3)}
    assert {(tuple(r._label), r.value) for r in tables["tags"].collect()} == {((0,), "t")}
    assert {(r.key, r.value) for r in tables["m"].collect()} == {("k", 1)}


def test_repeats_and_nulls_keep_their_places(spark):
    rows = [(1, [("a",), None, ("a",), ("",), ("",), (None,), ("b",), ("a",)]), (2, None), (3, [])]
    df = spark.createDataFrame(rows, "load_id long, c array<struct<id:string>>")
    kept = df.withColumn("c", nested.without_repeats(F.col("c"), "id"))
    found = lambda d: {(r.load_id, r.child, r.pos, r.parent_pos) for r in nested.placed(nested.labels(d, "load_id"), "load_id", {"c": "comment"}).collect()}
    assert found(kept) == {(1, "comment", p, -1) for p in (0, 3, 4, 5, 6)}
    assert found(df) == {(1, "comment", p, -1) for p in (0, 2, 3, 4, 5, 6, 7)}
    assert kept.where("load_id > 1").select("c").collect() == df.where("load_id > 1").select("c").collect()


def test_long_arrays_with_repeats(spark):
    df = spark.range(1).select(F.col("id").alias("load_id"), F.transform(F.sequence(F.lit(0), F.lit(59_999)), lambda i: F.struct((i % 20_000).cast("string").alias("id"))).alias("c"))
    kept = nested.labels(df.withColumn("c", nested.without_repeats(F.col("c"), "id")), "load_id")
    assert kept.agg(F.count(F.lit(1)), F.max(F.col("label")[0])).first()[:] == (20_000, 19_999)


def test_labels_of_all_depths_agree_with_the_tables(spark):
    schema = "id long, path string, outer array<struct<a:string,inner:array<struct<b:int>>,m:map<string,array<int>>>>, w array<array<int>>"
    rows = [(1, "x", [("p", [(1,), None, (3,)], {"k": [5, None]}), None, ("r", None, None)], [[1], None, [2, 3]]), (2, None, None, []), (3, None, [], None)]
    df = spark.createDataFrame(rows, schema)
    tables = nested.flatten(df, "id")
    want = {(r._id, at, tuple(r._label), tuple(r._parent)) for at, t in tables.items() if at for r in t.collect()}
    assert {(r.id, r.path, tuple(r.label), tuple(r.parent)) for r in nested.labels(df, "id").collect()} == want
    assert nested.labels(df.select("id", "path"), "id").count() == 0


def test_trees_in_text(spark):
    doc = {"type": "doc", "content": [{"type": "p", "content": [{"type": "text", "text": "a"}]}, None, "x", {"type": "q", "content": None}]}
    deep = {"type": "doc"}
    for _ in range(300):
        deep = {"type": "n", "content": [deep]}
    texts = [json.dumps(doc), json.dumps(json.dumps(doc)), json.dumps(doc)[:-3], "", None, "[]", '"x"', json.dumps(deep), "{} {}"]
    df = spark.createDataFrame(list(enumerate(texts)), "load_id long, adf string")
    links = {}
    for r in nested.tree_links(df, "load_id", "adf").collect():
        links.setdefault(r.load_id, []).append((r.pos, r.parent_pos))
    assert sorted(links[0]) == sorted(links[1]) == [(0, -1), (1, 0), (2, 1), (3, 0)]
    assert set(links) == {0, 1, 7} and len(links[7]) == 301
    nodes = {(r.pos, r.label, r.type, r.text) for r in nested.tree_nodes(df.where("load_id = 0"), "load_id", "adf").collect()}
    assert nodes == {(0, "", "doc", None), (1, "0", "p", None), (2, "0.0", "text", "a"), (3, "3", "q", None)}
    assert nested.tree_links(spark.createDataFrame([], "load_id long, adf string"), "load_id", "adf").count() == 0

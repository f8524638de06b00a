"""The operators of p1 and p3 to p5 against brute force, and their edge cases."""

from __future__ import annotations

import json
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from citeloom.functions.jsonvalue import EMPTY, value_digest
from citeloom.operators.eager_join_agg import Measure, eager_join_aggregate
from citeloom.operators.nested_tables import KNOWN, REFERENCE_VARIANTS, TABLES, ShapeAutomaton, is_typed, nested_rows, nested_table, typed_columns, variants_with
from citeloom.operators.orphans import latest_parents, orphan_references
from citeloom.operators.snapshot_diff import _levels, level_pairs, snapshot_changes
from tests.conftest import rows

T = datetime(2025, 1, 1)


# --- p1


def _clashing(spark, values, schema):
    """A frame with columns that have the names the operators use inside."""
    return spark.createDataFrame(values, schema).withColumns({"__k0": F.lit(1), "__leftn": F.lit(1), "n": F.lit(1), "item": F.lit("x"), "unit": F.lit(0), "side": F.lit(1)})


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_eager_join_equals_join(spark, how):
    left = _clashing(spark, [("a", "p", 1), ("a", "q", 2), ("a", "p", None), ("b", "p", 4), (None, "p", 5), ("a", "p", 1)], "k string, g string, v int")
    right = spark.createDataFrame([("a", 10), ("a", 20), ("c", 30), (None, 40), ("a", None)], "k string, w int")
    measures = [Measure("pairs", "pairs"), Measure("sum", "sv", "left", "v"), Measure("sum", "sw", "right", "w"), Measure("min", "mv", "left", "v"), Measure("max", "mw", "right", "w"), Measure("count", "cv", "left", "v")]
    got = eager_join_aggregate(left, right, ["k"], measures, group_left=["g"], how=how)
    plain = left.select("k", "g", "v").join(right, "k", how).groupBy("k", "g").agg(F.count(F.lit(1)), F.sum("v"), F.sum("w"), F.min("v"), F.max("w"), F.count("v"))
    assert rows(got) == rows(plain)


def test_eager_join_empty(spark):
    none = spark.createDataFrame([], "k string, v int")
    some = spark.createDataFrame([("a", 1)], "k string, v int")
    assert rows(eager_join_aggregate(none, some, ["k"], [Measure("pairs", "n")])) == []
    assert rows(eager_join_aggregate(none, some, ["k"], [Measure("left_rows", "l"), Measure("right_rows", "r")], how="full")) == [("a", 0, 1)]


def test_hot_key_reaches_the_join_as_one_state(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("k"), F.col("id").cast("int").alias("v"))
    assert rows(eager_join_aggregate(hot, hot, ["k"], [Measure("pairs", "n"), Measure("sum", "s", "left", "v")])) == [("hot", 9_000_000, 3000 * sum(range(3000)))]


# --- p3


FILES = [
    (1, "1.json", '{"items":[{"DOI":"a","reference":[{"unstructured":"x","doi-asserted-by":"publisher"},"text",[],null,{"unstructured":5},{"unstructured":""}]},7,{"reference":{"unstructured":"no"}}]}'),
    (2, "2.json", '{"items":{"reference":[{"unstructured":"no"}]}}'),
    (3, "3.json", '{"items":[{"reference":[{"unstructured":"no"}]}]} trailing'),
    (4, "4.json", '{"items":[{"reference":[{"unstructured":"a","unstructured":"b"}'),
    (5, None, None), (6, "6.json", ""), (7, "7.json", "[1]"), (8, "8.json", '{"items":[{"reference":[{"unstructured":"\\ud800","doi-asserted-by":null,"nested":{"unstructured":"no"}}]}]}'),
    (9, "9.json", '{"items":[{"reference":[{"unstructured":NaN}]}]}'), (10, "1.json", '{"items":[{"DOI":1,"reference":[{"DOI":"10.1/x","doi-asserted-by":"crossref"}]}]}'),
]


def _nested(spark, tables=("files", "items", "references", "fields")):
    frame = spark.createDataFrame(FILES, "record_no bigint, file_name string, raw_json string").withColumns({"table_name": F.lit("x"), "kind": F.lit("y")})
    return nested_rows(frame, "record_no", "file_name", "raw_json", tables)


def test_nested_tables(spark):
    all_rows = _nested(spark)
    files = {r.record_no: (r.variant, r.n_items) for r in nested_table(all_rows, "files").collect()}
    assert files == {1: ("items_list", 3), 2: ("items_object", 0), 3: ("broken", 0), 4: ("broken", 0), 5: ("broken", 0), 6: ("broken", 0), 7: ("list", 0), 8: ("items_list", 1), 9: ("broken", 0), 10: ("items_list", 1)}
    items = [(r.record_no, r.item_pos, r.doi, r.variant, r.n_references) for r in nested_table(all_rows, "items").orderBy("record_no", "item_pos").collect()]
    assert items == [(1, 0, "a", "references_list", 6), (1, 1, None, "number", 0), (1, 2, None, "references_object", 0), (8, 0, None, "references_list", 1), (10, 0, None, "references_list", 1)]
    refs = {(r.record_no, r.ref_pos): r.variant for r in nested_table(all_rows, "references").collect()}
    assert refs == {(1, 0): "unstructured", (1, 1): "string", (1, 2): "list", (1, 3): "null", (1, 4): "other", (1, 5): "unstructured", (8, 0): "unstructured", (10, 0): "asserted"}
    fields = {(r.record_no, r.ref_pos, r.field_name): (r.kind, r.value) for r in nested_table(all_rows, "fields").collect()}
    assert fields[(1, 4, "unstructured")] == ("number", "5") and fields[(1, 5, "unstructured")] == ("string", "") and fields[(8, 0, "unstructured")] == ("string", "�")
    assert fields[(8, 0, "nested")] == ("object", '{"unstructured": "no"}') and fields[(8, 0, "doi-asserted-by")] == ("null", None)


def test_typed_tables_hold_every_object_once(spark):
    names = [n for n, _ in REFERENCE_VARIANTS]
    all_rows = _nested(spark, [*TABLES, *names])
    refs = {(r.record_no, r.item_pos, r.ref_pos): r for r in nested_table(all_rows, "references").collect()}
    seen = {}
    for name, required in REFERENCE_VARIANTS:
        own = nested_table(all_rows, name)
        assert own.columns == ["record_no", "item_pos", "ref_pos", "shape", "typed", *(f.lower().replace("-", "_") for f in typed_columns(name))]
        for r in own.collect():
            key = (r.record_no, r.item_pos, r.ref_pos)
            assert key not in seen and refs[key].variant == name and refs[key].shape == r.shape
            seen[key] = {f for i, f in enumerate(KNOWN) if r.typed >> i & 1}
            assert set(required) <= seen[key] <= set(typed_columns(name))
            assert all((refs[key][f.lower().replace("-", "_")] is not None) == (f in seen[key]) for f in KNOWN)
            assert all(r[f.lower().replace("-", "_")] == refs[key][f.lower().replace("-", "_")] for f in typed_columns(name))
    assert seen.keys() == {k for k, r in refs.items() if r.variant in names}
    assert variants_with("DOI") == ["asserted", "linked"] and variants_with("doi-asserted-by") == ["asserted", "unstructured", "titled", "serial", "web", "other"]
    pruned = nested_rows(spark.createDataFrame(FILES, "record_no bigint, file_name string, raw_json string"), "record_no", "file_name", "raw_json", names, ["typed", "doi"])
    assert pruned.columns == ["table_name", "record_no", "item_pos", "ref_pos", "typed", "doi"] and pruned.where(is_typed("DOI")).count() == pruned.where("doi IS NOT NULL").count() == 1


def test_numbers_are_kept_as_written_and_depth_is_no_bound(spark):
    numbers = ["9" * 6000, "1e400", "0.12345678901234567890", "-0.0", "1E+2"]
    deep = '{"x":' * 3000 + "1" + "}" * 3000
    doc = '{"items":[{"reference":[{"n":%s},{"l":[%s]},%s]}]}' % (numbers[0], ",".join(numbers), deep)
    got = nested_rows(spark.createDataFrame([(1, "f", doc)], "record_no bigint, file_name string, raw_json string"), "record_no", "file_name", "raw_json", ["fields", "items", "references"])
    values = {r.field_name: r.value for r in nested_table(got, "fields").collect()}
    assert values["n"] == numbers[0] and values["l"] == "[" + ", ".join(numbers) + "]" and values["x"] == deep[5:-1].replace(":", ": ")
    assert nested_table(got, "references").count() == 3


def test_every_row_has_its_parent(spark, data):
    frame = spark.read.parquet(f"{data}/work_files.parquet")
    t = {n: nested_table(nested_rows(frame, "record_no", "file_name", "raw_json"), n) for n in ("files", "items", "references", "fields")}
    assert t["items"].join(t["files"], "record_no", "left_anti").count() == 0
    assert t["references"].join(t["items"], ["record_no", "item_pos"], "left_anti").count() == 0
    assert t["fields"].join(t["references"], ["record_no", "item_pos", "ref_pos"], "left_anti").count() == 0
    assert t["files"].count() == frame.count()


def test_nested_against_brute_force(spark, data):
    want = []
    for record_no, raw in spark.read.parquet(f"{data}/work_files.parquet").select("record_no", "raw_json").collect():
        try:
            doc = json.loads(raw or "")
        except ValueError:
            continue
        for i, item in enumerate(doc["items"] if isinstance(doc, dict) and isinstance(doc.get("items"), list) else []):
            for j, ref in enumerate(item["reference"] if isinstance(item, dict) and isinstance(item.get("reference"), list) else []):
                want += [(record_no, i, j, f) for f in ("doi-asserted-by", "unstructured") if isinstance(ref, dict) and isinstance(ref.get(f), str)]
    assert rows(entry.queries()["p3_found"](spark, data)) == sorted(want, key=lambda t: [(True, str(v)) for v in t])


def test_shapes():
    a = ShapeAutomaton()
    assert a.state({"x": 1, "y": "s"}) == a.state({"y": "t", "x": 2.5}) == ShapeAutomaton().state({"x": 0, "y": ""})
    assert len({a.state(v) for v in ({}, [], "", 0, True, None, {"x": 1}, {"x": "1"}, {"y": 1}, [1], ["1"], [1, "1"], {"x": {}}, {"x": []})}) == 14
    assert a.state([1, 2, 3]) == a.state([4])


def test_nested_empty(spark):
    none = spark.createDataFrame([], "record_no bigint, file_name string, raw_json string")
    assert nested_rows(none, "record_no", "file_name", "raw_json").count() == 0


# --- p4


def _refs(spark, values):
    return _clashing(spark, values, "src_table string, key string, written_at timestamp, row_no bigint")


def test_orphans(spark):
    parents = spark.createDataFrame([("a", T, None), ("b", T, T + timedelta(days=9)), ("c", None, None), (None, T, None)], "key string, starts_at timestamp, ends_at timestamp")
    day = lambda n: T + timedelta(days=n)
    refs = [("r", "a", day(0), 1), ("r", "a", day(-1), 2), ("r", "b", day(8), 3), ("r", "b", day(9), 4), ("r", "c", day(5), 5), ("r", "z", day(5), 6), ("r", None, day(5), 7), ("r", "a", None, 8), ("r", "z", None, 9), ("r", "z", day(5), 6), ("s", "z", day(5), 6)]
    got = orphan_references(_refs(spark, refs), parents)
    assert sorted((r.src_table, r.row_no) for r in got.collect()) == [("r", 2), ("r", 4), ("r", 5), ("r", 6), ("r", 6), ("r", 9), ("s", 6)]
    assert orphan_references(_refs(spark, refs).limit(0), parents).count() == 0
    assert orphan_references(_refs(spark, refs), parents.limit(0)).count() == 10


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_orphans_with_a_hot_key(spark, ranges):
    keys = ["hot"] * 2000 + [f"k{i}" for i in range(600)]
    parents = spark.createDataFrame([(f"k{i}", T, None) for i in range(0, 600, 2)] + [("hot", T + timedelta(hours=500), None)], "key string, starts_at timestamp, ends_at timestamp")
    refs = _refs(spark, [("r", k, T + timedelta(hours=i), i) for i, k in enumerate(keys)])
    want = sorted([i for i in range(500)] + [2000 + i for i in range(600) if i % 2])
    assert sorted(r.row_no for r in orphan_references(refs, parents, ranges).collect()) == want


def test_latest_parents(spark):
    values = [(1, "a", T, None, T), (2, "a", T, T, T + timedelta(days=1)), (3, "a", None, None, None), (4, None, T, None, T), (5, "b", T, None, T), (6, "b", T, T, T)]
    records = spark.createDataFrame(values, "i bigint, k string, s timestamp, e timestamp, d timestamp")
    assert rows(latest_parents(records, "k", "s", "e", "d", "i")) == [("a", T, T), ("b", T, T)]


# --- p5


def test_value_digest():
    same = ['[{"a":1,"b":"ü"}]', '[ {"b":"\\u00fc", "a":1.0, "c":null} ]', '[{"b":"ü","a":10e-1}]']
    assert len({value_digest(x) for x in same}) == 1
    assert {value_digest(x) for x in (None, "", " ", "null", "[]", " [ ] ")} == {EMPTY}
    unlike = ['[{"a":1}]', '[{"a":"1"}]', '[{"a":true}]', '[{"a":1.5}]', "[{}]", "[null]", '[{"a":1},{"a":2}]', '[{"a":2},{"a":1}]', "[1", "{}", '[{"a":[1,2]}]', '[{"a":[2,1]}]', '[{"a":{"b":1}}]']
    assert len({value_digest(x) for x in unlike}) == len(unlike)
    assert value_digest('[{"a":{"b":null}}]') == value_digest('[{"a":{}}]')
    assert value_digest("[" * 100_000) != EMPTY and value_digest("[" + "9" * 6000 + "]") == value_digest("[" + "9" * 6000 + ".0]")


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        ("0.12345678901234567890123456789012", "0.12345678901234567890123456789013", False), ("9" * 402, "9" * 401 + "8", False), ("9" * 6000, "1" + "0" * 6000, False), ("1e400", "1e401", False), ("1e" + "9" * 5000, "1e" + "9" * 4999 + "8", False),
        ("1" + "0" * 6000, "1e6000", True), ("1e" + "9" * 5000, "10e" + "9" * 4999 + "8", True), ("1234567890123456", "1.234567890123456E+15", True), ("-0", "0.0e7", True), ("1.50", "15e-1", True), ('{"\\u0000":"15e-1"}', "1.5", False), ('"1"', "1", False),
    ],
)
def test_numbers_are_compared_exactly(a, b, same):
    assert (value_digest(f"[{a}]") == value_digest(f"[{b}]")) is same


def test_few_nodes_are_looked_at(spark):
    """One altered row of 100,000: 32 nodes of every level are looked at."""
    day = spark.range(100_000).select(F.col("id").cast("string").alias("key"), F.xxhash64("id").alias("digest"))
    rows_ = day.select(F.lit("1").alias("snapshot"), "*").unionByName(day.select(F.lit("2").alias("snapshot"), "key", F.when(F.col("key") == "77", 5).otherwise(F.col("digest")).alias("digest")))
    depth = 3
    rows_ = rows_.withColumn("node", F.shiftrightunsigned(F.xxhash64("key"), 64 - depth * 5))
    pairs = spark.createDataFrame([("2", "1")], "snapshot string, before string")
    found, seen = None, []
    for level in _levels(rows_, depth):
        both = level_pairs(pairs, level, found).cache()
        seen.append(both.count())
        found = both.where("new <> old").select("snapshot", "before", "node")
    assert seen == [32, 32, 32] and found.count() == 1


def _snapshots(spark, values):
    return spark.createDataFrame(values, "day string, k string, j string, d timestamp").withColumns({"node": F.lit(1), "snapshot": F.lit("x"), "digest": F.lit(0)})


@pytest.mark.parametrize("leaf_rows", [1, 32])
def test_changes(spark, leaf_rows):
    values = [
        ("1", "a", "[1]", T), ("1", "b", None, T), ("1", "c", "[1]", T), ("1", "d", "[1]", T), ("1", None, "[1]", T), (None, "z", "[1]", T),
        ("3", "a", "[2]", T), ("3", "a", "[1]", T + timedelta(days=1)), ("3", "b", "[]", T), ("3", "c", "[2]", T), ("3", "e", "[1]", T), ("3", "e", "[1]", T),
        ("4", None, "[1]", T), ("5", "a", "[1]", None),
    ]
    got = snapshot_changes(_snapshots(spark, values), "day", F.col("k"), "j", "d", leaf_rows)
    assert rows(got) == [("3", "c", "altered"), ("3", "d", "removed"), ("3", "e", "added"), ("4", "a", "removed"), ("4", "b", "removed"), ("4", "c", "removed"), ("4", "e", "removed"), ("5", "a", "added")]


def test_changes_of_none_or_one(spark):
    one = _snapshots(spark, [("1", "a", "[1]", T)])
    for frame in (one, one.limit(0)):
        assert snapshot_changes(frame, "day", F.col("k"), "j", "d").count() == 0


def test_changes_against_brute_force(spark, data):
    def plain(v):
        return {k: plain(x) for k, x in v.items() if x is not None} if isinstance(v, dict) else [plain(x) for x in v] if isinstance(v, list) else v

    held = defaultdict(dict)
    frame = spark.read.parquet(f"{data}/item_snapshots.parquet")
    keyed = frame.select("snapshot_day", F.lower(F.regexp_replace(F.regexp_replace("doi", r"\s", ""), "(?i)^doi:", "")).alias("k"), "reference", "delivered_at")
    for day, k, ref, _ in keyed.orderBy("delivered_at").collect():
        if k:
            held[day][k] = plain(json.loads(ref or "null")) or []
    want = []
    days = sorted(held)
    for before, day in zip(days, days[1:], strict=False):
        want += [(day, k, "added") for k in held[day].keys() - held[before].keys()] + [(day, k, "removed") for k in held[before].keys() - held[day].keys()]
        want += [(day, k, "altered") for k in held[day].keys() & held[before].keys() if held[day][k] != held[before][k]]
    assert rows(entry.queries()["p5_found"](spark, data)) == sorted(want)

import random

import pytest

from returnsmith.operators.lookup import Lookup, apply_chain, chosen_lookup, inline_table, lookup, routed_lookup, unmatched


@pytest.fixture
def data(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "z"), (5, "")], "id int, k string")


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(1, "a", "first"), (2, "a", "second"), (3, None, "of null"), (4, "b", ""), (5, "b", "late")],
                                 "seq long, k string, v string")


def test_first_and_last_wins_keep_the_row_count(data, dim, rows):
    assert rows(lookup(data, dim, {"k": "k"}, {"v": "v1"}), "id", "v1") == [
        (1, "first"), (2, ""), (3, "of null"), (4, None), (5, None)]
    assert rows(lookup(data, dim, {"k": "k"}, {"v": "v1"}, keep="last"), "id", "v1") == [
        (1, "second"), (2, "late"), (3, "of null"), (4, None), (5, None)]


def test_missing_keys_meet_only_when_asked(data, dim, rows):
    found = lookup(data, dim, {"k": "k"}, {"v": "v1"}, null_safe=False, match_flag="hit")
    assert rows(found, "id", "hit") == [(1, True), (2, True), (3, False), (4, False), (5, False)]


def test_keys_are_not_trimmed_unless_asked(spark, dim, rows):
    data = spark.createDataFrame([(1, " a ")], "id int, k string")
    assert rows(lookup(data, dim, {"k": "k"}, {"v": "v1"}), "v1") == [(None,)]
    assert rows(lookup(data, dim, {"k": "k"}, {"v": "v1"}, trim_keys=True), "v1") == [("first",)]


def test_equal_order_is_told_apart_by_value(spark, rows):
    dim = spark.createDataFrame([(1, "a", "y"), (1, "a", "x")], "seq long, k string, v string")
    data = spark.createDataFrame([("a",)], "k string")
    assert rows(lookup(data, dim, {"k": "k"}, {"v": "v1"}), "v1") == [("x",)]


def test_overwriting_a_column_is_refused(data, dim):
    with pytest.raises(ValueError, match="overwrite"):
        lookup(data, dim, {"k": "k"}, {"v": "id"})


def test_chain_and_unknown_table(data, dim, rows):
    other = dim.selectExpr("seq", "v AS w", "upper(v) AS u")
    steps = [Lookup("one", {"k": "k"}, {"v": "v1"}), Lookup("two", {"v1": "w"}, {"u": "u1"})]
    assert rows(apply_chain(data, steps, {"one": dim, "two": other}), "id", "u1") == [
        (1, "FIRST"), (2, ""), (3, None), (4, None), (5, None)]
    with pytest.raises(ValueError, match="not found"):
        apply_chain(data, steps, {"one": dim})


def test_unmatched_counts_rows_without_entry(data, dim, rows):
    counted = unmatched(data, [Lookup("one", {"k": "k"}, {"v": "v1"})], {"one": dim.where("k IS NOT NULL")})
    assert rows(counted) == [(0, "one", "k", 3)]


def test_routed_lookup_falls_through_null_and_blank(spark, rows):
    df = spark.createDataFrame([("x", "c"), ("y", "c"), ("z", None)], "code string, ccy string")
    dim = spark.createDataFrame([("p", "c", ""), ("q", "c", None), ("r", "c", "hit"), ("y", "c", "own")],
                                "code string, currency string, v string")
    route = """CASE WHEN code = 'x' THEN array(struct('p' AS code, ccy AS currency), struct('q' AS code, ccy AS currency),
        struct('r' AS code, ccy AS currency)) ELSE array(struct(code AS code, ccy AS currency)) END"""
    assert rows(routed_lookup(df, route, dim, ("code", "currency"), "v", "found"), "code", "found") == [
        ("x", "hit"), ("y", "own"), ("z", None)]


def test_routed_lookup_keeps_equal_rows(spark, rows):
    df = spark.createDataFrame([("x", "c"), ("x", "c"), ("y", None)], "code string, ccy string")
    dim = spark.createDataFrame([("x", "c", "hit")], "code string, currency string, v string")
    route = "array(struct('none' AS code, ccy AS currency), struct(code AS code, ccy AS currency))"
    assert rows(routed_lookup(df, route, dim, ("code", "currency"), "v", "found"), "code", "found") == [
        ("x", "hit"), ("x", "hit"), ("y", None)]
    with pytest.raises(Exception, match="route too long"):
        routed_lookup(df, route, dim, ("code", "currency"), "v", "found", tries=1).collect()


def test_inline_tables_need_no_shuffle(spark, data):
    small = inline_table(spark, "seq k v", [(1, "a", None), (2, "a'b", "w")])
    found = lookup(data, small, {"k": "k"}, {"v": "v1"})
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()


def test_chosen_lookup_equals_brute_force(spark):
    rnd = random.Random(4)
    keys = [None, "", "a", "b", "c", "d"]
    data = [(i, rnd.choice([True, False, None]), rnd.choice(keys), rnd.choice(keys)) for i in range(200)]
    dim = [(i, rnd.choice(keys[:5]), rnd.choice(keys[1:]), f"v{i}", rnd.choice([None, f"t{i}"])) for i in range(12)]
    df = spark.createDataFrame(data, "id int, fee boolean, customer string, ref string").repartition(4)
    table = spark.createDataFrame(dim, "seq int, customer string, ref string, country string, type string")
    out = chosen_lookup(df, table, "fee", "customer", "ref", {"country": "found_country"}, {"country": "found_country", "type": "found_type"}, "listed")
    by_customer, by_ref = {}, {}
    for row in dim:
        by_customer.setdefault(row[1], row)
        by_ref.setdefault(row[2], row)
    want = []
    for i, fee, customer, ref in data:
        one, other = (by_customer.get(customer) if fee else by_ref.get(ref)), by_ref.get(ref)
        want.append((i, fee, customer, ref, one is not None, one and one[3], other and other[4]))
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert out.columns == ["id", "fee", "customer", "ref", "listed", "found_country", "found_type"]

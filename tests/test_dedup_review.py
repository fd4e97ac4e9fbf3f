import random
from collections import Counter

import pytest

from returnsmith.operators import dedup
from returnsmith.operators.dedup import drop_repeats, duplicate_sets, merge_log, repeats, split_repeats
from returnsmith.operators.review import apply_actions, delete_listed, split_listed, take_listed, with_status
from returnsmith.session import scratch_path, settle


def brute_force(data):
    """All rows of a set but the lowest customer, a missing one being lowest; and the highest of each set."""
    sets = {}
    for content, customer in data:
        sets.setdefault(content, []).append(customer)
    logged, kept = Counter(), Counter()
    for content, customers in sets.items():
        ordered = sorted(customers, key=lambda v: (v is not None, v or ""))
        logged.update((content, v) for v in ordered[1:])
        kept[(content, ordered[-1])] += 1
    return logged, kept


def test_repeats_with_a_hot_group_match_brute_force(spark):
    rnd = random.Random(7)
    data = [(None if rnd.random() < 0.1 else f"k{rnd.randrange(40)}", rnd.choice([None, "1", "2", "3"])) for _ in range(400)]
    data += [("hot", rnd.choice([None, "1", "9"])) for _ in range(300)]
    df = spark.createDataFrame(data, "content string, customer string").repartition(7)
    logged, kept = brute_force(data)
    assert Counter(map(tuple, repeats(df, "customer").collect())) == logged
    assert Counter(map(tuple, drop_repeats(df, "customer").collect())) == kept


def test_row_numbers_are_not_content(spark, rows):
    df = spark.createDataFrame([(1, "a", "7"), (2, "a", "7"), (3, "a", None), (4, "b", None)], "seq long, content string, customer string")
    assert rows(drop_repeats(df, "customer", order_by="seq"), "seq") == [(1,), (4,)]
    assert rows(repeats(df, "customer", order_by="seq"), "seq") == [(1,), (2,)]


def test_duplicate_sets_and_log(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "id int, k string")
    assert rows(duplicate_sets(df, ["k"]), "id") == [(1,), (2,), (3,), (4,)]
    assert len(merge_log(df, df.where("id < 3")).collect()) == 5


@pytest.fixture
def case(spark):
    data = spark.createDataFrame([("r1", "1", 1.0), ("r2", None, 2.0), ("r3", "3", 3.0), ("r4", "4", 4.0)],
                                 "ref string, customer string, v double")
    log = spark.createDataFrame([("r1", "1", 1.0, "Delete", "PENDING"), ("r2", None, 9.0, "UPDATE", None),
                                 ("r5", "5", 5.0, "insert", "PENDING"), ("r3", "3", 3.0, "delete", "DONE"),
                                 ("r4", "4", 4.0, None, "PENDING")],
                                "ref string, customer string, v double, record_action string, status string")
    return data, log


def test_actions_by_key(case, rows):
    data, log = case
    after, marked = apply_actions(data, log, ["ref", "customer"])
    assert rows(after, "ref", "v") == [("r2", 9.0), ("r3", 3.0), ("r4", 4.0), ("r5", 5.0)]
    assert rows(marked, "ref", "status") == [("r1", "DONE"), ("r2", "DONE"), ("r3", "DONE"), ("r4", "PENDING"), ("r5", "DONE")]


def test_a_second_run_changes_nothing(case, rows):
    after, marked = apply_actions(*case, ["ref", "customer"])
    again, marked_again = apply_actions(after, marked, ["ref", "customer"])
    assert rows(again) == rows(after) and rows(marked_again) == rows(marked)


def test_update_over_all_columns_adds_an_edited_row(case, rows):
    after, _ = apply_actions(*case)
    assert rows(after.where("ref = 'r2'"), "v") == [(2.0,), (9.0,)]


def test_status_default_and_null_safe_delete(spark, case, rows):
    data, log = case
    assert rows(with_status(log.drop("status")), "status") == [("PENDING",)] * 5
    assert rows(delete_listed(data, log.where("ref = 'r2'"), ["customer"]), "ref") == [("r1",), ("r3",), ("r4",)]


def test_nulls_in_different_columns_are_different_content(spark, rows):
    df = spark.createDataFrame([("a", None, "1"), (None, "a", "2"), ("a", None, "3"), (None, None, "4"), (None, None, None)],
                               "x string, y string, customer string")
    assert rows(drop_repeats(df, "customer"), "customer") == [("2",), ("3",), ("4",)]
    assert rows(repeats(df, "customer"), "customer") == [("3",), ("4",)]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counting_repeats_is_a_hash_aggregate(spark):
    df = spark.range(10).selectExpr("CAST(id % 7 AS string) AS content", "CAST(id AS string) AS customer", "id AS seq")
    written = {}

    def share(df, name):
        written[name] = plan_of(df)
        return settle(df, name)

    split_repeats(df, "customer", "seq", share)
    assert "Window" not in written["hashes"] and written["hashes"].count("HashAggregate") >= 2


def test_kept_rows_and_log_need_two_reads_of_the_feed(spark):
    """The feed is read for the hashes and for the split; all outputs come from what was written, unique rows without a shuffle."""
    path = scratch_path(spark, "feed")
    rows = spark.range(20_000).selectExpr("id AS seq", "CAST(id % 19000 AS string) AS content", "CAST(id AS string) AS customer")
    rows.write.parquet(path)
    feed = spark.read.parquet(path)
    written = []

    def share(df, name):
        written.append((name, df))
        return settle(df, name)

    split = split_repeats(feed, "customer", "seq", share)
    kept, logged = split.kept(), split.logged()
    assert (kept.count(), logged.count()) == (19_000, 1000)
    scans = [line for df in (*(df for _, df in written), kept, logged) for line in plan_of(df).splitlines()
             if "FileScan" in line and path.removeprefix("file:") in line]
    assert [name for name, _ in written] == ["hashes", "split"] and len(scans) == 2
    marked = plan_of(written[1][1])
    assert "hashpartitioning(_hash" not in marked and "BroadcastHashJoin" in marked and "SortMergeJoin" not in marked
    assert "Exchange" not in plan_of(split.single)
    assert 2000 <= split.several.count() < 2000 + 18_000 / 20  # both rows of 1000 sets, and one of 32 others that shares a bit


def test_full_bitmaps_only_send_more_rows_to_be_compared(spark, monkeypatch):
    """Where all bits are set, every row is compared in full, and the result is the same."""
    monkeypatch.setattr(dedup, "BITMAP", 1 << 15)
    monkeypatch.setattr(dedup, "BITMAPS", 1)
    monkeypatch.setattr(dedup, "BITS_PER_HASH", 1)
    data = [(f"k{i % 60_000}", str(i % 7)) for i in range(120_000)]
    df = spark.createDataFrame(data, "content string, customer string")
    logged, kept = brute_force(data)
    assert Counter(map(tuple, repeats(df, "customer").collect())) == logged
    assert Counter(map(tuple, drop_repeats(df, "customer").collect())) == kept


def test_pairs_are_compared_by_one_shuffle(spark):
    """Copies that come in pairs, told from larger sets, need no join: one shuffle gives what is kept and logged of them."""
    data = [(f"k{i % 3000}" if i % 10 else None, str(i % 11)) for i in range(6000)] + [("thrice", v) for v in (None, "2", "1")]
    df = spark.createDataFrame(data, "content string, customer string").repartition(5)
    logged, kept = brute_force(data)
    split = split_repeats(df, "customer")
    assert Counter(map(tuple, split.logged().collect())) == logged and Counter(map(tuple, split.kept().collect())) == kept
    assert split.many.count() < 1200 and split.pairs.count() > 4000
    shown = plan_of(split._paired())
    assert shown.count("Exchange hashpartitioning") == 1 and "Join" not in shown


def test_rows_that_are_not_listed_are_not_shuffled(spark):
    path = scratch_path(spark, "rows")
    spark.range(3000).selectExpr("CAST(IF(id % 5 = 0, NULL, id % 900) AS string) AS ref", "IF(id % 2 = 0, 0.0D, -0.0D) AS v").write.parquet(path)
    df = spark.read.parquet(path)
    listed = spark.createDataFrame([(None, -0.0), ("7", 0.0), ("8", -0.0), ("8", 1.0)], "ref string, v double")
    held = [tuple(r) for r in df.collect()]
    gone = [r for r in held if r[0] in (None, "7", "8")]  # both zeros are equal
    assert Counter(map(tuple, delete_listed(df, listed).collect())) == Counter(held) - Counter(gone)
    assert Counter(map(tuple, take_listed(df, listed).collect())) == Counter(gone)
    shown = delete_listed(df, listed)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in shown and "bitmap_construct_agg" in shown
    texts = spark.createDataFrame([("7", "0.0")], "ref string, v string")  # of another type: compared as values, not by hashes
    assert delete_listed(df, texts).count() == len([r for r in held if r[0] != "7"])


def test_listed_rows_are_looked_for_among_those_that_the_bitmaps_leave(spark):
    """A semi or an anti join would be moved below the bitmaps, and all rows be shuffled for it."""
    path = scratch_path(spark, "rows")
    spark.range(5000).selectExpr("CAST(IF(id % 5 = 0, NULL, id % 900) AS string) AS ref", "id % 3 AS v").write.parquet(path)
    df = spark.read.parquet(path)
    listed = df.where("ref IN ('7', '8') OR ref IS NULL AND v = 1")  # copies among them
    removed, kept = split_listed(df, listed)
    held, gone = Counter(map(tuple, df.collect())), Counter(map(tuple, listed.collect()))
    assert Counter(map(tuple, removed.collect())) == gone and Counter(map(tuple, kept.collect())) == held - gone
    for found in (take_listed(df, listed), delete_listed(df, listed)):
        shown = found._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" not in shown and "LeftAnti" not in shown and "bitmap_construct_agg" in shown
        assert "isnotnull(shiftright" not in shown and "isnotnull((pmod" not in shown  # no row is hashed for a null check


def test_the_log_of_duplicates_writes_no_rows_without_a_copy(spark, monkeypatch):
    data = [(f"k{i % 2900}", str(i)) for i in range(3000)]
    df, split, written = spark.createDataFrame(data, "content string, customer string"), dedup.split_repeats, {}

    def share(df, name):
        written[name] = settle(df, name)
        return written[name]

    monkeypatch.setattr(dedup, "split_repeats", lambda *a, **k: split(*a, share=share, **k))
    assert Counter(map(tuple, repeats(df, "customer").collect())) == brute_force(data)[0]
    assert 200 <= written["split"].count() < 600  # both rows of 100 sets, and some that share a bit
    found = split(df, "customer", write_single=False)
    assert Counter(map(tuple, found.kept().collect())) == brute_force(data)[1]

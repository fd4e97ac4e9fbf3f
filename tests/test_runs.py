"""The three runs end to end over the small test tables, through bundles."""

import contextlib
import io
import os
import re
import time
from collections import Counter
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from catalog.adapter import AS_OF, BODIES, ENTITY, LOT, Feed
from catalog import queries
from catalog.queries import QUERIES, runnable
from returnsmith.operators.review import with_status
from returnsmith.plans import lifecycle
from returnsmith.plans.chains import POSITION_CHAIN
from returnsmith.plans.positions import add_risk, enrich_positions, enrich_with_risk, map_positions
from returnsmith.plans.quality import position_issues
from returnsmith.plans.reconcile import position_cells
from returnsmith.plans.register import build_register
from returnsmith.schemas import FACILITY, POSITIONS
from returnsmith.session import SHORT_LIVED, WIDE_ROWS, run_scratch, scratch_path, settle, shared_dir, tune
from returnsmith.sources import bundle, warehouse
from returnsmith.sources.readers import conform

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def feed(spark):
    return Feed(spark, FOLDER)


def test_runs_from_raw_tables_to_reports(spark, feed):
    dims = feed.dims()
    raw = {"positions": conform(feed.table("positions"), POSITIONS, ["seq"]), "ledger": feed.table("ledger"),
           "facility": conform(feed.table("facility"), FACILITY)}
    copies = raw["positions"].where("currency = 'AUD'")
    started = lifecycle.initial_run({**raw, "positions": raw["positions"].unionByName(copies)}, dims)
    home, logs = scratch_path(spark, "raw"), scratch_path(spark, "logs")
    bundle.write_bundle(started["raw"], home)
    bundle.write_bundle(started["logs"], logs)

    tables, opened = bundle.read_bundle(spark, home), bundle.read_bundle(spark, logs)
    assert tables["positions"].count() == raw["positions"].count()
    assert opened["duplicates"].count() == copies.count()

    reviewed = lifecycle.review_run(tables, {k: with_status(v) for k, v in opened.items()}, dims)
    updated = scratch_path(spark, "updated")
    bundle.write_bundle(reviewed["updated"], updated)
    bundle.write_bundle(reviewed["logs"], logs)
    assert bundle.newest_bundle(spark, updated, home) == updated
    assert bundle.read_bundle(spark, logs, names=["register_log"])["register_log"].count() == 2 * opened["register_log"].count()

    tables = bundle.read_bundle(spark, updated)
    out = lifecycle.final_run(tables, dims)
    reports = scratch_path(spark, "reports")
    for name, df in out.items():
        bundle.write_report(df, reports, name)
    saved = bundle.read_bundle(spark, reports)
    assert set(saved) == set(out) and saved["country"].count() == 25 and saved["derivatives_check"].count() == 50
    total = saved["assets"].selectExpr("sum(abs(total - loans - securities - other)) AS gap", "count(*) AS n").first()
    assert total.n > 0 and total.gap < 1e-6
    parts = lifecycle.final_run(tables, dims, in_millions=True)
    assert {"country_a", "country_e"} <= set(parts)


def test_position_actions_rebuild_everything(feed):
    dims = feed.dims()
    enriched = lifecycle.rebuild({"positions": feed.table("positions"), "facility": feed.table("facility"),
                                  "ledger": feed.table("ledger")}, dims)
    log = enriched["positions"].where("currency = 'AUD' AND ide_linkage_type = '1'").selectExpr(
        "*", "'delete' AS record_action", "'PENDING' AS status")
    tables, log_after = lifecycle.apply_position_actions(enriched, log, dims)
    assert tables["positions"].count() == enriched["positions"].count() - log.count()
    assert [r.status for r in log_after.select("status").distinct().collect()] == ["DONE"]
    assert tables["positions"].columns == enriched["positions"].columns


def test_risk_joins_the_positions_once(spark, feed):
    """The wide rows are read and joined once; a second scan reads the keys of the fee rows only."""
    path = scratch_path(spark, "positions")
    enrich_positions(feed.table("positions"), feed.dims()).write.parquet(path)
    positions = spark.read.parquet(path)
    register = settle(build_register(positions, feed.table("register_now"), feed.table("register_last")), "register")
    shown = add_risk(positions, register)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in shown.splitlines() if "FileScan" in line and path.removeprefix("file:") in line]
    read = [{c.split(":")[0] for c in line.split("ReadSchema: struct<")[1].split(",")} for line in scans]
    assert len(read) == 2 and {"customer_nr", "ide_linkage_ref", "deal_code"} in read
    # the joins below the rows' own one are between keys: only one has a wide left side
    wide = add_risk(positions, register)._jdf.queryExecution().optimizedPlan()
    assert wide.toString().splitlines()[0].startswith("Project") and _joins_on_the_left(wide) == 1


def _joins_on_the_left(plan):
    """Joins between the result and its leftmost leaf."""
    n = 0
    while plan.children().size():
        n += plan.nodeName().startswith("Join")
        plan = plan.children().head()
    return n


def test_first_run_splits_the_feed_once(spark, feed, monkeypatch):
    calls = []
    split = lifecycle.split_repeats
    monkeypatch.setattr(lifecycle, "split_repeats", lambda *a, **k: calls.append(1) or split(*a, **k))
    with run_scratch(spark) as share:
        started = lifecycle.initial_run({"positions": conform(feed.table("positions"), POSITIONS, ["seq"]),
                                         "ledger": feed.table("ledger"), "facility": feed.table("facility")}, feed.dims(), share=share)
        for df in (started["raw"]["positions"], started["raw"]["register"], *started["logs"].values()):
            shown = df._jdf.queryExecution().executedPlan().toString()
            scans = [line for line in shown.splitlines() if "FileScan" in line]
            assert scans and not any("lineitem" in line for line in scans)
        folder = started["raw"]["register"].inputFiles()[0].rsplit("/", 2)[0]
        assert os.path.isdir(folder.removeprefix("file://"))
    assert calls == [1] and not os.path.exists(folder.removeprefix("file://"))


def test_rebuild_by_difference_equals_the_full_one(spark, feed):
    """Rows deleted, changed in reference, customer and amount, and added: positions, register and cells as a full rebuild leaves them."""
    dims = feed.dims()
    tables = lifecycle.rebuild({"positions": feed.table("positions"), "facility": feed.table("facility"), "ledger": feed.table("ledger")}, dims)
    tables["positions"] = settle(tables["positions"], "positions")
    tables["cells"] = settle(position_cells(tables["positions"]), "cells")
    rows = tables["positions"]
    first = rows.groupBy("deal_code", "currency").agg(F.min("seq").alias("seq"))  # cells lose their first rows
    deleted = rows.join(first.where("seq % 3 = 0").select("seq"), "seq", "left_semi")
    changed = rows.where("seq % 97 = 1").withColumns({"rca_bookv": F.expr("rca_bookv + 10.25"), "customer_nr": F.expr("concat(customer_nr, '9')")})
    moved = rows.where("seq % 101 = 2").withColumn("ide_linkage_ref", F.lit("moved"))
    added = rows.where("seq % 89 = 3").withColumns({"seq": F.expr("seq + 1000000"), "rv_coa": F.lit("BLS-AST-LOANS-PLAIN")})
    log = None
    for action, df in (("delete", deleted), ("update", changed), ("Update", moved), ("insert", added)):
        df = df.selectExpr("*", f"'{action}' AS record_action", "IF(seq % 5 = 0, 'DONE', 'PENDING') AS status")
        log = df if log is None else log.unionByName(df)
    log = settle(log, "log")
    full, full_log = lifecycle.apply_position_actions(tables, log, dims, ["seq"])
    out, marked = lifecycle.apply_by_difference(tables, log, dims, ["seq"])
    full["cells"] = position_cells(full["positions"])
    for name in ("positions", "register", "cells", "facility"):
        names = out[name].columns
        assert sorted(names) == sorted(full[name].columns)
        got, want = (Counter(map(tuple, t[name].select(*names).collect())) for t in (out, full))
        assert got == want, name
    assert Counter(map(tuple, marked.collect())) == Counter(map(tuple, full_log.select(*marked.columns).collect()))
    assert out["positions"].where("ide_linkage_ref = 'moved'").count() > 0 and deleted.count() > 0


def test_final_run_applies_position_actions(feed):
    dims = feed.dims()
    tables = lifecycle.rebuild({"positions": feed.table("positions"), "facility": feed.table("facility"), "ledger": feed.table("ledger")}, dims)
    log = tables["positions"].where("currency = 'AUD'").selectExpr("*", "'delete' AS record_action", "'PENDING' AS status")
    out = lifecycle.final_run(tables, dims, positions_log=log)
    assert [r.status for r in out["positions_log"].select("status").distinct().collect()] == ["DONE"]
    assert out["assets"].where("report_ccy = 'AUD'").count() == 0 < lifecycle.final_run(tables, dims)["assets"].where("report_ccy = 'AUD'").count()


def test_a_bundle_that_dies_between_two_tables_leaves_the_one_before(spark):
    path = scratch_path(spark, "bundle")
    bundle.write_bundle({"a": spark.range(1), "b": spark.range(1)}, path)
    with pytest.raises(Exception):
        bundle.write_bundle({"a": spark.range(2), "b": spark.range(2).selectExpr("raise_error('x') AS id")}, path)
    assert [df.count() for df in bundle.read_bundle(spark, path).values()] == [1, 1]
    bundle.write_bundle({"a": spark.range(3), "b": spark.range(3)}, path)
    assert [df.count() for df in bundle.read_bundle(spark, path).values()] == [3, 3]
    bundle.write_bundle({"a": spark.range(9)}, path, only=[])
    assert bundle.read_bundle(spark, path)["a"].count() == 3 and bundle.read_bundle(spark, path, names=[]) == {}


def test_reports_of_several_parts_are_read_back_in_order(spark):
    path = scratch_path(spark, "reports")
    rows = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "country string, n int").repartition(3)
    bundle.write_report({"x": rows, "y": rows.select("n")}, path, "country", order_by=["country"])
    saved = bundle.read_bundle(spark, path)
    assert set(saved) == {"country_x", "country_y"}
    assert [r.country for r in bundle.read_report(spark, path, "country_x").collect()] == ["a", "b", "c"]
    many = spark.range(5000).selectExpr("pmod(hash(id), 700) AS k", "CAST(id AS string) AS v").repartition(9)
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")  # so that few rows make several files too
    try:
        bundle.write_report(many, path, "long", order_by=["k"])
    finally:
        spark.conf.set(coalesce, before)
    assert len(spark.read.parquet(f"{path}/{bundle._manifest(spark, path)['long'][0]}").inputFiles()) > 1
    back = [(r.k, r.v) for r in bundle.read_report(spark, path, "long").collect()]
    assert back == sorted(map(tuple, many.collect()))


def test_a_writer_notices_that_the_version_moved(spark):
    path = scratch_path(spark, "bundle")
    bundle.write_bundle({"a": spark.range(1), "b": spark.range(1)}, path)
    seen = bundle.version_in_force(spark, path)
    bundle.write_bundle({"b": spark.range(5)}, path)  # another writer, meanwhile
    assert bundle.write_bundle({"a": spark.range(7)}, path, based_on=seen) == seen + 2
    assert {n: df.count() for n, df in bundle.read_bundle(spark, path).items()} == {"a": 7, "b": 5}
    with pytest.raises(bundle.VersionMoved):
        bundle.write_bundle({"b": spark.range(9)}, path, based_on=seen)
    assert bundle.read_bundle(spark, path)["b"].count() == 5


def test_two_writers_at_once(spark):
    """Each of several threads replaces a table of its own; no manifest is lost."""
    path = scratch_path(spark, "bundle")
    bundle.write_bundle({f"t{i}": spark.range(1) for i in range(4)}, path)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: [bundle.write_bundle({f"t{i}": spark.range(n)}, path) for n in (2, 3, i + 4)], range(4)))
    assert {n: df.count() for n, df in bundle.read_bundle(spark, path).items()} == {f"t{i}": i + 4 for i in range(4)}
    assert bundle.version_in_force(spark, path) == 13
    taken = bundle._put_in_force(spark, path, 13, {})
    assert taken is False and bundle.read_bundle(spark, path)["t0"].count() == 4


def test_old_versions_go(spark):
    path = scratch_path(spark, "bundle")
    for n in (1, 2, 3):
        bundle.write_bundle({"a": spark.range(n)}, path)
    bundle.write_bundle({"b": spark.range(9)}, path)
    held = bundle.read_bundle(spark, path)
    begun = f"{path}/a/000005-other".removeprefix("file:")  # a writer at work on the next version
    os.mkdir(begun)
    gone = bundle.remove_old(spark, path)
    assert len(gone) == 2 and os.path.isdir(begun)
    assert {n: df.count() for n, df in held.items()} == {"a": 3, "b": 9}
    assert bundle.write_bundle({"a": spark.range(4)}, path) == 5 and bundle.remove_old(spark, path + "-none") == []


def test_prepared_lookups_pick_nothing_again(spark, feed):
    """The first row of each key is picked once for a version of the set; a newer version is prepared anew."""
    path = scratch_path(spark, "lookups")
    names = {s.table for s in POSITION_CHAIN}
    bundle.write_bundle({name: feed.rows(name) for name in names}, path)
    ready = bundle.prepare_lookups(spark, path, POSITION_CHAIN)
    positions = feed.table("positions")
    out, want = map_positions(positions, ready), map_positions(positions, bundle.read_lookups(spark, path))
    assert out.columns == want.columns and Counter(map(tuple, out.collect())) == Counter(map(tuple, want.collect()))

    def aggregates(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Aggregate(")

    assert aggregates(out) == aggregates(positions) < aggregates(want)
    files = set(ready.ready[("ccy", ("currency_group",), ("report_ccy",))].inputFiles())
    assert files == set(bundle.prepare_lookups(spark, path, POSITION_CHAIN).ready[("ccy", ("currency_group",), ("report_ccy",))].inputFiles())
    bundle.write_bundle({"ccy": feed.rows("ccy").where("false")}, path)
    newer = bundle.prepare_lookups(spark, path, POSITION_CHAIN)
    assert map_positions(positions, newer).where("report_ccy IS NOT NULL").count() == 0
    computed = ready.with_tables({"ccy": newer["ccy"]})
    assert map_positions(positions, computed).where("report_ccy IS NOT NULL").count() == 0


def test_settings_of_the_user_are_kept(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        assert tune(spark).conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)


def test_extraction_gives_the_raw_tables(feed):
    found = warehouse.extract(feed.warehouse(), AS_OF, ENTITY, LOT)
    assert found["positions"].schema.names == POSITIONS.names
    assert set(found) == {"positions", "ledger", "facility"}
    customers = warehouse.valid_at(feed.table("wh_customer"), "1998-07-30")
    assert customers.where("end_validity_date = DATE '1998-07-30'").count() == customers.count() > 0


def test_bundles_version_their_tables(spark):
    path = scratch_path(spark, "bundle")
    assert path.startswith(shared_dir(spark))
    one, two = spark.range(3), spark.range(5)
    bundle.write_bundle({"a": one, "b": one}, path)
    a = bundle.read_bundle(spark, path)["a"]
    bundle.write_bundle({"a": a.unionByName(two)}, path, only=["a"])
    tables = bundle.read_bundle(spark, path)
    assert tables["a"].count() == 8 and tables["b"].count() == 3 and a.count() == 3
    os.mkdir(os.path.join(path.removeprefix("file:"), "a", "000009"))  # a write that died half-way
    assert bundle.read_bundle(spark, path)["a"].count() == 8
    schema = StructType.fromDDL("id long")
    log = bundle.read_log(spark, path, "absent", schema)
    assert log.columns == ["id", "status"] and log.count() == 0
    assert bundle.read_log(spark, path, "b", schema).where("status = 'PENDING'").count() == 3
    with pytest.raises(FileNotFoundError):
        bundle.newest_bundle(spark, path + "-none")


def test_a_run_owns_all_scratch_made_during_it(spark):
    """Queries settle what they share by themselves; within a run it all goes with the run."""
    home = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(home))
    with run_scratch(spark) as share:
        inner = share(spark.range(3), "a")
        with run_scratch(spark):
            gone = settle(spark.range(2), "b")
            assert gone.count() == 2
        kept = runnable(QUERIES["rpt_b_part_e"])(spark, FOLDER).collect()
        assert kept and inner.count() == 3
        made = set(os.listdir(home)) - before
        assert len(made) == 1 and len(os.listdir(os.path.join(home, *made))) > 2
        with pytest.raises(Exception):
            gone.count()
    assert set(os.listdir(home)) == before


def test_a_log_grows_by_its_new_rows_only(spark):
    path = scratch_path(spark, "logs")
    schema = "k string, v int, d double"
    first = spark.createDataFrame([("a", 1, 1.0), ("a", None, 1.0), (None, 1, None)], schema)
    second = spark.createDataFrame([("a", 1, 1.0), (None, 1, None), ("a", None, None), ("a", None, None), ("b", 2, 2.0)], schema)
    bundle.write_bundle({"log": first, "other": spark.range(2)}, path)
    bundle.extend_log(second, path, "log")
    bundle.extend_log(first.unionByName(second), path, "log")
    want = {("a", 1, 1.0), ("a", None, 1.0), (None, 1, None), ("a", None, None), ("b", 2, 2.0)}
    log = bundle.read_bundle(spark, path)["log"]
    assert log.columns == ["k", "v", "d"] and sorted(map(tuple, log.collect()), key=str) == sorted(want, key=str)
    written = [spark.read.parquet(f"{path}/{place}").count() for place in bundle._manifest(spark, path)["log"]]
    assert written == [3, 2, 0]
    bundle.extend_log(second, path, "fresh")
    assert bundle.read_log(spark, path, "fresh", log.schema).where("status = 'PENDING'").count() == 4
    assert bundle.remove_old(spark, path) and bundle.read_bundle(spark, path)["log"].count() == 5


def test_the_feed_reads_positions_that_are_joined_once(spark, feed):
    """The feed reads the positions three times, from where they were written; their line items are shuffled while narrow."""
    shown = feed.table("feed")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in shown and "lineitem" not in shown
    assert feed.written("positions") is feed.written("positions")
    both = [df.drop("tfi_id") for df in (feed.written("positions"), feed.table("positions"))]
    assert both[0].exceptAll(both[1]).isEmpty() and both[0].count() == both[1].count()


def method_sizes(spark, df):
    """Bytes of the largest method that Spark generates for each stage of the plan; the JVM compiles none above 8000."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as shown:
            df.selectExpr("*").explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]


def test_the_rebuild_of_positions_makes_methods_that_the_jvm_compiles(spark, feed):
    dims, raw = feed.dims(), settle(conform(feed.table("positions"), POSITIONS, ["seq"]), "positions")
    tables = lifecycle.rebuild({"positions": raw, "facility": feed.table("facility"), "ledger": feed.table("ledger")}, dims)
    sizes = method_sizes(spark, tables["positions"])
    assert sizes and max(sizes) < 8000
    assert max(method_sizes(spark, queries.with_risk(feed))) < 8000
    in_two = add_risk(enrich_positions(raw, dims), tables["register"])
    assert in_two.schema == tables["positions"].schema and in_two.schema == enrich_with_risk(raw, dims, tables["register"]).schema
    assert Counter(map(tuple, in_two.collect())) == Counter(map(tuple, tables["positions"].collect()))


def test_acted_positions_are_compared_once(feed):
    """The rebuild after position actions reads what is left as written, it doesn't look for the listed rows at every read."""
    dims = feed.dims()
    tables = lifecycle.rebuild({"positions": feed.table("positions"), "facility": feed.table("facility"), "ledger": feed.table("ledger")}, dims)
    tables["positions"] = settle(tables["positions"], "positions")
    log = tables["positions"].where("currency = 'AUD'").selectExpr("*", "'delete' AS record_action", "'PENDING' AS status")
    out, _ = lifecycle.apply_position_actions(tables, log, dims)
    assert "bitmap_construct_agg" not in out["positions"]._jdf.queryExecution().optimizedPlan().toString()


def test_rows_that_no_action_reaches_are_written_once(spark, feed):
    """The rebuild by difference writes the rows that are left once, and again only those that may ask for a changed reference or customer."""
    dims, written = feed.dims(), {}
    tables = lifecycle.rebuild({"positions": feed.table("positions"), "facility": feed.table("facility"), "ledger": feed.table("ledger")}, dims)
    tables["positions"] = settle(tables["positions"], "positions")
    tables["cells"] = settle(position_cells(tables["positions"]), "cells")
    log = tables["positions"].orderBy("seq").limit(3).selectExpr("*", "'delete' AS record_action", "'PENDING' AS status")

    def share(df, name):
        written[name] = settle(df, name)
        return written[name]

    out = lifecycle.apply_by_difference(tables, settle(log, "log"), dims, share=share)[0]
    total = tables["positions"].count()
    wide = {name: df.count() for name, df in written.items() if "rca_bookv" in df.columns and "vis_sector" in df.columns}
    assert out["positions"].count() == total - 3 and wide["not_removed"] == total - 3
    assert [name for name, n in wide.items() if n > total / 2] == ["not_removed"]


def test_only_the_log_of_duplicates_needs_the_run_before(spark, monkeypatch):
    monkeypatch.setattr(queries.dedup, "repeats", lambda *a, **k: pytest.fail("a run before was made"))
    assert queries.started(Feed(spark, FOLDER))["raw"]["register"].count() > 0


def test_wide_rows_are_dealt_out_finely_whatever_the_number_of_partitions(spark):
    """Into eight partitions, what a task sorts grows with the tables until it spills; adaptive execution puts small parts together."""
    (name, number), = WIDE_ROWS.items()
    before = spark.conf.get(name, None)
    spark.conf.unset(name)
    rows = spark.range(9).selectExpr("id % 4 AS content", "CAST(id AS string) AS customer")
    try:
        found = runnable(lambda feed: queries.dedup.repeats(rows, "customer"))(spark, FOLDER)
        shown = found._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in shown.splitlines() if "Exchange hashpartitioning" in line]
        assert dealt and all(f", {number})" in line for line in dealt) and spark.conf.get("spark.sql.shuffle.partitions") != number
        spark.conf.set(name, "16")  # the user's own number is kept
        assert tune(spark, wide_rows=True).conf.get(name) == "16"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_position_log_by_itself_needs_no_register(spark, feed, rows, monkeypatch):
    raw = {"positions": queries.delivered(feed), "ledger": feed.table("ledger"), "facility": feed.table("facility")}
    expected, written = rows(lifecycle.initial_run(raw, feed.dims())["logs"]["positions_log"]), {}

    def share(df, name):
        written[name] = settle(df, name)
        return written[name]

    monkeypatch.setattr(lifecycle, "build_register", lambda *a: pytest.fail("a register was built"))
    assert rows(lifecycle.initial_position_log(raw, feed.dims(), share)) == expected and expected
    assert set(written) == {"hashes", "split"} and written["split"].count() < raw["positions"].count()
    assert runnable(queries.run_initial_position_log)(spark, FOLDER).count() == len(expected)


def test_where_a_review_begins_needs_no_written_register(spark, monkeypatch):
    monkeypatch.setattr(queries, "started", lambda f: pytest.fail("the whole first run was made"))
    found = {r.log_reason: r for r in queries.run_review_start(Feed(spark, FOLDER)).collect()}
    assert found and all(r.status == "PENDING" and r.n > 0 and r.begins_with == "raw" for r in found.values())


def test_register_log_of_a_review_writes_no_positions(spark, feed, rows):
    first, dims, written = queries.started(feed), feed.dims(), []
    logs = {name: with_status(log) for name, log in first["logs"].items()}

    def share(df, name):
        written.append(name)
        return settle(df, name)

    tables, log = lifecycle.review_register(first["raw"], logs["register_log"], dims, share)
    assert "positions" not in written
    whole = lifecycle.review_run(first["raw"], logs, dims)
    assert rows(log) == rows(whole["logs"]["register_log"])
    assert rows(tables["positions"].select("seq", "risk_in", "risk_in_sector")) == rows(whole["updated"]["positions"].select("seq", "risk_in", "risk_in_sector"))


def test_line_items_are_shuffled_with_what_positions_take_of_them(feed):
    """Of the supplier a remainder, of the time of shipping the day."""
    sold = feed._sold()
    assert dict(sold.dtypes)["l_shipdate"] == "date"
    assert {r[0] for r in sold.select("l_suppkey").distinct().collect()} <= {0, 1, 2}


def test_the_feed_reads_each_position_once(spark):
    """One scan gives what the union of the feed's body gives, rows without a number or a customer as well."""
    feed, names = Feed(spark, FOLDER), feed_columns()
    numbers = [None, 0, 1, 3, 5, 7, 14, 15, 21, 35, 105, 35]
    rows = spark.createDataFrame([(n, None if n == 14 else f"c{n}") for n in numbers], "seq long, customer_nr string")
    path = scratch_path(spark, "positions")
    rows.selectExpr(*[n if n in rows.columns else f"CAST(NULL AS {kind}) AS {n}" for n, kind in names.items()]).write.parquet(path)
    feed._made["written <positions>"] = spark.read.parquet(path)
    union = spark.sql(BODIES["feed"].replace("<position_base>", "{positions}"), positions=feed.written("positions"))
    got = feed.table("feed")
    assert got.schema == union.schema and Counter(map(tuple, got.collect())) == Counter(map(tuple, union.collect()))
    assert got.count() == len(numbers) + 6 + 7  # 0, 7, 14, 21, 35, 105 and 35 again come under another customer
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def feed_columns():
    return {f.name: f.dataType.simpleString() for f in POSITIONS.fields} | {"seq": "bigint"}


def test_the_position_log_makes_methods_that_the_jvm_compiles(spark, feed):
    """The enrichment with the issues of its rows was one method of 9206 bytes."""
    raw = settle(conform(feed.table("positions"), POSITIONS, ["seq"]), "positions")
    enriched = enrich_positions(raw, feed.dims())
    sizes = method_sizes(spark, position_issues(enriched))
    assert sizes and max(sizes) < 8000
    shown = enriched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in shown and "Exchange RoundRobin" not in shown
    assert enriched.rdd.getNumPartitions() == raw.rdd.getNumPartitions()


def shuffle_files(spark):
    held = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_job_that_wrote_them(spark):
    (name, value), = SHORT_LIVED.items()
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # a session's own choice is kept
    assert tune(spark, wide_rows=True).conf.get(name) == "false"
    try:
        spark.conf.set(name, value)
        held = shuffle_files(spark)
        again = settle(spark.range(1000).groupBy(F.expr("id % 10 AS k")).agg(F.expr("count(*) AS n")), "counts")
        assert again.count() == 10
        for _ in range(50):
            left = shuffle_files(spark) - held
            if not left:
                break
            time.sleep(0.2)
        assert not left
        twice = spark.range(100).repartition(F.expr("id % 7")).groupBy(F.expr("id % 5 AS k")).agg(F.expr("count(*) AS n"))
        assert sorted(twice.collect()) == sorted(twice.collect())  # its shuffles are made again
    finally:
        spark.conf.set(name, before)


def test_columns_made_from_the_row_are_not_shuffled_for_its_risk(spark, feed):
    """The rows cross to the register without the columns that are made of their others."""
    raw = settle(conform(feed.table("positions"), POSITIONS, ["seq"]), "positions")
    register = settle(build_register(enrich_positions(raw, feed.dims()), feed.table("register_now"), feed.table("register_last")), "register")
    plan = enrich_with_risk(raw, feed.dims(), register)._jdf.queryExecution().optimizedPlan()
    while not (plan.nodeName().startswith("Join") and "_pair" in plan.verboseStringWithSuffix(1000).split("Join", 1)[1]):
        plan = plan.children().head()
    crossing = {a.split("#")[0] for a in plan.children().head().output().mkString(" ").split()}
    assert {"rca_bookv", "vis_sector", "deal_code"} <= crossing and not crossing & {"key", "vis_country", "nationality_derived"}


def test_the_log_after_review_is_made_of_the_written_one(spark, monkeypatch):
    made = []
    monkeypatch.setattr(lifecycle, "position_issues", lambda df: made.append(position_issues(df)) or made[-1])
    seen = []
    monkeypatch.setattr(queries, "reviewed_log", lambda f, issues, columns, make=queries.reviewed_log: seen.append(issues) or make(f, issues, columns))
    counts = {r.what: r.n for r in queries.run_initial_counts(Feed(spark, FOLDER)).collect()}
    scans = [line for line in seen[0]._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert len(made) == 1 and len(scans) == 1 and "positions_log" in scans[0]
    assert sum(n for what, n in counts.items() if what.startswith("positions_log: ")) == sum(
        n for what, n in counts.items() if what.startswith("after_review: issue: ")) > 0


def test_the_first_run_makes_its_pairs_once_and_drops_what_the_feed_was_read_from(spark):
    feed = Feed(spark, FOLDER)
    rows = queries.delivered(feed)
    kept, logged = (Counter(map(tuple, make(rows, "customer_nr", order_by="seq").collect())) for make in (queries.dedup.drop_repeats, queries.dedup.repeats))
    folder = feed.written("positions").inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    first = queries.started(feed)
    assert not os.path.exists(folder) and "<feed>" not in feed._made
    assert Counter(map(tuple, first["raw"]["positions"].collect())) == kept
    found = first["logs"]["duplicates"]
    names = [n for n in rows.columns if n != "seq"]
    at = [rows.columns.index(n) for n in names]
    expected = Counter()
    for row, n in logged.items():
        expected[tuple(row[i] for i in at)] += n
    assert Counter(map(tuple, found.select(*names).collect())) == expected
    # the pairs are read as written: only larger sets are still joined
    assert "bitmap" not in found._jdf.queryExecution().optimizedPlan().toString()
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert len(scans) == 3 and sum("kept-" in line for line in scans) == 1
    assert feed.table("feed").count() > 0  # made anew

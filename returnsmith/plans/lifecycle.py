"""The three runs of a reporting period, each from tables to tables.

Between runs the tables live in bundles, so a run starts from files, not from lineage. What several outputs
of a run share is settled once in the shared folder (``share``; ``session.run_scratch`` drops it after the run).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returnsmith.operators.counts import as_rows, by_value, written
from returnsmith.operators.dedup import merge_log, split_repeats
from returnsmith.operators.review import ACTION, apply_actions
from returnsmith.plans import reports
from returnsmith.plans.difference import apply_by_difference
from returnsmith.plans.facility import enrich_facility
from returnsmith.plans.ledger import enrich_ledger
from returnsmith.plans.positions import enrich_positions, enrich_with_risk
from returnsmith.plans.quality import BAD_VALUATION, FALSE_FLAG, NO_KEY, position_issues, register_issues
from returnsmith.plans.reconcile import (derivatives_check, gl_breaks, off_balance_check, position_cells,
                                         reconcile)
from returnsmith.plans.register import build_register, refresh_register_log
from returnsmith.functions.money import as_double
from returnsmith.schemas import FACILITY, LEDGER, MEASURES, POSITIONS
from returnsmith.session import settle
from returnsmith.sources.readers import conform

Tables = Mapping[str, DataFrame]
Settle = Callable[[DataFrame, str], DataFrame]

# what the reconciliations and reports read of the enriched positions
REPORTED = ("seq", "ale", "category", "report_ccy", "vis_sector", "vis_country", "key", "currency", "deal_code",
            "interest_code", "valuation_code", "rv_mat_remaining", "rv_mat_remaining_derived", "risk_in",
            "risk_transfer", "risk_in_sector", *MEASURES)


def initial_run(raw: Tables, dims: Tables, duplicates_before: DataFrame | None = None,
                share: Settle = settle) -> dict[str, Tables]:
    """De-duplicate and enrich the positions, build the register, and open the review logs.

    ``raw`` holds positions, ledger and facility. Positions leave this run de-duplicated but not enriched; ``duplicates``
    is the log of the runs before (``duplicates_before``) with this run's additions. The positions are split once, by two reads
    of the feed, into rows without a copy and the others; kept rows and log both follow from what was written, and so does
    the register, which is built once.
    """
    split = split_repeats(raw["positions"], "customer_nr", "seq", share).written(share)
    found = split.logged().drop("seq")
    duplicates = found if duplicates_before is None else merge_log(duplicates_before, found)
    positions = split.kept()
    enriched = enrich_positions(positions, dims)
    register = share(build_register(enriched, dims["register_now"], dims["register_last"]), "register")
    return {
        "raw": {"positions": positions, "ledger": raw["ledger"], "facility": raw["facility"], "register": register},
        "logs": {"positions_log": position_issues(enriched), "register_log": register_issues(register),
                 "duplicates": duplicates},
    }


def initial_position_log(raw: Tables, dims: Tables, share: Settle = settle) -> DataFrame:
    """The position log of ``initial_run`` by itself. It asks for no register, and the kept rows are read once, so they are not written."""
    kept = split_repeats(raw["positions"], "customer_nr", "seq", share, write_single=False).kept()
    return position_issues(enrich_positions(kept, dims))


def rebuild(tables: Tables, dims: Tables, share: Settle = settle) -> dict[str, DataFrame]:
    """All tables anew from their raw columns: positions, register, facility, risk, ledger. The
    register serves positions and facilities, so it is settled first."""
    raw = conform(tables["positions"], POSITIONS, ["seq"])
    register = share(build_register(enrich_positions(raw, dims), dims["register_now"], dims["register_last"]), "register")
    return {
        "positions": enrich_with_risk(raw, dims, register),
        "register": register,
        "facility": enrich_facility(conform(tables["facility"], FACILITY), register, dims),
        "ledger": enrich_ledger(conform(tables["ledger"], LEDGER), dims),
    }


def extended(log: DataFrame, issues: DataFrame) -> DataFrame:
    return log.unionByName(issues, allowMissingColumns=True)


def review_register(tables: Tables, register_log: DataFrame, dims: Tables,
                    share: Settle = settle) -> tuple[dict[str, DataFrame], DataFrame]:
    """The register's part of a review: the rebuilt tables, their register with the reviewers' actions, and its log extended. The
    positions, whose risk goes by the register before those actions, are not written."""
    data = rebuild(tables, dims, share)
    register, register_log = apply_actions(data["register"], refresh_register_log(register_log), ["ide_linkage_ref", "customer_nr"])
    data["register"] = share(register, "register")
    return data, extended(register_log, register_issues(data["register"]))


def review_run(tables: Tables, logs: Tables, dims: Tables, share: Settle = settle) -> dict[str, Tables]:
    """Rebuild everything, apply the register reviewers' actions, and extend the logs. Repeatable. The rebuilt
    positions are written before the log is made from them."""
    data, register_log = review_register(tables, logs["register_log"], dims, share)
    data["positions"] = share(data["positions"], "positions")
    return {"updated": data,
            "logs": {"register_log": register_log,
                     "positions_log": extended(logs["positions_log"], position_issues(data["positions"]))}}


def apply_position_actions(tables: Tables, log: DataFrame, dims: Tables, keys: Sequence[str] | None = None,
                           share: Settle = settle) -> tuple[dict[str, DataFrame], DataFrame]:
    """Position reviewers' actions, then everything rebuilt from the result.

    A log row is about the rows equal to it in all columns, so one that the first run logged, without the risk columns,
    finds nothing after a review; with ``keys`` only those columns are compared. The rows that are left are compared and
    written once, in their raw columns; the rebuild reads them several times.
    """
    positions, log = apply_actions(tables["positions"], log, keys)
    positions = share(conform(positions, POSITIONS, ["seq"]), "acted")
    return rebuild({**tables, "positions": positions}, dims, share), log


def final_run(tables: Tables, dims: Tables, in_millions: bool = False, share: Settle = settle,
              positions_log: DataFrame | None = None, keys: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """All reconciliations and reports over enriched tables (as the review run leaves them).

    With ``positions_log`` its pending actions are applied first and everything is rebuilt: by difference where ``tables`` hold
    the ``cells`` of their positions, in full where they do not. The log, with what was done marked, is then the output
    ``positions_log``, to be written back.

    The positions are read four times, each time for a few columns: for the account cells, the country
    figures, the asset and the liability lines. All else works on the small results, which ``share`` settles.
    """
    marked = cells = None
    if positions_log is not None:
        if "cells" in tables:
            tables, marked = apply_by_difference(tables, positions_log, dims, keys, share)
            cells = tables["cells"]
        else:
            tables, marked = apply_position_actions(tables, positions_log, dims, keys, share)
            tables["positions"] = share(tables["positions"].select(*REPORTED), "positions")
    positions = tables["positions"]
    cells = share(position_cells(positions) if cells is None else cells, "cells")
    rec = share(reconcile(tables["ledger"], cells), "reconciliation")
    table = share(reports.country_report(positions, tables["facility"], rec, dims["country"]), "country")
    check = share(off_balance_check(tables["ledger"], tables["facility"], reports.part(table, "e")), "check")
    table = reports.with_off_balance(table, check)
    out = {"assets": reports.assets_report(positions, rec),
           "liabilities": reports.liabilities_report(positions, rec),
           "ledger_check": as_double(rec), "off_balance_check": as_double(check),
           "derivatives_check": as_double(derivatives_check(cells, tables["ledger"], dims)),
           "ledger_breaks": as_double(gl_breaks(rec))}
    if in_millions:
        out.update({f"country_{letter}": df for letter, df in reports.scaled(table).items()})
    else:
        out["country"] = reports.wide(table)
    return out if marked is None else {**out, "positions_log": marked}


ACTIONS = ("delete", "update", "insert", "")
STATES = ("PENDING", "DONE")


def log_figures(log: DataFrame) -> dict[str, str]:
    """What is counted of a review log while it is written: rows by reason, and by action and state where it has them."""
    figures = by_value("issue: ", "log_reason", (NO_KEY, BAD_VALUATION, FALSE_FLAG)) if "log_reason" in log.columns else {}
    if "status" in log.columns:
        state = f"concat({ACTION}, ', ', coalesce(status, 'PENDING'))"
        figures |= by_value("action: ", state, [f"{action}, {state}" for action in ACTIONS for state in STATES])
    return figures or {"rows": "count(*)"}


def write_logs(logs: Tables, share: Settle = settle) -> tuple[dict[str, DataFrame], DataFrame]:
    """The logs of a run as written, and (what, n): the counts that the run reports, taken while the rows were written."""
    out, figures = {}, {}
    for name, log in logs.items():
        out[name], seen = written(log, name, share, log_figures(log))
        figures |= {f"{name}: {what}": n for what, n in seen.items()}
    return out, as_rows(next(iter(logs.values())).sparkSession, figures)

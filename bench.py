"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. Each
query runs whole, from files to its last row, and includes building the plan; the session is warmed up
with one small query first.

The test tables are one file of one row group each, which a single task has to read, whatever the cores. Tables of any
size worth timing stand in many files, so the largest ones are first copied into one file a core (not timed); all
rows and columns are the same.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

import pyarrow.parquet as pq

from catalog.queries import QUERIES, runnable
from returnsmith.session import local_session, run_scratch

HEADLINE = ("src_three_way_union", "map_chain", "pos_enriched", "rmd_register", "dq_duplicates", "dq_dedup_keep",
            "dq_position_issues", "rev_apply_actions", "rec_gl_full", "rec_derivatives", "rpt_assets_core", "rpt_assets",
            "rpt_liabilities", "rpt_b_wide")


SPLIT_ROWS = 100_000


def in_files(folder: str, files: int) -> str:
    """A folder with the same tables, those of SPLIT_ROWS rows or more in several files."""
    out = tempfile.mkdtemp(prefix="bench-")
    for name in sorted(n for n in os.listdir(folder) if n.endswith(".parquet")):
        path = os.path.join(folder, name)
        if os.path.isdir(path) or pq.ParquetFile(path).metadata.num_rows < SPLIT_ROWS:
            os.symlink(os.path.abspath(path), os.path.join(out, name))
            continue
        table = pq.read_table(path)
        os.mkdir(os.path.join(out, name))
        step = -(-table.num_rows // files)
        for i in range(files):
            pq.write_table(table.slice(i * step, step), os.path.join(out, name, f"part-{i:05d}.parquet"))
    return out


def run(spark, folder: str, name: str) -> float:
    with run_scratch(spark):
        start = time.perf_counter()
        runnable(QUERIES[name])(spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    copied = in_files(folder, int(cpus) if cpus.isdigit() else 8)
    run(spark, copied, "flt_valid_at")
    times = {name: run(spark, copied, name) for name in HEADLINE}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()

from __future__ import annotations

import os
import time

from test_files_and_stream import local

from tidestar.session import scratch_dir
from tidestar.sources import files

HOUR = 3600
NOW = 1_700_000_000


def land(spark, root, name, at):
    """A file with a time of its own."""
    folder = f"{local(root)}/raw/public/orders"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.parquet", "w") as out:
        out.write(name)
    os.utime(f"{folder}/{name}.parquet", (at, at))


def names(found):
    return [os.path.basename(r["path"]).removesuffix(".parquet") for r in found.collect()]


def test_discovery_reads_the_hours_that_differ(spark):
    root, ledger = scratch_dir(spark, "hours"), scratch_dir(spark, "ledger")
    files.create_hour_ledger(spark, ledger)
    files.create_hour_ledger(spark, ledger)
    for k in range(30):
        land(spark, root, f"f{k:02d}", NOW + k * HOUR // 3)
    prefix = f"{root}/raw"
    found = files.discover_new_files(spark, prefix, ledger)
    assert names(found) == [f"f{k:02d}" for k in range(30)]
    files.mark_files_processed(spark, found, ledger)
    listed = files.discover_files(spark, prefix)
    assert files.hours_to_read(spark, listed, ledger) == []
    assert names(files.discover_new_files(spark, prefix, ledger)) == []
    # The newest hour, and a file that comes late with an old time: two hours are read, of eleven.
    land(spark, root, "new", NOW + 31 * HOUR // 3)
    land(spark, root, "late", NOW + HOUR)
    listed = files.discover_files(spark, prefix)
    assert len(files.hours_to_read(spark, listed, ledger)) == 2
    found = files.discover_new_files(spark, prefix, ledger)
    assert names(found) == ["late", "new"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert scans and all("hour" in s.split("PartitionFilters: [")[1].split("PushedFilters")[0] for s in scans)
    files.mark_files_processed(spark, found, ledger)
    assert names(files.discover_new_files(spark, prefix, ledger)) == []
    # A file written anew is found again.
    land(spark, root, "f03", NOW + 2 * HOUR + time.time() % 1)
    assert names(files.discover_new_files(spark, prefix, ledger)) == ["f03"]


def test_compaction_and_a_job_that_stopped(spark):
    root, ledger = scratch_dir(spark, "hours"), scratch_dir(spark, "ledger")
    files.create_hour_ledger(spark, ledger)
    prefix = f"{root}/raw"
    for k in range(5):
        land(spark, root, f"f{k}", NOW + k * HOUR)
        files.mark_files_processed(spark, files.discover_new_files(spark, prefix, ledger), ledger)
    land(spark, root, "last", NOW + 4 * HOUR + 60)
    # Stops between the files and the counts.
    found = files.discover_new_files(spark, prefix, ledger)
    whole, files._by_hour = files._by_hour, None
    try:
        files.mark_files_processed(spark, found, ledger)
    except TypeError:
        pass
    finally:
        files._by_hour = whole
    assert names(files.discover_new_files(spark, prefix, ledger)) == []
    assert len(files.hours_to_read(spark, files.discover_files(spark, prefix), ledger)) == 1
    assert files.compact_hours(spark, ledger) == 5
    assert files.hours_to_read(spark, files.discover_files(spark, prefix), ledger) == []
    assert names(files.discover_new_files(spark, prefix, ledger)) == []

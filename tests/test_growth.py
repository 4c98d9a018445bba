"""What must hold at any size: no task, worker or exchange takes more because a table has more rows."""

import datetime as dt
import random

import pandas as pd

from berthlake import testbed_files as tf
from berthlake.operators import workload
from berthlake.sources import parsers

CALL = ("terminal_id string, k string, eta timestamp_ntz, etd timestamp_ntz, berth string, vessel_name string, parsed_at timestamp_ntz, "
        "total_workload int, discharge int, loading int, shift int, stay_hours double")


def test_vessels_per_hour_without_a_row_per_key_and_hour(spark):
    r, rows = random.Random(3), []
    for i in range(300):
        eta = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=r.randrange(6000))
        stay = r.choice([20, 60, 200, 3000])
        rows.append((r.choice(["a", "b", None]), r.choice(["x", "y", "z", None]), eta, eta + dt.timedelta(minutes=stay), r.choice(["1", None]),
                     f"v{i % 7}", eta, 5, 1, None, 4, stay / 60))
    rows += rows[:40]
    out = workload.hourly_workload(spark.createDataFrame(rows, CALL), "k", key_is_unique=False)
    keys, work = {}, {}
    for t, k, eta, etd, *_, hours in rows:
        at = eta.replace(minute=0, second=0)
        while at <= etd:
            keys.setdefault((t, at), set()).add(k)
            work[t, at] = work.get((t, at), 0) + 5 / hours
            at += dt.timedelta(hours=1)
    got = {(x["terminal_id"], x["work_hour"]): x for x in out.collect()}
    assert {k: x["vessel_count"] for k, x in got.items()} == {k: len(v - {None}) for k, v in keys.items()}
    assert all(abs(x["estimated_hourly_workload"] - work[k]) < 0.006 for k, x in got.items())
    assert dict(out.dtypes)["vessel_count"] == "bigint"
    plan = out._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert exchanges and not any("work_hour" in e and "k#" in e for e in exchanges)


def test_vessel_names_meet_their_hours_by_day(spark):
    """Names are dealt out per day, with the hours as bits; only lists are made per hour, in order."""
    r, rows = random.Random(5), []
    for i in range(200):
        eta = dt.datetime(1969, 12, 30) + dt.timedelta(minutes=r.randrange(6000))
        stay = r.choice([1, 60, 1439, 1440, 5000])
        rows.append((r.choice(["a", "b", None]), f"k{i}", eta, eta + dt.timedelta(minutes=stay), r.choice(["2", "1", None]),
                     r.choice(["", None, "x", "y", f"v{i}"]), eta, 5, 1, None, 4, stay / 60))
    rows += rows[:30] + [("a", "k1", None, dt.datetime(1970, 2, 1), "9", "z", None, 5, 1, None, 4, 1.0)]
    names, berths, newest = {}, {}, {}
    for t, _, eta, etd, berth, name, at, *_ in rows:
        hour = eta and eta.replace(minute=0)
        while hour and hour <= etd:
            names.setdefault((t, hour), set()).add(name)
            berths.setdefault((t, hour), set()).add(berth)
            newest[t, hour] = max(at, newest.get((t, hour), at))
            hour += dt.timedelta(hours=1)
    stays = spark.createDataFrame(rows, CALL)
    for unique in (True, False):
        out = workload.hourly_workload(stays, "k", key_is_unique=unique)
        got = out.collect()
        at = [(x["terminal_id"], x["work_hour"]) for x in got]
        assert at == sorted(names, key=lambda k: (k[0] or "", k[1]))
        assert [x["vessel_list"] for x in got] == [sorted(names[k] - {None}) for k in at]
        assert [x["berth_list"] for x in got] == [sorted(berths[k] - {None}) for k in at]
        assert [x["latest_parsed_at"] for x in got] == [newest[k] for k in at]
        assert all((x["work_date"], x["work_hour_of_day"]) == (x["work_hour"].date(), x["work_hour"].hour) for x in got)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "collect_set(vessel_name" not in plan
        assert not any("vessel_name#" in line and "work_hour" in line for line in plan.splitlines() if "partitioning" in line)


def test_a_row_without_arrival_hides_no_hours_of_its_key(spark):
    d = dt.datetime(2024, 1, 1)
    rows = [("a", "k", d, d + dt.timedelta(hours=2), "1", "v", d, 5, 1, None, 4, 2.0),
            ("a", "k", None, d + dt.timedelta(hours=1), "1", "v", d, 5, 1, None, 4, 2.0)]
    out = workload.hourly_workload(spark.createDataFrame(rows, CALL), "k", key_is_unique=False).collect()
    assert [(x["vessel_count"], x["vessel_list"]) for x in out] == [(1, ["v"])] * 3


def test_checks_of_a_schedule_do_not_make_its_columns_again(spark):
    from pyspark.sql import functions as F

    d = dt.datetime(2024, 1, 1)
    rows = [("a", d, d + dt.timedelta(hours=2), 5), ("a", d, d, 5), ("a", None, d, 5), ("a", d, None, 5), ("a", d, d + dt.timedelta(hours=2), None), ("a", d, d + dt.timedelta(hours=2), -5)]
    made = spark.createDataFrame(rows, "t string, eta timestamp_ntz, etd timestamp_ntz, n int").withColumn("total_workload", F.abs("n") * F.signum("n")).withColumn(
        "stay_hours", (F.unix_timestamp("etd") - F.unix_timestamp("eta")) / 3600)
    out = workload.valid_schedule(made)
    assert out.columns == made.columns and [r["n"] for r in out.collect()] == [5]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not any("unix_timestamp" in line or "SIGNUM" in line.upper() for line in plan.splitlines() if "Filter" in line)


def test_decoded_files_leave_a_worker_in_chunks():
    page = b"<table>" + b"<tr><td>abc</td></tr>" * 2000 + b"</table>"
    names, contents = pd.Series(["a.xls"] * 120 + ["b.xlsx", "c.xls"]), pd.Series([page] * 120 + [b"broken", None])
    chunks = list(parsers.decode_batches(iter([(names, contents), (names[:0], contents[:0])])))
    most = parsers.CHUNK_BYTES // len(page) + 1
    assert len(chunks) > 3 and max(map(len, chunks)) <= most
    rows = pd.concat(chunks)
    assert len(rows) == 122 and all(len(x) == 2000 for x in rows["rows"][:120])
    assert rows["error"].iloc[120] and rows["rows"].iloc[120] is None and rows["rows"].iloc[121] is None


def test_workbooks_are_written_a_few_at_a_time(spark):
    """Arrow would hand thousands of tables to a worker at once."""
    from pyspark.sql import functions as F

    df = spark.range(1).select(tf._xlsx(F.array(F.array(F.lit("a"), F.lit(None)))).alias("x"), tf._xlsx(F.lit(None).cast("array<array<string>>")).alias("n"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    x, n = df.first()
    assert parsers.xlsx_table(bytes(x)) == [["a"]] and n is None

"""A snapshot that arrives late takes its place: the stream gives what the batch gives."""

import datetime as dt
import random

from pyspark.sql import functions as F

from berthlake.operators import changes
from berthlake.streaming import changes as sc, ingest, upsert

SCHEMA = ("gold_key string, snapshot_ts timestamp_ntz, bronze_row_id string, snapshot_id string, parsed_at timestamp_ntz, row_hash string, "
          "terminal_id string, berth string, eta timestamp_ntz, etd timestamp_ntz, closing timestamp_ntz, discharge int, loading int, shift int")


def row(key, hour, berth, day=1):
    ts = dt.datetime(2024, 1, day, hour, 0, 0, 123456)
    return (key, ts, f"{day:02d}{hour:02d}", f"s{hour}", ts, berth, "t", berth, ts, None, None, None, 1, hour)


COLUMNS = ["gold_key", "bronze_row_id", "berth", "prev_berth", "eta", "prev_eta", "change_type", "change_detail"]


def run(spark, tmp_path, batches, **options):
    """One run per arrival: state and progress carry over."""
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out, log = str(tmp_path / "out"), str(tmp_path / "log")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        sc.merge_changes(stream, out, log, **options).awaitTermination()
    everything = spark.createDataFrame(list(dict.fromkeys(r for rows in batches for r in rows)), SCHEMA)
    got = sorted(tuple(r) for r in sc.current_changes(spark, out).select(*COLUMNS).collect())
    return got, sorted(tuple(r) for r in changes.change_history(everything).select(*COLUMNS).collect()), sc.late_rows(spark, out).collect()


def test_rows_in_any_order(spark, tmp_path):
    rnd = random.Random(4)
    rows = [row(key, hour, rnd.choice("xyz"), day) for key in "abcd" for day in (1, 2, 3) for hour in range(0, 20, 3) if rnd.random() < .8]
    rnd.shuffle(rows)
    got, want, late = run(spark, tmp_path, [rows[:9], rows[9:12], rows[12:40], rows[20:44], rows[44:]], buckets=3)
    assert got == want and late == [] and len({r[6] for r in got}) == 2


def test_a_late_row_retracts_a_change(spark, tmp_path):
    """(x, y) is a change until x comes to stand between them; then the same row has not changed."""
    first, second, between = row("a", 1, "x"), row("a", 5, "y"), row("a", 3, "y")
    between = (*between[:3], *second[3:])
    got, want, _ = run(spark, tmp_path, [[first, second], [between]])
    assert got == want and [r[1] for r in got] == ["0101", "0103"]


def test_rows_beyond_the_expiry_are_kept_aside(spark, tmp_path):
    batches = [[row("a", 1, "x"), row("a", 2, "y"), row("b", 1, "x")], [row("a", 1, "z", day=9), row("a", 3, "w")], [row("a", 0, "u"), row("a", 4, "v"), row("b", 0, "q")]]
    got, want, late = run(spark, tmp_path, batches, expiry="2 days")
    assert [r["bronze_row_id"] for r in late] == ["0100"]  # b has no row that left the state, so its late row is placed
    placed = [r for rows in batches for r in rows if r[2] != "0100" or r[0] != "a"]
    want = changes.change_history(spark.createDataFrame(placed, SCHEMA)).select(*COLUMNS).collect()
    assert got == sorted(map(tuple, want))


def test_a_file_delivered_twice_counts_once(spark, tmp_path):
    schema = ingest.BINARY_SCHEMA
    at = dt.datetime(2024, 1, 1, 5)
    files = [[("/a/t_1.html", at, 1, b"one")], [("/b/t_1.html", at, 1, b"one"), ("/b/t_2.html", at, 1, b"one")], [("/b/t_1.html", at, 1, b"two")]]
    (tmp_path / "in").mkdir()
    stream = ingest.each_file_once(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    for rows in files:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).trigger(
            availableNow=True).start().awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("path", "content").collect()
    assert sorted((r["path"], bytes(r["content"])) for r in got) == [("/a/t_1.html", b"one"), ("/b/t_1.html", b"two"), ("/b/t_2.html", b"one")]


def test_upsert_and_compact(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "log_table")
    for i, rows in enumerate([[row("a", 5, "x"), row("a", 1, "y")], [row("a", 3, "z"), row("b", 2, "w")]]):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    upsert.upsert_latest(stream, out, str(tmp_path / "log")).awaitTermination()
    want = {("a", "0105"), ("b", "0102")}
    pick = lambda df: {tuple(r) for r in df.select("gold_key", "bronze_row_id").collect()}
    assert pick(upsert.current_rows(spark, out)) == want
    assert pick(upsert.compact(spark, out, str(tmp_path / "compacted"))) == want
    assert spark.read.parquet(out).select(F.count_distinct("epoch")).first()[0] == 2


def test_folded_log(spark, tmp_path):
    """Eleven epochs, folded in threes: same rows as the batch, few runs, lookups by bucket, repeated epochs."""
    import random

    r, out, seen = random.Random(6), str(tmp_path / "log"), []
    for epoch in range(11):
        rows = [row(f"k{r.randrange(12)}", r.randrange(24), r.choice("xyz"), r.randrange(1, 28)) for _ in range(9)]
        seen += rows
        batch = spark.createDataFrame(rows, SCHEMA)
        upsert.add_epoch(batch, epoch, out, fold=3, buckets=4)
        if epoch in (2, 8, 10):  # the same epoch again, as after a lost driver
            upsert.add_epoch(batch, epoch, out, fold=3, buckets=4)
    newest = {}
    for x in seen:
        newest[x[0]] = max(newest.get(x[0], x), x, key=lambda v: (v[1], v[2]))
    got = upsert.current_rows(spark, out, fold=3, buckets=4)
    assert {(x["gold_key"], x["bronze_row_id"]) for x in got.collect()} == {(k, v[2]) for k, v in newest.items()}
    assert upsert.live_runs(spark, out, 3) == [(0, 9), (0, 10), (2, 8)]
    one = upsert.current_rows(spark, out, fold=3, buckets=4, keys=["k3"])
    assert [(x["gold_key"], x["bronze_row_id"]) for x in one.collect()] == [("k3", newest["k3"][2])]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [(bucket" in plan
    # folded runs go one fold later, and a run that is not complete is not read
    assert len(list((tmp_path / "log" / "level=0").iterdir())) <= 5
    (tmp_path / "log" / "level=2" / "epoch=8" / "_SUCCESS").unlink()
    assert (1, 8) in upsert.live_runs(spark, out, 3)

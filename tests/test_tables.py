"""Readers, loading, stores, checks and streams."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeline.operators import checks as ck
from gaugeline.operators import profile as pf
from gaugeline.sources import readers, seeds, tables
from gaugeline.streaming import flows

SCHEMA = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("d", T.DateType())])


def test_csv_tokens_quotes_and_ragged_rows(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('name,n,d\n"a, b", 1 ,2024-01-02\nNA,null,N/A\n  c  ,NULL\nd,5,2024-02-30,extra\n"",7,\n')
    got = [tuple(r) for r in readers.read_csv(spark, str(path), SCHEMA).collect()]
    assert got == [("a, b", 1, dt.date(2024, 1, 2)), (None, None, None), ("c", None, None), ("d", 5, None), (None, 7, None)]


def test_json_array_document(spark, tmp_path):
    path = tmp_path / "in.json"
    path.write_text('[\n {"name": "a", "n": 1},\n {"name": "b", "n": 2}\n]')
    got = readers.read_json(spark, str(path), SCHEMA, multi_line=True).orderBy("n").collect()
    assert [(r.name, r.n, r.d) for r in got] == [("a", 1, None), ("b", 2, None)]


def test_payload_end_is_exclusive(spark):
    df = spark.createDataFrame([("p", 0, 7200, 3600, [1.0, 2.0, 3.0]), ("empty", 0, 0, 3600, [9.0])], "id string, start long, end long, interval long, v array<double>")
    got = readers.unpack_payload(df, {"temperature": F.col("v")}, keep=["id"]).collect()
    assert [(r.id, r.temperature) for r in got] == [("p", 1.0), ("p", 2.0)]


def test_seeds(spark):
    assert seeds.location_metadata(spark).count() == 5
    assert seeds.season_mappings(spark).filter("season = 'Dry Season'").count() == 6
    assert seeds.weather_thresholds(spark).filter("metric = 'pressure'").first().min_value == 950.0
    results = ck.run_checks(ck.seed_checks(seeds.location_metadata(spark), seeds.season_mappings(spark), seeds.weather_thresholds(spark)))
    assert {r.status for r in results.collect()} == {"pass"}


def _batch(spark, first, last):
    start = dt.datetime(2024, 1, 1)
    rows = [(f"r{i}", start + dt.timedelta(hours=i), float(i)) for i in range(first, last)]
    return spark.createDataFrame(rows, "record_id string, datetime timestamp_ntz, v double")


def test_append_is_idempotent_over_days(spark, tmp_path):
    path = str(tmp_path / "raw")
    for first, last in ((0, 30), (0, 30), (20, 60), (59, 61)):
        tables.append_new(_batch(spark, first, last), path)
    tables.append_new(_batch(spark, 60, 62).unionByName(_batch(spark, 60, 62)), path)  # copies inside a batch
    stored = spark.read.parquet(path)
    assert stored.count() == 62 and stored.select("record_id").distinct().count() == 62


def test_unreadable_target_stops_the_load(spark, tmp_path):
    path = tmp_path / "broken"
    path.mkdir()
    (path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        tables.append_new(_batch(spark, 0, 2), str(path))


def test_day_scope_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.append_new(_batch(spark, 0, 240), path)
    batch = _batch(spark, 200, 250).withColumn("date", F.to_date("datetime"))
    target = tables.on_days_of(spark.read.parquet(path), batch, "date")
    assert target.select("date").distinct().count() == 2
    plan = target._jdf.queryExecution().executedPlan().toString()
    assert "date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert tables.new_rows(batch, spark.read.parquet(path)).count() == 10


def test_table_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save_table(spark.range(3), path, "fail")
    with pytest.raises(Exception):
        tables.save_table(spark.range(3), path, "fail")
    tables.save_table(spark.range(3), path, "append")
    tables.replace_table(spark.read.parquet(path).filter("id > 0"), path)
    assert spark.read.parquet(path).count() == 4


def test_upsert_keeps_latest(spark, tmp_path):
    path = str(tmp_path / "store")
    one = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 20.0)], "k string, version int, v double")
    two = spark.createDataFrame([("b", 2, 21.0), ("c", 1, 30.0)], "k string, version int, v double")
    tables.upsert(one, path, ["k"], ["version"])
    got = tables.upsert(two, path, ["k"], ["version"]).orderBy("k").collect()
    assert [(r.k, r.v) for r in got] == [("a", 10.0), ("b", 21.0), ("c", 30.0)]


def test_result_file_is_single(spark, tmp_path):
    path = tmp_path / "out"
    tables.save_result(spark.range(10).repartition(4), str(path), single_file=True)
    assert len(list(path.glob("*.csv"))) == 1
    tables.save_result(spark.range(10).repartition(4), str(path))
    assert len(list(path.glob("*.csv"))) == 4


def test_store_takes_the_newer_of_equal_versions_and_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "store")
    kind = "k string, day date, version int, v double"
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    tables.upsert(spark.createDataFrame([("a", d, 1, 1.0) for d in days], kind), path, ["k", "day"], ["version"], "day")
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "store").glob("day=2024-01-0[13]/*.parquet")}
    again = spark.createDataFrame([("a", days[1], 1, 2.0), ("b", days[1], 1, 3.0)], kind)
    got = tables.upsert(again, path, ["k", "day"], ["version"], "day").orderBy("day", "k").collect()
    assert [(r.k, r.day.day, r.v) for r in got] == [("a", 1, 1.0), ("a", 2, 2.0), ("b", 2, 3.0), ("a", 3, 1.0)]
    assert untouched and {p: p.stat().st_mtime_ns for p in untouched} == untouched


def test_rows_without_a_time_never_get_in(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [("1", dt.datetime(2024, 1, 1)), ("2", None), (None, dt.datetime(2024, 1, 1))]
    batch = spark.createDataFrame(rows, "record_id string, datetime timestamp_ntz")
    for _ in range(3):
        tables.append_new(batch, path)
        assert spark.read.parquet(path).count() == 1
    assert tables.incomplete(batch).count() == 2


def test_check_store_and_status(spark, tmp_path):
    df = spark.createDataFrame([(1, -1.0), (1, 2.0), (None, 3.0)], "id int, v double")
    suite = [
        ck.Check("unique", lambda: ck.unique(df, "id")),
        ck.Check("not_null", lambda: ck.not_null(df, "id")),
        ck.Check("range", lambda: ck.in_range(df, "v", -5, 5)),
        ck.Check("accepted", lambda: ck.accepted_values(df, "id", [1])),
    ]
    got = {r.check_name: (r.violations, r.status) for r in ck.run_checks(suite, str(tmp_path)).collect()}
    assert got == {"unique": (1, "fail"), "not_null": (1, "fail"), "range": (0, "pass"), "accepted": (0, "pass")}
    assert spark.read.parquet(str(tmp_path / "unique")).first().n_records == 2


def test_null_bounds_pass_temperature_order(spark):
    rows = [("a", dt.date(2024, 1, i), lo, mid, hi) for i, (lo, mid, hi) in enumerate([(1.0, 2.0, 3.0), (3.0, 2.0, 4.0), (None, 2.0, 3.0), (None, 5.0, 3.0)], 1)]
    df = spark.createDataFrame(rows, "location_name string, date date, min_temperature double, avg_temperature double, max_temperature double")
    assert [r.date.day for r in ck.ordered_temperatures(df).orderBy("date").collect()] == [2, 4]


def test_hash_sample_is_stable(spark):
    one = {r.id for r in pf.hash_sample(spark.range(1000), ["id"], 50).collect()}
    two = {r.id for r in pf.hash_sample(spark.range(1000).repartition(7), ["id"], 50).collect()}
    assert one == two and len(one) == 50
    assert one != {r.id for r in pf.hash_sample(spark.range(1000), ["id"], 50, seed=7).collect()}


def test_histogram_of_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert [tuple(r) for r in pf.histogram(df, ["v"], 10).collect()] == [("v", 0, 2)]


def test_stream_restart_adds_nothing(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    _batch(spark, 0, 40).write.parquet(source)
    schema = spark.read.parquet(source).schema
    build = lambda raw: raw.groupBy("date").agg(F.count(F.lit(1)).alias("n"))

    def run():
        stream = flows.read_batches(spark, source, schema)
        flows.start_daily_mart(stream, f"{target}/raw", f"{target}/mart", ["record_id"], "datetime", build, state).awaitTermination()
        return spark.read.parquet(f"{target}/raw").count(), spark.read.parquet(f"{target}/mart").agg(F.sum("n")).first()[0]

    assert run() == (40, 40) and run() == (40, 40)
    _batch(spark, 30, 50).write.mode("append").parquet(source)
    assert run() == (50, 50)


def test_late_rows_are_dropped_from_closed_days(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    kind = "location_name string, datetime timestamp_ntz, temperature double"
    start = dt.datetime(2024, 1, 1)

    def send(days):
        spark.createDataFrame([("a", start + dt.timedelta(days=d), float(d)) for d in days], kind).coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = flows.read_batches(spark, source, spark.read.parquet(source).schema)
        totals = flows.daily_totals(stream, late="1 day", measures=("temperature",))
        flows.start_daily_store(totals, target, state).awaitTermination()

    send([0, 0, 1, 5])
    run()
    send([0, 9])  # day 0 is closed by now
    run()
    got = {r.date: r.total_hourly_records for r in spark.read.parquet(target).collect()}
    assert got[dt.date(2024, 1, 1)] == 2 and got[dt.date(2024, 1, 2)] == 1

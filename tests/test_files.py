"""Readers, writers, file bookkeeping and streams."""

import gzip
import statistics
import zipfile
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from signalframe import config
from signalframe.catalog import fixtures as fx
from signalframe.catalog.queries import follow
from signalframe.operators.articles import enrich_articles
from signalframe.plans.staging import shared_folder, stage
from signalframe.sources import archives, commits, files, manifest
from signalframe.streaming import intervals, records


def line(key: str, date: str = "20240101000000", **extra) -> str:
    cells = {"GKGRECORDID": key, "DATE": date, **extra}
    return "\t".join(cells.get(c, "") for c in config.RAW_COLUMNS)


def test_tsv_tokens_and_short_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text(line("1", Persons="NULL", Themes="x y", Locations=" nan") + "\n" + "2\t20240101\n", encoding="utf-8")
    one, two = files.scan_gkg_tsv(spark, str(tmp_path)).orderBy("GKGRECORDID").collect()
    assert one.Persons is None and one.Themes == "x y" and one.Locations == " nan" and one.Extras is None
    assert two.DATE == "20240101" and two.Extras is None


def zipped(folder, stamp, text, member=None, encoding="utf-8"):
    with zipfile.ZipFile(folder / f"{stamp}.gkg.csv.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(member or f"{stamp}.gkg.csv", text.encode(encoding))


def test_records_and_outcomes_come_from_one_read(spark, tmp_path):
    good = "\r\n".join([line("1", AllNames="Łódź"), "", line("2", Quotations='"a ""b"" c"')]) + "\n"
    zipped(tmp_path, "20240101000000", good)
    zipped(tmp_path, "20240101001500", line("9") + "\n", member="other.csv")
    (tmp_path / "20240101003000.gkg.csv.zip").write_bytes(b"not a zip")
    zipped(tmp_path, "20240101004500", "\n")
    zipped(tmp_path, "20240101010000", "\n".join(line(str(k), Persons="x" * 50) for k in range(2000)))
    whole = (tmp_path / "20240101010000.gkg.csv.zip").read_bytes()
    (tmp_path / "20240101010000.gkg.csv.zip").write_bytes(whole[:900] + b"\x00" * 40 + whole[940:])  # damaged in the middle
    read = archives.read_archives(archives.archives(spark, str(tmp_path)))
    got = archives.records_of(read).orderBy("GKGRECORDID").collect()
    assert [r.GKGRECORDID for r in got] == ["1", "2"]
    assert got[0].AllNames == "Łódź" and got[0].Persons is None and got[1].Quotations == '"a ""b"" c"'
    outcomes = {r.file_name[:14]: (r.outcome, r.reason and r.reason.split(":")[0], r.records) for r in archives.outcomes_of(read).collect()}
    assert outcomes.pop("20240101010000")[0] == "skipped"
    assert outcomes == {"20240101000000": ("landed", None, 2), "20240101001500": ("skipped", "KeyError", 0),
                        "20240101003000": ("skipped", "BadZipFile", 0), "20240101004500": ("empty", None, 0)}


def test_a_range_of_days_opens_only_its_archives(spark, tmp_path):
    for day in range(1, 6):
        for hour in (0, 12):
            zipped(tmp_path, f"202401{day:02d}{hour:02d}0000", line(f"{day}-{hour}"))
    found = archives.archives(spark, str(tmp_path), first=date(2024, 1, 2), last=date(2024, 1, 3))
    assert sorted(f.rsplit("/", 1)[-1][:10] for f in found.inputFiles()) == ["2024010200", "2024010212", "2024010300", "2024010312"]
    assert archives.scan_gkg_zip(spark, str(tmp_path), first=date(2024, 1, 2), last=date(2024, 1, 3)).count() == 4
    assert archives.scan_gkg_zip(spark, str(tmp_path), first=date(2025, 1, 2), last=date(2025, 1, 3)).count() == 0


def test_landing_reads_each_archive_once(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    zipped(tmp_path / "in", "20240101000000", line("1"))
    zipped(tmp_path / "in", "20240101001500", line("2"), member="wrong")
    zipped(tmp_path / "in", "20240102000000", line("3"))
    ids = lambda: sorted(r.GKGRECORDID for r in archives.read_landed(spark, table).collect())
    ledger = lambda: {r.file_name[:14]: r.outcome for r in archives.read_ledger(spark, table).collect()}
    assert ledger() == {}
    put = commits.record
    monkeypatch.setattr(commits, "record", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        archives.land(spark, source, table)
    monkeypatch.setattr(commits, "record", put)
    assert ledger() == {}  # what died before its record is not there
    day = dict(first=date(2024, 1, 1), last=date(2024, 1, 1))
    assert archives.land(spark, source, table, **day) == 2 and ids() == ["1"]
    assert ledger() == {"20240101000000": "landed", "20240101001500": "skipped"}
    assert archives.land(spark, source, table, **day) == 0 and ids() == ["1"]
    zipped(tmp_path / "in", "20240101001500", line("2"))  # the damaged archive is published again
    assert archives.land(spark, source, table) == 2 and ids() == ["1", "2", "3"]
    assert set(ledger().values()) == {"landed"} and archives.land(spark, source, table) == 0
    wanted = manifest.interval_manifest(manifest.date_bounds(spark, "2024-01-01", "2024-01-02"))
    assert manifest.pending_files(wanted, archives.read_ledger(spark, table)).count() == 2 * 96 - 3


def test_encodings(spark, tmp_path):
    text = line("1", AllNames="Łódź né")
    (tmp_path / "a.csv").write_bytes(text.encode("utf-16-le"))
    assert files.scan_gkg_tsv(spark, str(tmp_path / "a.csv"), encoding="UTF-16LE").first().AllNames == "Łódź né"
    (tmp_path / "b.csv").write_bytes(line("1", AllNames="né").encode("latin-1"))
    assert files.scan_gkg_tsv(spark, str(tmp_path / "b.csv"), encoding="ISO-8859-1").first().AllNames == "né"
    zipped(tmp_path, "20240101000000", line("1", AllNames="né"), encoding="latin-1")
    assert archives.scan_gkg_zip(spark, str(tmp_path), encoding="latin-1").first().AllNames == "né"


def test_the_same_bytes_give_the_same_records_both_ways(spark, tmp_path):
    odd = [line("1", Persons='"open'), line("2", Persons='a "quoted" b'), line("3", Persons='"'), line("4", Persons="\\"), line("5") + "\textra\tcells", "6\tshort"]
    content = "\n".join(odd)
    (tmp_path / "tsv").mkdir()
    (tmp_path / "tsv" / "20240101000000.gkg.csv").write_text(content, encoding="utf-8")
    with zipfile.ZipFile(tmp_path / "20240101000000.gkg.csv.zip", "w") as z:
        z.writestr("20240101000000.gkg.csv", content)
    one = sorted(map(tuple, files.scan_gkg_tsv(spark, str(tmp_path / "tsv")).collect()), key=str)
    two = sorted(map(tuple, archives.scan_gkg_zip(spark, str(tmp_path)).collect()), key=str)
    assert one == two and [r[0] for r in one] == list("123456")


def test_a_truncated_file_fails_the_job(spark, tmp_path):
    whole = gzip.compress(("t,v\n" + "\n".join(f"2024-01-01,{k * 7919 % 1000003}" for k in range(100_000))).encode())
    (tmp_path / "a.csv.gz").write_bytes(whole)
    (tmp_path / "b.csv.gz").write_bytes(whole[: len(whole) // 2])
    with pytest.raises(Exception):
        files.scan_csv_table(spark, str(tmp_path), "t string, v int").agg(F.sum("v")).collect()


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", 1.5, " lead"), ("bad", None, 'q"x,')], "t string, v double, s string")
    files.write_table(rows, str(tmp_path / "x"), format="csv")
    got = files.scan_csv_table(spark, str(tmp_path / "x"), rows.schema, "t").orderBy(F.col("v").isNull()).collect()
    assert [r.t for r in got] == [datetime(2024, 1, 1), None] and got[1].s == 'q"x,' and got[0].s == " lead"


def test_union_batches(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2.0, 2)], "f double, i int")
    assert files.union_batches([a, b]).orderBy("i").collect()[1].asDict() == {"i": 2, "s": None, "f": 2.0}


def test_manifest_of_the_full_range(spark):
    bounds = manifest.date_bounds(spark, "2021-01-01", "2024-12-12")
    wanted = manifest.interval_manifest(bounds)
    assert wanted.count() == 138_432 and wanted.select("file_name").distinct().count() == 138_432
    plan = manifest.batch_plan(bounds).orderBy("batch_start").collect()
    assert len(plan) == 16 and plan[0].batch_end == date(2021, 4, 1) and plan[-1].batch_end == date(2024, 12, 12)
    assert plan[1].file_name == "batch_20210402_to_20210701.csv"


def test_resume_point(spark):
    names = spark.createDataFrame([("d_20210101_to_20210401.csv",), ("d_20210402_to_20210701.csv",), ("d_to_20991340.csv",), ("x.csv",)], "file_name string")
    got = manifest.resume_point(names).first()
    assert got.last_end == date(2021, 7, 1) and got.next_start == date(2021, 7, 2)
    assert manifest.resume_point(names.where("file_name = 'x.csv'")).first().next_start is None


def test_file_names_and_pending(spark, tmp_path):
    (tmp_path / "20240101000000.gkg.csv.zip").write_text(line("1") + "\n")
    landed = manifest.file_names(spark.read.text(str(tmp_path)))
    wanted = manifest.interval_manifest(manifest.date_bounds(spark, "2024-01-01", "2024-01-01"))
    assert manifest.pending_files(wanted, landed).count() == 95


def test_latest_run(spark, tmp_path):
    split = spark.createDataFrame([(datetime(2024, 1, 1), 1.0, "train"), (datetime(2024, 2, 1), 2.0, "test")], "t timestamp_ntz, v double, part string")
    for run in ("20240101_000000", "20240301_000000"):
        files.write_split_tables(split.withColumn("v", F.lit(int(run[:8]))), str(tmp_path), "month_based", run, "t")
    files.write_split_tables(split.withColumn("v", F.lit(7)), str(tmp_path), "fully_random", "20230101_000000", "t")
    files.write_split_tables(split.withColumn("v", F.lit(7)), str(tmp_path), "fully_random", "20230101_000000", "t")  # replaces itself
    got = files.latest_run(spark, str(tmp_path))
    assert got.count() == 4 and all("run=20240101" not in f for f in got.inputFiles())
    assert {(r.strategy, r.run, r.v) for r in got.collect()} == {("month_based", "20240301_000000", 20240301), ("fully_random", "20230101_000000", 7)}
    meta = files.read_split_tables(spark, str(tmp_path), "metadata")
    assert meta.agg(F.sum("rows")).first()[0] == 6
    assert {f.name for f in got.schema if f.dataType.simpleString() == "string"} == {"strategy", "run", "part"}
    with pytest.raises(ValueError):
        files.latest_run(spark, str(tmp_path), "scalers")


def test_a_half_written_run_is_not_seen(spark, tmp_path, monkeypatch):
    split = spark.createDataFrame([(datetime(2024, 1, 1), 1.0, "train"), (datetime(2024, 2, 1), 2.0, "test")], "t timestamp_ntz, v double, part string")
    scalers = spark.createDataFrame([("v", 1.0)], "name string, mean double")
    store = lambda run, v: files.write_split_tables(split.withColumn("v", F.lit(v)), str(tmp_path), "s", run, "t", scalers.withColumn("mean", F.lit(v)))
    seen = lambda: {(name, r.run, r[c]) for name, c in (("rows", "v"), ("scalers", "mean")) for r in files.latest_run(spark, str(tmp_path), name).collect()}
    store("run1", 1)
    before, whole = seen(), files.write_table
    for written in range(4):  # dies before, between and after the tables, but before the record
        count = []

        def dies(*args, **more):
            if len(count) == written:
                raise OSError("gone")
            count.append(whole(*args, **more))

        monkeypatch.setattr(files, "write_table", dies)
        monkeypatch.setattr(files.commits, "record", dies)
        for run in ("run1", "run2"):  # a new run, and one to replace the former
            count.clear()
            with pytest.raises(OSError):
                store(run, 9)
        monkeypatch.undo()
        assert seen() == before
    store("run2", 2)
    assert seen() == {("rows", "run2", 2), ("scalers", "run2", 2)}


def test_stage_uses_the_shared_folder(spark):
    df = stage(spark.range(10).withColumn("a b", F.lit(1)))
    assert df.count() == 10 and shared_folder(spark) in df.inputFiles()[0]


def test_stream_of_new_records(spark, sf_dir, tmp_path):
    arriving, store, mark = (str(tmp_path / n) for n in ("arriving", "store", "mark"))
    rows = fx.articles_table(spark, sf_dir)
    half = F.xxhash64("GKGRECORDID") % 2 == 0
    rows.where(half).write.parquet(arriving)
    source = lambda: follow(spark, arriving, rows.schema)
    records.stream_new_records(source(), store, mark).awaitTermination()
    first = spark.read.parquet(store).count()
    # a second arrival repeats everything and holds each record twice
    rows.unionAll(rows).write.mode("append").parquet(arriving)
    records.stream_new_records(source(), store, mark).awaitTermination()
    want = enrich_articles(rows)
    got = spark.read.parquet(store)
    assert first == enrich_articles(rows.where(half)).count()
    assert got.count() == want.count() == got.select("GKGRECORDID").distinct().count()
    # a replayed batch adds nothing
    records.append_new(rows, store, "GKGRECORDID", enrich_articles)
    assert spark.read.parquet(store).count() == want.count()


def test_only_the_days_of_a_batch_are_looked_up(spark, tmp_path):
    rows = spark.createDataFrame([("20240101000000-1", "20240101000000"), ("20240102000000-2", "20240102000000"), ("odd", "20240103000000")], "GKGRECORDID string, DATE string")
    store = str(tmp_path / "store")
    for batch in (rows, rows.limit(1), rows):
        records.append_new(batch, store, "GKGRECORDID", lambda df: df) if batch is not rows or (tmp_path / "store").exists() else rows.withColumn(records.DAY, records.id_day("GKGRECORDID")).write.partitionBy(records.DAY).parquet(store)
    assert spark.read.parquet(store).count() == 3
    stored = records.read_store(spark, store, rows.schema).where(F.col(records.DAY).isin(["20240101"]))
    assert "PartitionFilters: [isnotnull(stored_day" in stored._jdf.queryExecution().executedPlan().toString()


def test_batches_of_a_stream_go_with_bytes_not_files(spark, sf_dir, tmp_path, monkeypatch):
    from signalframe.catalog import queries

    arriving = str(tmp_path / "arriving")
    rows = fx.articles_table(spark, sf_dir)
    rows.repartition(6).write.parquet(arriving)
    batches = lambda mark: len(list((tmp_path / mark / "commits").glob("[0-9]*")))
    ids = lambda store: sorted(r[0] for r in spark.read.parquet(str(tmp_path / store)).select("GKGRECORDID").collect())
    records.stream_new_records(follow(spark, arriving, rows.schema), str(tmp_path / "store"), str(tmp_path / "mark")).awaitTermination()
    assert batches("mark") == 1
    monkeypatch.setattr(queries, "TRIGGER_BYTES", 1)  # every file is larger
    records.stream_new_records(follow(spark, arriving, rows.schema), str(tmp_path / "store2"), str(tmp_path / "mark2")).awaitTermination()
    assert batches("mark2") == 6 and ids("store") == ids("store2")


def test_a_batch_adds_one_small_file_for_each_of_its_days(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([(f"2024010{d}000000-{k}",) for d in (1, 2) for k in range(200)], "GKGRECORDID string")
    rows.limit(0).withColumn(records.DAY, records.id_day("GKGRECORDID")).write.partitionBy(records.DAY).parquet(store)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with a batch too large for one task
    try:
        for batch in (rows.limit(300), rows):
            records.append_new(batch, store, "GKGRECORDID", lambda df: df)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(store).count() == 400
    assert all(len(list(day.glob("*.parquet"))) <= 2 for day in (tmp_path / "store").glob("stored_day=*"))


def test_stream_folds_every_row_whatever_the_order(spark, sf_dir, tmp_path):
    events, arriving = fx.table(spark, sf_dir, "events"), str(tmp_path / "arriving")
    middle = events.agg(F.expr("percentile_approx(ts, array(0.3, 0.6))")).first()[0]
    parts = [F.col("ts") >= middle[1], F.col("ts") < middle[0], (F.col("ts") >= middle[0]) & (F.col("ts") < middle[1])]
    store, mark = str(tmp_path / "out"), str(tmp_path / "mark")
    for part in parts:  # the newest rows come first
        events.where(part).coalesce(1).write.mode("append").parquet(arriving)
        intervals.stream_partials(follow(spark, arriving, events.schema), store, mark, "ts", ["value"]).awaitTermination()
    whole = events.withColumn("time_bucket", F.window("ts", "15 minutes").start.cast("timestamp_ntz")).groupBy("time_bucket").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("s"), F.round(F.stddev_samp("value"), 6).alias("d"))
    want = {tuple(r) for r in whole.collect()}

    def now():
        rows = intervals.read_partials(spark, store, ["value"])
        return {tuple(r) for r in rows.select("time_bucket", "article_count", F.round("value_sum", 6), F.round("value_std", 6)).collect()}

    assert now() == want
    intervals.store_partials(events.where(parts[0]), 0, store, "ts", ["value"])  # a replayed batch
    assert now() == want


def test_a_batch_reads_only_its_own_days(spark, tmp_path):
    """Fifty batches, each with rows of its own day, of the day before and, every tenth, of the first day."""
    store, want = str(tmp_path / "out"), {}
    for k in range(50):
        days = [k, max(0, k - 1), *([0] if k % 10 == 0 else [])]
        cells = [(datetime(2024, 1, 1) + timedelta(days=d, minutes=7 * j), float(j * k + 1e6), f"k{j % 2}") for d in days for j in range(3)]
        read = intervals.store_partials(spark.createDataFrame(cells, "t timestamp_ntz, v double, k string").coalesce(1), k, store, "t", ["v"], keys=["k"], stream="s", period=intervals.DAYS)
        assert read <= 2, k
        for t, v, key in cells:
            want.setdefault((t.replace(minute=t.minute // 15 * 15), key), []).append(v)
    got = {(r.time_bucket, r.k): r for r in intervals.read_partials(spark, store, ["v"], keys=["k"]).collect()}
    assert got.keys() == want.keys()
    for at, values in want.items():
        assert got[at].article_count == len(values) and got[at].v_sum == pytest.approx(sum(values)) and got[at].v_max == max(values)
        assert (got[at].v_std or 0.0) == pytest.approx(statistics.stdev(values) if len(values) > 1 else 0.0)
    assert len(commits.recorded(spark, store)) == 50
    assert commits.sweep(spark, store, hours=0) > 0
    assert {(r.time_bucket, r.k) for r in intervals.read_partials(spark, store, ["v"], keys=["k"]).collect()} == want.keys()


def test_a_batch_that_died_between_days_is_completed(spark, tmp_path, monkeypatch):
    store, put = str(tmp_path / "out"), commits.record
    rows = lambda v: spark.createDataFrame([(datetime(2024, 1, d), v) for d in (1, 2, 3)] + [(None, v)], "t timestamp_ntz, v double")  # rows without a time are left out
    sums = lambda: sorted(r.v_sum for r in intervals.read_partials(spark, store, ["v"]).collect())
    intervals.store_partials(rows(1.0), 0, store, "t", ["v"], stream="s", period=intervals.DAYS)
    done = []

    def dies(*args, **facts):
        if len(done) == 2:
            raise OSError("gone")
        done.append(put(*args, **facts))

    monkeypatch.setattr(commits, "record", dies)
    with pytest.raises(OSError):
        intervals.store_partials(rows(10.0), 1, store, "t", ["v"], stream="s", period=intervals.DAYS)
    monkeypatch.setattr(commits, "record", put)
    assert sums() == [1.0, 11.0, 11.0]
    for _ in range(2):
        intervals.store_partials(rows(10.0), 1, store, "t", ["v"], stream="s", period=intervals.DAYS)
        assert sums() == [11.0] * 3
    intervals.store_partials(rows(100.0), 0, store, "t", ["v"], stream="another", period=intervals.DAYS)  # a stream of its own begins at 0
    assert sums() == [111.0] * 3


def test_a_repeated_append_adds_nothing(spark, tmp_path):
    table, rows = str(tmp_path / "t"), spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    assert commits.append_once(rows, table, "2024/01", ["p"]) and not commits.append_once(rows, table, "2024/01", ["p"])
    rows.write.parquet(commits.new_folder(table))  # a job that died before its record
    assert commits.append_once(rows, table, "2024/02", ["p"])
    files.write_table(rows, table, "append", partition_by=["p"], token="2024/02")
    assert commits.read_committed(spark, table).count() == 4
    assert commits.sweep(spark, table, hours=0) == 1 and commits.read_committed(spark, table).count() == 4

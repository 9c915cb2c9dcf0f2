"""Day-partitioned storage, landing, events and gold."""

import zipfile

import pytest
from pyspark.sql import functions as F

from roadspeed.operators import conform_gold, five_channels
from roadspeed.sinks import land_zip, metrics_table, params_table, replace_days_jdbc, write_days, write_run
from roadspeed.sinks import gold_jdbc
from roadspeed.sources import (
    day_list, day_predicates, day_range, landed_days, list_members, pending_days, read_days, read_zip_members,
)
from roadspeed.streaming import event_values, file_events


def days_of(spark, *pairs):
    return spark.createDataFrame([(d, i) for d, n in pairs for i in range(n)], "date string, v int")


def counts(spark, base, start="20250101", end="20250131"):
    rows = read_days(spark, base, start, end, "v int, date string").groupBy("date").count().collect()
    return {r.date: r["count"] for r in rows}


def test_write_days_replaces_only_its_days(spark, tmp_path):
    base = str(tmp_path)
    write_days(days_of(spark, ("20250101", 5), ("20250102", 7), ("20250103", 2)), base)
    report = write_days(days_of(spark, ("20250102", 3)), base, days=["20250102", "20250103"])
    assert (report.rows, report.days, report.empty_days) == (3, ["20250102"], ["20250103"])
    assert counts(spark, base) == {"20250101": 5, "20250102": 3}
    again = write_days(days_of(spark, ("20250102", 3)), base)
    assert again.rows == 3 and counts(spark, base) == {"20250101": 5, "20250102": 3}


def test_small_day_is_one_file_and_files_per_day_spreads(spark, tmp_path):
    df = days_of(spark, ("20250101", 200), ("20250102", 200)).repartition(7)
    write_days(df, str(tmp_path / "a"))
    assert len(list((tmp_path / "a" / "date=20250101").glob("*.parquet"))) == 1
    write_days(df, str(tmp_path / "b"), files_per_day=8, by="v")
    assert 1 < len(list((tmp_path / "b" / "date=20250101").glob("*.parquet"))) <= 8
    assert counts(spark, str(tmp_path / "b")) == {"20250101": 200, "20250102": 200}
    report = write_days(df, str(tmp_path / "c"), as_read=True)
    assert report.rows == 400 and counts(spark, str(tmp_path / "c")) == {"20250101": 200, "20250102": 200}


def test_read_days_prunes_and_keeps_text(spark, tmp_path):
    base = str(tmp_path)
    write_days(days_of(spark, ("20250101", 1), ("20250102", 1)), base)
    inferred = read_days(spark, base, "20250102", "20250109")
    assert dict(inferred.dtypes)["date"] == "string" and inferred.count() == 1
    plan = inferred._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "DataFilters: []" in plan


def test_day_lists(spark):
    assert day_list("20241230", "20250102") == ["20241230", "20241231", "20250101", "20250102"]
    assert day_list("20250102", "20250101") == []
    assert [r.date for r in day_range(spark, "20240228", "20240301").collect()] == ["20240228", "20240229", "20240301"]
    assert day_range(spark, "20250102", "20250101").collect() == []


def archive(folder, name, members):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / name, "w", zipfile.ZIP_DEFLATED) as z:
        for member, text in members.items():
            z.writestr(member, text)


@pytest.fixture
def archives(tmp_path):
    folder = tmp_path / "zips"
    archive(folder, "20251113_5Min.zip", {"a.csv": "h\n1\n2\n", "inner/": "", "inner/b.csv": "h\n3\n"})
    archive(folder, "latest.zip", {"c.csv": "h\nä\n", "notes.txt": "n\n"})
    return str(folder)


def test_members(spark, archives):
    got = {(r.date, r.member): r.size for r in list_members(spark, archives).collect()}
    assert got == {
        ("20251113", "a.csv"): 6, ("20251113", "inner/b.csv"): 4,
        ("unknown_date", "c.csv"): 5, ("unknown_date", "notes.txt"): 2,
    }


def test_member_lines(spark, archives):
    rows = read_zip_members(spark, archives).orderBy("member", "line_no").collect()
    assert [(r.member, r.line_no, r.line) for r in rows] == [
        ("a.csv", 1, "h"), ("a.csv", 2, "1"), ("a.csv", 3, "2"), ("c.csv", 1, "h"), ("c.csv", 2, "ä"),
    ]
    assert read_zip_members(spark, archives, glob="inner/*.csv").count() == 2


def test_landing_skips_days_that_have_files(spark, archives, tmp_path):
    lake = tmp_path / "lake"
    assert landed_days(spark, str(lake)).collect() == []
    landed = land_zip(spark, archives, str(lake), days=["20251113"])
    assert {(r.date, r.key, r.size) for r in landed.collect()} == {
        ("20251113", "date=20251113/a.csv", 6), ("20251113", "date=20251113/inner/b.csv", 4),
    }
    assert (lake / "date=20251113" / "a.csv").read_text() == "h\n1\n2\n"
    assert not list(lake.rglob("_*.*"))
    wanted = day_range(spark, "20251112", "20251114")
    left = pending_days(wanted, landed_days(spark, str(lake)))
    assert sorted(r.date for r in left.collect()) == ["20251112", "20251114"]


def test_events(spark):
    landed = spark.createDataFrame([("20251113", "date=20251113/a.csv", 6)], "date string, key string, size int")
    events = file_events(landed, "lake", "raw/")
    assert event_values(events).first().value == (
        '{"date":"20251113","bucket":"lake","key":"raw/date=20251113/a.csv","size":6}'
    )


def test_conform_gold(spark):
    old = spark.createDataFrame([("a", 1, 2.0)], "LINKID string, DATETIME_5MIN int, self_mean double")
    assert conform_gold(old, "20251113").columns == ["date", "datetime", "linkid", "self_mean"]
    assert conform_gold(old, "20251113").first() == ("20251113", 1, "a", 2.0)
    new = spark.createDataFrame([(1, 2.0, "a")], "datetime_5min int, self_mean double, linkid string")
    assert conform_gold(new).columns == ["datetime", "linkid", "self_mean"]


def test_five_channels(spark):
    gold = spark.createDataFrame([("d", 1, "a", 2.0)], "date string, datetime int, linkid string, self_mean double")
    wide = five_channels(gold)
    assert wide.columns == ["datetime", "linkid", "t2_mean", "t1_mean", "self_mean", "f1_mean", "f2_mean"]
    assert wide.first()[2:] == (2.0,) * 5


def test_gold_predicates_cover_each_row_once(spark):
    rows = [("20250101", "2025-01-01 00:00:00"), ("20250101", "2025-01-01 12:00:00"), ("20250101", "2025-01-01 23:59:59"),
            ("20250102", None), ("20250103", "2025-01-03 00:00:00")]
    df = spark.createDataFrame(rows, "date string, t string").select("date", F.col("t").cast("timestamp").alias("datetime"))
    clauses = day_predicates("20250101", "20250102", slices_per_day=3)
    assert len(clauses) == 6
    assert sum(df.filter(c).count() for c in clauses) == 4
    assert day_predicates("20250101", "20250101") == ["date = '20250101'"]


class FakeConnection:
    """Records the statements of a transaction; no database is started in tests."""

    def __init__(self, fail_on=None):
        self.log, self.fail_on = [], fail_on

    def prepareStatement(self, sql):
        connection, values = self, {}

        class Statement:
            def setString(self, place, value):
                values[place] = value

            def executeUpdate(self):
                if connection.fail_on and connection.fail_on in sql:
                    raise RuntimeError("refused")
                connection.log.append((sql, [values[i] for i in sorted(values)]))

            def close(self):
                pass

        return Statement()

    def __getattr__(self, name):
        return lambda *args: self.log.append((name, list(args)))


def replace_with(monkeypatch, spark, connection, staged=None):
    gold = spark.createDataFrame([("20250101", 1.0)], "date string, self_mean double")

    def write(df, jdbc, table, mode):
        connection.log.append((mode, [table]))
        if staged and table == "s":
            raise staged

    monkeypatch.setattr(gold_jdbc, "_write", write)
    monkeypatch.setattr(gold_jdbc, "_connect", lambda spark, jdbc: connection)
    replace_days_jdbc(gold, {"url": "jdbc:x", "dbtable": "gold"}, ["20250102", "20250101"], staging="s")


def test_jdbc_replacement_is_one_transaction(spark, monkeypatch):
    connection = FakeConnection()
    replace_with(monkeypatch, spark, connection)
    assert connection.log == [
        ("ignore", ["gold"]),  # the first load creates the table
        ("overwrite", ["s"]),
        ("setAutoCommit", [False]),
        ('DELETE FROM gold WHERE "date" IN (?, ?)', ["20250101", "20250102"]),
        ('INSERT INTO gold ("date", "self_mean") SELECT DISTINCT "date", "self_mean" FROM s', []),
        ("commit", []),
        ("setAutoCommit", [True]),
        ("DROP TABLE IF EXISTS s", []),
        ("close", []),
    ]


def test_jdbc_replacement_rolls_back(spark, monkeypatch):
    connection = FakeConnection(fail_on="INSERT")
    with pytest.raises(RuntimeError, match="refused"):
        replace_with(monkeypatch, spark, connection)
    names = [name for name, _ in connection.log]
    assert "rollback" in names and "commit" not in names and names[-2:] == ["DROP TABLE IF EXISTS s", "close"]


def test_a_failed_staging_leaves_nothing(spark, monkeypatch):
    connection = FakeConnection()
    with pytest.raises(RuntimeError, match="no space"):
        replace_with(monkeypatch, spark, connection, RuntimeError("no space"))
    assert [name for name, _ in connection.log] == ["ignore", "overwrite", "DROP TABLE IF EXISTS s", "close"]


def test_run_tables(spark, tmp_path):
    wide = spark.createDataFrame([(1, 0.5, 0.1), (2, 0.4, None)], "step int, val_mae double, val_f1 double")
    long = metrics_table(wide, "r1")
    assert long.columns == ["run_id", "step", "name", "value"] and long.count() == 4
    for _ in range(2):
        write_run(long, str(tmp_path))
    write_run(metrics_table(wide.limit(1), "r2"), str(tmp_path))
    stored = {r.run_id: r["count"] for r in spark.read.parquet(str(tmp_path)).groupBy("run_id").count().collect()}
    assert stored == {"r1": 4, "r2": 2}
    assert {r.name: r.value for r in params_table(spark, "r1", {"lr": 0.1, "x": None}).collect()} == {"lr": "0.1", "x": None}


def pack(path, members):
    import zipfile

    path.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        for name, text in members.items():
            z.writestr(name, text)


def test_equal_member_names_of_a_day_all_land(spark, tmp_path):
    for stem, text in (("20251113_a", "h\n1\n"), ("20251113_b", "h\n22\n")):
        pack(tmp_path / "in" / f"{stem}.zip", {"in/data.csv": text, f"{stem[-1]}.csv": "h\n"})
    landed = land_zip(spark, str(tmp_path / "in"), str(tmp_path / "lake"))
    keys = [r.key for r in landed.collect()]
    assert len(set(keys)) == 4 and "date=20251113/a.csv" in keys
    texts = sorted(p.read_text() for p in (tmp_path / "lake/date=20251113/in").iterdir() if p.suffix == ".csv")
    assert texts == ["h\n1\n", "h\n22\n"]


@pytest.mark.parametrize("member", ["../../escaped.csv", "/etc/x.csv", "a/../../x.csv", "C:/x.csv", "a\\b.csv"])
def test_members_that_leave_their_folder_are_refused(spark, tmp_path, member):
    from roadspeed.sources.archives import safe_member

    with pytest.raises(ValueError, match="unsafe member name .* in the.zip"):
        safe_member("the.zip", member)


def test_a_bad_member_stops_the_landing(spark, tmp_path):
    pack(tmp_path / "in" / "20251113.zip", {"../../escaped.csv": "x"})
    with pytest.raises(Exception, match="unsafe member name"):
        land_zip(spark, str(tmp_path / "in"), str(tmp_path / "deep/er/lake"))
    assert not list(tmp_path.rglob("escaped.csv"))


def test_a_half_landed_day_is_completed_without_opening_other_days(spark, tmp_path):
    pack(tmp_path / "in" / "20251113.zip", {"a.csv": "1\n", "b.csv": "22\n", "c.csv": "333\n"})
    (tmp_path / "in" / "20251112.zip").write_bytes(b"not an archive")
    day = tmp_path / "lake/date=20251113"
    day.mkdir(parents=True)
    (day / "a.csv").write_text("1\n")
    (day / "b.csv").write_text("2")  # cut short
    landed = land_zip(spark, str(tmp_path / "in"), str(tmp_path / "lake"), days=["20251113"])
    assert sorted(r.key for r in landed.collect()) == ["date=20251113/b.csv", "date=20251113/c.csv"]
    assert (day / "b.csv").read_text() == "22\n"
    assert land_zip(spark, str(tmp_path / "in"), str(tmp_path / "lake"), days=["20251113"]).count() == 0


def test_lake_paths_are_qualified_before_they_enter_tasks(spark, tmp_path):
    from roadspeed.session import qualified

    assert qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    pack(tmp_path / "in" / "20251113.zip", {"a.csv": "1\n"})
    assert {r.lake for r in land_zip(spark, str(tmp_path / "in"), f"{tmp_path}/lake").collect()} == {f"file:{tmp_path}/lake"}


def test_days_without_a_source_keep_their_rows(spark, tmp_path):
    import shutil

    from roadspeed.plans import LakeConfig
    from roadspeed.plans.lake import bronze_to_silver, gold_rows, raw_to_bronze, silver_to_gold

    day = tmp_path / "raw/date=20251113"
    day.mkdir(parents=True)
    link = LakeConfig(archives="x", base="y").links[0]
    (day / "a.csv").write_text(f"CREATDE,CREATHM,LINKID,ROADINSTTCD,PASNGSPED,PASNGTIME\n20251113,0005,{link},R,50,1\n")
    cfg = LakeConfig(archives=str(tmp_path), base=str(tmp_path))

    def run():
        reports = [step(spark, cfg, "20251113", "20251114") for step in (raw_to_bronze, bronze_to_silver)]
        silver_to_gold(spark, cfg, "20251113", "20251114")
        return reports

    bronze, _ = run()
    assert (bronze.rows, bronze.empty_days, bronze.absent_days) == (1, [], ["20251114"])
    shutil.rmtree(day)
    bronze, silver = run()
    assert bronze.absent_days == ["20251113", "20251114"] and silver.rows == 1
    assert gold_rows(spark, cfg, "20251113", "20251114").count() == 1

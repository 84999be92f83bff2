import shutil
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bondscope import files
from bondscope.session import Staging, drop_database, own_database, renew_leases, staging_folder, sweep
from bondscope.sources import results
from bondscope.sources.results import (
    CSV,
    Run,
    archive_run,
    cleanup,
    publish,
    read_bundle,
    read_result,
    to_cells,
    write_bundle,
)
from bondscope.sources.tables import CORP_TABLES, SCHEMAS, jdbc_options, load, load_tables, preview, report_dates
from tests.golden import WINDOW, at, corp_row, rows_of, table

FIRST, SECOND = date(2024, 1, 19), date(2024, 1, 26)


def sections(spark, n):
    return {
        "winners": spark.createDataFrame([(n, "a")], "Ord int, Name string"),
        "spread": spark.createDataFrame([("x", float(n))], f"grp string, `01/{n}/24` double"),
    }


def test_publish_views_and_drop_them(spark):
    assert publish(sections(spark, 1)) == ["winners", "spread"]
    publish(sections(spark, 2))  # replaces
    assert rows_of(read_result(spark, "winners")) == [(2, "a")]
    assert cleanup(spark, ["winners", "spread", "absent"]) == ["winners", "spread"]
    assert cleanup(spark, ["winners"]) == []
    with pytest.raises(Exception, match="winners"):
        read_result(spark, "winners")


def test_cleanup_lets_frames_go(spark):
    frame = spark.range(5).persist()
    cleanup(spark, [], [frame])
    assert not frame.is_cached


def test_published_datasets_replace_only_their_own_run(spark, tmp_path):
    path = str(tmp_path)
    publish(sections(spark, 1), path, report_date=FIRST, sector="HY")
    publish(sections(spark, 2), path, report_date=SECOND, sector="HY")
    publish(sections(spark, 3), path, report_date=SECOND, sector="IG")
    publish(sections(spark, 4), path, report_date=SECOND, sector="HY")
    got = sorted(rows_of(read_result(spark, "winners", path), "report_date", "sector", "Ord"))
    assert got == [(FIRST, "HY", 1), (SECOND, "HY", 4), (SECOND, "IG", 3)]
    one = read_result(spark, "spread", path, report_date=FIRST)
    assert "01/1/24" in one.columns and "01/4/24" not in one.columns
    assert rows_of(read_result(spark, "winners", path, report_date=SECOND, sector="IG"), "Ord") == [(3,)]
    with pytest.raises(ValueError):
        publish(sections(spark, 1), path)


def test_archive_copies_one_run(spark, tmp_path):
    path, archive = str(tmp_path / "now"), str(tmp_path / "old")
    publish(sections(spark, 1), path, report_date=FIRST, sector="HY")
    publish(sections(spark, 2), path, report_date=SECOND, sector="HY")
    archived = archive_run(spark, path, archive, ["winners", "spread"], FIRST)
    publish(sections(spark, 9), path, report_date=FIRST, sector="HY")
    assert rows_of(archived["winners"], "Ord", "sector") == [(1, "HY")]
    assert rows_of(read_result(spark, "winners", archive), "Ord") == [(1,)]
    assert read_result(spark, "spread", archive).first()["01/1/24"] == 1.0


def test_sectors_of_one_date_keep_their_own_columns(spark, tmp_path):
    path, archive = str(tmp_path / "now"), str(tmp_path / "old")
    publish(sections(spark, 1), path, report_date=FIRST, sector="HY")
    publish(sections(spark, 2), path, report_date=FIRST, sector="IG")
    both = archive_run(spark, path, archive, ["spread"], FIRST)["spread"]
    assert {"01/1/24", "01/2/24"} <= set(both.columns)
    assert sorted(rows_of(both, "sector", "01/1/24", "01/2/24")) == [("HY", 1.0, None), ("IG", None, 2.0)]
    one = read_result(spark, "spread", archive, report_date=FIRST, sector="IG")
    assert "01/1/24" not in one.columns and rows_of(one, "01/2/24") == [(2.0,)]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_bundle_round_trip(spark, tmp_path, fmt):
    path = str(tmp_path)
    written = sections(spark, 7) | {"dates": report_dates(spark, WINDOW)}
    write_bundle(spark, written, path, fmt)
    write_bundle(spark, written, path, fmt)  # replaces
    found = read_bundle(spark, path, fmt)
    assert list(found) == ["winners", "spread", "dates"]
    for name, frame in found.items():
        assert frame.dtypes == written[name].dtypes
        assert rows_of(frame) == rows_of(written[name])
    with pytest.raises(ValueError):
        write_bundle(spark, written, path, "xlsx")


AWKWARD = ["a\nb", "\r\n", "", None, " lead ", "\t", 'say "x"', '"', "\\", "\\n", "\\N", "\\E", "\\b\\", "a,b;c", "\0", "é漢\u2028x", "null", "#"]


def test_text_bundle_keeps_every_value(spark, tmp_path):
    schema = (
        "n int, `a,\"b` string, d decimal(12,5), x double, f float, t timestamp, z timestamp_ntz, day date, flag boolean, raw binary"
    )
    moment, zoned = datetime(2024, 1, 26, 15, 0, 0, 123456), datetime(2024, 10, 27, 1, 30, tzinfo=UTC)
    rows = [
        (n, body, Decimal("-1.50000"), x, 0.1, zoned, moment, FIRST, n % 2 == 0, b"\0\n\xff")
        for n, (body, x) in enumerate(zip(AWKWARD, [0.1, -0.0, float("inf"), 1e-300, 1 / 3, None] * 3, strict=True))
    ]
    rows.append((None,) * 10)
    written = {"awkward": spark.createDataFrame(rows, schema), "none": spark.createDataFrame([], "a string")}
    write_bundle(spark, written, str(tmp_path), "csv")
    found = read_bundle(spark, str(tmp_path), "csv")
    assert found["awkward"].schema == written["awkward"].schema
    assert sorted(map(repr, rows_of(found["awkward"]))) == sorted(map(repr, rows_of(written["awkward"])))
    assert found["none"].count() == 0 and found["none"].columns == ["a"]
    with pytest.raises(ValueError, match="'m' of 'x' is nested"):
        write_bundle(spark, {"x": spark.sql("select map(1, 2) as m")}, str(tmp_path), "csv")


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_bundle_with_missing_rows_is_refused(spark, tmp_path, fmt):
    write_bundle(spark, {"x": spark.range(10)}, str(tmp_path), fmt)
    shown = spark.range(9) if fmt == "parquet" else to_cells(spark.range(9))
    writer = shown.write.mode("overwrite").format(fmt)
    (writer.options(**CSV) if fmt == "csv" else writer).save(f"{tmp_path}/sections/x")
    with pytest.raises(ValueError, match="'x' has 9 rows, its manifest 10"):
        read_bundle(spark, str(tmp_path), fmt)


def failing(spark):
    return spark.range(3).select(F.raise_error(F.lit("broken")).cast("int").alias("Ord"))


def test_a_publish_that_fails_leaves_the_old_run_whole(spark, tmp_path):
    path, third = str(tmp_path), {"third": spark.range(1)}
    publish(sections(spark, 1) | third, path, report_date=FIRST, sector="H/Y 1")
    publish(sections(spark, 1) | third)
    before = sorted(p for p in tmp_path.rglob("*") if p.is_file())
    for target in ({"path": path, "report_date": FIRST, "sector": "H/Y 1"}, {}):
        with pytest.raises(Exception, match="broken"):
            publish(sections(spark, 2) | {"third": failing(spark)}, **target)
    assert sorted(p for p in tmp_path.rglob("*") if p.is_file()) == before
    assert rows_of(read_result(spark, "winners", path, sector="H/Y 1"), "Ord", "sector") == [(1, "H/Y 1")]
    assert rows_of(read_result(spark, "winners"), "Ord") == [(1,)]
    cleanup(spark, ["winners", "spread", "third"])


def test_readers_keep_the_version_they_began_with(spark, tmp_path):
    path = str(tmp_path)
    publish(sections(spark, 1), path, report_date=FIRST, sector="HY")
    begun = read_result(spark, "winners", path)
    publish(sections(spark, 2), path, report_date=FIRST, sector="HY")
    assert rows_of(begun, "Ord") == [(1,)] and rows_of(read_result(spark, "winners", path), "Ord") == [(2,)]
    publish(sections(spark, 3) | {"spread": spark.createDataFrame([], "grp string")}, path, report_date=FIRST, sector="HY")
    # the current version and the one before
    assert len(list(tmp_path.glob("winners/*/*/version=*"))) == 2
    assert read_result(spark, "spread", path).count() == 0
    with pytest.raises(ValueError, match="no published 'absent'"):
        read_result(spark, "absent", path)


def test_an_archive_is_finished_by_another_call(spark, tmp_path):
    path, archive = str(tmp_path / "now"), tmp_path / "old"
    publish(sections(spark, 1), path, report_date=FIRST, sector="HY")
    publish(sections(spark, 2), path, report_date=FIRST, sector="IG")
    first = archive_run(spark, path, str(archive), ["winners", "spread"], FIRST)
    wanted = {n: sorted(map(repr, rows_of(f))) for n, f in first.items()}
    times = lambda: {p: p.stat().st_mtime_ns for p in archive.rglob("*.parquet")}
    before = times()
    archive_run(spark, path, str(archive), ["winners", "spread"], FIRST)
    assert times() == before  # nothing lacked
    # one sector is lost, one file of the other is cut short
    shutil.rmtree(archive / "winners/report_date=2024-01-19/sector=HY")
    cut = next(p for p in before if "winners" in str(p) and "sector=IG" in str(p))
    cut.write_bytes(b"PAR1")
    again = archive_run(spark, path, str(archive), ["winners", "spread"], FIRST)
    assert {n: sorted(map(repr, rows_of(f))) for n, f in again.items()} == wanted
    kept = [p for p in before if "spread" in str(p)]
    assert kept and all(times()[p] == before[p] for p in kept)
    # a newer version of the source is copied
    publish(sections(spark, 5), path, report_date=FIRST, sector="HY")
    newer = archive_run(spark, path, str(archive), ["winners"], FIRST)["winners"]
    assert sorted(rows_of(newer, "sector", "Ord")) == [("HY", 5), ("IG", 2)]


def test_copies_that_differ_are_not_entered(spark, tmp_path, monkeypatch):
    path, archive = str(tmp_path / "now"), str(tmp_path / "old")
    publish(sections(spark, 1), path, report_date=FIRST, sector="HY")
    monkeypatch.setattr(results, "_measured", lambda run, name, entry: {**entry, "checksum": "0"})
    with pytest.raises(ValueError, match="differs from its source"):
        archive_run(spark, path, archive, ["winners"], FIRST)
    assert Run.all_in(spark, archive) == []


def test_left_over_places_are_swept(spark, tmp_path):
    folder, own = staging_folder(spark), own_database(spark)
    place = f"{folder}/{own}"
    assert files.exists(spark, place)
    left = str(tmp_path / "left")
    spark.range(3).write.parquet(left)
    told = {"application": "another", "place": left, "time": 0}
    files.write_record(spark, f"{folder}/leases/aged.json", told)
    files.write_record(spark, f"{folder}/leases/fresh.json", told | {"place": place, "time": 9e9})
    renew_leases(spark)
    assert sweep(spark) == [left] and not files.exists(spark, left)
    assert files.exists(spark, place) and sweep(spark) == []
    files.remove(spark, f"{folder}/leases/fresh.json")
    held = len(files.names_in(spark, f"{folder}/leases"))
    drop_database(spark, own)
    assert not files.exists(spark, place) and len(files.names_in(spark, f"{folder}/leases")) == held - 1


def test_a_record_is_written_once(spark, tmp_path):
    assert files.write_record(spark, f"{tmp_path}/r.json", {"n": 1}) and not files.write_record(spark, f"{tmp_path}/r.json", {"n": 2})
    assert files.read_record(spark, f"{tmp_path}/r.json") == {"n": 1} and files.names_in(spark, f"{tmp_path}/none") == []


def test_staged_tables_go_with_their_lease(spark):
    staging = Staging(spark)
    frame, told = staging.measured(spark.range(7), "few", rows=F.count("*"), last=F.max("id"))
    assert told == {"rows": 7, "last": 6} and frame.count() == 7
    place = f"{staging_folder(spark)}/{staging.database}"
    staging.release()
    assert not files.exists(spark, place)


def test_types_are_reconciled(spark, tmp_path):
    written = spark.sql(
        """SELECT 1S AS MuniCompositeId, CAST(2 AS DECIMAL(18,0)) AS SecurityId, TIMESTAMP '2024-01-26 15:00:00.25Z' AS Date,
        CAST(1.5 AS FLOAT) AS BidComposite, 3 AS OfferComposite, 4Y AS ProviderCount, 5S AS BidCount, 6 AS OfferCount, 1 AS IsSnap,
        false AS IsQuarantined, '{}' AS JsonDetail, TIMESTAMP_NTZ '2024-01-26 16:00:00' AS UpdatedDate, 'x' AS Unused"""
    )
    written.write.parquet(str(tmp_path / "muni_composite"))
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            loaded = load(spark, "muni_composite", str(tmp_path))
            assert loaded.schema.simpleString() == T.StructType.fromDDL(SCHEMAS["muni_composite"]).simpleString()
            assert loaded.first()["Date"] == datetime(2024, 1, 26, 15, 0, 0, 250000)
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows_of(loaded, "MuniCompositeId", "SecurityId", "BidComposite", "OfferComposite", "IsSnap") == [(1, 2, 1.5, 3.0, True)]


@pytest.mark.parametrize(
    "name, value",
    [("SecurityId", "'1'"), ("Date", "'2024-01-26'"), ("Date", "DATE '2024-01-26'"), ("BidCount", "1L"), ("BidComposite", "1L"), ("JsonDetail", "1"), ("IsSnap", "'t'")],
)
def test_types_that_lose_values_are_refused(spark, name, value):
    frame = table(spark, "muni_composite", []).withColumn(name, F.expr(value))
    frame.createOrReplaceTempView("muni_composite")
    with pytest.raises(ValueError, match=f"column '{name}' of table 'muni_composite' is"):
        load(spark, "muni_composite")
    spark.catalog.dropTempView("muni_composite")


def test_load_from_files_and_from_views(spark, tmp_path):
    frame = table(spark, "corp_composite", [corp_row(1, 1, at("2024-01-22"))])
    frame.selectExpr("*", "date '2024-01-22' as Day", "1 as Unused").write.parquet(str(tmp_path / "corp_composite"))
    loaded = load(spark, "corp_composite", str(tmp_path), keep=["Day"])
    assert loaded.columns == [*frame.columns, "Day"] and loaded.count() == 1
    frame.createOrReplaceTempView("corp_composite")
    assert rows_of(load(spark, "corp_composite")) == rows_of(frame)
    with pytest.raises(ValueError, match="unknown"):
        load(spark, "trades")
    frame.drop("IsSnap").createOrReplaceTempView("corp_composite")
    with pytest.raises(ValueError, match="IsSnap"):
        load_tables(spark, CORP_TABLES[:1])
    spark.catalog.dropTempView("corp_composite")


def test_jdbc_options():
    plain = jdbc_options("jdbc:x://h", "dbo.Security")
    assert plain == {"url": "jdbc:x://h", "dbtable": "dbo.Security", "fetchsize": "10000"}
    split = jdbc_options(
        "jdbc:x://h", "SELECT a FROM t", partition_column="a", lower=1, upper=900, partitions=8, driver="d",
        properties={"user": "u"},
    )
    assert split["dbtable"] == "(SELECT a FROM t) source" and split["user"] == "u" and split["driver"] == "d"
    assert [split[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["a", "1", "900", "8"]
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x://h", "t", partition_column="a")


def test_preview_prints_the_first_rows(spark, capsys):
    preview(spark.range(100), 2)
    assert "only showing top 2 rows" in capsys.readouterr().out

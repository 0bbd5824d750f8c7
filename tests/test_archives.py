import io
import zipfile

import pytest
from pyspark.sql import functions as F

from barloom.plans import history
from barloom.sinks.bar_table import BarTable
from barloom.sinks.run_state import RunState
from barloom.sources import archives, feeds
from barloom.sources.archive_source import ArchiveFolder, ZipHistoryReader, chosen
from queries.feeds import Feeds
from tests.helpers import d


def packed(entries):
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in entries:
            z.writestr(name, text)
    return content.getvalue()


GOOD = packed(
    [
        ("x.HSX.csv", " fpt ,20240102,10,12,9,11,100\r\nFPT,20240102,10,12,9,11.5,200\n\nbad\n"),
        ("x.HNX.csv", "SHS,20240102,1,2,0.5,1.5,7\nFPT,20240102,10,13,9,12,300\nSHS,20240103,1,2,0.5,1.5,16777217\n"),
        ("readme.txt", "FPT,20240102,1,1,1,1,1\n"),
        ("empty.UPCOM.csv", ""),
    ]
)


def broken_entry():
    """An archive whose first entry fails its checksum after most lines were read."""
    content = bytearray(packed([("a.HNX.csv", "AAA,20240102,1,2,1,1,1\n" * 3), ("b.HNX.csv", "BBB,20240102,1,2,1,1,1\n")]))
    place = content.index(b"a.HNX.csv") - 16
    content[place] ^= 0xFF  # CRC in the local header
    central = content.index(b"PK\x01\x02") + 16
    content[central] ^= 0xFF  # CRC in the central directory
    return bytes(content)


@pytest.fixture
def folder(tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "Raw.Upto02012024.zip").write_bytes(GOOD)
    (landing / "Raw.Upto03012024.zip").write_bytes(broken_entry())
    (landing / "Raw.Upto04012024.zip").write_bytes(b"<html>not found</html>")
    (landing / "Raw.Upto05012024.zip").write_bytes(GOOD[: len(GOOD) // 2])
    (landing / "Raw.Upto06012024.zip").write_bytes(packed([("readme.txt", "x")]))
    (landing / "Raw.Upto07012024.zip").write_bytes(b"")
    return str(landing)


def test_scan_skips_what_is_damaged(spark, rows, folder):
    files = archives.read_archives(spark, folder)
    scanned = archives.archive_scan(files)
    got = rows(scanned.filter("symbol is not null and trading_date is not null"), "symbol", "exchange", "close_price", "total_volume")
    assert got == [
        (" fpt ", "HoSE", 11.0, "100"),
        ("BBB", "HNX", 1.0, "1"),
        ("FPT", "HNX", 12.0, "300"),
        ("FPT", "HoSE", 11.5, "200"),
        ("SHS", "HNX", 1.5, "16777217"),
        ("SHS", "HNX", 1.5, "7"),
    ]
    names = {p.rsplit("/", 1)[1] for (p,) in archives.quarantined(files).select("path").collect()}
    # An empty file is not even listed; its day shows up as unfilled.
    assert names == {"Raw.Upto04012024.zip"}
    problems = [(a.rsplit("/", 1)[1], e) for a, e, _ in archives.archive_problems(files).collect()]
    assert sorted(problems, key=str) == [("Raw.Upto03012024.zip", "a.HNX.csv"), ("Raw.Upto05012024.zip", None)]


def test_history_load_keeps_the_last_line(spark, rows, folder):
    files = archives.read_archives(spark, folder).filter(F.col("path").contains("Upto02"))
    bars = history.history_load(files, "archive")
    # FPT is in two entries; the entry later in the archive wins.
    assert rows(bars, "symbol", "trading_date", "close_price", "total_volume", "exchange") == [
        ("FPT", d("2024-01-02"), 12000.0, 300, "HNX"),
        ("SHS", d("2024-01-02"), 1500.0, 7, "HNX"),
        ("SHS", d("2024-01-03"), 1500.0, 16777217, "HNX"),
    ]
    assert history.history_load(files, "archive", day=d("2024-01-03")).count() == 1
    blacklist = spark.createDataFrame([("SHS",)], "symbol string")
    assert rows(history.history_load(files, "archive", blacklist), "symbol") == [("FPT",)]


def test_backfill_takes_each_day_from_its_own_archive(spark, rows, folder):
    files = archives.read_archives(spark, folder)
    wanted = spark.createDataFrame([(d("2024-01-02"),), (d("2024-01-03"),), (d("2024-01-05"),)], "trading_date date")
    filled = history.backfill(files, [row[0] for row in wanted.collect()], "archive")
    # The first archive also holds a line of the 3rd, which is not its own day.
    assert rows(filled, "symbol", "trading_date") == [("FPT", d("2024-01-02")), ("SHS", d("2024-01-02"))]
    assert rows(history.unfilled_days(wanted, filled)) == [(d("2024-01-03"),), (d("2024-01-05"),)]


def named(spark, **volumes):
    line = "AAA,20240131,1,2,1,1,{}\n"
    files = [(f"x/{name.replace('_', '.')}.zip", packed([("x.HNX.csv", line.format(v))])) for name, v in volumes.items()]
    return spark.createDataFrame(files, "path string, content binary")


def test_the_newer_archive_wins_by_its_day(spark, rows):
    files = named(spark, Upto31012024=1000, Upto01022024=2000, Raw_Upto02022024=3000)
    volume = lambda **kw: rows(history.history_load(files, "archive", **kw), "total_volume")
    assert volume(kind="adjusted") == [(2000,)] and volume(kind="raw") == volume() == [(3000,)]
    with pytest.raises(ValueError):
        history.history_load(files, "archive", kind="both")


def test_backfill_of_one_kind(spark, rows):
    files = named(spark, Upto31012024=1000, Raw_Upto31012024=3000)
    for kind, volume in (("raw", 3000), ("adjusted", 1000)):
        filled = history.backfill(files, [d("2024-01-31")], "archive", kind=kind)
        assert rows(filled, "total_volume") == [(volume,)]


def test_only_wanted_archives_are_opened(spark, folder):
    wanted = archives.select_archives(archives.read_archives(spark, folder), days=[d("2024-01-02"), d("2024-01-06")])
    assert len(wanted.collect()) == 2
    scan = wanted._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 2


def test_a_long_entry_keeps_its_lines_in_order(spark, monkeypatch):
    monkeypatch.setattr(archives, "_LINES_PER_TASK", 1000)
    text = "".join(f"S{n},20240102,1,2,1,1,{n}\n" for n in range(50_000))
    files = spark.createDataFrame([("x/Upto02012024.zip", packed([("x.HNX.csv", text)]))], "path string, content binary")
    got = archives.archive_scan(files)
    assert got.filter("symbol = concat('S', line_no) AND total_volume = cast(line_no AS string)").count() == 50_000


def test_run_history(spark, rows, folder, tmp_path):
    from datetime import datetime

    files = archives.read_archives(spark, folder)
    table, state = BarTable(str(tmp_path / "raw"), buckets=1), RunState(str(tmp_path / "state"))
    history.run_history(files, table, "archive", datetime(2024, 1, 4, 9, 0), state)
    assert table.read(spark).count() == 4
    assert state.run(spark).first() == ("2024-01-03", True, 3)
    assert rows(state.snapshot(spark), "symbol", "close_price") == [("BBB", 1000), ("FPT", 12000), ("SHS", 1500)]
    history.run_history(files, table, "archive", datetime(2024, 1, 4, 9, 0), day=d("2024-01-03"))
    assert table.read(spark).count() == 4
    with pytest.raises(ValueError, match="no bar is left"):
        history.run_history(files, table, "archive", datetime(2024, 1, 4, 9, 0), day=d("2030-01-01"))
    assert table.read(spark).count() == 4
    history.run_history(ArchiveFolder(spark, folder), table, "archive", datetime(2024, 1, 4, 9, 0), until=d("2024-01-02"))
    assert rows(table.read(spark), "symbol") == [("FPT",), ("SHS",), ("SHS",)]


def test_landed_feeds(spark, rows, tmp_path):
    blacklist = tmp_path / "blacklist.txt"
    blacklist.write_text("# bad ones\n\n aaa \nBBB\nBBB\n  # more\n")
    assert rows(feeds.blacklist_load(spark, str(blacklist))) == [("AAA",), ("BBB",)]

    lines = tmp_path / "hose_landing" / "csv"
    lines.mkdir(parents=True)
    (lines / "HNX.csv").write_text("AAA,20240102,1,x,NaN,Inf,7.0\nBBB,20240102\n")
    got = feeds.csv_scan(spark, str(lines))
    assert rows(got, "symbol", "high_price", "total_volume", "exchange") == [
        ("AAA", None, "7.0", "HNX"),
        ("BBB", None, None, "HNX"),
    ]

    page = tmp_path / "events.json"
    page.write_text('{"data":{"content":[{"ticker":"FPT","eventCode":"DIV"},{"exrightDate":"2024-01-02"}]}}\n{"data":{}}\n')
    assert rows(feeds.event_scan(spark, str(page)), "ticker", "exrightDate") == [(None, "2024-01-02"), ("FPT", None)]

    board = tmp_path / "board.json"
    board.write_text('{"symbol":"A","close_price":1,"time":5}\n{"symbol":"B","close_price":1.5}\n')
    assert rows(feeds.board_scan(spark, str(board)), "symbol", "close_price", "time") == [("A", 1.0, 5), ("B", 1.5, None)]


def test_source_gives_the_same_lines_and_problems(spark, rows, folder):
    files, source = archives.read_archives(spark, folder), ArchiveFolder(spark, folder)
    columns = ["entry", "entry_no", "line_no", "line"]
    name = F.regexp_extract("archive", "[^/]*$", 0).alias("name")
    sound = lambda lines: rows(lines.filter("error is null").select(name, *columns))
    assert sound(source.lines()) == sound(archives.archive_lines(files)) != []
    bad = rows(source.lines().filter("error is not null").select(name, "entry", "error"))
    assert [(n[8:10], e) for n, e, _ in bad] == [("03", "a.HNX.csv"), ("04", None), ("05", None), ("07", None)]
    assert source.lines().filter("error is not null and line is not null").count() == 0
    bars = history.history_load(source, "archive")
    assert rows(bars) == rows(history.history_load(files, "archive")) != []


def test_source_reads_an_entry_per_task_without_a_shuffle(spark, folder):
    scan = ArchiveFolder(spark, f"file://{folder}").scan()
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "BatchScan" in plan
    parts = ZipHistoryReader({"path": folder}).partitions()
    assert sorted((p.archive[-16:-4], p.entry) for p in parts if p.error is None) == [
        ("Upto02012024", "empty.UPCOM.csv"), ("Upto02012024", "x.HNX.csv"), ("Upto02012024", "x.HSX.csv"),
        ("Upto03012024", "a.HNX.csv"), ("Upto03012024", "b.HNX.csv"),
    ]


def test_source_skips_to_an_entry_of_a_large_archive(spark, tmp_path):
    """An archive above 2 GB, most of it a hole: only the wanted entry's bytes are read."""
    path = tmp_path / "Raw.Upto02012024.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.HSX.csv", "AAA,20240102,1,2,1,1,1\n")
    small = path.read_bytes()
    hole = 3 << 30
    with open(path, "wb") as out:
        out.write(b"PK\x03\x04")
        out.truncate(hole)
        out.seek(hole)
        out.write(small)
    assert path.stat().st_size > 2**31
    got = ArchiveFolder(spark, str(tmp_path)).scan().select("symbol", "exchange", "total_volume").collect()
    assert [tuple(r) for r in got] == [("AAA", "HoSE", "1")]


def test_source_of_an_empty_folder(spark, tmp_path):
    assert ArchiveFolder(spark, str(tmp_path)).scan().collect() == []
    assert ArchiveFolder(spark, str(tmp_path)).lines(days=[d("2024-01-02")]).collect() == []


def test_names_are_chosen_alike(spark, rows):
    names = ["x/Raw.Upto31012024.zip", "x/Raw.Upto01022024.zip", "x/Upto05022024.zip", "x/part-1.zip", "x/Raw.Upto99992024.zip"]
    files = spark.createDataFrame([(n, b"") for n in names], "path string, content binary")
    for kind in archives.KINDS:
        for days in (None, ["2024-01-31"], ["2024-02-05", "2024-02-01"]):
            for until in (None, "2024-01-01", "2024-01-31", "2024-02-03", "2024-03-01"):
                if days and until:
                    continue
                kept = archives.select_archives(files, kind, days and [d(x) for x in days], until and d(until))
                assert sorted(r[0] for r in rows(kept, "path")) == sorted(chosen(names, kind, days and ",".join(days), until)), (kind, days, until)


def test_day_archives_are_dealt_without_a_pass_for_ranges(spark):
    """Archives of a day hold its lines in order; Spark makes the text of a line and needs no sample to deal them."""
    nan, inf = float("nan"), float("inf")
    prices = [(1.5, 2e10, None, nan), (inf, -inf, 1e-7, 100.0)]
    rows = [
        (k * 1_000, None if k == 5 else f"S{k}", "20240102" if k % 3 else "2024xx01", *prices[k % 2], "7", " hose " if k % 4 else None)
        for k in range(900)
    ]
    schema = "seq long, symbol string, trading_date string, open_price double, high_price double, low_price double, close_price double, total_volume string, exchange string"
    files = Feeds(spark, "none").day_archives(spark.createDataFrame(rows, schema).repartition(5))
    assert "rangepartitioning" not in files._jdf.queryExecution().executedPlan().toString()
    days = {}
    for path, content in sorted(files.collect()):
        assert path[16:] in ("Raw.Upto02012024.zip", "Raw.Upto01012024.zip")
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for name in archive.namelist():
                lines = archive.read(name).decode().splitlines()
                days.setdefault((path[16:], name), []).extend(line.split(",") for line in lines)
    got = {key: [fields[0] for fields in found] for key, found in days.items()}
    for day, wrong in (("02", False), ("01", True)):
        for name, empty in (("hose.csv", False), ("other.csv", True)):
            want = [r[1] or "" for r in rows if (r[2] == "2024xx01") == wrong and (r[8] is None) == empty]
            assert got[f"Raw.Upto{day}012024.zip", name] == want
    texts = {fields[0]: fields[2:] for found in days.values() for fields in found}
    assert texts["S1"] == ["Inf", "-inf", "1.0E-7", "100.0", "7"] and texts["S2"] == ["1.5", "2.0E10", "", "NaN", "7"]

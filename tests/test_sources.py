"""Hand-written provider text with its edge cases."""

import gzip

import pytest
from pyspark.sql import functions as F

from orrery.functions import time
from orrery.sinks.lines import write_lines
from orrery.sources import elements, filenames, lines, manoeuvres, orbits, ranging


def text(spark, rows, file="f"):
    return spark.createDataFrame([(file, i, v) for i, v in enumerate(rows)], "file string, line_no long, value string")


L1 = "1 25544U 98067A   08264.51782528 -.00002182  00000-0 -11606-4 0  2927"
L2 = "2 25544  51.6416 247.4627 0006703 130.5360 325.0288 15.72125391563537"


def test_element_pairs(spark):
    rows = ["0 NAME", L1, L2, L1[:-1] + "0", L2, L1[:40], L2, L1, L2[:2] + "11111" + L2[7:], "2 stray", "junk", L1]
    p = elements.parse_pairs(text(spark, rows), chunk=3)
    ok = elements.accepted(p).collect()
    assert len(ok) == 1 and abs(ok[0].bstar + 0.11606e-4) < 1e-12 and abs(ok[0].eccentricity - 0.0006703) < 1e-12
    assert abs(ok[0].mean_motion - 15.72125391 * 2 * 3.141592653589793 / 1440) < 1e-12
    led = {r.reason: r.n for r in elements.reject_ledger(p).collect()}
    assert led["name_lines"] == 2 and led["pairs_accepted"] == 1 and led["checksum_line1"] == 1 and led["short_line"] == 1 and led["unrecognized_line"] == 2


def test_century_pivots(spark):
    r = spark.sql("select 56 a, 57 b, 85 c, 86 d").select(*[time.full_year(F.col(x), p, inc).alias(x) for x, p, inc in (("a", 57, False), ("b", 57, False), ("c", 85, True), ("d", 85, True))]).first()
    assert tuple(r) == (2056, 1957, 2085, 1986)


NINE = "SAT 2016 366 01 00 2016 366 02 00"


def test_manoeuvre_arity_and_days(spark):
    good = manoeuvres.parse_history(text(spark, ["# c", NINE, NINE + " C 2", NINE + " C 1 2016 366 01 30 26.812 0", NINE]), "s").collect()
    assert sorted((r.role, r.uncertainty_s, r.impulses) for r in good) == [("first_impulse_time", 0.0005, 1), ("reported_operation_end_time", 3630.0, 0), ("reported_operation_end_time", 3630.0, 2)]
    with pytest.raises(Exception, match="manoeuvre record"):
        manoeuvres.parse_history(text(spark, [NINE + " C"]), "s").collect()
    bad = manoeuvres.parse_history(text(spark, [NINE.replace("2016 366 02", "2015 366 02")]), "s", strict=False).first()
    assert bad.problem == "unreadable_time"


def test_sessions_clear_at_h8(spark):
    rows = ["H2 STA 7090 1", "H4 1 2020 02 29 00 00 00 2020 02 29 01 00 00", "10 3600.5 0.01 std 2", "11 3601 0.01 std 2 30 12 50", "H8", "10 10 0.01 std 2", "ZZ", "93 free", "11 1 0.01 std"]
    p = ranging.parse_sessions(text(spark, rows), chunk=2).orderBy("line_no").collect()
    assert [r.reject_reason for r in p] == [None, None, "epoch_reference_missing", "unknown_record_type", "short_record"]
    assert p[0].t == 1582934400000000 + 3600500000 and p[1].num_returns == 12 and p[1].station_id == "7090"


def test_passes(spark):
    data = "360000000000" + "010000000000" + "0000050" + "0" * 12 + "0012" + "0" * 7
    rows = [data, "99999", "7603901" + "86" + "001" + "7090" + "00", data, "99999", "BAD", data[:20], data]
    p = ranging.parse_passes(text(spark, rows), chunk=2).orderBy("line_no").collect()
    assert [r.reject_reason for r in p] == ["data_without_active_pass", None, "malformed_header_record", "short_data_record", None]
    assert p[1].t == 504921600000000 + 36_000_000_000 and p[1].num_returns == 12


def test_fixed_width_century_and_launch_anchor(spark):
    rec = " 105501" + " 5" + "366" + "000000000000" + "7090" + " " * 17 + "010000000000" + "0000050" + "5320" + " " * 46 + "5" + "  12"
    r = ranging.parse_fixed_width(text(spark, [rec, "short"])).orderBy("line_no").collect()
    assert r[0].t == 1136073600000000 and r[0].window_s == 5.0 and r[0].target_id == "0105501" and r[1].reject_reason == "malformed_record"
    m = spark.createDataFrame([("f", 1200000000000000, None)], "file string, start_t long, end_t long")
    assert ranging.parse_fixed_width(text(spark, [rec]), m).first().reject_reason == "epoch_outside_mission_window"


def test_format_detection(spark):
    parts = {"a": ["", "H1 CRD 2"], "b": ["99999"], "c": ["<!DOCTYPE html>"], "d": ["hello"], "e": [" "]}
    df = None
    for f, rows in parts.items():
        x = text(spark, rows, f)
        df = x if df is None else df.unionByName(x)
    assert {r.file: r.format for r in ranging.detect_format(df).collect()} == {"a": "crd", "b": "legacy_npt", "c": "html_error_page", "d": "unknown", "e": "unknown"}


def test_epoch_blocks(spark):
    num = lambda *v: "".join(f"{x:14.6f}" for x in v)
    rows = ["*  2020  1  1  0  0  0.00000000", "PL01" + num(7000, 0, 0, 999999.999999), "VL01" + num(0, 75460, 0), "*  2020  1  1  0  1  0.00000000", "PL01" + num(7000, 1, 0, 5), "PL01 bad"]
    out, led = orbits.parse_epoch_blocks(text(spark, rows), chunk=2)
    r = out.orderBy("t").collect()
    assert r[0].x == 7e6 and r[0].clock is None and abs(r[0].vy - 7546.0) < 1e-9 and r[1].vy is None and r[1].clock == 5.0
    n = led.first()
    assert (n.p_records, n.p_records_rejected, n.v_records, n.clock_sentinel_rows, n.velocity_unit_basis) == (2, 1, 1, 1, "dm/s_spec")


def test_names(spark):
    rows = [("S3A_OPER_V20200101T000000_20200102T000000_x.EOF",), ("a_20200101_000000_20200101_010203.nc",), ("X_20200321200_01D_30S.rnx",), ("s.b20032.e20033.x",), ("none",)]
    got = [r.s for r in spark.createDataFrame(rows, "n string").select(filenames.orbit_span(F.col("n")).alias("s")).collect()]
    day = 86_400_000_000
    assert [g and g.e - g.s for g in got] == [day, 3723_000_000, day, 2 * day, None]
    m = spark.createDataFrame([("a_202002.npt",), ("a_20200229.npt",), ("a_20201399.npt",)], "n string").select(filenames.ranging_span(F.col("n")).alias("s")).collect()
    assert m[0].s.e - m[0].s.s == 29 * day and m[1].s.e - m[1].s.s == day and m[2].s is None


def numbered(df):
    return sorted((r.file.rsplit("/", 1)[1], r.line_no, r.value) for r in df.collect())


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_lines_of_split_compressed_marked_and_undecodable_files(spark, tmp_path, small_splits):
    rows = [f"line {i} " + "x" * (i % 90) for i in range(400)] + ["", "last, without an end"]
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.txt").write_bytes("\n".join(rows).encode())
    (tmp_path / "sub" / "b.txt").write_bytes(b"\xef\xbb\xbf" + "\r\n".join(rows).encode())
    (tmp_path / "c.txt.gz").write_bytes(gzip.compress("\n".join(rows).encode()))
    (tmp_path / "d.txt").write_bytes(b"one\ntwo\xff\r\nthree\n" + b"long " * 900 + b"\nend\n")
    (tmp_path / "empty.txt").write_bytes(b"")
    want = [(f, i, v) for f in ("a.txt", "b.txt", "c.txt.gz") for i, v in enumerate(rows)] + [("d.txt", i, v) for i, v in enumerate(["one", "two\ufffd", "three", "long " * 900, "end"])]
    got = lines.read_decoded(spark, str(tmp_path))
    assert spark.read.text(str(tmp_path / "a.txt")).rdd.getNumPartitions() > 10
    assert numbered(got) == sorted(want) == numbered(lines.read_lines(spark, str(tmp_path)))
    assert {(r.file.rsplit("/", 1)[1], r.note) for r in got.collect()} == {("a.txt", ""), ("b.txt", ""), ("c.txt.gz", ""), ("d.txt", "non_utf8_sanitized_copy")}


def test_lines_by_shuffle_equal_lines_by_broadcast(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "a.txt").write_text("\n".join(f"line {i}" for i in range(900)))
    broadcast = numbered(lines.read_lines(spark, str(tmp_path)))
    monkeypatch.setattr(lines, "BROADCAST_BLOCKS", 0)
    assert numbered(lines.read_lines(spark, str(tmp_path))) == broadcast and len(broadcast) == 900


def test_context_crosses_block_borders(spark, tmp_path, small_splits):
    """The session of the first block dates rows many blocks on; line pairs may have their border between them."""
    rows = ["H2 STA 7090 1", "H4 1 2020 02 29 00 00 00 2020 02 29 01 00 00"] + [f"10 {i} 0.01 std 2" for i in range(600)] + ["H8"] + [f"10 {i} 0.01 std 2" for i in range(30)]
    (tmp_path / "s").write_text("\n".join(rows))
    p = ranging.parse_sessions(lines.read_lines(spark, str(tmp_path / "s"))).orderBy("line_no").collect()
    assert [r.reject_reason for r in p] == [None] * 600 + ["epoch_reference_missing"] * 30 and [r.line_no for r in p] == [*range(2, 602), *range(603, 633)]
    assert all(r.t == 1582934400000000 + i * 1_000_000 and r.station_id == "7090" for i, r in enumerate(p[:600]))
    (tmp_path / "e").write_text("\n".join([L1, L2] * 200))
    q = elements.parse_pairs(lines.read_lines(spark, str(tmp_path / "e")))
    assert {r.reason: r.n for r in elements.reject_ledger(q).collect()} == {"pairs_accepted": 200}


def test_written_lines_keep_their_order(spark, tmp_path):
    n = 3000
    df = spark.range(n).select((F.col("id") % 2).cast("int").alias("f"), (F.col("id") % 3).cast("int").alias("part"), (n - F.col("id")).alias("at"), F.concat(F.lit("row "), n - F.col("id")).alias("value"))
    write_lines(df.repartition(5), str(tmp_path / "w"), ["at"], compressed=F.col("part") == 1, crlf=F.col("f") == 1, marked=F.col("part") == 2)
    files = [p for p in (tmp_path / "w").rglob("part-*") if not p.name.endswith(".crc")]
    assert len(files) == 6
    for p in files:
        f, part = (int(x.split("=")[1]) for x in p.parts[-3:-1])
        raw = gzip.decompress(p.read_bytes()) if part == 1 else p.read_bytes()
        end = "\r\n" if f == 1 else "\n"
        want = [f"row {n - i}" for i in range(n - 1, -1, -1) if i % 2 == f and i % 3 == part]
        assert raw.decode() == "".join(x + end for x in ["\ufeff"] * (part == 2) + want)


def test_undecodable_bytes_are_written_as_they_are(spark, tmp_path):
    value = F.when(F.col("id") == 1, F.concat(F.lit("# \u00e9 "), F.unhex(F.lit("FF")).cast("string"))).otherwise("row")
    df = spark.range(4).select((F.col("id") % 2).cast("int").alias("f"), F.lit(0).alias("part"), F.col("id").alias("at"), value.alias("value"))
    write_lines(df, str(tmp_path / "w"), ["at"], compressed=F.col("f") == 0)
    (path,) = (tmp_path / "w" / "f=1" / "part=0").glob("part-*.txt")
    assert path.read_bytes() == "# \u00e9 ".encode() + b"\xff\nrow\n"
    assert sorted(r.value for r in lines.read_lines(spark, str(tmp_path / "w")).collect()) == ["# \u00e9 \ufffd", "row", "row", "row"]


def test_small_files_are_dealt_to_many_tasks(spark, tmp_path):
    """Few bytes, many files: adaptive execution merged them into one task, which wrote them one after another."""
    df = spark.range(600).select((F.col("id") % 30).cast("int").alias("f"), (F.col("id") % 2).cast("int").alias("part"), F.col("id").alias("at"), F.col("id").cast("string").alias("value"))
    spark.sparkContext.setJobGroup("small files", "")
    write_lines(df, str(tmp_path / "w"), ["at"], compressed=F.col("part") == 1)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("small files") for s in tracker.getJobInfo(j).stageIds]
    assert stages[-1] is not None and max(s.numTasks for s in stages if s) >= spark.sparkContext.defaultParallelism * 4
    assert len([p for p in (tmp_path / "w").rglob("part-*") if p.is_file()]) == 30
    assert sorted(int(r.value) for r in lines.read_lines(spark, str(tmp_path / "w")).collect()) == list(range(600))

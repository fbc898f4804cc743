"""Guards that stop a job, counts taken in the pass of the result, and bounds from footers."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from orrery.operators import qc, response
from orrery.sources import tables

H = 3_600_000_000
WINDOW = "annotation_id string, entity_id long, ws long, we long"
SELECTED = "annotation_id string, path string, source_type string, rotating boolean"
REFUSED = "path string, assertion string, row long"
STATES = "entity_id long, t long, path string, x double, y double, z double, vx double, vy double, vz double"


def states(rows):
    return [(1, t * H, path, 7e6 + shift, 0.0, 0.0, 0.0, 7546.0, 0.0) for t, path, shift in rows]


def products(spark, selected, refused, rows):
    w = spark.createDataFrame([("w", 1, 20 * H, 22 * H), ("none", 2, 20 * H, 22 * H)], WINDOW)
    out = response.product_response(w, spark.createDataFrame(states(rows), STATES), spark.createDataFrame(selected, SELECTED), spark.createDataFrame(refused, REFUSED))
    return {r.annotation_id: r for r in out.collect()}


ROWS = [(15, "a", 0.0), (16, "a", 0.0), (16, "b", 500.0), (23, "b", 100.0), (24, "b", 100.0), (21, "b", 9e5), (40, "b", 9e5), (17, "c", 7e5)]


def test_only_chosen_and_accepted_files_count(spark):
    got = products(spark, [("w", "a", "pod", True), ("w", "b", "pod", True), ("w", "c", "pod", None)], [("c", "radius_in_leo_band", 7)], ROWS)
    w = got["w"]
    assert (w.orbit_file_count, w.orbit_parse_failure_count, w.orbit_first_failure, w.orbit_status_response) == (3, 1, "c:radius_in_leo_band:7", "computed")
    assert (w.orbit_samples_before, w.orbit_samples_after) == (2, 2), "an epoch given by two files counts once, rows outside the bands never"
    assert w.orbit_radius_shift_m == pytest.approx(100.0)
    n = got["none"]
    assert (n.orbit_file_count, n.orbit_parse_failure_count, n.orbit_status_response) == (0, 0, "insufficient_coverage")


def test_a_frame_decides_the_axis(spark):
    axis = {turning: products(spark, [("w", "a", "pod", turning), ("w", "b", "pod", turning)], [], ROWS)["w"].orbit_sma_before_m for turning in (True, False)}
    assert axis[False] == pytest.approx(7e6, rel=1e-3) and axis[True] > 7.5e6


def test_mixed_frames_stop_the_query(spark):
    with pytest.raises(Exception, match="mixed_frame_orbit_products"):
        products(spark, [("w", "a", "pod", True), ("w", "b", "pod", False)], [], ROWS)
    # a refused file has no say
    assert products(spark, [("w", "a", "pod", True), ("w", "b", "pod", False)], [("a", "x", 1)], ROWS)["w"].orbit_status_response == "insufficient_coverage"


def test_a_window_of_refused_files_is_unavailable(spark):
    w = products(spark, [("w", "a", "pod", True)], [("a", "epoch_present", 3)], ROWS)["w"]
    assert (w.orbit_status_response, w.orbit_parse_failure_count, w.orbit_radius_shift_m) == ("parse_unavailable", 1, None)


RANGING = "entity_id long, t long, tof_s double, range_m double"


def ranging(spark, ranges):
    return spark.createDataFrame([(1, i, 2 * r / 299792458.0, r) for i, r in enumerate(ranges)], RANGING)


def test_strict_mode_stops_at_a_violation(spark, tmp_path):
    checks = qc.ranging_violations()
    assert qc.enforce(ranging(spark, [1e6, 2e6]), checks, "entity_id").count() == 2
    with pytest.raises(Exception, match="physical violation: slr_range_in_band"):
        qc.enforce(ranging(spark, [1e6, 9e6]), checks, "entity_id").write.parquet(f"{tmp_path}/out")


def test_counts_come_with_the_written_rows(spark, tmp_path):
    checks, seen = qc.ranging_violations(), Observation()
    ranging(spark, [1e6, 9e6, 1e3]).observe(seen, F.count_if(checks["slr_range_in_band"]).alias("out")).write.parquet(f"{tmp_path}/out")
    assert seen.get == {"out": 2}


@pytest.mark.parametrize("rows_a_group", [2, 1000])
def test_footer_bounds_where_entities_meet_in_a_group(spark, tmp_path, rows_a_group):
    import pyarrow as pa
    import pyarrow.parquet as pq

    e = [1] * 5 + [2] * 3 + [3] + [None] * 2
    t = [10, 11, 12, 13, 14, 5, 6, None, 9, 1, 2]
    pq.write_table(pa.table({"entity_id": pa.array(e, pa.int64()), "t": pa.array(t, pa.int64()), "x": t}), f"{tmp_path}/a.parquet", row_group_size=rows_a_group)
    pq.write_table(pa.table({"entity_id": pa.array([1], pa.int64()), "t": pa.array([99], pa.int64())}), f"{tmp_path}/b.parquet")
    pq.write_table(pa.table({"entity_id": pa.array([], pa.int64()), "t": pa.array([], pa.int64())}), f"{tmp_path}/c.parquet")
    got = {r.entity_id: (r.start_t, r.end_t, r.rows) for r in tables.full_window(tables.footer_bounds(spark, str(tmp_path)), 10, 99).collect()}
    assert got == {1: (10, 99, 6), 2: (5, 6, 3), 3: (9, 9, 1), None: (1, 2, 2)}

"""Stored enrichment tasks: only pending ones are computed, a broken ranking fails alone. The monitor's crossings and closing event."""

import datetime as dt

from pyspark.sql import functions as F

from spotweave.operators import enrichment as en, reporting
from spotweave.streaming import monitor


def test_second_run_computes_pending_tasks_and_a_broken_ranking_fails_alone(spark, tmp_path):
    rows = [(roi, "c", f"g{i}", f"s{i}", 40 - i, float(20 - i)) for roi in ("a", "b") for i in range(40)]
    rows += [("bad", "c", f"g{i}", f"s{i}", i + 1, float("nan") if i == 3 else 1.0 * i) for i in range(40)]
    ranking = spark.createDataFrame(rows, "roi_label_canonical string, contrast_id string, gene_id string, gene_symbol string, rank long, original_effect double")
    sets = spark.createDataFrame([("L", f"t{k}", f"s{i}") for k in range(3) for i in range(k, 40, 5)], "library_id string, term string, gene string")
    libs = spark.createDataFrame([("L", "x")], "library_id string, observed_sha256 string")
    prints = en.ranking_fingerprints(ranking)
    folder = str(tmp_path / "tasks")

    def go(part):
        grid = en.task_grid(part, libs, en.finished_tasks(spark, folder))
        return {r["roi_label_canonical"]: r["execution_status"] for r in grid.collect()}, {
            r["roi_label_canonical"]: (r["task_status"], r["failure_reason"], r["n_terms"]) for r in en.run_tasks(ranking, sets, grid, folder, 20).collect()}

    before, status = go(prints.filter("roi_label_canonical <> 'b'"))
    assert before == {"a": "pending", "bad": "pending"}
    assert status == {"a": ("completed", None, 3), "bad": ("failed", "RANKING_NOT_FINITE", None)}
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "tasks/results").rglob("*.parquet")}
    before, status = go(prints)
    assert before == {"a": "completed_reused_checkpoint", "b": "pending", "bad": "pending"}
    assert {k: v[0] for k, v in status.items()} == {"a": "completed", "b": "completed", "bad": "failed"}
    assert all(p.stat().st_mtime_ns == t for p, t in files.items()) and files
    assert sorted({r["roi_label_canonical"] for r in en.task_results(spark, folder).collect()}) == ["a", "b"]


def test_crossings_equal_the_batch_and_the_closing_event_ends_windows(spark, tmp_path):
    start = dt.datetime(2024, 1, 1)
    rows = [(f"s{i % 3}", start + dt.timedelta(seconds=20 * i), float((i * 37) % 120), 1.0, 1.0, float(i), 50.0 - i) for i in range(60)]
    src = str(tmp_path / "src")
    s = spark.createDataFrame(rows, "step string, ts timestamp, cpu_percent double, rss_gib double, vms_gib double, project_gib double, free_gib double")
    s.repartition(4, "ts").write.parquet(src)
    stream = monitor.read_samples(spark, src, s.schema, max_files=1)
    monitor.write_crossings(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    cols = ["step", "code", "threshold", "first_ts", "peak_observed"]
    assert sorted(map(tuple, monitor.crossings(spark, str(tmp_path / "out")).select(*cols).collect())) == sorted(
        map(tuple, reporting.threshold_warnings(s).select(*cols).collect()))
    peaks = monitor.windowed_peaks(monitor.read_samples(spark, src, s.schema))
    out, ck = str(tmp_path / "peaks"), str(tmp_path / "ck2")
    monitor.write_peaks(peaks, out, ck).awaitTermination()
    whole = monitor.windowed_peaks(s).count()
    assert spark.read.schema(peaks.schema).parquet(out).count() < whole
    monitor.close_samples(spark, src, s.schema)
    monitor.write_peaks(peaks, out, ck).awaitTermination()
    got = spark.read.schema(peaks.schema).parquet(out)
    assert got.count() == whole and got.filter(F.col("step").isNull()).count() == 0

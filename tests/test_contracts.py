"""Contracts raise their stable code, and only then."""

import pytest
from pyspark.sql import functions as F

from spotweave.operators import compare, contracts as c, design, eligibility as el, score
from spotweave.sources import readers


def code(fn):
    with pytest.raises(c.ContractError) as info:
        fn()
    return info.value.code


def places(spark):
    core = ["A" * 16, "C" * 16, "G" * 16, "T" * 16]
    return spark.createDataFrame([("s", b + "-1") for b in core], "sample_id string, barcode string")


def roi(spark, rows):
    return spark.createDataFrame([("s", b, l) for b, l in rows], "sample_id string, roi_barcode string, roi_label string")


def test_roi_exact_then_suffix(spark):
    got = {r["roi_barcode"]: (r["barcode"], r["barcode_match_method"]) for r in el.match_roi(
        roi(spark, [("A" * 16 + "-1", "x"), ("C" * 16 + "-2", "y")]), places(spark)).collect()}
    assert got["A" * 16 + "-1"] == ("A" * 16 + "-1", "exact")
    assert got["C" * 16 + "-2"] == ("C" * 16 + "-1", "10x_suffix_normalized")


def test_roi_orphan_and_ambiguity(spark):
    orphan = roi(spark, [("A" * 15 + "N-1", "x")])
    assert code(lambda: el.match_roi(orphan, places(spark))) == "ROI_ORPHAN_BARCODE"
    assert el.match_roi(orphan, places(spark), orphans="report").first()["barcode"] is None
    double = roi(spark, [("A" * 16 + "-1", "x"), ("A" * 16 + "-2", "y")])
    assert code(lambda: el.match_roi(double, places(spark))) == "ROI_BARCODE_MATCH_AMBIGUOUS"
    two = places(spark).union(spark.createDataFrame([("s", "A" * 16 + "-3")], "sample_id string, barcode string"))
    assert code(lambda: el.match_roi(roi(spark, [("A" * 16 + "-2", "x")]), two)) == "ROI_BARCODE_MATCH_AMBIGUOUS"


def test_raw_counts(spark):
    df = spark.createDataFrame([(1.0,), (2.5,), (-1.0,), (float("nan"),), (float("inf"),), (3.0,)], "x double")
    assert c.bad_counts(df, "x").count() == 4


def test_design_errors(spark):
    schema = "sample_id string, genotype string, treatment string"
    off = spark.createDataFrame([("1", "a", "x"), ("2", "b", "z")], schema)
    assert code(lambda: design.assign_design_cells(off, "a", "b", "x", "y")) == "DESIGN_NOT_ELIGIBLE"
    assert code(lambda: design.assign_design_cells(off, "a", "a", "x", "y")) == "DESIGN_NOT_ELIGIBLE"
    hole = spark.createDataFrame([("1", "a", "x"), ("2", "b", "y"), ("3", "a", "y")], schema)
    assert code(lambda: design.assign_design_cells(hole, "a", "b", "x", "y")) == "DESIGN_NOT_ELIGIBLE"


def test_unit_gate(spark):
    cells = ["g0_t0", "g0_t1", "g1_t0", "g1_t1"]
    rows = [(f"s{i}{k}", f"u{i}{k}", cells[i], "b") for i in range(4) for k in range(3)]
    schema = "sample_id string, animal_id string, design_cell string, technical_batch string"
    ok = spark.createDataFrame(rows, schema)
    assert design.check_biological_units(ok).count() == 12
    assert code(lambda: design.check_biological_units(ok, min_units=4)) == "INSUFFICIENT_BIOLOGICAL_REPLICATION"
    crossing = spark.createDataFrame(rows[:-1] + [("z", "u00", "g1_t1", "b")], schema)
    assert code(lambda: design.check_biological_units(crossing)) == "DESIGN_NOT_ELIGIBLE"


def test_confounded_batch_is_rank_deficient(spark):
    cells = ["g0_t0", "g0_t1", "g1_t0", "g1_t1"]
    rows = [(f"s{i}{k}", f"u{i}{k}", cells[i], f"b{i}") for i in range(4) for k in range(3)]
    units = design.check_biological_units(spark.createDataFrame(
        rows, "sample_id string, animal_id string, design_cell string, technical_batch string"), batch="technical_batch")
    r = design.design_rank(design.design_rows(units)).first()
    assert r["design_rank"] == 4 and r["n_design_columns"] == 7


def test_join_audit_collision_and_sides(spark):
    schema = "sample_id string, barcode string, source_identifier string, identifier_valid boolean"
    cur = spark.createDataFrame([("s", "a", "s::a", True), ("s", "b", "s::b", True), ("s", "", "s::", True)], schema)
    ref = spark.createDataFrame([("s", "a", "a-s", True), ("s", "c", "c-s", True), ("s", "d", "d1", True),
                                 ("s", "d", "d2", True)], schema)
    audit = compare.spot_join_audit(cur, ref)
    n = {r["reason_code"]: r["count"] for r in audit.groupBy("reason_code").count().collect()}
    assert n == {"MATCHED": 1, "CURRENT_ONLY": 1, "REFERENCE_ONLY": 1, "REFERENCE_KEY_COLLISION": 2,
                 "CURRENT_INVALID_IDENTIFIER": 1}
    s = {r["scope"]: r for r in compare.join_summary(audit).collect()}
    assert s["cohort"]["integrity_status"] == "fail" and s["cohort"]["current_total_denominator"] == 3


def test_review_cannot_replace_evidence(spark):
    ev = spark.createDataFrame([("s", "image_alignment", False)], "sample_id string, component string, available boolean")
    rv = spark.createDataFrame([("s", "image_alignment", "PASS")], "sample_id string, component string, decision string")
    assert code(lambda: score.manual_components(ev, rv)) == "REVIEW_WITHOUT_EVIDENCE"


def test_review_table_rules(spark):
    samples = spark.createDataFrame([("s",)], "sample_id string")
    comps = ("image_alignment",)

    def table(*rows):
        return spark.createDataFrame(list(rows), ", ".join(f"{x} string" for x in readers.REVIEW_COLUMNS))

    good = ("s", "image_alignment", "pass", "e", "r", "2024-01-01T00:00:00Z", "")
    assert readers.check_reviews(table(good), samples, comps).first()["decision"] == "PASS"
    assert code(lambda: readers.check_reviews(table(good, good), samples, comps)) == "REVIEW_DUPLICATE"
    assert code(lambda: readers.check_reviews(table(("t",) + good[1:]), samples, comps)) == "REVIEW_UNKNOWN_SAMPLE"
    assert code(lambda: readers.check_reviews(table(good[:3] + ("", "r", "2024-01-01", "")), samples, comps)) == "REVIEW_INCOMPLETE"
    assert code(lambda: readers.check_reviews(table(good[:5] + ("yesterday", "")), samples, comps)) == "REVIEW_TIME_INVALID"


def test_checksum_mismatch_is_loud(spark):
    m = spark.createDataFrame([("a", "true", "x/a.gmt", "00")], "library_id string, enabled string, gmt_path string, sha256 string")
    seen = spark.createDataFrame([("a.gmt", "11")], "file_name string, observed_sha256 string")
    assert code(lambda: readers.verify_manifest(m, seen)) == "GMT_SHA256_MISMATCH"


def test_forbidden_text_labels(spark):
    lines = spark.createDataFrame([
        ("f", 1, "see /home/x/file"), ("f", 2, r"at C:\data\x"), ("f", 3, r"on \\host\share"), ("f", 4, "plain"),
        ("f", 5, "file:///etc and secret")], "path string, line_number int, line string")
    got = {r["line_number"]: r["labels"] for r in c.forbidden_text(lines, ["secret"]).collect()}
    assert set(got) == {1, 2, 3, 5} and "forbidden value 'secret'" in got[5] and "file URL" in got[5]

"""Matrix and position scans: contracts that must raise, header order, stored zeros."""

import os

import pytest

from spotweave.operators.contracts import ContractError
from spotweave.sources import readers, sinks


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def matrix(root, entries, size=None, barcodes=("AC-1", "GT-1")):
    size = size or f"2 2 {len(entries)}"
    put(f"{root}/matrix/S1/matrix.mtx", "%%MatrixMarket matrix coordinate integer general\n%\n" + "\n".join([size, *entries]) + "\n")
    put(f"{root}/features/S1/features.tsv", "g1\tA\tGene Expression\ng2\tB\tGene Expression\n")
    put(f"{root}/barcodes/S1/barcodes.tsv", "\n".join(barcodes) + "\n")
    return f"{root}/matrix", f"{root}/features", f"{root}/barcodes"


def test_matrix_drops_stored_zeros(spark, tmp_path):
    got = readers.read_10x_count_matrix(spark, *matrix(tmp_path, ["1 1 3", "2 1 0", "2 2 4.0"])).collect()
    assert sorted((r["barcode"], r["gene_id"], r["count"]) for r in got) == [("AC-1", "g1", 3), ("GT-1", "g2", 4)]


@pytest.mark.parametrize("entries, size, barcodes, code", (
    (["1 1 1.5"], None, ("A", "B"), "RAW_COUNT_CONTRACT"), (["1 1 -3"], None, ("A", "B"), "RAW_COUNT_CONTRACT"),
    (["1 1 NaN"], None, ("A", "B"), "RAW_COUNT_CONTRACT"), (["1 1 x"], None, ("A", "B"), "RAW_COUNT_CONTRACT"),
    (["1 1 2", "1 2 2"], "2 2 3", ("A", "B"), "MTX_SIZE_MISMATCH"), (["1 1 2"], None, ("A", "A"), "BARCODE_DUPLICATE")))
def test_broken_matrices_raise(spark, tmp_path, entries, size, barcodes, code):
    with pytest.raises(ContractError, match=code):
        readers.read_10x_count_matrix(spark, *matrix(tmp_path, entries, size, barcodes))


def test_a_large_sample_is_written_by_many_tasks_and_read_in_order(spark, tmp_path):
    rows = [("S1", f"b{i:03d}", f"g{(i * 7) % 50:02d}", i + 1) for i in range(300)] + [("S2", "b0", "g01", 5)]
    counts = spark.createDataFrame(rows, "sample_id string, barcode string, gene_id string, count long")
    genes = spark.createDataFrame([(f"g{i:02d}", f"n{i}", "Gene Expression") for i in range(50)], "gene_id string, gene_symbol string, feature_type string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_mtx(counts, genes, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "matrix/sample_id=S1").glob("part-*"))
    lines = "".join(p.read_text() for p in parts).splitlines()
    assert len(parts) > 1 and lines[0].startswith("%%MatrixMarket") and lines[1] == "50 300 300"
    assert [int(x.split()[1]) for x in lines[2:]] == list(range(1, 301))
    assert sorted(map(tuple, readers.mtx_dimensions(spark, f"{tmp_path}/matrix").collect())) == [("S1", 50, 300, 300), ("S2", 50, 1, 1)]
    back = readers.read_10x_count_matrix(spark, *[f"{tmp_path}/{x}" for x in ("matrix", "features", "barcodes")])
    assert sorted(map(tuple, back.select("sample_id", "barcode", "gene_id", "count").collect())) == sorted(rows)


def test_positions_by_header_name_in_any_order(spark, tmp_path):
    put(f"{tmp_path}/S1/p.csv", "pxl_col_in_fullres,barcode,in_tissue,array_col,array_row,pxl_row_in_fullres,extra\n2.5,AC-1,1,8,7,1.5,z\n")
    put(f"{tmp_path}/S2/p.csv", "AC-1,0,7,8,1.5,2.5\nGT-1,,1,2,3,4\n")
    got = {(r["sample_id"], r["barcode"]): tuple(r)[2:] for r in readers.read_positions(spark, str(tmp_path)).collect()}
    assert got == {("S1", "AC-1"): (1, 7, 8, 1.5, 2.5), ("S2", "AC-1"): (0, 7, 8, 1.5, 2.5), ("S2", "GT-1"): (None, 1, 2, 3.0, 4.0)}


@pytest.mark.parametrize("text, code", (("AC-1,1,x,2,3,4\n", "POSITION_NOT_NUMERIC"), ("AC-1,1.5,1,2,3,4\n", "POSITION_NOT_NUMERIC"),
                                        ("barcode,in_tissue\nAC-1,1\n", "POSITION_COLUMNS_MISSING"),
                                        ("A,1,1,1,1,1\nA,1,1,2,1,1\n", "POSITION_BARCODE_DUPLICATE")))
def test_broken_positions_raise(spark, tmp_path, text, code):
    put(f"{tmp_path}/S1/p.csv", text)
    with pytest.raises(ContractError, match=code):
        readers.read_positions(spark, str(tmp_path))


def test_checkpoint_runs_its_source_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(50).selectExpr("concat('S', id % 3) as sample_id", "id").mapInArrow(count, "sample_id string, id long")
    assert sinks.write_checkpoint(df, str(tmp_path / "c")).count() == 50 and runs.value == 50

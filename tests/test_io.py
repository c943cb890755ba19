import gzip

import pytest

from helixframe.sources import io


def test_pvar_in_any_order_and_gzip(spark, tmp_path):
    path = tmp_path / "x.pvar.gz"
    path.write_bytes(gzip.compress(b"##meta\n\nID\tALT\t#CHROM\tFILTER\tPOS\tREF\nrs1\tG\t1\t.\t100\tA\n"))
    r = io.read_variants(spark, str(path), "pvar").first()
    assert (r.chrom, r.pos, r.id, r.ref, r.alt) == ("1", 100, "rs1", "A", "G")


def test_bad_position_raises(spark, tmp_path):
    path = tmp_path / "x.bim"
    path.write_text("1 rs1 0 -5 A G\n")
    with pytest.raises(ValueError):
        io.read_variants(spark, str(path), "bim")


def test_sample_lists(spark, tmp_path):
    path = tmp_path / "keep.txt"
    path.write_text("#FID IID\nF1 I1\n")
    assert [tuple(r) for r in io.read_samples(spark, str(path)).collect()] == [("F1", "I1")]
    path = tmp_path / "one.txt"
    path.write_text("I2\n")
    assert [tuple(r) for r in io.read_samples(spark, str(path), "zero").collect()] == [("0", "I2")]


def test_table_keeps_na_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "t.tsv"
    path.write_text('id\tv\n007\tNA\n"8\t\n')
    assert [tuple(r) for r in io.read_table(spark, str(path)).collect()] == [("007", "NA"), ('"8', "")]


def test_inventory(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "._a.txt").write_text("y")
    (r,) = io.file_inventory(spark, str(tmp_path)).collect()
    assert r.size_bytes == 1 and r.path.endswith("/a.txt")

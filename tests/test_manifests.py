"""Manifest builders on small files."""

import pytest
from pyspark.sql import functions as F

from trackweave.sources import tracks as tr


def test_folds(spark, tmp_path):
    (tmp_path / "fold_0_data.txt").write_text("user_id\tface_id\toriginal_image\tage\tlabel\nu1\t1\ta.jpg\t(0, 2)\tm\nu1\t2\tb.jpg\t35\tf\nu2\t3\tc.jpg\tNone\tu\nu2\t4\td.jpg\tNone\tf\nu3\t5\te.jpg\t(4, 6)\tm\n")
    rows = spark.read.option("header", True).option("sep", "\t").csv(str(tmp_path / "fold_*_data.txt"))
    files = spark.createDataFrame([(p,) for p in ("faces/u1/coarse.1.a.jpg", "faces/u1/fine.1.a.jpg", "faces/u1/coarse.2.b.jpg", "faces/u2/fine.3.c.jpg", "faces/u2/fine.4.d.jpg")], "path string")
    got = tr.manifest_from_folds(rows, files, {"(0, 2)": (0, 2), "(4, 6)": (4, 6)}, {"m": 0, "f": 1}, ["faces/{user_id}/fine.{face_id}.{original_image}", "faces/{user_id}/coarse.{face_id}.{original_image}"])
    assert got.columns == ["path", "age", "age_lo", "age_hi", "label"]
    # the first pattern that exists; a number is an age; neither label nor age, or no file: no row
    assert sorted(map(tuple, got.collect())) == [("faces/u1/coarse.2.b.jpg", None, 35, 35, 1), ("faces/u1/fine.1.a.jpg", None, 0, 2, 0), ("faces/u2/fine.4.d.jpg", None, None, None, 1)]


def test_attributes(spark):
    text = ["3", "Bald Male Young", "1.jpg  1 -1  1", "2.jpg -1  1 -1", "3.jpg -1", "4.jpg 1 1 1"]
    lines = spark.createDataFrame(list(enumerate(text)), "line int, value string").repartition(3)
    files = spark.createDataFrame([(f"img/{k}.jpg",) for k in (1, 2, 3)], "path string")
    got = tr.manifest_from_attributes(lines, files, "Male", "img").collect()
    assert sorted((r.path, r.age, r.label) for r in got) == [("img/1.jpg", None, 1), ("img/2.jpg", None, 0)]
    with pytest.raises(ValueError):
        tr.manifest_from_attributes(lines, files, "Old", "img")


def test_all_manifests(spark, tmp_path):
    for name, text in (("a.csv", "x,1,1,1,0\n"), ("b.csv", "y,2,2,2,1\nz,3,3,3,0\n"), ("all.csv", "old,9,9,9,9\n")):
        (tmp_path / name).write_text(text)
    lines = tr.all_manifests(spark, str(tmp_path))
    assert sorted(r.value for r in lines.collect()) == ["x,1,1,1,0", "y,2,2,2,1", "z,3,3,3,0"]
    assert tr.manifest(lines).filter(F.col("label") == 0).count() == 2

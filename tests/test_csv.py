"""CSV files with headers of their own, read by column name."""

import gzip

import pytest
from pyspark.sql import types as T

from fathomline.sources import files

AREA = T.StructType([T.StructField("name", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("share", T.DoubleType())])


def jobs_of(spark, group, work):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        result = work()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    return result, len(sc.statusTracker().getJobIdsForGroup(group))


def test_columns_are_taken_by_name_whatever_the_header(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("name,size,share\na,1,0.5\n")
    (tmp_path / "turned round.csv").write_text("share,other,name,size\n0.25,x,b,2\n")
    (tmp_path / "per%20cent.csv").write_text('\n  \n"name","size","share"\r\n"c, d",3,NaN\r\n')
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n\n")
    (tmp_path / "bare.csv").write_text("size,share,name")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as f:
        f.write("size,name,share\nmany,e,1\n")
    rows = sorted(tuple(r) for r in files.scan_csv(spark, str(tmp_path), AREA).collect())
    assert rows == [("a", 1, 0.5), ("b", 2, 0.25), ("c, d", 3, None), ("e", None, 1.0)]


def test_jobs_grow_with_headers_not_with_files(spark, tmp_path):
    headers = ["name,size,share", "share,name,size"]

    def folder(n):
        path = tmp_path / f"n{n}"
        path.mkdir()
        for i in range(n):
            (path / f"{i}.csv").write_text(f"{headers[i % 2]}\n" + ("k,1,0.5\n" if i % 2 == 0 else "0.5,k,1\n"))
        return str(path)

    few, many = folder(2), folder(40)
    a, jobs_few = jobs_of(spark, "few", lambda: files.scan_csv(spark, few, AREA))
    b, jobs_many = jobs_of(spark, "many", lambda: files.scan_csv(spark, many, AREA))
    assert jobs_many == jobs_few <= 4
    assert (a.count(), b.count()) == (2, 40)
    assert {tuple(r) for r in b.collect()} == {("k", 1, 0.5)}


def test_no_lines_are_no_rows_and_a_missing_column_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    none = files.scan_csv(spark, str(tmp_path), AREA)
    assert none.columns == AREA.fieldNames() and none.count() == 0
    (tmp_path / "b.csv").write_text("name,size\na,1\n")
    with pytest.raises(Exception, match="share"):
        files.scan_csv(spark, str(tmp_path), AREA)

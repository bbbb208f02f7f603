"""Broken records of delimited files."""

import pytest
from pyspark.sql import types as T

from strata.session import scratch_path
from strata.sources.malformed import broken_by_file, read_csv_records

SHAPE = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("s", T.StringType()), T.StructField("d", T.DateType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def write(spark, lines, sep="\n"):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "line string").coalesce(1).write.option("lineSep", sep).text(path)
    return path


def test_every_record_is_good_or_broken_with_a_reason(spark):
    lines = ["n,s,d", '1,"a, b",2020-01-02', "2,x", "3,x,2020-01-01,y,z", "four,x,2020-01-01", '5,"say ""no"", no",soon', ",,", '6,"q,2020-01-01']
    records = read_csv_records(spark, write(spark, lines), SHAPE)
    assert [str(r) for r in rows(records.good.select("n", "s"))] == ["(1, 'a, b')", "(None, None)"]
    found = {r.record: r.reason for r in records.broken.collect()}
    assert found["2,x"] == "too few fields: 2" and found["3,x,2020-01-01,y,z"] == "too many fields: 5"
    assert found["four,x,2020-01-01"] == "not a int: n" and found[lines[5]] == "not a date: d"
    assert records.good.count() + records.broken.count() == len(lines) - 1
    assert sum(r.records for r in broken_by_file(records).collect()) == records.broken.count()
    assert all(r.file.startswith("file:") for r in records.broken.select("file").collect())


def test_other_delimiters_empty_files_and_reserved_names(spark):
    records = read_csv_records(spark, write(spark, ["n|s|d", "1|a,b|2020-01-01", "2|c"]), SHAPE, delimiter="|")
    assert rows(records.good.select("s")) == [("a,b",)] and [r.reason for r in records.broken.collect()] == ["too few fields: 2"]
    none = read_csv_records(spark, write(spark, ["n,s,d"]), SHAPE)
    assert none.good.count() == none.broken.count() == 0
    with pytest.raises(ValueError):
        read_csv_records(spark, "x", T.StructType([T.StructField("_record", T.StringType())]))


def test_records_over_several_lines(spark):
    records = read_csv_records(spark, write(spark, ["n,s,d", '1,"two\nlines",2020-01-01', '2,"a\nb"']), SHAPE, multi_line=True)
    assert rows(records.good.select("s")) == [("two\nlines",)] and records.broken.count() == 1

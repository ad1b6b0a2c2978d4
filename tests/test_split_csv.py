"""Split CSV reading equals whole-file parsing, over many splits."""

import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from mercato.sources.split_csv import read_split_csv, records

SCHEMA = StructType([StructField("a", StringType()), StructField("b", StringType()), StructField("n", LongType())])
PIECES = ["x", "é", '"', ",", "\n", "\r\n", " ", "yy", '""', "\n\n", "a,b", '",', ',"']


@pytest.fixture()
def splits(spark):
    """Splits of some hundred bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def whole(spark, path, encoding="UTF-8"):
    return spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"') \
        .option("mode", "FAILFAST").option("encoding", encoding).csv(path)


def rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[2])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_equals_whole_file_parsing(splits, tmp_dir, end):
    rng = random.Random(11)

    def value():
        text = "".join(rng.choice(PIECES) for _ in range(rng.randrange(9)))
        return '"' + text.replace('"', '""') + '"' if any(c in text for c in '",\r\n') or rng.random() < 0.3 else text

    path = f"{tmp_dir}/f.csv"
    write(path, f"a,b,n{end}" + "".join(f"{value()},{value()},{i}{end}" for i in range(500)))
    got = read_split_csv(splits, path, SCHEMA)
    assert rows(got) == rows(whole(splits, path)) and got.count() == 500
    lines = splits.read.option("lineSep", "\n").text(path).select("_metadata.file_block_start")
    assert lines.distinct().count() > 20 and lines.rdd.getNumPartitions() > 20


def test_one_value_over_many_splits(splits, tmp_dir):
    path = f"{tmp_dir}/f.csv"
    long = "\n".join(f"line {i}, ""said"" " for i in range(400))
    write(path, f'a,b,n\nq,"{long}",1\nr,s,2\n"{long}","{long}",3')
    assert rows(read_split_csv(splits, path, SCHEMA)) == rows(whole(splits, path))


def test_quotes_within_plain_values(splits, tmp_dir):
    """Quotes that don't open a value are characters; they turn nothing."""
    path = f"{tmp_dir}/f.csv"
    write(path, "a,b,n\n" + "".join(f'{i} 5" disk,in "short{i},{i}\n"he said ""no""\nto 3"" ",z,{i + 1000}\n' for i in range(80)))
    assert rows(read_split_csv(splits, path, SCHEMA)) == rows(whole(splits, path))


def test_folder_encoding_mark_and_empty_file(splits, tmp_dir):
    write(f"{tmp_dir}/a.csv", 'a,b,n\nmó,"v\ní",1\n', "latin-1")
    write(f"{tmp_dir}/b.csv", "a,b,n\n", "latin-1")
    write(f"{tmp_dir}/c.csv", "", "latin-1")
    write(f"{tmp_dir}/d.csv", "a,b,n\n\nx,,2\n\n", "latin-1")
    assert rows(read_split_csv(splits, tmp_dir, SCHEMA, encoding="ISO-8859-1")) == [("mó", "v\ní", 1), ("x", None, 2)]
    write(f"{tmp_dir}/bom.csv", "﻿a,b,n\nx,y,1\n")
    assert rows(read_split_csv(splits, f"{tmp_dir}/bom.csv", SCHEMA)) == [("x", "y", 1)]


@pytest.mark.parametrize("text, said", [('a,b,n\nx,"y,1\nz,w,2\n', "ends within quotes"), ("a,c,n\nx,y,1\n", "header"), ("a,b,n\nx,y,no\n", "MALFORMED")])
def test_faults_raise(splits, tmp_dir, text, said):
    write(f"{tmp_dir}/f.csv", text)
    with pytest.raises(Exception, match=said):
        read_split_csv(splits, f"{tmp_dir}/f.csv", SCHEMA).collect()


@pytest.mark.parametrize("end, inner", [("\n", "\r\n"), ("\r\n", "\n")])
def test_line_ends_within_values(spark, tmp_dir, end, inner):
    write(f"{tmp_dir}/f.csv", f'h{end}"a\r\nb"{end}c')
    got = records(spark, f"{tmp_dir}/f.csv").select("record", "first").collect()
    assert sorted((r["record"], r["first"]) for r in got) == [(f'"a{inner}b"', False), ("c", False), ("h", True)]

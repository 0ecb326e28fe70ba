from __future__ import annotations

import csv
import io
import random

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from ledgerlane.sources.csv_files import CORRUPT, read_csv
from ledgerlane.sources.csv_records import _found, _lines, _splits, read_records

NAMES = ["a", "b", "c"]
SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in NAMES])


@pytest.fixture()
def small_splits(spark):
    """Files are cut every few bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def made(seed, n, ends="\n"):
    draw = random.Random(seed)
    cells = ["x", "", "long " * 30, 'say "no"', "two\nlines", "a,b", "\n\n\n", "é\nü" * 40, "plain", '"', '""\n"']
    rows = [[f"{k}", draw.choice(cells), draw.choice(cells)] for k in range(n)]
    out = io.StringIO()
    csv.writer(out, lineterminator=ends).writerows([NAMES, *rows])
    return out.getvalue(), rows


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_records_over_many_splits(spark, tmp_path, small_splits, ends):
    for seed in (1, 2):
        (tmp_path / f"{seed}.csv").write_bytes(made(seed, 60, ends)[0].encode())
    found = read_records(spark, str(tmp_path), NAMES)
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    got = sorted(next(csv.reader([row.record])) if "\n" not in row.record else next(csv.reader(io.StringIO(row.record)))
                 for row in found.collect())
    assert got == sorted(made(1, 60)[1] + made(2, 60)[1])


def test_same_rows_as_one_task_a_file(spark, tmp_path, small_splits):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_bytes(("﻿" + made(3, 50)[0]).encode())
    got = sorted(map(tuple, read_csv(spark, path, SCHEMA, multi_line=True).collect()), key=str)
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').schema(SCHEMA).csv(path)
    want = [tuple(None if v in ("", None) else v for v in row) for row in whole.collect()]
    assert got == sorted(want, key=str) and len(got) == 50


def test_bad_records_are_reported(spark, tmp_path, small_splits):
    file = tmp_path / "t.csv"
    file.write_text('a,b,c\n1,"x\ny",z\n2,only two\n3,"never closed,z\n4,p,q\n')
    rows = {row.a: row[CORRUPT] for row in read_csv(spark, str(file), SCHEMA, multi_line=True, keep_bad_rows=True).collect()}
    assert rows["1"] is None and rows["2"] is not None and any("do not pair up" in (v or "") for v in rows.values())
    with pytest.raises(Exception, match="pair up|MALFORMED|malformed"):
        read_csv(spark, str(file), SCHEMA, multi_line=True).collect()
    file.write_text("b,a,c\n1,2,3\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(file), SCHEMA, multi_line=True).collect()


def test_empty_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "head.csv").write_text("a,b,c\n")
    assert read_csv(spark, str(tmp_path), SCHEMA, multi_line=True).collect() == []


def test_lines_are_put_together_a_batch_at_a_time():
    lines = ["a,b,c\r", '1,"x', "", 'y",z\r', "\u00a0", "  \r", "2,p,q", '3,"open']
    batch = pa.RecordBatch.from_pydict({"value": lines, "mark": [29] * len(lines)})
    middle, *rest = (
        pa.RecordBatch.from_pydict({"value": values, "mark": [mark] * len(values)})
        for values, mark in ((["on"], 34), (["on"], 38), (['end",r', "4,s,t"], 38))
    )
    whole, begin, middle, end, last = (found.to_pydict() for found in _found(NAMES, [batch, middle, *rest]))
    assert whole["record"] == ['1,"x\n\ny",z', "2,p,q"] and set(whole["at"]) == {-1}
    assert [(p["record"], p["split"], p["at"], p["ends"], p["opens"]) for p in (begin, middle)] == [
        (['3,"open'], [7], [1], [False], [True]), (["on"], [8], [0], [False], [False])]
    assert (end["record"], end["at"], end["ends"], end["opens"]) == (['on\nend",r'], [0], [True], [False])
    assert last["record"] == ["4,s,t"]


def test_only_splits_that_a_record_crosses_are_read_again(spark, tmp_path, small_splits):
    (tmp_path / "t.csv").write_text("a,b,c\n" + "1,x,y\n" * 100 + '2,"' + "long\n" * 60 + '",z\n' + "3,x,y\n" * 100)
    found = _splits(_lines(spark, str(tmp_path))).collect()
    crossed = [row.start for row in found if row.crossed]
    assert 0 < len(crossed) < len(found) / 2 and min(crossed) > 400 and max(crossed) < 1000
    assert len(read_records(spark, str(tmp_path), NAMES).collect()) == 201


def test_a_split_that_is_not_known_fails_the_read():
    batch = pa.RecordBatch.from_arrays([pa.array(["1,x,y"]), pa.nulls(1, pa.int64())], names=["value", "mark"])
    with pytest.raises(RuntimeError, match="splits changed"):
        list(_found(NAMES, [batch]))

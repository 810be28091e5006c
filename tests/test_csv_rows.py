"""Row ids and records of quoted CSV files that several tasks read, against Python's csv module."""

import csv
import io as stdio
import random

import pytest
from pyspark.sql import functions as F

from tessera.sources import csv_rows, io


@pytest.fixture
def small_ranges(spark):
    """Cut files into ranges of a few kilobytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _field(rng):
    parts = ["plain", "", "a,b", 'say "hi"', "two\nlines", "\n\n", '"', "é日本", "x" * 300, "tail\r\nnext", " pad ", '"\n"', "\r"]
    return "".join(rng.choices(parts, k=rng.randrange(4)))


def _write(path, rows, end="\n", bom=False, quote=csv.QUOTE_MINIMAL, last=True):
    out = stdio.StringIO()
    csv.writer(out, lineterminator=end, quoting=quote).writerows(rows)
    text = out.getvalue()
    path.write_bytes((("﻿" if bom else "") + (text if last else text[:-len(end)])).encode())


def test_rows_across_ranges(spark, tmp_path, small_ranges):
    rng, want, files = random.Random(6), [], 0
    for name, end, bom, last in [("a.csv", "\n", True, True), ("b.csv", "\r\n", False, True), ("c.csv", "\n", False, False), ("d.csv", "\n", False, True)]:
        rows = [(str(len(want) + i), _field(rng), _field(rng)) for i in range(0 if name == "d.csv" else 300)]
        _write(tmp_path / name, [("id", 'te"xt', "more"), *rows], end, bom, last=last)
        want += rows
        files += 1
    cols = ["id", 'te"xt', "more"]
    starts = csv_rows.csv_ranges(spark, str(tmp_path)).collect()
    assert len({r.path for r in starts}) == files and len(starts) > 30  # several ranges a file
    assert {r.parity for r in starts} == {0, 1}                          # some begin inside a quoted field
    got = csv_rows.read_csv_rows(spark, str(tmp_path), cols).collect()
    assert sorted((r[0], r[1], r[2] or "", r[3] or "") for r in got) == [(i + 1, *r) for i, r in enumerate(want)]


def test_blank_lines_and_base(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n\n1,"a\n\nb"\n\r\n2,\n\n')
    (tmp_path / "b.csv").write_text("")
    got = csv_rows.read_csv_rows(spark, str(tmp_path), ["x", "y"], base=0).collect()
    assert sorted(map(tuple, got)) == [(0, "1", "a\n\nb"), (1, "2", None)]


@pytest.mark.parametrize("text, says", [('x,y\n1,"a\n2,b\n', "not closed"), ("y,x\n1,2\n", "another header"), ("x,y\n1,2,3\n", "")])
def test_errors(spark, tmp_path, text, says):
    (tmp_path / "a.csv").write_text(text)
    with pytest.raises(Exception, match=says):
        csv_rows.read_csv_rows(spark, str(tmp_path), ["x", "y"]).collect()


def test_text_table_reads_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(7)
    rows = [(str(i), _field(rng)) for i in range(200)]
    _write(tmp_path / "a.csv", [("id", "text"), *rows])
    got = io.read_text_table(spark, str(tmp_path / "a.csv"), required=("id",))
    assert got.columns == ["id", "text"] and sorted(map(tuple, got.collect())) == sorted(rows)
    assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1

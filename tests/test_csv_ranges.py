"""CSV read by byte ranges: records that cross their borders, against Python's csv module."""

import csv
import io
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from starloom.sources.csv_ranges import csv_records, read_csv_ranges


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 300 bytes, so that records cross many borders."""
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _folder(**files):
    d = tempfile.mkdtemp(prefix="csv-ranges-")
    for name, text in files.items():
        with open(os.path.join(d, f"{name}.csv"), "w", newline="") as fh:
            fh.write(text)
    return d


def _text(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_across_ranges(spark, small_ranges, end):
    rnd = random.Random(3)
    piece = ["word", '"', '""', ",", "\n", "\r\n", "\n\n", " ", "a\"b", "ä", "long " * 30, "x,y\n\"z\"\n"]
    rows = [[str(i), "".join(rnd.choices(piece, k=rnd.randint(1, 9))), rnd.choice(["", "t", 'q"', "two\nlines"])]
            for i in range(400)]
    d = _folder(one=_text([["id", "text", "tag"], *rows[:250]], end), two=_text([["id", "text", "tag"], *rows[250:]], end))
    good, bad = read_csv_ranges(spark, d, ["tag", "id", "text", "absent"])
    found = {r.id: (r.text, r.tag, r.absent) for r in good.collect()}
    assert bad.count() == 0
    assert found == {i: (t or None, g or None, None) for i, t, g in rows}
    assert spark.read.option("lineSep", "\n").text(d).rdd.getNumPartitions() > 20


def test_broken_records(spark, small_ranges):
    lines = ['id,text', '1,"a\nb"', '2', '3,x,y', '', '4,"closed"junk', '5,6" pipe', '6," never', 'closed,"', '7,z', '8,w']
    good, bad = read_csv_ranges(spark, _folder(a="\n".join(lines) + "\n"), ["id", "text"])
    assert sorted(r.id for r in good.collect()) == ["1", "4", "5", "6", "7", "8"]
    assert sorted(r.line for r in bad.collect()) == ["2", "3,x,y"]
    # an open quote: the lines behind it, one by one; the other file isn't touched by it
    lines = ['id,text', '1,"fine\n"', '2,"open', '3,x', '', '4,' + "y" * 900, '5,z']
    good, bad = read_csv_ranges(spark, _folder(a="\n".join(lines), b="id,text\n9,ok\n"), ["id", "text"])
    assert sorted(r.id for r in good.collect()) == ["1", "9"]
    assert sorted(r.line[:4] for r in bad.collect()) == ['2,"o', "3,x", "4,yy", "5,z"]


def test_headers_names_and_empty_files(spark):
    with pytest.raises(ValueError, match="different headers"):
        read_csv_ranges(spark, _folder(a="x,y\n1,2\n", b="y,x\n1,2\n"), ["x"])
    good, bad = read_csv_ranges(spark, _folder(a="", b='﻿"the, id",y\n1,2\n'), ["the, id", "y"])
    assert [tuple(r) for r in good.collect()] == [("1", "2")] and bad.count() == 0
    good, _ = read_csv_ranges(spark, _folder(a="1,2\n", b="3,4"), ["y"], names=["x", "y"])
    assert sorted(r.y for r in good.collect()) == ["2", "4"]
    good, bad = read_csv_ranges(spark, _folder(a=""), ["x"])
    assert good.count() == bad.count() == 0


def test_a_long_value_and_many_lines(spark, small_ranges):
    """A value of 200,000 quotes and lines: no recursion in the pattern, one record."""
    value = 'say ""x""\n' * 20000
    records = csv_records(spark, _folder(a=f'id,text\n1,"{value}"\n2,' + '"' + '""' * 200000 + '"\n'))
    got = sorted(r.n for r in records.select(F.length("record").alias("n")).collect())
    assert got == sorted([len("id,text"), len('2,""') + 400000, len('1,""') + len(value)])

"""Large files with quoted line breaks, cut by many tasks, against the reader that takes a file whole."""

import random

import pytest
from pyspark.sql import functions as F

from panelflow.sources.header import header_groups, read_header_file, read_header_text
from panelflow.sources.records import open_after, quoted_records


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "400")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("line, out, inside", [
    ("a,b", False, True), ('"a,b', True, False), ('a,"b', True, False), ('a"b,c', False, False), ('"a""b",c', False, False), ('"a"x"y,"', True, True),
    ('",', True, False), ("", False, True), ('"', True, False), ('""', False, True), ('""""', False, True), ('x","y', True, True),
])
def test_state_after_a_line(line, out, inside):
    assert open_after(line, ",") is out and open_after(line, ",", True) is inside


def _value(rng):
    kind = rng.random()
    word = "".join(rng.choice("abc é日") for _ in range(rng.randint(0, 12)))
    if kind < 0.5:
        return word
    if kind < 0.6:
        return word + '"' + word + "x" if word.strip() else "y"          # a quote inside a plain value
    inner = [word, '""', "\n", ",", "line", "\n\n", "\t", " "]
    n = rng.choice([2, 5, 5, 400 if rng.random() < 0.05 else 3])
    return '"' + "".join(rng.choice(inner) for _ in range(n)) + '"'


def _file(rng, k):
    end = "\r\n" if k % 4 == 3 else "\n"
    rows = [",".join(_value(rng) for _ in range(3)) for _ in range(rng.randint(20, 120))]
    if k % 4 == 3:                                                       # line ends are told apart by the first one
        rows = [r.replace("\n", "\r\n") for r in rows]
    rows = ["id,grp,text", *rows, *([""] * (k % 3))]
    text = end.join(rows) + (end if k % 2 else "")
    return ("﻿" if k % 5 == 0 else "") + text


def test_records_equal_the_whole_file_reader(spark, tmp_path, small_blocks):
    rng = random.Random(8)
    for k in range(24):
        (tmp_path / f"f{k:02d}.csv").write_bytes(_file(rng, k).encode())
    groups = header_groups(spark, str(tmp_path), ",")
    assert len(groups) == 2 and sum(len(g.large) for g in groups) >= 20        # line ends of either kind
    got = read_header_text(spark, str(tmp_path), ",", na_values=None, file_col="f")
    whole = (spark.read.schema("id string, grp string, text string").options(sep=",", header="true", escape='"', multiLine="true").csv(str(tmp_path))
             .select("*", F.col("_metadata.file_path").alias("f")))
    key = lambda r: tuple("" if x is None else x + "." for x in r)
    rows, expected = sorted(map(tuple, got.collect()), key=key), sorted(map(tuple, whole.collect()), key=key)
    assert rows == expected and len(rows) > 500
    assert got.rdd.getNumPartitions() > 2 * len(list(tmp_path.iterdir()))


def test_one_record_over_many_blocks(spark, tmp_path, small_blocks):
    p = tmp_path / "one.csv"
    long = "\n".join(f"row {i}, \"\"q\"\"" for i in range(300))
    p.write_text(f'id,text\n1,"{long}"\n2,b\n3,"never closed\nat all')
    rows = {r.id: r.text for r in read_header_text(spark, str(p), ",").collect()}
    assert rows["1"] == long.replace('""', '"') and rows["2"] == "b" and rows["3"].rstrip().endswith("at all")
    assert quoted_records(spark, [str(p)], ",", header=False).count() == 4


def test_typed_read_of_large_and_small_files_with_other_headers(spark, tmp_path, small_blocks):
    (tmp_path / "a.csv").write_text("id,grp\n" + "".join(f'{i},"g\n{i}"\n' for i in range(200)))
    (tmp_path / "b.csv").write_text("grp,id,more\nx,1000,2.5\n")
    got = read_header_file(spark, str(tmp_path), ",")
    assert dict(got.dtypes) == {"id": "bigint", "grp": "string", "more": "double"}
    r = got.agg(F.sum("id"), F.count("*"), F.countDistinct("grp"), F.sum("more")).first()
    assert tuple(r) == (sum(range(200)) + 1000, 201, 201, 2.5)

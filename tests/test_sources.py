"""Sources on hand-made files: UTF-16, CRLF, ragged rows, headers, listings, zips."""

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from panelflow.operators.reconcile import raw_count
from panelflow.schemas import APP, MEDIA, Feed, _schema
from panelflow.sources.archive import archive_members
from panelflow.sources.files import expected_files, latest_file, list_files
from panelflow.sources.header import read_compliance, read_snapshot
from panelflow.sources.sql import query_df, query_rows
from panelflow.sources.usage import raw_lines, read_usage

SMALL = Feed("small", _schema("name string, n int, t timestamp, tail string"),
             encoding="UTF-16LE", file_prefix="small_")


def _utf16(path, text, crlf=False):
    if crlf:
        text = text.replace("\n", "\r\n")
    path.write_bytes(b"\xff\xfe" + text.encode("utf-16-le"))


@pytest.mark.parametrize("crlf", [False, True])
def test_utf16_lf_and_crlf_give_same_values(spark, tmp_path, crlf):
    body = ("héllo\t1\t2023-05-17 10:00:00\tx\n"
            "\n"
            "   \n"
            "wörld\t2\t2023-05-17 11:00:00\ty\n")
    _utf16(tmp_path / "small_2023-05-17.txt", body, crlf)
    df = read_usage(spark, str(tmp_path), SMALL)
    rows = sorted(df.select("name", "n", "t", "tail", "ref_date").collect())
    assert [r.tail for r in rows] == ["x", "y"]          # no stray \r
    assert [r.name for r in rows] == ["héllo", "wörld"]    # mark dropped, non-ASCII kept
    assert rows[0].n == 1 and rows[0].t == dt.datetime(2023, 5, 17, 10)
    assert {r.ref_date for r in rows} == {dt.date(2023, 5, 17)}
    raw = raw_count(raw_lines(spark, str(tmp_path), SMALL)).collect()
    assert [(r.ref_date, r.count_raw) for r in raw] == [(dt.date(2023, 5, 17), 2)]


def test_crlf_last_column_int(spark, tmp_path):
    f = Feed("t", _schema("a string, n int"), encoding="UTF-16LE")
    _utf16(tmp_path / "t_2023-01-02.txt", "a\t5\nb\t6\n", crlf=True)
    assert sorted(r.n for r in read_usage(spark, str(tmp_path), f).collect()) == [5, 6]


def test_permissive_short_long_and_bad_fields(spark, tmp_path):
    f = Feed("p", _schema("a string, v int, t timestamp"), file_prefix="p_")
    (tmp_path / "p_2023-01-02.txt").write_text(
        "short\n"
        "long\t1\t2023-01-02 00:00:00\textra\tmore\n"
        "float\t14.4\t2023-01-02 00:00:00\n"
        "badts\t3\tnot-a-time\n")
    rows = {r.a: r for r in read_usage(spark, str(tmp_path), f).collect()}
    assert rows["short"].v is None and rows["short"].t is None
    assert rows["long"].v == 1
    assert rows["float"].v is None
    assert rows["badts"].v == 3 and rows["badts"].t is None


def test_feed_schemas_have_reference_widths():
    assert (len(APP.schema), len(MEDIA.schema)) == (25, 26)
    assert MEDIA.schema["OsVersion"].dataType.simpleString() == "int"
    assert APP.schema["OsVersion"].dataType.simpleString() == "string"


def test_app_feed_line(spark, tmp_path):
    vals = ["G", "P1", "PC", "C", "CK", "iOS", "14.4", "Apple", "iPhone", "phone", "1.0", "Games", "App",
            "2023-05-17 10:00:00", "2023-05-17 10:05:00", "2023-05-17 02:00:00", "2023-05-17 02:05:00",
            "2023-05-17", "10:00:00", "2023-05-17", "10:05:00", "300", "com.x", "IAB1", "T1"]
    _utf16(tmp_path / "usage_app_2023-05-17.txt", "\t".join(vals) + "\n", crlf=True)
    r = read_usage(spark, str(tmp_path), APP).first()
    assert r.OsVersion == "14.4" and r.SessionDuration == 300 and r.TrackId == "T1"
    assert r.refDate == dt.date(2023, 5, 17)


def test_snapshot_inference_and_missing_values(spark, tmp_path):
    (tmp_path / "snap.csv").write_text(
        "RespondentID\tHousehold\tName\tScore\tFlag\tEmpty\tSGP_MD2_EndTIme\n"
        "1\t10\tAnn\t1.5\tTrue\t\t20230517\n"
        "2\t\tNA\t2\tfalse\t\tbad\n"
        "3\t30\tN/A\t\tTRUE\tNULL\t20231301\n")
    df = read_snapshot(spark, str(tmp_path / "snap.csv"))
    types = dict(df.dtypes)
    assert types == {"RespondentID": "bigint", "Household": "bigint", "Name": "string",
                     "Score": "double", "Flag": "boolean", "Empty": "double",
                     "SGP_MD2_EndTIme": "string"}   # "bad" keeps it text, as pandas would
    rows = {r.RespondentID: r for r in df.collect()}
    assert rows[2].Household is None and rows[2].Name is None and rows[3].Name is None


def test_compliance_declared_schema(spark, tmp_path):
    (tmp_path / "c.csv").write_text('PanelistId,Compliant\n"a,1",1\nb,NA\n')
    df = read_compliance(spark, str(tmp_path / "c.csv"), schema="PanelistId string, Compliant int")
    assert sorted(df.collect()) == [("a,1", 1), ("b", None)]


def test_listing_keeps_zero_byte_and_latest(spark, tmp_path):
    (tmp_path / "export-1.csv").write_text("x\n")
    (tmp_path / "export-0.csv").write_text("")
    lst = {r.file_name: r.length for r in list_files(spark, str(tmp_path)).collect()}
    assert lst == {"export-1.csv": 2, "export-0.csv": 0}
    assert latest_file(spark, str(tmp_path), "export-").endswith("export-1.csv")
    (tmp_path / "export-2.csv").write_text("")
    with pytest.raises(ValueError):
        latest_file(spark, str(tmp_path), "export-")


def _zip(path, members):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    path.write_bytes(buf.getvalue())


def test_archive_members(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    payload = b"\xff\xfe" + "a\t1\n".encode("utf-16-le")
    _zip(land / "usage-20230517T000000Z-20230518T000000Z.zip",
         [("dir/other.txt", b"x"), ("dir/app.txt", payload)])
    _zip(land / "usage-20230518T000000Z-20230519T000000Z.zip", [("other.txt", b"x")])
    out = str(tmp_path / "out")
    rows = {r.archive.rsplit("/", 1)[-1]: r for r in archive_members(spark, str(land), "app.txt", out, APP).collect()}
    hit = rows["usage-20230517T000000Z-20230518T000000Z.zip"]
    assert hit.found and hit.bytes == len(payload) and hit.out_path.endswith("usage_app_2023-05-17.txt")
    assert not rows["usage-20230518T000000Z-20230519T000000Z.zip"].found
    assert (tmp_path / "out" / "usage_app_2023-05-17.txt").read_bytes() == payload


def test_expected_files(spark):
    got = expected_files(spark, ("2023-08-30", "2023-09-01"), APP).orderBy("ref_date").collect()
    assert [r.file_name for r in got] == ["usage_app_2023-08-30.txt", "usage_app_2023-08-31.txt",
                                          "usage_app_2023-09-01.txt"]
    assert got[-1].archive_name == "usage-20230901T000000Z-20230902T000000Z.zip"
    d = expected_files(spark, None, APP, today=dt.date(2024, 3, 1)).first()
    assert d.ref_date == dt.date(2024, 2, 29)


def test_query_rows_one_after_another(spark):
    spark.range(20000).createOrReplaceTempView("many")
    assert [r.id for r in query_rows(spark, "SELECT * FROM many WHERE id >= :lo ORDER BY id", {"lo": 5})] == list(range(5, 20000))
    spark.range(5).createOrReplaceTempView("five")
    assert query_df(spark, "SELECT count(*) AS n FROM five").first().n == 5


def test_utf16_split_across_many_tasks(spark, tmp_path):
    """A large UTF-16 CRLF file cut into many splits keeps every row once."""
    n = 20000
    body = "".join(f"nam€{i}\t{i}\t2023-05-17 10:00:00\tt{i}\n" for i in range(n))
    _utf16(tmp_path / "small_2023-05-17.txt", body, crlf=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = read_usage(spark, str(tmp_path), SMALL)
        assert df.rdd.getNumPartitions() > 10
        agg = df.agg(F.count("*").alias("c"), F.countDistinct("n").alias("d"), F.sum("n").alias("s"),
                     F.count_if(F.col("tail").endswith("\r")).alias("cr")).first()
        assert (agg.c, agg.d, agg.s, agg.cr) == (n, n, n * (n - 1) // 2, 0)
        raw = raw_count(raw_lines(spark, str(tmp_path), SMALL)).first()
        assert raw.count_raw == n
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_utf16_big_endian(spark, tmp_path):
    f = SMALL.with_(encoding="UTF-16BE")
    body = "héllo\t1\t2023-05-17 10:00:00\tx\r\nwörld\t2\t2023-05-17 11:00:00\ty\r\n"
    (tmp_path / "small_2023-05-17.txt").write_bytes(b"\xfe\xff" + body.encode("utf-16-be"))
    rows = sorted(read_usage(spark, str(tmp_path), f).select("name", "n", "tail").collect())
    assert [tuple(r) for r in rows] == [("héllo", 1, "x"), ("wörld", 2, "y")]
    assert raw_count(raw_lines(spark, str(tmp_path), f)).first().count_raw == 2


def test_latest_file_breaks_time_ties_by_name(spark, tmp_path):
    import os
    for name in ("export-2023110906550458.csv", "export-2023111006550458.csv", "export-2023110806550458.csv"):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (1.7e9, 1.7e9))
    assert latest_file(spark, str(tmp_path), "export-").endswith("export-2023111006550458.csv")


def test_jdbc_push_down_refuses_spliced_parameters(spark):
    with pytest.raises(ValueError):
        query_df(spark, "SELECT * FROM t WHERE a = :a", {"a": 1}, jdbc={"url": "jdbc:none:"})

"""Archives written by executors: bytes, digests and rejects of the round trip, equal bytes on a second run, edges."""
import glob
import hashlib
import zipfile

import pytest

from ledgerline.operators import manifest as I
from ledgerline.sources.archives import file_hash, mounted, write_archives
from ledgerline.sources.layouts import LAYOUTS
from ledgerline.sources.zipped import member_stats, zip_lines, zip_members

LINES = "table_name string, cycle int, raw binary"
N = len(LAYOUTS["ccl"].columns)


def ccl(*fields):
    return "|".join([*fields, *[""] * (N - len(fields))]).encode()


def sample():
    rows = [("ccl", 1996, ccl(f"H{i}") + b"\r\n") for i in range(40)]
    rows += [("ccl", 1998, ccl("é☃", str(i)) + b"\n") for i in range(30)]
    rows += [("ccl", 1996, b"\xc3\x28\r\n"), ("ccl", 1996, b"\r\n"), ("ccl", 1998, ccl("x") + b"|y|z\n")]
    return rows + [("cm", 1996, b"C1|NAME\r\n"), ("cm", 1996, b"C1|NAME\r\n")]


def test_round_trip(spark, tmp_path):
    root = str(tmp_path)
    made = write_archives(spark.createDataFrame(sample(), LINES).repartition(3), root)
    rows = made.collect()
    assert sum(r.n_lines for r in rows) == len(sample()) and len({r.zip_path for r in rows}) == len(rows) > 3
    for r in rows:
        path = f"{root}/{r.zip_path}"
        assert r.written_hash == file_hash(path) == hashlib.sha256(open(path, "rb").read()).hexdigest()
        assert zipfile.ZipFile(path).namelist() == [r.source_entry]
    got = [(r.cycle, r.raw_value) for r in zip_lines(spark, made, root).selectExpr("cycle", "cast(value as binary) as raw_value").collect()]
    want = [(c, raw.rstrip(b"\n").removesuffix(b"\r")) for _, c, raw in sample()]
    assert sorted((c, bytes(v)) for c, v in got) == sorted(want)


def test_digest_and_rejects_in_one_pass(spark, tmp_path):
    root = str(tmp_path)
    made = write_archives(spark.createDataFrame(sample(), LINES).repartition(2), root)
    members = zip_members(spark, made, root)
    plan = members._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    stats = member_stats(members)
    assert {(r.zip_path, r.source_file_hash) for r in stats.collect()} == {(r.zip_path, r.written_hash) for r in made.collect()}
    total = {}
    for r in I.archive_history(stats, "2026-01-01 00:00:00").collect():
        a = total.setdefault((r.table_name, r.cycle), [0, 0])
        a[0] += r.row_count
        a[1] += r.rejected_rows
        assert r.duration_ms >= 0 and r.load_id >= 1
    assert total == {("ccl", 1996): [40, 2], ("ccl", 1998): [30, 1], ("cm", 1996): [2, 0]}


def test_a_second_run_writes_the_same_bytes(spark, tmp_path):
    df = spark.createDataFrame(sample(), LINES).repartition(3, "raw")
    one, two = (sorted(map(tuple, write_archives(df, str(tmp_path / x)).collect())) for x in "ab")
    assert one == two
    assert all(f.endswith(".zip") for f in glob.glob(f"{tmp_path}/a/data/*/*"))  # no draft is left


def test_edges(spark, tmp_path):
    empty = write_archives(spark.createDataFrame([], LINES), str(tmp_path / "empty"))
    assert empty.collect() == [] and zip_members(spark, empty, str(tmp_path / "empty")).collect() == []
    long = ("ccl", 2000, b"a" * 3_000_000 + b"\n")
    made = write_archives(spark.createDataFrame([long, long], LINES).repartition(1), str(tmp_path / "long"))
    assert [r.n for r in zip_lines(spark, made, str(tmp_path / "long")).selectExpr("length(value) as n").collect()] == [3_000_000] * 2
    for i in range(3):
        row = [("cm", 1996, b"x\n")[k] if k != i else None for k in range(3)]
        with pytest.raises(Exception, match="is NULL"):
            write_archives(spark.createDataFrame([tuple(row)], LINES), str(tmp_path / f"null{i}"))
    assert mounted("file:///x/y") == "/x/y" == mounted("/x/y")
    with pytest.raises(ValueError):
        mounted("hdfs://host/x")

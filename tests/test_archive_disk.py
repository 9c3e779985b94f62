"""Disk and plan of the archives: members are compressed, one cycle's archives at a time, lines counted without a sort."""
import glob
import os
import random
import uuid
import zipfile

import pytest

import __spark_entry__ as E
from ledgerline.plans import q_refresh
from ledgerline.sources.archives import remove_archives, write_archives
from ledgerline.sources.zipped import member_stats, zip_members

LINES = "table_name string, cycle int, raw binary"


def test_members_are_compressed(spark, tmp_path):
    draw = random.Random(1)
    rows = [(t, c, f"C{draw.randrange(10**8)}|CANDIDATE OF THE PARTY|{'é' * (i % 4)}|{i}\n".encode())
            for i in range(2000) for t, c in [(("cm", "cn")[i % 2], 1996 + 2 * (i % 3))]]
    made = write_archives(spark.createDataFrame(rows, LINES).repartition(2), str(tmp_path)).collect()
    assert sum(r.n_lines for r in made) == len(rows)
    for r in made:
        with zipfile.ZipFile(f"{tmp_path}/{r.zip_path}") as zf:
            (info,) = zf.infolist()
            text = zf.read(info)
        assert info.compress_type == zipfile.ZIP_DEFLATED and info.date_time == (1980, 1, 1, 0, 0, 0)
        assert r.zip_bytes < len(text) / 2 and text.count(b"\n") == r.n_lines
        held = {raw for t, c, raw in rows if (t, c) == (r.table_name, r.cycle)}
        assert {*text.splitlines(keepends=True)} <= held


def test_only_the_archives_of_a_manifest_go(spark, tmp_path):
    made = write_archives(spark.createDataFrame([("cm", 1996, b"x\n"), ("cm", 1998, b"y\n")], LINES).repartition(1), str(tmp_path))
    remove_archives(made.where("cycle = 1996"), str(tmp_path))
    assert [os.path.basename(os.path.dirname(f)) for f in glob.glob(f"{tmp_path}/data/*/*")] == ["1998"]
    remove_archives(made, str(tmp_path))  # one is gone already
    assert glob.glob(f"{tmp_path}/data/*/*") == [] and made.count() == 2


def test_lines_are_counted_without_a_sort(spark, tmp_path):
    raws = [b"C1|a\r\n", b"\n", b"C1" + b"|x" * 40 + b"\n", b"\xc3\x28\n", b"C2\n"]
    made = write_archives(spark.createDataFrame([("cm", 1996, r) for r in raws], LINES).repartition(1), str(tmp_path))
    stats = member_stats(zip_members(spark, made, str(tmp_path)))
    assert [(r.row_count, r.rejected_rows, r.source_file_hash) for r in stats.collect()] == [(2, 3, made.first().written_hash)]
    members = zip_members(spark, made, str(tmp_path)).selectExpr(
        "'other' as table_name", "cycle", "zip_path", "source_entry", "value", "source_file_hash", "duration_ms")
    assert [(r.row_count, r.rejected_rows) for r in member_stats(members).collect()] == [(0, 0)]  # no layout, no lines of it
    plan = member_stats(zip_members(spark, made, str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("MapInArrow") == 1


def test_one_cycle_at_a_time(spark, sf, duck, tmp_path, monkeypatch):
    seen = []

    def watched(archives, root):
        seen.append({f.split("/")[-2] for f in glob.glob(f"{tmp_path}/*/data/*/*.zip")})
        remove_archives(archives, root)

    monkeypatch.setattr(q_refresh, "_folder", lambda spark, what: f"{tmp_path}/{what}-{uuid.uuid4().hex}")
    monkeypatch.setattr(q_refresh, "remove_archives", watched, raising=False)
    got = E.queries()["archive_load_history"](spark, sf)
    assert glob.glob(f"{tmp_path}/*/data/*/*") == []
    assert len(seen) >= 4 and all(len(x) <= 1 for x in seen)
    cur = duck.execute(E.oracle_sql()["archive_load_history"])
    at = [d[0] for d in cur.description]
    assert sorted(tuple(r[c] for c in at) for r in got.collect()) == sorted(cur.fetchall())


def test_no_ship_date_is_refused(spark, sf, tmp_path):
    for t in ("customer", "supplier"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(3).write.parquet(f"{tmp_path}/{t}.parquet")
    li = spark.read.parquet(f"{sf}/lineitem.parquet").limit(20)
    li.unionByName(li.limit(1).selectExpr(*[c if c != "l_shipdate" else "cast(null as timestamp_ntz) as l_shipdate" for c in li.columns])) \
        .write.parquet(f"{tmp_path}/lineitem.parquet")
    with pytest.raises(Exception, match="cycle of a line is NULL"):
        E.queries()["archive_load_history"](spark, str(tmp_path))

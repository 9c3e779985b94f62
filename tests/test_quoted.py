"""Quoted records over file splits: against a character-by-character reader and DuckDB's read_csv."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources.layouts import LAYOUTS
from ledgerline.sources.quoted import INSIDE, OUTSIDE, line_state, parse_records, read_records, split_starts, _lines


def plain_reader(data: bytes):
    """(quoted, records as lists of fields) of a file, one character at a time."""
    text = data.decode("utf-8", "surrogateescape")
    records, fields, field, state, any_quoted = [], [], "", "start", False
    ok, begin = True, 0
    for i, ch in enumerate(text):
        if state == "in":
            if ch == '"':
                state = "maybe"
            else:
                field += ch
            continue
        if state == "maybe":
            if ch == '"':
                field, state = field + '"', "in"
                continue
            if ch not in "|\n" and not (ch == "\r" and text[i + 1:i + 2] in ("\n", "")):
                ok = False
                break
            state = "after"
        if ch == "|":
            fields, field, state = fields + [field], "", "start"
        elif ch == "\n":
            if text[begin:i] not in ("", "\r"):
                records.append(fields + [field])
            fields, field, state, begin = [], "", "start", i + 1
        elif ch == '"' and state == "start":
            state, any_quoted = "in", True
        else:
            field, state = field + ch, ("plain" if state != "after" else "after")
    if state == "in":
        ok = False
    if ok and any_quoted:
        if text[begin:] not in ("", "\r"):
            records.append(fields + [field])
        return True, [r[:-1] + [r[-1][:-1] if r[-1].endswith("\r") else r[-1]] for r in records]
    lines = text.split("\n")
    if lines and lines[-1] == "":
        lines.pop()
    lines = [x[:-1] if x.endswith("\r") else x for x in lines]
    return False, [x.split("|") for x in lines if x]


def valid(records):
    return [r for r in records if not any(0xDC80 <= ord(c) <= 0xDCFF for f in r for c in f)]


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "40"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k in keys:
        spark.conf.unset(k)


def well_formed(rng, n):
    def field():
        x = "".join(rng.choice(['a', 'b', 'ß', ' ', '"', '|', '\n', '\n\n', '""']) for _ in range(rng.randrange(6)))
        quote = any(c in x for c in '"|\n') or rng.random() < 0.1
        return '"' + x.replace('"', '""') + '"' if quote else x
    return "\n".join("|".join(field() for _ in range(rng.randrange(1, 4))) for _ in range(n)).encode()


def test_random_files_in_many_splits(spark, tmp_path, small_splits):
    rng = random.Random(11)
    files = {}
    for k in range(30):
        data = well_formed(rng, 40)
        if k % 5 == 1:
            data = data.replace(b'"|', b'" x|', 1)  # a stray character makes the file literal
        if k % 5 == 2:
            data += b'\n"never closed|\nline\n'
        if k % 5 == 3:
            data = b"".join(rng.choice([b"a", b'"', b"|", b"\n", b"\xff", b"\r\n", b"x5\" y"]) for _ in range(400))
        if k % 5 == 4:
            data = b'1|"' + b"long line without quotes\n" * 60 + b'end"|2\r\n\n3|\xff\n4|"\xff\n5"\n' + data
        files[k] = data
    files[100], files[101], files[102] = b"", b'""', b'"a|b"\n'
    for k, data in files.items():
        (tmp_path / f"cycle={k}").mkdir()
        (tmp_path / f"cycle={k}" / "t.txt").write_bytes(data)
    got = {}
    for r in read_records(spark, str(tmp_path)).collect():
        got.setdefault(r.cycle, []).append((r.quoted, tuple(r.parts)))
    dialects = set()
    for k, data in files.items():
        quoted, records = plain_reader(data)
        dialects.add(quoted)
        assert sorted(got.get(k, [])) == sorted((quoted, tuple(r)) for r in valid(records)), k
    assert dialects == {True, False}
    starts = split_starts(_lines(spark, str(tmp_path), ["cycle"]))
    assert starts.where("starts_inside").count() > 30 and starts.count() > 100


def test_quoted_file_equals_read_csv(spark, tmp_path, small_splits):
    import duckdb

    rng = random.Random(5)
    names = LAYOUTS["ccl"].names
    rows = [[rng.choice(["H1", 'a "b" c', "x|y", "two\nlines", "", "2024", "20.6"]) for _ in names] for _ in range(200)]
    lines = ["|".join('"' + f.replace('"', '""') + '"' if any(c in f for c in '"|\n') else f for f in r) for r in rows]
    (tmp_path / "cycle=2024").mkdir()
    (tmp_path / "cycle=2024" / "ccl.txt").write_text("\n".join(lines) + "\n")
    cols = "{" + ", ".join(f"'{n}': 'VARCHAR'" for n in names) + "}"
    want = duckdb.sql(f"select * from read_csv('{tmp_path}/cycle=2024/ccl.txt', delim='|', header=false, all_varchar=true, null_padding=true, "
                      f"quote='\"', escape='\"', parallel=false, hive_partitioning=false, columns={cols})").fetchall()
    got = read_records(spark, str(tmp_path)).select(*[F.expr(f"nullif(get(parts, {i}), '')") for i in range(len(names))]).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert parse_records(read_records(spark, str(tmp_path)), LAYOUTS["ccl"]).count() == 200


def test_states_of_a_line():
    assert line_state(b'a|"b', OUTSIDE) == (INSIDE, True)
    assert line_state(b'b"|c', INSIDE) == (OUTSIDE, False)
    assert line_state(b'"a""', OUTSIDE) == (INSIDE, True)
    assert line_state(b'5" pipe|x', OUTSIDE) == (OUTSIDE, False)
    assert line_state(b'"Q" S', OUTSIDE)[0] == 2
    assert line_state(b'"', INSIDE) == (OUTSIDE, False)


def test_text_is_not_shuffled(spark, tmp_path):
    (tmp_path / "cycle=2").mkdir()
    (tmp_path / "cycle=2" / "t.txt").write_bytes(b'"a"|b\n')
    plan = read_records(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [path" not in plan and "BroadcastHashJoin" in plan

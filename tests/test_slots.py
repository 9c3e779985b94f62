"""Profile of every slot: each source read once, no row per field, equal to brute force whatever is kept or handed on."""
import collections

import pyarrow as pa
import pyarrow.compute as pc
import pytest

import __spark_entry__ as E
from ledgerline.operators import slots as S
from ledgerline.sources.layouts import LAYOUTS
from ledgerline.sources.render import render_lines, render_tables

LINES = "table_name string, cycle int, raw binary"
N = len(LAYOUTS["ccl"].columns)


def sample():
    rows = [("ccl", 1996 + 2 * (i % 2), "|".join([f"H{i % 40}", "é☃" * (i % 3), "", str(i), "x" * (i % 6), str(i // 1000), "\U0001f600"]).encode()) for i in range(500)]
    rows += [("ccl", None, b"a|b"), ("ccl", 1996, b"a"), ("ccl", 1998, b"|"), ("cm", 1996, b"a|b\\c\"|d"), ("cm", -2, b" | ")]
    full = b"|".join([b"f"] * N)
    rows += [("ccl", 2000, full + b"|"), ("ccl", 2000, full + b"| "), ("ccl", 2000, full + b"||"), ("ccl", 2000, b""), ("ccl", 2000, b"\xc3\x28|a")]
    return rows + rows[:50]


def expected(rows):
    held = collections.defaultdict(list)
    for table, cycle, raw in rows:
        try:
            f = raw.decode().split("|")
        except UnicodeDecodeError:
            continue
        n = len(LAYOUTS[table].columns)
        if raw and (len(f) <= n or (len(f) == n + 1 and not f[n])):
            for i, text in enumerate(f):
                held[table, cycle, i + 1].append(text)
    key = str.encode
    return {k: (len(v), sum(map(bool, v)), sum(map(len, v)), min(filter(None, v), default=None, key=key),
                max(filter(None, v), default=None, key=key), len({*v} - {""})) for k, v in held.items()}


def test_equals_brute_force(spark):
    df = spark.createDataFrame(sample(), LINES).repartition(3)
    got = S.slot_profile(df.selectExpr("table_name", "cycle", "cast(raw as string) as value")).collect()
    assert {tuple(r[:3]): tuple(r[3:]) for r in got} == expected(sample()) and len(got) == len(expected(sample()))


@pytest.mark.parametrize("chunk, held, buckets", [(1, 0, 1), (500, 0, 3), (500, 2000, 24), (1 << 20, 1 << 20, 7)])
def test_whatever_is_handed_on(monkeypatch, chunk, held, buckets):
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(S, "HELD_BYTES", held)
    monkeypatch.setattr(S, "BLOCK_ROWS", 5)
    monkeypatch.setattr(S, "HASHED", 3)
    rows = [r for r in sample() if r[2] and b"\xc3\x28" not in r[2]]
    schema = pa.schema([("table_name", pa.string()), ("cycle", pa.int32()), ("value", pa.string())])
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*[(a, b, v.decode()) for a, b, v in rows[i:i + 20]]), schema.types)], schema=schema)
               for i in range(0, len(rows), 20)]
    widths = {t: len(lay.columns) for t, lay in LAYOUTS.items()}
    blocks = pa.Table.from_batches(S._profile(buckets, widths)(iter(batches)), schema=S._BLOCKS)
    blocks = blocks.sort_by([(c, "ascending") for c in ("table_name", "cycle", "slot", "bucket")])
    counts = pa.Table.from_batches(S._count(iter(blocks.to_batches(max_chunksize=4))), schema=S._COUNTS)
    got = counts.group_by(["table_name", "cycle", "slot"]).aggregate(
        [("n_rows", "sum"), ("n_filled", "sum"), ("n_chars", "sum"), ("least", "min"), ("greatest", "max"), ("n_distinct", "sum")])
    assert {tuple(list(r.values())[:3]): tuple(list(r.values())[3:]) for r in got.to_pylist()} == expected(rows)


def test_a_bucket_depends_on_the_text_alone():
    texts = pa.array([str(i) * (i % 5) for i in range(1, 3000) if i % 5] + ["é" * 2000, "a", "ab"])
    at = dict(zip(texts.to_pylist(), S._buckets(texts, 97)))
    back = pa.concat_arrays([pa.array(["z"]), texts.take(pc.sort_indices(texts))]).slice(1)
    assert dict(zip(back.to_pylist(), S._buckets(back, 97))) == at and len({*at.values()}) == 97


def test_lines_of_all_tables_at_once(spark, sf):
    got = collections.Counter(map(tuple, render_tables(spark, sf, LAYOUTS).collect()))
    want = collections.Counter((t, *r) for t in LAYOUTS for r in render_lines(spark, sf, t).collect())
    assert got == want


def test_plan_reads_each_source_once(spark, sf):
    plan = E.queries()["scan_fields"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and "posexplode" not in plan

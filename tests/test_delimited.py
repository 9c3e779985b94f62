"""Malformed landing lines, from literal files in a fresh temp directory."""

import os

from ledgerline.sources.delimited import load_text, rejected_lines, read_text_lines
from ledgerline.sources.layouts import Layout

THREE = Layout("t3", "t3.txt", "dimension", (("A", "s"), ("B", "s"), ("C", "s")))


def _write(path, data: bytes):
    with open(path, "wb") as fh:
        fh.write(data)


def test_malformed_lines(spark, tmp_path):
    p = os.path.join(tmp_path, "t3.txt")
    _write(p, b"S|a\r\nS\n\nW|a|b|c\nQ|\"open|z\nQ|\"Q\" S|z\nT|x|y|\nbad|\xff\xfe|z\nOK|1|2\n")
    rows = load_text(spark, p, THREE, 2026).select("A", "B", "C").collect()
    got = sorted((tuple(r) for r in rows), key=repr)
    assert got == sorted([
        ("S", "a", None), ("S", None, None), ("Q", '"open', "z"), ("Q", '"Q" S', "z"),
        ("T", "x", "y"), ("OK", "1", "2"),
    ], key=repr)
    # rows in = typed + rejected
    lines = read_text_lines(spark, p, 2026)
    assert lines.count() == len(got) + rejected_lines(lines, THREE).count()


def test_empty_file(spark, tmp_path):
    p = os.path.join(tmp_path, "empty.txt")
    _write(p, b"")
    assert load_text(spark, p, THREE, 2026).count() == 0

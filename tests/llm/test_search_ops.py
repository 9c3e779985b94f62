"""Top-k search, archives, decontamination, licenses and the pipeline."""
import gzip
import re

import numpy as np
import pytest
from pyspark.sql import types as T

import corpus_pipeline
from ledgerline.llm import warc
from ledgerline.llm.decontaminate import contaminated, decontaminate
from ledgerline.llm.licenses import TEMPLATES, TEXTS, default_templates, scan_licenses
from ledgerline.llm.native_words import EDGES
from ledgerline.llm.queries import ORACLE, QUERIES
from ledgerline.llm.topk_search import _reached, exact_top_k


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracles(spark, duck, sf, name):
    got = QUERIES[name](spark, sf)
    want = duck.execute(ORACLE[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(str, got.select(cols).collect())) == sorted(str(T.Row(*cols)(*r)) for r in want.fetchall())


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (20, [-1.0]), (20, [-1.0]), (3, None), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (None, [1.0, 1.0]), (7, []), (40, [1e30, -1e30])]
    v = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, rank string")
    got = exact_top_k(v, v.where("vec_id % 20 = 0"), k=3, shard_rows=2, block_rows=1, leaf=1).collect()
    good = [(i, [int(x * 64 // 1) if abs(x) < 1e15 else int(x) * 64 for x in e] + [0] * (2 - len(e))) for i, e in rows if i is not None and i not in (3, 4, 5, 6)]
    want = []
    for q in (0, 20, 40):
        mine = dict(good)[q]
        near = sorted((-sum(a * b for a, b in zip(mine, e)), i) for i, e in good if i != q)[:3]
        want += [(q, k + 1, i, max(-2**63, min(2**63 - 1, -s))) for k, (s, i) in enumerate(near)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert exact_top_k(v.limit(0), v.limit(0)).collect() == []


def test_top_k_of_many_shards(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(3000, 6)) * 0.3 + rng.normal(size=(12, 6))[rng.integers(0, 12, 3000)], 3)
    ids = [7 if i < 900 else i for i in range(3000)]  # an id in many rows
    v = spark.createDataFrame([(i, r) for i, r in zip(ids, x.tolist())], "vec_id long, embedding array<double>").repartition(5)
    got = exact_top_k(v, v.where("vec_id % 20 = 0"), k=5, shard_rows=64, block_rows=16, leaf=8, sample=1000, box_rows=8).collect()
    z = np.floor(64 * x).astype(int)
    want = []
    for q in range(900, 3000, 20):
        near = sorted((-int(s), i, at) for at, (i, s) in enumerate(zip(ids, z @ z[q])) if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i, _) in enumerate(near)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want


def test_top_k_asks_only_shards_that_can_hold_a_hit():
    low, high = np.array([[0.0, 0.0], [4.0, 4.0], [-3.0, -3.0]]), np.array([[1.0, 1.0], [5.0, 5.0], [-2.0, -2.0]])
    q = np.array([[1.0, 1.0], [-1.0, -1.0]])
    bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    row = {"ids": np.array([10, 11]).tobytes(), "vectors": q.tobytes(), "kth_of": [(10, 3), (11, 5)], "home": 1, "block": 4}
    out = [r for b in _reached(2)(row, np.arange(3), bounds) for r in b.to_pylist()]
    assert [(r["shard"], np.frombuffer(r["ids"], np.int64).tolist(), r["kths"]) for r in out] == [(2, [11], [5])]


PAGES = [(1, "x" * 100_000 + "é€" * 40_000, "http://a"), (2, None, None), (3, "", "http://c\r\nX: y"), (4, "<p>\r\n\r\nWARC/1.1</p>", "d"), (5, "<p>\r\n\r\nWARC/1.1</p>", "e"),
         (None, "only", "f"), (5, "<p>\r\n\r\nWARC/1.1</p>", "e")]


def test_warc_round_trip_edges(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, html string, url string")
    got = {(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.problem) for r in warc.round_trip(pages, segment=1000, chunk=300).collect()}
    want = set()
    for i, html, _ in PAGES:
        same = [p for p, h, _ in PAGES if (h or "") == (html or "") and p is not None]
        first = max(same, default=None)
        body = (html or "").encode()
        want.add((i, len(body), warc.digest_of(body), "response" if i == first else "revisit", None if i == first else first, None))
    assert got == want
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_warc_damage_is_reported(spark, tmp_path):
    pages = spark.createDataFrame([(1, "abcdefgh" * 100, "u")], "page_id long, html string, url string")
    warc.write_archives(pages, str(tmp_path / "a"), segment=200, chunk=64)
    part = next((tmp_path / "a").glob("part-*"))
    data = gzip.decompress(part.read_bytes())
    cut = data.index(b"WARC/1.1", data.index(b"WARC-Segment-Number: 2"))
    again = data.index(b"WARC/1.1", cut + 8)
    for name, broken, problem in (("b", data[:cut] + data[again:], "segments are missing"), ("c", data.replace(b"Total-Length: ", b"Total-Length: 1"), "total length differs")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc").write_bytes(broken)
        assert [r.problem for r in warc.read_archives(spark, str(tmp_path / name)).collect()] == [problem]


ITEM = "In the town of Arden a baker sells 12 loaves each morning and 30 rolls each evening so how many goods are sold in 7 days"
OTHER = "In the town of Boston a baker sells 15 loaves each morning and 44 rolls each evening so how many goods are sold in 9 days"
TWICE = "At the fair they sold {} on the first market day of spring and on the second market day once more they sold {} in all"

DENSE = "then one gave {} apples to us and {} pears to them and {} plums to her and {} figs to him"


def test_decontamination(spark, docs_of, edge_rows):
    bench = spark.createDataFrame([(1, ITEM), (2, None), (3, ""), (None, ITEM), (4, TWICE.format(5, 5)), (5, DENSE.format(5, 5, 5, 5))], "item_id long, text string")
    rows = [*edge_rows, (20, "Well. " + ITEM + " Yes."), (21, "Hm, " + OTHER), (22, "nothing of the kind happens in this text at all, not even by chance"),
            (23, TWICE.format(8, 8)), (24, TWICE.format(8, 2)), (25, TWICE.format(5, 6)), (26, DENSE.format(8, 8, 8, 8)), (27, DENSE.format(8, 2, 7, 1))]
    docs = docs_of(rows)
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    # 24 and 25 hold most windows word for word; in 27 every window has a slot, and they disagree
    assert got == {(20, 1), (21, 1), (23, 4), (24, 4), (25, 4), (26, 5)}
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 6
    assert contaminated(docs_of([]), bench).collect() == [] and contaminated(docs, bench.limit(0)).collect() == []
    shuffled = {(r.doc_id, r.item_id) for r in contaminated(docs, bench, broadcast_rows=0, inline_rows=0).collect()}
    assert shuffled == got


SUMS = "3 + 5 = 8 and 7 * 6 = 42 and 90 - 41 = 49 and 12 / 4 = 3 and 15 + 16 = 31"
SUMS2 = "4 + 5 = 9 and 8 * 6 = 48 and 91 - 41 = 50 and 16 / 4 = 4 and 15 + 17 = 32"
TABLE = "12 km 13 km 15 miles 18 pounds 20 kg 25 kg 30 hours 31 days 40 cm 44 mm"
NAMES = "Alice Arden Bruno Boston Clara Carlisle Dmitri Dover Elena Exeter Felix Falmouth"
SHOUT = "WHICH OF THE FOUR RIVERS OF THE OLD PROVINCE FLOWS INTO THE NORTHERN SEA"


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 0, "inline_rows": 0}])
def test_decontamination_of_placeholders_and_short_items(spark, docs_of, options):
    items = {1: SUMS, 2: TABLE, 3: NAMES, 4: SHOUT, 5: "capital of the old province", 6: "a baker sells 12 loaves daily", 7: "12 loaves and 30 rolls"}
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    around = "it was said that {} and so it went on"
    docs = [(i, around.format(t)) for i, t in items.items()] + [
        (11, around.format(SUMS2)), (12, around.format("1 km 2 km 3 miles 4 pounds 5 kg 6 kg 7 hours 8 days 9 cm 10 mm")), (13, around.format("Anna Bath Carl Cork Dora Derby Egon Ely Fritz Fife")),
        (14, around.format(SHOUT.lower())), (15, SHOUT.title()), (16, "the capital of the new province is not known"),
        (17, around.format("a baker sells 15 loaves daily")), (18, around.format("15 loaves and 44 rolls")), (19, "15 loaves and 44 rolls"), (20, "loaves and 30"), (21, items[5])]
    got = {(r.doc_id, r.item_id) for r in contaminated(docs_of(docs), bench, **options).collect()}
    assert got == {(i, i) for i in items} | {(11, 1), (14, 4), (15, 4), (17, 6), (19, 7), (21, 5)}


def test_decontamination_finds_whole_items(spark, sf, documents):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    want = {(r.doc_id, i) for r in documents.collect() for i, t in items.items() if t and t in (r.text or "")}
    got = {(r.doc_id, r.item_id) for r in contaminated(documents, bench).collect()}
    assert want and got == want


def test_license_scan(documents):
    notices = ["licensed under the GNU General Public License, version 3.", "Licensed under CC BY-NC 4.0.", "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."]
    want = {r.doc_id for r in documents.collect() if any(n in (r.text or "") for n in notices)}
    assert want and {r.doc_id for r in scan_licenses(documents).collect()} == want


def brute_licenses(rows, templates):
    """(doc, license, template, containment, start) of the best window of every text, by plain sets of words."""
    def words(text):
        low = [w.strip(EDGES).lower() for w in re.split("[ \\x09-\\x0d]+", text or "") if w]
        at = [i for i, w in enumerate(low) if w]
        w = [low[i] for i in at]
        return at, [tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))] if w else []

    known = [(t, name, set(words(text)[1]), len(words(text)[1])) for t, name, text in templates]
    out = set()
    for i, text in rows:
        at, grams = words(text)
        inside = set(grams)
        for t, name, own, n in known:
            if len(own & inside) < 0.8 * len(own):
                continue
            size = 1 << (n - 1).bit_length()
            best = max((len(own & set(grams[s:s + 2 * size])) / len(own), -s) for s in range(0, len(grams), size))
            if best[0] >= 0.8:
                out.add((i, name, t, best[0], at[-best[1]]))
    return out


def test_license_scan_against_brute_force(spark, documents):
    templates = [(r.template_id, r.license, r.text) for r in default_templates(spark).collect()]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    full = max((t for _, _, t in templates), key=len)
    rows += [(10_000 + t, f"some words before it {text} and after") for t, _, text in templates]
    rows += [(20_000, "# " + "\n# ".join(full.split("\n"))), (20_001, full[:len(full) // 2]), (20_002, templates[1][2].replace("License", "Licence", 1))]
    got = {tuple(r) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_licenses(rows, templates)


def test_license_edges(spark, docs_of, edge_rows):
    text = "pad " * 333 + "You may NOT use this file except in compliance with the License. You may obtain a copy of the license at once " + "pad " * 50
    rows = [*edge_rows, (30, text), (31, "Released under the MIT License."), (31, "Released under the MIT License.")]
    got = {(r.doc_id, r.license) for r in scan_licenses(docs_of(rows)).collect()}
    assert got == {(30, "Apache-2.0"), (31, "MIT")}
    assert scan_licenses(docs_of([])).collect() == []
    none = spark.createDataFrame([], "template_id int, license string, text string")
    assert scan_licenses(docs_of(rows), none).collect() == []


def test_license_headers_in_comments(spark, docs_of):
    mit = (TEXTS / "MIT.txt").read_text()
    rows = [(i, "import os " * 40 + "\n" + "".join(f"{mark} {line}\n" for line in mit.splitlines()) + "x = 1 " * 40) for i, mark in enumerate(("#", "//", " *", ";;"))]
    gpl = "either version 3 of\n# the License, or\n# (at your option)\n# any later version."
    rows += [(10, "# " + gpl), (11, "--- *** ---"), (12, " ".join((TEXTS / "GPL-3.0.txt").read_text().split()[:1000]))]
    got = {(r.doc_id, r.license, r.template_id >= len(TEMPLATES)) for r in scan_licenses(docs_of(rows)).collect()}
    assert got >= {(i, "MIT", True) for i in range(4)} | {(i, "MIT", False) for i in range(4)} | {(10, "GPL-3.0", False)}
    assert not {g for g in got if g[0] == 11 or g[0] == 12 and g[2]}


def test_license_full_texts(spark, docs_of):
    """Every text is found in a document that holds it with words left out, inlined and shuffled alike."""
    texts = {f.stem: f.read_text() for f in TEXTS.glob("*.txt")}
    rows = [(i, "lead in " * 100 + " ".join(w for k, w in enumerate(t.split()) if k % 200 != 150) + " tail" * 100) for i, t in enumerate(texts.values())]
    docs = docs_of(rows)
    got = [{(r.doc_id, r.license, r.template_id, round(r.containment, 9), r.start) for r in scan_licenses(docs, inline=n).collect()} for n in (50_000, 0)]
    assert got[0] == got[1]
    assert {(i, name) for i, name in enumerate(texts)} <= {(i, name) for i, name, t, *_ in got[0] if t >= len(TEMPLATES)}


def test_license_templates_without_a_cap(spark, docs_of):
    words = [f"w{i}" for i in range(60_000)]
    rows = [(k, f"L{k}", " ".join(words[k * 500:(k + 1) * 500])) for k in range(120)]
    many = spark.createDataFrame(rows, "template_id int, license string, text string")
    got = scan_licenses(docs_of([(1, rows[7][2]), (2, "x " * 300 + rows[100][2] + " y" * 9), (None, rows[3][2])]), many).collect()
    assert {(r.doc_id, r.license) for r in got} == {(1, "L7"), (2, "L100"), (None, "L3")}


def test_pipeline_decisions(spark, sf):
    """Every stage by brute force or by its own operator's rule, on its predecessor's rows."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, seen[-1], sf)
        assert out.columns == docs.columns
        seen.append(spark.createDataFrame(out.collect(), docs.schema))
    start, good, single, clean, safe = ({r.doc_id: r for r in d.collect()} for d in seen)
    bad = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 0}
    assert bad & start.keys() and not bad & good.keys()
    from test_dedup_ops import brute_components
    comps = brute_components([(i, r.text) for i, r in good.items()])
    assert single.keys() == {i for i, (_, c) in comps.items() if c == i}
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert clean.keys() == {i for i, r in single.items() if not any(t in r.text for t in items)}
    from test_scoring_ops import brute_spans, check_packing
    assert safe.keys() == clean.keys() and all(not brute_spans(r.text) and r.n_chars == len(r.text) for r in safe.values())
    packed = corpus_pipeline.run(spark, sf).collect()
    check_packing([(i, r.text) for i, r in safe.items()], packed)


def test_pipeline_of_hard_rows_and_none(spark, sf, edge_rows, tmp_path):
    """Nulls, empty and long texts, repeated rows, clashing extra columns; and empty tables."""
    extra = "array(1) as spans, 'm' as masked, true as held_out, 0.5D as score, 'i' as own_id, 'p' as place, 'c' as contaminated"
    docs = spark.createDataFrame(edge_rows, "doc_id long, text string").selectExpr("doc_id", "text", "cast(length(text) as bigint) as n_chars", *extra.split(", "))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), sf).collect() == [], name
    assert stage(spark, docs, sf).count() == len(edge_rows)
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []

"""Merkle manifest: against a plain recomputation of every digest, proof and folded root."""

from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm import merkle
from ledgerline.llm.queries import LETTERS, op11

LOWER = str.maketrans(*LETTERS)


def h(text):
    return sha256(text.encode()).hexdigest()


def row_digest(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree_levels(leaves, fan):
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h("".join(row[i:i + fan])) for i in range(0, len(row), fan)])
    return levels


def expected(rows, fan=16):
    """Sorted rows (doc_id, leaf, subroot, root, proof, folded, verified) of (doc_id, source, lang, n_chars, text)."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        ordered = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, row_digest(r)))
        trees[s] = (ordered, tree_levels([row_digest(r) for r in ordered], fan))
    top = tree_levels([trees[s][1][-1][0] for s in names], fan)
    out = []
    for at, s in enumerate(names):
        ordered, levels = trees[s]
        for i, r in enumerate(ordered):
            changed = r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0
            now = row_digest([*r[:4], r[4].translate(LOWER) if r[4] is not None else None]) if changed else row_digest(r)
            proof, k = "", i
            for steps, start in ((levels[:-1], i), (top[:-1], at)):
                k = start
                for row in steps:
                    run = row[k - k % fan:][:fan]
                    proof += "".join(run[:k % fan] + run[k % fan + 1:])
                    now = h("".join(run[:k % fan] + [now] + run[k % fan + 1:]))
                    k //= fan
            out.append((r[0], levels[0][i], levels[-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def frame(spark):
    schema = T.StructType([T.StructField(n, t()) for n, t in (("doc_id", T.LongType), ("source", T.StringType), ("lang", T.StringType), ("n_chars", T.LongType),
                                                             ("text", T.StringType), ("leaf", T.StringType), ("tree", T.LongType), ("digest", T.StringType))])
    return lambda rows: spark.createDataFrame([(*r, "clash", 1, None) for r in rows], schema)


def found(docs, **options):
    suspect = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = merkle.document_manifest(docs, suspect, {"text": F.translate("text", *LETTERS)}, **options)
    return sorted((tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified").collect()), key=repr)


@pytest.mark.parametrize("fan,height", [(2, 1), (2, 3), (3, 2), (16, 2)])
def test_several_levels_of_blocks(frame, fan, height):
    rows = [(i, f"s{i % 7 if i % 3 else 0}", "en", i, f"Text {i} ÄÖ") for i in range(90)]
    assert found(frame(rows).repartition(5), fan=fan, height=height) == expected(rows, fan)


def test_edge_rows(frame, edge_rows):
    rows = [(i, s, None, None, t) for i, t in edge_rows for s in (None, "", "Ä", "b")]
    got = found(frame(rows), fan=2, height=2)
    assert got == expected(rows, 2)
    assert {r[6] for r in got} == {True, False} or all(r[6] for r in got)


def test_one_leaf_and_no_rows(frame):
    one = [(5, "s", "en", 3, "abc")]
    assert found(frame(one)) == expected(one)
    assert found(frame([])) == []


def test_query_on_documents(spark, sf, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = sorted(((r[0], r[1], r[2], r[3], h(r[4]), r[5], r[6]) for r in expected(rows)), key=repr)
    assert sorted((tuple(r) for r in op11(spark, sf).collect()), key=repr) == want
    assert not all(r[6] for r in want)


@pytest.mark.parametrize("fan", [2, 3, 16])
def test_addresses_are_a_permutation_with_whole_subtrees_together(fan):
    for leaves in [1, 2, fan, fan + 1, fan ** 2, fan ** 3 - 1, fan ** 3]:
        for levels in {merkle.levels_of(leaves, fan), merkle.levels_of(leaves, fan) + 1}:
            places = merkle._places(leaves, levels, fan)
            flat = np.concatenate(places)
            assert sorted(flat.tolist()) == list(range(len(flat))) and places[0][0] == 0
            low = levels - levels // 2
            for d in range(levels // 2, levels):  # a bottom tree lies in one stretch
                tree = np.arange(len(places[d])) // fan ** (d - levels // 2)
                starts = places[levels // 2][tree]
                assert ((places[d] >= starts) & (places[d] < starts + (fan ** low - 1) // (fan - 1))).all()

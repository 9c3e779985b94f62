"""Jaccard join and substring dedup against brute force."""
import hashlib
import re

from ledgerline.llm.jaccard_join import keep_one, ngram_jaccard
from ledgerline.llm.substring_dedup import substring_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_jaccard_matches_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(documents).collect()}
    assert got == brute_components(rows)


def test_jaccard_near_copies_of_one_text(docs_of):
    """A group of edited copies, many of them linked only through others, plus frequent shingles."""
    base = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(base))]
    for k in range(1, 80):
        own = list(base)
        for j in range(k % 4):
            own[(7 * k + 13 * j) % 60] = f"x{k}_{j}"
        rows.append((k, " ".join(own)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(docs_of(rows)).collect()}
    assert got == brute_components(rows)


def test_jaccard_edges(docs_of, edge_rows):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_jaccard(docs_of(edge_rows)).collect()), key=str)
    n = len(shingles(edge_rows[0][1]))
    assert got == sorted([(1, n, 1), (2, n, 1), (2, n, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (None, n, None), (None, 0, None), (6, 1, 6), (7, 1, 7)], key=str)
    assert ngram_jaccard(docs_of([])).collect() == []


def test_keep_one(docs_of, edge_rows):
    kept = keep_one(docs_of(edge_rows))
    assert kept.columns == ["doc_id", "text", "score"]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, 5, None, None, 6, 7], key=str)


def test_keep_one_keeps_columns_of_any_name(docs_of):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "z y x"), (3, "k l m"), (3, None)]
    docs = docs_of(rows).selectExpr("doc_id", "text", "'x' as own_id", "'y' as Place", "'z' as _id", "'w' as _gone")
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a b c d e f g", "x", "y", "z", "w"), (3, "k l m", "x", "y", "z", "w")]


def brute_removed(rows, span):
    first = {}
    for i, t in sorted(rows):
        w = words(t)
        for k in range(len(w) - span + 1):
            first.setdefault(tuple(w[k:k + span]), i)
    out = {}
    for i, t in rows:
        w = words(t)
        drop = set()
        for k in range(len(w) - span + 1):
            if first[tuple(w[k:k + span])] < i:
                drop |= set(range(k, k + span))
        out[i] = (len(w), len(drop), " ".join(x for k, x in enumerate(w) if k not in drop))
    return out


def test_substring_dedup_matches_brute_force(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup(documents).collect()}
    assert got == brute_removed(rows, 50)


def test_substring_dedup_factors_and_edges(docs_of, edge_rows):
    rows = [(10, "a b c d e f g h"), (11, "z a b c d e q d e f g h"), (12, "b c d e f")]
    out = {r.doc_id: r for r in substring_dedup(docs_of(rows), span=4).collect()}
    assert {i: (r.n_words, r.n_removed, r.kept_text) for i, r in out.items()} == brute_removed(rows, 4)
    assert [(f.start, f.length, f.src_doc, f.src_start) for f in out[11].factors] == [(1, 5, 10, 0), (7, 5, 10, 3)]
    got = sorted(((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup(docs_of(edge_rows)).collect()), key=str)
    n = len(words(edge_rows[0][1]))
    assert got == sorted([(1, n, 0), (2, n, n), (2, n, n), (3, 0, 0), (4, 0, 0), (5, 0, 0), (None, n, 0), (None, 0, 0), (6, 60_000, 0), (7, 2, 0)], key=str)
    assert substring_dedup(docs_of([])).collect() == []
    assert hashlib.sha256(out[10].kept_text.encode()).hexdigest() == hashlib.sha256(b"a b c d e f g h").hexdigest()


def test_a_thousand_repeated_rows_in_seconds(docs_of):
    import time

    text = " ".join(f"w{i}" for i in range(150))
    rows = [(1, text)] + [(2, text)] * 1000
    t0 = time.time()
    got = substring_dedup(docs_of(rows)).select("doc_id", "n_removed", "factors").collect()
    assert sorted({(r.doc_id, r.n_removed, len(r.factors)) for r in got}) == [(1, 0, 0), (2, 150, 1)] and len(got) == 1001
    assert time.time() - t0 < 60

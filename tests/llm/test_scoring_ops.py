"""Language-model scores, quality, personal data, packing."""
import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerline.llm import lm_score, packing, quality
from ledgerline.llm.pii import find_pii, find_spans, luhn, masked, mod97
from ledgerline.llm.queries import QUALITY_BAR, pack

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def brute_base(rows):
    out = [i is not None and zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    count = collections.Counter(t for (_, x), o in zip(rows, out) if not o for t in tokens(x))
    n, v = sum(count.values()), len(count)
    for (i, x), o in zip(rows, out):
        own = tokens(x)
        yield i, o, len(own), sum(count[t] > 0 for t in own), n, sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in own)


def same_scores(got, rows):
    key = lambda r: (str(r[0]), r[2], r[3])
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for g, e in zip(got, sorted(brute_base(rows), key=key), strict=True):
        assert g[:5] == e[:5] and math.isclose(g[5], e[5], rel_tol=1e-9, abs_tol=1e-9)


def test_lm_scores(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = lm_score.lm_scores(documents).collect()
    same_scores(got, rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_edges(docs_of, edge_rows):
    got = lm_score.lm_scores(docs_of(edge_rows)).collect()
    same_scores(got, edge_rows)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)
    assert lm_score.lm_scores(docs_of([])).collect() == []


def test_lm_table_is_normalised():
    pairs = np.zeros((1024, 1024), np.int64)
    pairs[0, 1], pairs[1, 0], pairs[2, 3] = 900, 900, 100
    table = lm_score.train(pairs, steps=60)
    assert np.allclose((10.0 ** table.astype(float)).sum(1), 1, atol=1e-3)
    assert table[0, 1] > table[0, 3] and table[2, 3] > table[2, 0]


def test_lm_classes_grow_with_the_tokens():
    """No cap: a million times the tokens give ten times the classes; ranks by exact count, ties to the smaller hash."""
    words = np.arange(100_000, dtype=np.uint64)
    sizes = [lm_score.Lexicon(words, np.ones(len(words), np.int64), n).classes for n in (10**4, 10**7, 10**10, 10**13)]
    assert all(b > 3 * a for a, b in zip(sizes, sizes[1:])) and sizes[1] < 1100 and sizes[3] < 10_000
    lex = lm_score.Lexicon(np.array([9, 4, 7, 5], np.uint64), np.array([3, 8, 3, 0]), 1)
    assert lex.own_classes == 48 and list(lex.hash) == [4, 5, 7, 9] and list(lex.own) == [0, -1, 1, 2]


def test_lm_scores_do_not_depend_on_the_partitioning(spark, documents):
    """Statistics are exact whatever the tasks saw; the scores equal those of one partition."""
    docs = documents.select("doc_id", "text")
    one, many = ({r.doc_id: (r.base_score, r.score) for r in lm_score.lm_scores(docs.repartition(n)).collect()} for n in (1, 7))
    assert one.keys() == many.keys()
    for i in one:
        assert np.allclose(one[i], many[i], rtol=1e-9)


def test_lm_more_classes_score_held_out_texts_higher(spark, sf):
    docs = spark.read.parquet(f"{sf[:-5]}0.01/documents.parquet").select("doc_id", "text")
    few, many = (sum(r.score for r in lm_score.lm_scores(docs, growth=g).collect() if r.held_out) for g in (4, lm_score.GROWTH))
    assert many > few


def test_quality_held_out(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf[:-5]}0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = [r for r in quality.score(docs.select("doc_id", "text"), model).collect() if r.held_out and r.doc_id in known]
    right = sum((r.score >= QUALITY_BAR) == known[r.doc_id] for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)


def test_quality_votes_recomputed(spark, documents, sf):
    model = quality.fit(documents, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = documents.select("doc_id", "text").collect()
    got = {r.doc_id: r.score for r in quality.score(documents.select("doc_id", "text"), model).collect()}
    assert len(got) == len(rows)
    for r in rows:
        (_, _, counts), = quality.term_counts(pa.array([r.text]))
        terms = {int(t): math.sqrt(counts[0][t] / counts[0].sum()) * float(model.weight[t]) for t in np.flatnonzero(counts[0])}
        v = sum((w * model.basis[t].astype(float) for t, w in terms.items()), np.zeros(model.basis.shape[1]))
        v = v / np.linalg.norm(v)
        near = sorted(((float(v @ m), int(y)) for m, y in zip(model.vectors.astype(float), model.labels)), reverse=True)
        votes = [(max(s, 1e-6) ** 8, y) for s, y in near[:25]]
        assert abs(got[r.doc_id] - sum(w * y for w, y in votes) / sum(w for w, _ in votes)) < 2e-3


def test_quality_of_texts_without_terms_is_the_label_share(spark, docs_of):
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(40)], "doc_id long, quality int")
    model = quality.fit(docs_of([(i, f"text {i} " * (1 + i % 3)) for i in range(40)]), labels)
    got = quality.score(docs_of([(1, None), (2, ""), (3, " \n")]), model, score_col="s", held_col="h").collect()
    assert {r.s for r in got} == {float(model.labels.mean(dtype=np.float64))}


def test_quality_edges(spark, docs_of, edge_rows):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 0), (7, None, 0), (2, 5, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(edge_rows)
    got = quality.score(docs, quality.fit(docs, labels), score_col="s", held_col="h").collect()
    assert len(got) == len(edge_rows) and all(0 <= r.s <= 1 for r in got)
    none = quality.score(docs, quality.fit(docs, labels.limit(0)), score_col="s", held_col="h").collect()
    assert {r.s for r in none} == {0.5}
    assert quality.score(docs_of([]), quality.fit(docs, labels), score_col="s", held_col="h").collect() == []


def test_quality_repeated_rows_of_an_id(spark, docs_of):
    labels = spark.createDataFrame([(i, int(i > 0)) for i in range(20)], "doc_id long, quality int")
    rows = [(i, f"some good text of number {i} stands here.") for i in range(20)]
    once, hot = (quality.fit(docs_of(x), labels) for x in (rows, rows + [(0, f"z spam {k}") for k in range(300)] * 30))
    assert {0, 1} == set(once.labels) and sorted(once.labels) == sorted(hot.labels) and np.allclose(once.vectors, hot.vectors)


def digits(s):
    return re.sub("[^0-9]", "", s)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]


def brute_spans(text):
    return sorted((m.start(), k, kind, m.end()) for k, (kind, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m.group()))


def test_pii_base_spans(documents):
    for r in find_pii(documents.select("doc_id", "text")).collect():
        got = [(s.start, s.kind, s.end) for s in r.pii_spans if s.kind in dict((k, 1) for k, *_ in BASE)]
        assert got == [(a, kind, b) for a, _, kind, b in brute_spans(r.text)]


def test_pii_cases():
    tricky = ["a@b@c.de x@y.z@q.rr", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.03.4", "4111 1111 1111 1111 and 4111-1111-1111-1112", "é@x.yz ☎ +1 (212) 555-0100.", "@@.a.@b.c", "a" * 50_000 + "@x"]
    for t in tricky:
        assert [(s["start"], s["kind"], s["end"]) for s in find_spans(t)] == [(a, k, b) for a, _, k, b in brute_spans(t)]
    assert luhn("4111111111111111") and not luhn("4111111111111112") and mod97("GB82WEST12345698765432")
    assert [s["kind"] for s in find_spans("IBAN GB82 WEST 1234 5698 7654 32")] == ["iban"]
    assert find_spans("GB83 WEST 1234 5698 7654 32") == []
    assert [s["kind"] for s in find_spans("social security 123-45-6789")] == ["ssn"] and find_spans("part 123-45-6789") == []
    assert masked("mail a@b.cd now", find_spans("mail a@b.cd now")) == "mail [EMAIL] now"


def test_pii_iban_before_capitals_or_digits():
    for text, code in (("IBAN GB82WEST12345698765432 BIC NWBKGB2LXXX", "GB82WEST12345698765432"), ("DE89370400440532013000 EUR 500", "DE89370400440532013000"),
                       ("GB82 WEST 1234 5698 7654 32 AND MORE", "GB82 WEST 1234 5698 7654 32"), ("REF AB12 IBAN GB82WEST12345698765432", "GB82WEST12345698765432")):
        assert [text[s["start"]:s["end"]] for s in find_spans(text) if s["kind"] == "iban"] == [code]
    both = "DE89370400440532013000 GB82WEST12345698765432"
    assert [both[s["start"]:s["end"]] for s in find_spans(both) if s["kind"] == "iban"] == both.split()


def test_pii_edges(docs_of, edge_rows):
    got = find_pii(docs_of(edge_rows), masked_col="m").collect()
    assert len(got) == len(edge_rows) and all(r.pii_spans == [] and r.m == r.text for r in got)
    assert find_pii(docs_of([])).collect() == []


def check_packing(docs, got):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for i, t in docs:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        head = len(ids) % 2048 or min(len(ids), 2048)
        for k, at in enumerate([0, *range(head, len(ids), 2048)]):
            n = head if k == 0 else 2048
            want[i, k, at, n, zlib.crc32(ids[at:at + n].tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(bins)


def test_packing(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = pack(documents).collect()
    bound = -(-sum(r.length for r in got) // 2048)
    assert check_packing(rows, got) <= bound + 1


def test_packing_edges(docs_of, edge_rows):
    rows = [*edge_rows, (8, "a <|endoftext|> b")]
    check_packing(rows, pack(docs_of(rows)).collect())
    assert pack(docs_of([])).collect() == []


def test_patterns_use_every_piece():
    counts = {2048: 3, 1500: 2, 548: 2, 700: 5, 648: 1, 1: 7}
    left = collections.Counter()
    for bin_, times in packing.patterns(counts, 2048):
        assert sum(bin_) <= 2048
        left.update({k: v * times for k, v in collections.Counter(bin_).items()})
    assert left == counts


def test_hard_texts_take_seconds(docs_of):
    import time

    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgerline.llm.packing import Encoder
    from ledgerline.llm.pii import find_spans

    t0 = time.time()
    assert find_spans("7" * 1_000_000) == [] and find_spans("1." * 300_000) != [] and find_spans("0" * 10_000 + ".1.2.3")[0]["kind"] == "ip"
    assert find_spans("+1" + "(" * 500_000) == [] and find_spans("a@" + "b" * 500_000) == []
    assert [(s["start"], s["end"]) for s in find_spans("x 12.3.4.5.6.7.8.9") if s["kind"] == "ip"] == [(2, 10), (11, 18)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, plain = Encoder(path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN), Tokenizer.from_file(path)
    for text in (" " * 1_200_000, "\n" * 1_200_000 + "x"):
        assert encoder.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert time.time() - t0 < 60

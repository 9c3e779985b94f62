"""Token operators: against the tokenizers libraries and plain loops over tokens."""

import json
import random
import sys
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest

from ledgerline.llm import bpe
from ledgerline.llm.queries import op12

BYTES = public_tokenizers.path("byte_bpe_50k.json")
HARD = [" " * 100_000, "\n" * 100_000 + "b", "a" * 100_000, "ab" * 50_000, "7" * 100_000, "<|endoftext|>" * 3, "x<|endoftext|> y", "<|endoftext|", "",
        "a\x00b", "it's we'LL 'twas", "ünïcödé ßtraße", "日本語 テキスト", "😀👍🏽", "՘\U00010940", "▁x", "tab\t\x85\xa0　end ", "﻿é é"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    def get(specials):
        t = Tokenizer.from_file(BYTES)
        t.encode_special_tokens = not specials
        return t

    return get


def mixed_texts(n):
    rng = random.Random(7)
    pool = [chr(x) for r in ((0, 0x250), (0x300, 0x370), (0x5D0, 0x600), (0x2000, 0x2070)) for x in range(*r)]
    pool += ["　", "\U0001f600", "՘", "一"] + ["<|endoftext|>", "'s", "'ll", "  ", "\n\n", "aaaa"] * 10
    return ["".join(rng.choices(pool, k=rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("specials", [True, False])
def test_ids_equal_the_library(library, specials):
    texts = mixed_texts(3000) + HARD
    want = [e.ids for e in library(specials).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in bpe.Bpe(BYTES, specials).encode_many(texts)] == want


def test_known_words_start_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 50)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 300)
    texts = mixed_texts(300)
    want = [e.ids for e in library(True).encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in bpe.Bpe(BYTES).encode_many(texts)] == want


def test_pre_tokens_of_every_settled_character(library):
    coder, cut = bpe.Bpe(BYTES), library(True).pre_tokenizer.pre_tokenize_str
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and coder.settled(chr(c))]
    for i in range(0, len(chars), 500):
        text = "".join(f"a{c} {c}b1{c}1.{c}." for c in chars[i:i + 500])
        assert coder.words(text) == [text[a:b] for _, (a, b) in cut(text)]
    assert len(chars) > 90_000


def test_any_ids_decode_as_the_library_does(library):
    rng = random.Random(3)
    coder, lib = bpe.Bpe(BYTES), library(True)
    for _ in range(3000):
        ids = [rng.randrange(50_400) for _ in range(rng.randrange(20))]
        assert coder.decode(np.array(ids, "<u4")) == lib.decode(ids, skip_special_tokens=False)


def test_merges_that_do_not_follow_are_refused(tmp_path):
    spec = json.load(open(BYTES, encoding="utf-8"))
    spec["model"]["merges"] = spec["model"]["merges"][::-1]
    (tmp_path / "t.json").write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.Bpe(str(tmp_path / "t.json"))


def test_edge_rows_and_no_rows(docs_of, edge_rows, library):
    rows = edge_rows + [(100 + i, t) for i, t in enumerate(HARD)]
    got = bpe.decode(bpe.encode(docs_of(rows), BYTES), BYTES).collect()
    lib = library(True)
    want = [(i, np.array(lib.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t or "") for i, t in rows]
    assert Counter((r.doc_id, bytes(r.ids), r.decoded) for r in got) == Counter(want)
    assert all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert bpe.encode(docs_of([]), BYTES).count() == 0


def test_query_on_documents(spark, sf, documents, library):
    lib = library(True)
    want = set()
    for i, t in documents.select("doc_id", "text").collect():
        ids = lib.encode(t or "", add_special_tokens=False).ids
        text = lib.decode(ids, skip_special_tokens=False)
        want.add((i, len(ids), sha256(np.array(ids, "<u4").tobytes()).hexdigest(), sha256(text.encode()).hexdigest()))
    assert {tuple(r) for r in op12(spark, sf).collect()} == want


# alignment

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def spans(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def expected_alignment(rows, lib_a, lib_b):
    """Counter of (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), token by token."""
    inverse = {i: t for t, i in lib_a.get_vocab().items()}
    letters = bpe.byte_letters()
    per_row, documents = [], Counter()
    for i, text in rows:
        a = lib_a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = lib_b.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in inverse[x]) for x in a]
        b_bytes = [bytes([lib_b.id_to_piece(x)[3:5] and int(lib_b.id_to_piece(x)[3:5], 16)]) if lib_b.is_byte(x)
                   else lib_b.id_to_piece(x).replace("▁", " ").encode() for x in b]
        want = b" " + (text or "").encode()
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            per_row.append((i, [], [], "", []))
            continue
        sa, sb = spans(a_bytes), spans(b_bytes)
        links, k = [], 0
        for x, (lo, hi) in zip(a, sa):
            while sb[k][1] <= lo:
                k += 1
            m = k
            while m < len(sb) and sb[m][0] < hi:
                links.append((x, b[m]))
                m += 1
        shared = {e for _, e in sa} & {e for _, e in sb}
        groups, last = [], 0
        for e in sorted(shared):
            groups.append(",".join(str(x) for x, (lo, hi) in zip(a, sa) if last <= lo and hi <= e) + "|"
                          + ",".join(str(x) for x, (lo, hi) in zip(b, sb) if last <= lo and hi <= e)) if len(a) < 3000 else groups.append(None)
            last = e
        documents.update(set(links))
        per_row.append((i, a, b, None if None in groups else ";".join(groups), links))
    top = defaultdict(int)
    for (x, _), n in documents.items():
        top[x] = max(top[x], n)
    return per_row, documents, top


def check_alignment(got, rows, lib_a, lib_b):
    per_row, documents, top = expected_alignment(rows, lib_a, lib_b)
    want = Counter((i, len(a), len(b), len(links), sum(documents[p] == top[p[0]] for p in links), sum(documents[p] for p in links)) for i, a, b, _, links in per_row)
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_links, r.n_best, r.count_sum) for r in got) == want
    text = Counter((i, g) for i, _, _, g, _ in per_row if g is not None)
    assert Counter((r.doc_id, r.groups) for r in got if (r.doc_id, r.groups) in text) == text
    assert all(r.n_groups == (r.groups.count(";") + 1 if r.groups else 0) for r in got)


@pytest.mark.parametrize("head", [0, 50, 1 << 18])
def test_alignment_of_hard_rows(docs_of, edge_rows, library, head):
    import sentencepiece

    from ledgerline.llm.align import align, link_counts

    rows = edge_rows + [(100 + i, t) for i, t in enumerate(HARD)] + [(500 + i, t) for i, t in enumerate(mixed_texts(200))]
    got = link_counts(align(docs_of(rows).repartition(3), BYTES, PIECES), head).collect()
    check_alignment(got, rows, library(False), sentencepiece.SentencePieceProcessor(model_file=PIECES))
    assert any(r.n_a == 0 for r in got if r.doc_id and r.doc_id >= 100)


def test_alignment_of_no_rows(docs_of):
    from ledgerline.llm.align import align, link_counts

    assert link_counts(align(docs_of([]), BYTES, PIECES)).count() == 0


def test_alignment_query_on_documents(spark, sf, documents, library):
    import sentencepiece

    from ledgerline.llm.queries import op13

    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    per_row, counts, top = expected_alignment(rows, library(False), sentencepiece.SentencePieceProcessor(model_file=PIECES))
    got = {r.doc_id: r for r in op13(spark, sf).collect()}
    assert len(got) == len(rows)
    for i, a, b, groups, links in per_row:
        r = got[i]
        assert (r.n_a, r.n_b, r.n_links) == (len(a), len(b), len(links))
        assert r.count_sum == sum(counts[p] for p in links) and r.n_best == sum(counts[p] == top[p[0]] for p in links)
        if groups is not None:
            assert r.groups_sha256 == (sha256(groups.encode()).hexdigest() if groups else "")

"""Byte-pair encoding by a pair occurrence index, and decoding.

Texts are cut into pre-tokens; a task takes them in chunks of bounded size and encodes the
chunk's distinct pre-tokens together.  Their bytes are symbols of one linked list.  An index
maps the rank of each pair of neighbours that can merge to all its positions in the chunk; the
active ranks wait in a heap.  The lowest rank is taken, its positions are merged from left to
right, and each merge enters the new pairs with the symbols on both sides into their lists.
Entries of pairs that a merge destroyed are told by their symbols when their list is reached.

A merge's parts are always made by earlier merges (checked when the vocabulary is read), so no
merge can bring back a rank that has been taken, and the order within a rank is the only one
that matters: the result is that of merging every text by itself.

Pre-tokens follow the tokenizer's pattern through the ``regex`` module, whose Unicode tables are
newer than those of the tokenizers library.  Texts with a character that Unicode 3.2 does not
know or files otherwise are therefore cut by the library's own pre-tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.stage import small_batches

CHUNK_CHARS = 2_000_000
KNOWN_WORDS = 300_000
KNOWN_CHARS = 8_000_000

#: Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: The same for ASCII texts.
ASCII_PATTERN = PATTERN.replace(r"\s\p{L}\p{N}", r"\sA-Za-z0-9").replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else the next one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(1)
def _settled() -> frozenset[str]:
    """Characters that Unicode 3.2 and the tables of this Python file alike."""
    old, now = unicodedata.ucd_3_2_0.category, unicodedata.category
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if old(c) != "Cn" and old(c)[0] == now(c)[0])


class Numbers(dict):
    """Running numbers of words, given out as they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Bpe:
    """Encoder and decoder of a tokenizers file with a byte-level BPE and no normalizer.

    ``specials`` False reads special strings in texts as plain text.
    """

    def __init__(self, path: str, specials: bool = True):
        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if model["type"] != "BPE" or not plain or spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
            raise ValueError("not a plain byte-level BPE")
        vocab = model["vocab"]
        letters = byte_letters()
        first = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            first[byte] = vocab[letter]
        self.first = first
        self.left, self.right, self.made = [], [], []
        self.follows: dict[int, dict[int, int]] = {}
        self.precedes: dict[int, dict[int, int]] = {}
        known = set(letters)
        for r, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            if a not in known or b not in known or a + b in known:
                raise ValueError(f"merge {r} does not follow from the merges before it")
            known.add(a + b)
            x, y = vocab[a], vocab[b]
            self.left.append(x), self.right.append(y), self.made.append(vocab[a + b])
            self.follows.setdefault(x, {})[y] = r
            self.precedes.setdefault(y, {})[x] = r
        self.first_rank = np.array([[self.follows.get(x, {}).get(y, -1) for y in first.tolist()] for x in first.tolist()], np.int64)

        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("special strings that take in their surroundings")
        self.bytes: dict[int, bytes] = {}
        for token, i in (vocab | added).items():
            inner = [letters.get(c) for c in token]
            self.bytes[i] = token.encode() if None in inner else bytes(inner)
        self.added = added if specials else {}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if self.added else None
        self.words = regex.compile(PATTERN).findall
        self.ascii_words = re.compile(ASCII_PATTERN, re.ASCII).findall
        self.settled = _settled().issuperset
        self.library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._forget()

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens of a text; special strings are pre-tokens of their own."""
        if self.split is not None and any(s in text for s in self.added):
            parts = self.split.split(text)
            return list(chain.from_iterable([p] if i % 2 else self._cut(p) for i, p in enumerate(parts)))
        return self._cut(text)

    def _cut(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii_words(text)
        if self.settled(text):
            return self.words(text)
        return [text[a:b] for _, (a, b) in self.library(text)] if text else []

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds) of pre-tokens, merged together over one pair occurrence index."""
        raw = [w.encode() for w in words]
        # a gap of two places on both sides of each word ends its list
        data = np.frombuffer(b"\0\0" + b"\0\0".join(raw) + b"\0\0", np.uint8)
        lengths = np.array([len(x) for x in raw], np.int64)
        starts = np.cumsum(np.concatenate(([2], lengths[:-1] + 2)))
        inside = np.ones(len(data), bool)
        gaps = np.concatenate(([0], starts + lengths))
        inside[gaps] = inside[gaps + 1] = False
        symbols = np.where(inside, self.first[data], -1)
        ranks = np.where(inside[:-1] & inside[1:], self.first_rank[data[:-1], data[1:]], -1)
        at = np.flatnonzero(ranks >= 0)
        at = at[np.argsort(ranks[at], kind="stable")]
        active, cuts = np.unique(ranks[at], return_index=True)
        index = {r: x.tolist() for r, x in zip(active.tolist(), np.split(at, cuts[1:]))}
        symbol, after, before = symbols.tolist(), list(range(1, len(data) + 1)), list(range(-1, len(data) - 1))

        heap = list(index)
        heapify(heap)
        while heap:
            r = heappop(heap)
            a, b, c = self.left[r], self.right[r], self.made[r]
            follows, precedes = self.follows.get(c), self.precedes.get(c)
            places = index.pop(r)
            places.sort()
            for p in places:
                q = after[p]
                if symbol[p] != a or symbol[q] != b:
                    continue
                n = after[q]
                symbol[p], symbol[q] = c, -2
                after[p], before[n] = n, p
                if follows is not None and symbol[n] in follows:
                    k = follows[symbol[n]]
                    if k in index:
                        index[k].append(p)
                    else:
                        index[k] = [p]
                        heappush(heap, k)
                if precedes is not None and symbol[before[p]] in precedes:
                    m = before[p]
                    k = precedes[symbol[m]]
                    if k in index:
                        index[k].append(m)
                    else:
                        index[k] = [m]
                        heappush(heap, k)
        done = np.array(symbol, np.int64)
        kept = np.flatnonzero(done >= 0)
        return done[kept].astype("<u4"), np.searchsorted(kept, np.concatenate((starts, [len(data)])))

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit numbers; null: none."""
        chunk: list[list[str]] = []
        size = 0  # characters
        for text in texts:
            chunk.append(self.pre_tokens(text or ""))
            size += len(text or "")
            if size >= CHUNK_CHARS:
                yield from self._encode_chunk(chunk)
                chunk, size = [], 0
        yield from self._encode_chunk(chunk)

    def _forget(self) -> None:
        """Start the table of known pre-tokens anew: special strings only."""
        self.number, self.chars = Numbers(), 0
        for word in self.added:
            self.number[word]
        self.ids = np.array(list(self.added.values()), "<u4")
        self.bounds = np.arange(len(self.added) + 1)

    def _encode_chunk(self, chunk: list[list[str]]) -> list[np.ndarray]:
        if len(self.number) > KNOWN_WORDS or self.chars > KNOWN_CHARS:
            self._forget()
        have = len(self.number)
        numbers = np.fromiter(map(self.number.__getitem__, chain.from_iterable(chunk)), np.int64)
        if len(self.number) > have:
            new = list(islice(self.number, have, None))
            self.chars += sum(map(len, new))
            ids, bounds = self.encode_words(new)
            self.bounds = np.concatenate((self.bounds[:-1], bounds + len(self.ids)))
            self.ids = np.concatenate((self.ids, ids))
        lengths = np.diff(self.bounds)[numbers]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        flat = self.ids[np.arange(ends[-1]) + np.repeat(self.bounds[numbers] - ends[:-1], lengths)]
        cuts = ends[np.cumsum([len(words) for words in chunk], dtype=np.int64)]
        return np.split(flat, cuts[:-1]) if chunk else []

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; unknown ids are skipped, bytes that are not UTF-8 become U+FFFD."""
        known = self.bytes
        return b"".join([known[i] for i in ids.tolist() if i in known]).decode("utf-8", "replace")


@lru_cache(4)
def bpe(path: str, specials: bool = True) -> Bpe:
    """One encoder per Python worker and file."""
    return Bpe(path, specials)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", specials: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids): one row per row of ``docs``; ``ids`` holds little-endian unsigned 32-bit ids.

    A null text is empty and has no ids.  Null and repeated ids keep their rows; other columns take
    no part; an empty table gives no rows.  No shuffle; a task holds one chunk of texts.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        coder = bpe(path, specials)
        for batch in batches:
            ids = list(coder.encode_many(batch.column(1).to_pylist()))
            yield pa.record_batch([batch.column(0), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                                  names=["doc_id", "n_tokens", "ids"])

    return docs.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` with ``decoded``, the text of their column ``ids`` (null: null)."""
    at = rows.columns.index("ids")

    def run(batches):
        coder = bpe(path)
        for batch in batches:
            texts = [None if x is None else coder.decode(np.frombuffer(x, "<u4")) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, decoded string")

"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust the score.

Kinds, in order: email, ip, card (Luhn), phone, iban (mod 97), ssn.  The first four are
base kinds: each match that passes its check stays, whatever its score.  The others need a
score of ``KEEP``: half for the pattern, more for a checksum or a context word nearby.
"""

from __future__ import annotations

import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerline.llm.stage import small_batches

#: Kinds in order, their context words, and scores.
KINDS = ["email", "ip", "card", "phone", "iban", "ssn"]
BASE = KINDS[:4]
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server"), "card": ("card", "visa", "credit", "payment"),
    "phone": ("phone", "tel", "call", "mobile", "fax"), "iban": ("iban", "account", "bank", "transfer"),
    "ssn": ("ssn", "social", "security"),
}
KEEP, PATTERN_SCORE, CHECK_SCORE, CONTEXT_SCORE, NEAR = 0.7, 0.5, 0.4, 0.3, 40

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++){3}")  # a match can only begin where digits begin: linear in a run of them
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                  T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def emails(text: str):
    """Leftmost matches of local@domain, found from each @ outwards: linear in the text."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def ibans(text: str):
    """Matches that pass mod 97, each with its longest end that does; the search goes on inside a match without one."""
    m = IBAN.search(text)
    while m:
        after = m.start() + 1
        for end in range(m.end(), m.start() + 14, -1):
            whole = text[end - 1] != " " and (end == m.end() or text[end] == " ")
            code = text[m.start():end].replace(" ", "") if whole else ""
            if 15 <= len(code) <= 34 and mod97(code):
                yield m.start(), end
                after = end
                break
        m = IBAN.search(text, after)


def proposals(text: str):
    """(kind, start, end, whether a checksum confirms it) of every match that passes its own check."""
    for a, b in emails(text):
        yield "email", a, b, False
    for m in IP.finditer(text):
        if all(len(x) <= 3 and int(x or "0") <= 255 for x in (y.lstrip("0") for y in m.group().split("."))):
            yield "ip", m.start(), m.end(), False
    for m in CARD.finditer(text):
        d = digits_of(m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            yield "card", m.start(), m.end(), True
    for m in PHONE.finditer(text):
        if 10 <= len(digits_of(m.group())) <= 15:
            yield "phone", m.start(), m.end(), False
    for a, b in ibans(text):
        yield "iban", a, b, True
    for m in SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "ssn", m.start(), m.end(), False


def find_spans(text: str) -> list[dict]:
    """Spans (kind, start, end, score) in code points, by start, then kind."""
    out = []
    for kind, a, b, checked in proposals(text):
        near = re.findall(r"[a-z]+", (text[max(0, a - NEAR):a] + " " + text[b:b + NEAR]).lower())
        score = PATTERN_SCORE + CHECK_SCORE * checked + CONTEXT_SCORE * any(w in CONTEXT[kind] for w in near)
        if kind in BASE or score >= KEEP:
            out.append({"kind": kind, "start": a, "end": b, "score": min(1.0, score)})
    return sorted(out, key=lambda s: (s["start"], KINDS.index(s["kind"])))


def masked(text: str, spans: list[dict]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    out, done = [], 0
    for s in spans:
        if s["start"] >= done:
            out += [text[done:s["start"]], f"[{s['kind'].upper()}]"]
        done = max(done, s["end"])
    return "".join(out) + text[done:]


def find_pii(docs: DataFrame, text_col: str = "text", spans_col: str = "pii_spans", masked_col: str | None = None) -> DataFrame:
    """``docs`` with ``spans_col`` (spans of the whole text) and, if named, ``masked_col`` (the text without them).

    Null and empty texts have no spans; a null text stays null when masked.  Repeated rows and
    rows with nulls elsewhere come back as they are.  The new names must differ from the old ones.
    """
    small_batches(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(at)
            may = pc.fill_null(pc.match_substring_regex(texts, "[0-9@]"), False).to_pylist()
            spans, clean = [[] for _ in may], []
            for row, hit in enumerate(may):
                if hit:
                    text = texts[row].as_py()
                    spans[row] = find_spans(text)
                    if masked_col:
                        clean.append(masked(text, spans[row]))
            cols = [*batch.columns, pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))]
            names = [*batch.schema.names, spans_col]
            if masked_col:
                cols.append(pc.replace_with_mask(texts, pa.array(may), pa.array(clean, texts.type)))
                names.append(masked_col)
            yield pa.record_batch(cols, names=names)

    schema = T.StructType([*docs.schema.fields, T.StructField(spans_col, SPANS)])
    return docs.mapInArrow(run, schema.add(masked_col, T.StringType()) if masked_col else schema)


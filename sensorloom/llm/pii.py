"""Personal data: patterns propose spans, checksums confirm them, words nearby move their score.

A span's score is its kind's prior, raised by a word of its kind's context near by and lowered by a word that speaks of
something else. Kinds that are asked for always (the base kinds) stay whatever their score; of the added kinds only
spans that reach LEAST stay: a national id or a short card number needs its context, an account number with a good
checksum stays unless the words near it speak against it.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .textops import pieces

# The kinds in their order, base kinds first.
KINDS = ("email", "ip", "card", "phone", "iban", "shortcard", "nationalid")
BASE = 4

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of these four begins where a run of digits does; possessive runs leave nothing to go back to.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
DIGIT = re.compile(r"[0-9]")

# Words that raise the score of a kind when they stand close before or after the span.
CONTEXT = {
    "email": ("email", "e-mail", "mail", "contact", "write", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "addr"),
    "card": ("card", "visa", "mastercard", "credit", "debit", "tarjeta", "carte", "karte"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "shortcard": ("card", "visa", "amex", "diners", "credit", "debit", "tarjeta", "carte", "karte"),
    "nationalid": ("ssn", "social", "security", "taxpayer", "national"),
}
# Words that speak of numbers which are nobody's.
AGAINST = frozenset(("order", "invoice", "isbn", "version", "serial", "tracking", "part", "model", "example", "sample", "test", "dummy"))
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.65, "shortcard": 0.35, "nationalid": 0.35}
LIFT, DROP, REACH, LEAST = 0.25, 0.3, 40, 0.5


def luhn(digits: str) -> bool:
    """Whether the Luhn sum of a digit string is a multiple of ten."""
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return (odd + even) % 10 == 0


def mod97(text: str) -> bool:
    """Whether an account number has remainder 1 as ISO 13616 reads it."""
    turned = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            done = m.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _base(text: str):
    if "@" in text:
        yield from ((0, s, e) for s, e in _emails(text))
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            yield 1, m.start(), m.end()
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield 2, m.start(), m.end()
                continue
        if 13 <= m.end() - m.start() <= 29:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 15 and luhn(digits):
                yield 5, m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(DIGIT.findall(m[0])) <= 15:
                yield 3, m.start(), m.end()
    for m in IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield 4, m.start(), m.end()
    if "-" in text:
        yield from ((6, m.start(), m.end()) for m in NATIONAL.finditer(text))


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, raised by a context word within REACH characters of the span and lowered by one that speaks
    against it; from 0 to 1."""
    near = text[max(0, start - REACH) : start].lower() + " " + text[end : end + REACH].lower()
    words = {w.strip("-") for w in re.findall(r"[^\W\d_][\w-]*", near)}
    x = PRIOR[kind] + LIFT * (not words.isdisjoint(CONTEXT[kind])) - DROP * (not words.isdisjoint(AGAINST))
    return round(min(1.0, max(0.0, x)), 4)


def find(text: str | None) -> list[tuple[int, int, int, float]]:
    """(kind, start, end, score) by kind, then start; offsets in code points, end exclusive; null has none.

    Base kinds always stay. An added kind stays if its score reaches LEAST and it overlaps no base span.
    """
    if not text:
        return []
    found = list(_base(text))
    out = [(k, s, e, score(text, KINDS[k], s, e)) for k, s, e in found if k < BASE]
    edges: list[tuple[int, int]] = []  # the stretches that base spans cover, in order
    for s, e in sorted((s, e) for k, s, e in found if k < BASE):
        if edges and s < edges[-1][1]:
            edges[-1] = (edges[-1][0], max(e, edges[-1][1]))
        else:
            edges.append((s, e))
    for k, s, e in found:
        if k >= BASE:
            at = bisect_left(edges, (e,)) - 1  # the last stretch that begins before this span ends
            x = score(text, KINDS[k], s, e)
            if x >= LEAST and not (at >= 0 and edges[at][1] > s):
                out.append((k, s, e, x))
    out.sort()
    return out


def redact(text: str | None, spans: list | None = None) -> str | None:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans, the union by the first kind."""
    found = sorted((s, e, k) for k, s, e, _ in (find(text) if spans is None else spans))
    if not found:
        return text
    out, at = [], 0
    i = 0
    while i < len(found):
        s, e, k = found[i]
        while i + 1 < len(found) and found[i + 1][0] < e:
            i += 1
            e = max(e, found[i][1])
        out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at, i = e, i + 1
    return "".join(out) + text[at:]


_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def find_pii(docs: DataFrame, text: str = "text", redacted: bool = False) -> DataFrame:
    """``docs`` with ``pii_spans`` (array of kind, start, end, score) and, if asked, the text redacted in place.

    Rows are independent: nothing is shuffled or grouped, a null or empty text has no span, repeated rows are treated
    alike, and other columns stay as they are.
    """
    schema = T.StructType([f for f in docs.schema.fields if f.name != "pii_spans"] + [T.StructField("pii_spans", _SPAN)])
    names = [f.name for f in schema.fields[:-1]]

    def work(batches):
        for whole in batches:
            for batch in pieces(whole, text):
                texts = batch.column(text).to_pylist()
                spans = [find(t) for t in texts]
                cols = [batch.column(n) for n in names]
                if redacted:
                    cols[names.index(text)] = pa.array([redact(t, s) if s else t for t, s in zip(texts, spans)], batch.column(text).type)
                cols.append(pa.array([[{"kind": KINDS[k], "start": s, "end": e, "score": x} for k, s, e, x in r] for r in spans], _ARROW))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, "pii_spans"])

    return docs.mapInArrow(work, schema)


def op6_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``: counts and digest of the base kinds, all spans, their scores."""
    from .common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores string"

    def digest(batches):
        for batch in batches:
            rows = []
            for found in batch.column("pii_spans").to_pylist():
                named = [f"{x['kind']}:{x['start']}:{x['end']}" for x in found]
                base = [n for n, x in zip(named, found) if x["kind"] in KINDS[:BASE]]
                rows.append([sum(x["kind"] == k for x in found) for k in KINDS[:BASE]] + [hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(named), ",".join(f"{x['score']:.2f}" for x in found)])
            cols = list(zip(*rows)) or [[]] * 7
            arrays = [pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=[x.split()[0] for x in schema.split(", ")])

    return find_pii(docs).select("doc_id", "pii_spans").mapInArrow(digest, schema)


def redact_pii(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document stays, with its personal data replaced and n_chars counted anew.

    Null and empty texts stay as they are, repeated rows are treated alike, an empty table stays empty, and columns of
    any name keep their values.
    """
    from pyspark.sql import functions as F

    names = docs.columns
    clean = find_pii(docs.select("text", *(F.col(c).alias(f"c{i}") for i, c in enumerate(names))), redacted=True)
    out = clean.select(*(F.col("text" if c == "text" else f"c{i}").alias(c) for i, c in enumerate(names)))
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in names else out

"""Span finders (secrets, personal data) on random, odd and very long texts, against plain loops."""

import math
import random
import re
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import brute

from sensorloom.llm import pii, secrets

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def entropy(text, window):
    return max([0.0, *(-sum(c / window * math.log2(c / window) for c in Counter(text[i : i + window]).values()) for i in range(len(text) - window + 1))])


def entropy_spans(text, window=20):
    """Candidates that are random for a class of theirs, on no allow-list, and apart from all base spans."""
    base = [(s, e) for p, least in ((brute.ASSIGN, 6), (re.compile("AKIA[A-Z0-9]+"), 20), (re.compile("[0-9a-f]+"), 24)) for m in p.finditer(text) if len(m[m.lastindex or 0]) >= least for s, e in [m.span()]]
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        hit = m[0]
        kinds = [(a, b) for must, a, b in secrets.CLASSES.values() if re.search(must, hit)]
        random_ = any(entropy(hit.lower() if len(a) == 16 else hit, window) >= b - 1e-12 for a, b in kinds)
        if random_ and not any(re.search(p, hit) for p in secrets.ALLOW) and not any(s < m.end() and m.start() < e for s, e in base):
            out.append((m.start(), m.end()))
    return out


def test_entropy_spans_against_loops(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice(rng.choice([LETTERS, "0123456789abcdef", "abc", LETTERS + "+/_=-"])) for _ in range(rng.randint(1, 60)))
    joints = [" ", "\n", ",", " password=", " token: ", " AKIA", "é", "secret='"]
    texts = ["".join(rng.choice(joints) + word() for _ in range(rng.randint(0, 30))) for _ in range(300)] + ["", None]
    got = secrets.scan_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    found = 0
    for r in got:
        want = entropy_spans(texts[r["doc_id"]] or "")
        assert [(x["start"], x["end"]) for x in r["secret_spans"] if x["kind"] == 3] == want
        found += len(want)
    assert found > 300


def test_secrets_in_very_long_texts(spark):
    rng = random.Random(5)
    long_ = "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWyzabcdefghijklmnopqrstuvw0987654321") for _ in range(600_000))
    many = " ".join(("password=" if i % 3 == 0 else "") + "".join(rng.choice(LETTERS) for _ in range(30)) for i in range(6000))
    began = time.time()
    got = {r["doc_id"]: r["secret_spans"] for r in secrets.scan_secrets(spark.createDataFrame([(1, long_), (2, many), (3, "x" * 100_000)], "doc_id long, text string")).collect()}
    assert time.time() - began < 60  # a step costs the same wherever it is
    assert [x["end"] - x["start"] for x in got[1]] in ([600_000], []) and not got[3]
    assert sum(x["kind"] == 0 for x in got[2]) == 2000 and sum(x["kind"] == 3 for x in got[2]) == len(entropy_spans(many))


def test_context_decides_added_kinds():
    kinds = lambda t: [(pii.KINDS[k], t[s:e]) for k, s, e, _ in pii.find(t)]
    assert kinds("her SSN is 123-45-6789.") == [("nationalid", "123-45-6789")] and kinds("see 123-45-6789.") == []
    assert kinds("amex 378282246310005") == [("shortcard", "378282246310005")] and kinds("378282246310005") == []
    assert kinds("amex order 378282246310005") == [] and kinds("amex 378282246310006") == []
    assert kinds("GB82WEST12345698765432") == [("iban", "GB82WEST12345698765432")] and kinds("serial GB82WEST12345698765432") == []
    assert kinds("part 4111 1111 1111 1111") == [("card", "4111 1111 1111 1111")]  # base kinds stay
    assert pii.score("call me: x", "phone", 9, 10) > pii.score("x", "phone", 0, 1) > pii.score("order x", "phone", 6, 7)


def test_added_spans_against_loops():
    """National ids by a plain rule: the whole token, its ranges, a context word within reach, no base span over it."""
    rng = random.Random(2)
    for _ in range(2000):
        n = f"{rng.choice([0, 1, 123, 666, 900])}".zfill(3) + "-" + f"{rng.choice([0, 45])}".zfill(2) + "-" + f"{rng.choice([0, 6789])}".zfill(4)
        before = rng.choice(["", "ssn ", "SSN: ", "order ssn ", "social security number ", "x" * 50 + " ", "ssn " + "y" * 50 + " ", "8", "mail@"])
        text = before + n + rng.choice(["", ".", " ssn", "7", "-1", ".de"])
        at = len(before)
        free = not (text[at - 1 : at].isdigit() or text[at + 11 : at + 12].isdigit() or text[at + 11 : at + 12] == "-" or "@" in before and ".de" in text)
        good = n[:3] not in ("000", "666") and n[0] != "9" and n[4:6] != "00" and n[7:] != "0000"
        near = re.findall(r"[a-z-]+", (text[max(0, at - 40) : at] + " " + text[at + 11 : at + 51]).lower())
        want = free and good and bool({"ssn", "social", "security"} & set(near)) and "order" not in near
        assert any(k == 6 for k, *_ in pii.find(text)) == want, text


def test_pii_in_very_long_texts(spark):
    began = time.time()
    for t, n in (("1" * 1_000_000, 0), (("1" * 1000 + ".") * 1000, 0), ("a" * 1_000_000 + "@", 0), ("+1" + "(" * 500_000, 0), ("a.b@c.d " * 50_000, 50_000), ("GB82WEST12345698765432 a@b.c " * 5000, 10_000)):
        assert len(pii.find(t)) == n
    assert time.time() - began < 30
    texts = ["mail a@b.c", None, "", "mail a@b.c", "z" * 3_000_000 + " a@b.c"]
    docs = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "doc_id long, text string, pii_spans string").coalesce(1)
    got = {r["doc_id"]: r for r in pii.find_pii(docs, redacted=True).collect()}
    assert [len(got[i]["pii_spans"]) for i in range(5)] == [1, 0, 0, 1, 1] and got[4]["text"].endswith("z [EMAIL]") and got[1]["text"] is None


def test_redact_stage(spark):
    """The pipeline's stage: nulls, empty and repeated rows, clashing names, an empty table."""
    schema = "doc_id long, text string, n_chars long, c0 string, pii_spans int"
    rows = [(1, "to a@b.c", 8, "k", 1), (1, "to a@b.c", 8, "k", 1), (2, None, None, None, None), (3, "", 0, "", 0), (None, "plain", 5, "q", 2)]
    docs = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, pii.redact_pii(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, "to [EMAIL]", 10, "k", 1)] * 2 + [(2, None, None, None, None), (3, "", 0, "", 0), (None, "plain", 5, "q", 2)], key=str)
    assert pii.redact_pii(spark, docs.limit(0), "").columns == docs.columns and pii.redact_pii(spark, docs.limit(0), "").count() == 0

"""Secret scans: patterns for assignments and keys, and sliding-window entropy over candidate strings.

Everything here is a DataFrame expression; no Python runs on the executors. Positions come from cutting a text at a
pattern: the pieces between matches and the matches themselves alternate, so their lengths give every offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base patterns and the least lengths of what they must hold.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # the runs of [0-9a-f]+ that have 24 or more
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings of the entropy scan.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Character class -> (what a candidate must match, its alphabet, least entropy in bits of some window).
CLASSES = {
    "hex": (r"^[0-9a-fA-F]+$", "0123456789abcdef", 3.0),
    "alnum": (r"^(?=.*[0-9])(?=.*[A-Za-z])[A-Za-z0-9]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", 3.8),
    "base64": (r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_=-]+$", "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-", 3.9),
}
#: Candidates that are known not to be secrets: UUID-like strings, digits only, examples, one character repeated.
ALLOW = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^[0-9_=+/-]+$", r"(?i)example|sample|placeholder|dummy|xxxx", r"^(.)\1+$", r"(?i)abcdefgh|01234567")
WINDOW = 20
#: Matches of a text that are walked together.
GROUP = 256


SPAN = "struct<start:int,kind:int,end:int,hit:string>"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out once, however often and however deep in lambdas it stands there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def walk(items: Column, state: Column, step, made: str) -> Column:
    """The array of what ``step(state, item) -> (state, made)`` makes of the items of an array, in their order.

    Growing an array costs its length, so items are walked in groups and the groups' results put together at the end.
    """
    none = F.array().cast(f"array<{made}>")

    def one(acc, item):
        after, out = step(acc["state"], item)
        return F.struct(after.alias("state"), F.concat(acc["out"], F.array(out)).alias("out"))

    def groups(every):
        def group(acc, k):
            found = F.aggregate(F.slice(every, k * GROUP + 1, GROUP), F.struct(acc["state"].alias("state"), none.alias("out")), one)
            return let(found, lambda g: F.struct(g["state"].alias("state"), F.concat(acc["out"], F.array(g["out"])).alias("out")))

        count = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / GROUP).cast("int"))
        start = F.struct(state.alias("state"), F.array().cast(f"array<array<{made}>>").alias("out"))
        return F.when(F.size(every) > 0, F.flatten(F.aggregate(count, start, group)["out"])).otherwise(none)

    return let(items, groups)


def spans(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,kind,end,hit>>, offsets in code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = let(hits, lambda h: F.arrays_zip(h.alias("hit"), F.slice(F.split(text, pattern, -1), 1, F.size(h)).alias("gap")))

    def step(at, pair):
        start = at + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        return end, F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), pair["hit"].alias("hit"))

    return F.when(text.rlike(pattern), walk(pairs, F.lit(0), step, SPAN)).otherwise(F.array().cast(f"array<{SPAN}>"))


def window_entropy(text: Column, alphabet: str, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any ``window`` characters of ``text`` in a row.

    One pass over the characters' numbers in the alphabet, which are looked up once. The counts of a window stand in a
    short text, a letter each ('A' is 0): the count of the character that enters is raised, that of the one that leaves
    lowered, and the sum of c*log2(c) follows these two. A step costs the same wherever it is in the text.
    """
    zero = ord("A")

    def part(c: Column) -> Column:
        return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))

    def count(n: Column, place: Column) -> Column:
        return F.ascii(F.substr(n, place, F.lit(1))) - zero

    def put(n: Column, place: Column, c: Column) -> Column:
        return F.overlay(n, F.char(c + zero), place, F.lit(1))

    # 1 stands for a character that is not in the alphabet, so that every character has a count
    places = F.transform(F.slice(F.split(text, "", -1), 1, F.char_length(text)), lambda c: F.call_function("locate", c, F.lit(alphabet)).cast("int") + 1)
    start = F.struct(F.lit("A" * (len(alphabet) + 1)).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best"))

    def steps(all_):
        def left(acc, i):
            """The counts and their sum without the character that leaves."""
            gone = F.get(all_, i - window)
            return F.when(i < window, F.struct(acc["n"].alias("n"), acc["s"].alias("s"))).otherwise(let(count(acc["n"], gone), lambda c: F.struct(put(acc["n"], gone, c - 1).alias("n"), (acc["s"] + part(c - 1) - part(c)).alias("s"))))

        def step(acc, i):
            came = F.get(all_, i)
            both = let(left(acc, i), lambda x: let(count(x["n"], came), lambda c: F.struct(put(x["n"], came, c + 1).alias("n"), (x["s"] + part(c + 1) - part(c)).alias("s"))))
            bits = lambda x: F.when(i >= window - 1, F.log2(F.lit(float(window))) - x["s"] / window).otherwise(F.lit(0.0))
            return let(both, lambda x: F.struct(x["n"].alias("n"), x["s"].alias("s"), F.greatest(acc["best"], bits(x)).alias("best")))

        return F.when(F.size(all_) > 0, F.aggregate(F.sequence(F.lit(0), F.size(all_) - 1), start, step, lambda acc: acc["best"])).otherwise(F.lit(0.0))

    return let(places, steps)


def entropy_spans(text: Column, window: int = WINDOW, allow=ALLOW) -> Column:
    """Candidate strings that look random for their character class and are on no allow-list."""
    def keep(x):
        hit = x["hit"]
        known = F.lit(False)
        for pattern in allow:
            known = known | hit.rlike(pattern)
        random = F.lit(False)
        for must, alphabet, bits in CLASSES.values():
            lower = F.lower(hit) if len(alphabet) == 16 else hit
            random = random | (hit.rlike(must) & (window_entropy(lower, alphabet, window) >= bits))
        return ~known & random

    return F.filter(spans(text, CANDIDATE, 3), keep)


def apart(base: Column, more: Column) -> Column:
    """The spans of ``more`` that overlap none of ``base``: one walk forwards over the starts of both, and one back.

    Forwards a span is met by the farthest end of the base spans that start before it or with it, backwards by the
    nearest start of those that start after it.
    """
    marked = "struct<start:int,kind:int,end:int,hit:string,free:boolean>"

    def judged(x, free):
        return F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"), x["hit"].alias("hit"), free.alias("free"))

    def forwards(far, x):
        return F.when(x["kind"] < 3, F.greatest(far, x["end"])).otherwise(far), judged(x, (x["kind"] == 3) & (far <= x["start"]))

    def backwards(near, x):
        return F.when(x["kind"] < 3, x["start"]).otherwise(near), judged(x, x["free"] & (x["end"] <= near))

    met = walk(F.array_sort(F.concat(base, more)), F.lit(0), forwards, marked)
    met = walk(F.reverse(met), F.lit(2**31 - 1), backwards, marked)
    return F.transform(F.filter(met, lambda x: x["free"]), lambda x: F.struct(x["start"], x["kind"], x["end"], x["hit"]))


def scan_secrets(docs: DataFrame, text: str = "text", window: int = WINDOW, allow=ALLOW) -> DataFrame:
    """``docs`` with ``secret_spans``: array<struct<start,kind,end,hit>> by start, then kind.

    A null or empty text has an empty array; a row is never dropped, repeated rows are scanned alike, and columns that
    the caller has beside ``text`` stay (one called secret_spans is replaced). Kinds 0 to 2 are the base patterns;
    kind 3 adds high-entropy candidates that overlap no base span.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(spans(t, ASSIGN, 0), lambda x: F.char_length(F.regexp_extract(x["hit"], ASSIGN, 2)) >= 6)
    access = F.filter(spans(t, ACCESS, 1), lambda x: F.char_length(x["hit"]) >= 20)
    base = docs.withColumn("secret_spans", F.concat(assign, access, spans(t, HEX, 2)))
    both = base.withColumn("_more", entropy_spans(t, window, allow))
    more = F.when(F.size("_more") == 0, F.col("_more")).when(F.size("secret_spans") == 0, F.col("_more")).otherwise(apart(F.col("secret_spans"), F.col("_more")))
    return both.withColumn("secret_spans", F.array_sort(F.concat("secret_spans", more))).drop("_more")


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.get(name, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op8_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``; base digests and all spans."""
    from .common import table

    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    base = F.filter("secret_spans", lambda x: x["kind"] < 3)
    count = lambda k: F.size(F.filter("secret_spans", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("secret_spans")).alias("spans"))

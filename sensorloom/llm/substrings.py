"""Exact repeated passages: per-shard suffix arrays, common prefixes and merging by binary search.

A byte is removed if a 50-byte string covers it that also starts in a document with a smaller id. A suffix array of all
text at once would need all text at once, so texts are first cut into the runs of 50-byte windows that share one
anchor (the least hash among the window's 24-byte strings). Equal windows have equal anchors; so a run whose anchor
stands in one document only holds no match, and runs that may match meet in the shard of their anchor. This loses
nothing. Each shard builds suffix arrays of bounded size by Larsson-Sadakane refinement, finds common prefixes by
Kasai's method, and merges the arrays by binary search of their 50-byte strings.

Documents travel in pieces of about a megabyte, packed in a table that is bucketed by piece; every later step joins
small rows to that table without moving the text again. Equal runs are settled by their digests alone: all but those of
the least document go. Only runs that differ from another run of their anchor, yet may overlap it, are sent, once each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, table
from .packs import pack, unpacked
from .textops import K1, K2, mix

SPAN, GRAM = 50, 24
PIECE = 1_000_000
#: Anchors that one task compares, text bytes for which there is a part of runs or a shard, bytes in one suffix array.
ANCHORS_A_TASK, TEXT_A_PART, TEXT_A_SHARD, ARRAY = 3_000_000, 32_000_000, 16_000_000, 2_000_000
_BYTE = mix(np.arange(256, dtype=np.uint64) * K1 + K2)


def grams(data: np.ndarray) -> np.ndarray:
    """Hashes of all 24-byte strings, by doubling."""
    h, width, saved = _BYTE[data], 1, None
    power = np.array([0x9E3779B97F4A7C15], np.uint64)  # odd; as an array, so that it may wrap
    while width < 16:
        h = h[:-width] * power + h[width:]
        width, power = 2 * width, power * power
        if width == 8:
            saved, saved_power = h, power
    return mix(h[: len(data) - GRAM + 1] * saved_power + saved[16 : 16 + len(data) - GRAM + 1])


def anchors(data: np.ndarray, off: np.ndarray):
    """Runs of windows with one anchor: (text number, first window, last window, 32-bit anchor, left and right hash).

    Positions are those in ``data``; windows that would cross from one text into the next do not exist. A window holds
    13 bytes or more before its anchor or after it, so equal windows also share the left hash, of the anchor with the
    13 bytes before it, or the right one; where the text has no such bytes the hash is 0.
    """
    none = np.zeros(0, np.int64)
    if len(data) < SPAN:
        return none, none, none, *(np.zeros(0, np.uint32),) * 3
    h = grams(data)
    pos = np.arange(len(h), dtype=np.uint64)
    bits = np.uint64(max(1, int(len(h)).bit_length()))
    m = (h >> bits << bits) | pos
    for w in (1, 2, 4, 8):
        m = np.minimum(m[:-w], m[w:])
    m = np.minimum(m[:-11], m[11:])  # least of 27 strings: the anchor of each window
    at = (m & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    size = np.diff(off)
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, off[:-1][size >= SPAN], 1)
    np.add.at(inside, (off[1:] - SPAN + 1)[size >= SPAN], -1)
    ok = np.cumsum(inside, dtype=np.int8)[: len(at)] > 0
    begin = ok.copy()
    begin[1:] &= ~ok[:-1] | (at[1:] != at[:-1])
    begin[off[:-1][(size >= SPAN)]] = True
    first = np.flatnonzero(begin)
    stop = ok.copy()
    stop[:-1] &= ~ok[1:] | begin[1:]
    last = np.flatnonzero(stop)
    text = np.searchsorted(off, first, "right") - 1
    pos = at[first]
    half = (SPAN - GRAM) // 2
    before, after = pos - half >= off[text], pos + GRAM + half <= off[text + 1]
    short = lambda x: (x >> np.uint64(32)).astype(np.uint32)
    left = np.where(before, short(mix(h[np.maximum(pos - half, 0)] * K1 + h[pos])) | np.uint32(1), np.uint32(0))
    right = np.where(after, short(mix(h[pos] * K2 + h[np.minimum(pos + half, len(h) - 1)])) | np.uint32(1), np.uint32(0))
    return text, first, last, short(h[pos]), left, right


NEAR = 32


def suffix_array(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of their suffixes, each ending with its own text; equal suffixes by position.

    Also which of them share NEAR bytes or more with the one before, which the refinement knows on its way.

    Larsson-Sadakane: sort by eight bytes, then refine only the groups that are still tied by the rank of the suffix
    8, 16, 32... bytes on.
    """
    n = len(data)
    end = np.repeat(off[1:], np.diff(off))
    pad = np.zeros(n + 8, np.uint8)
    pad[:n] = data
    key = np.ndarray((n,), np.dtype(">u8"), pad, 0, (1,)).astype(np.uint64)
    left = end - np.arange(n)
    short = left < 8
    key[short] &= ~((np.uint64(1) << (np.uint64(8) * (8 - left[short]).astype(np.uint64))) - np.uint64(1))
    sa = np.argsort(key, kind="stable")
    ranked = key[sa]
    # bytes beyond the end count as less than any byte: texts that end within the eight bytes come by length first
    new = np.r_[True, ranked[1:] != ranked[:-1]]
    size = np.minimum(left, 8)
    if short.any():
        group = np.cumsum(new)
        again = np.lexsort((sa, size[sa], group))
        sa, group = sa[again], group[again]
        new = np.r_[True, (group[1:] != group[:-1]) | (size[sa][1:] != size[sa][:-1])]
    h = 8
    longest = int(np.diff(off).max(initial=0))
    rank = np.empty(n, np.int64)
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[sa] = head
    near = ~new
    while h < longest:
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
        if not len(tied):
            break
        who = sa[tied]
        beyond = who + h >= end[who]
        nxt = np.where(beyond, -1, rank[np.minimum(who + h, n - 1)])
        order = np.argsort((rank[who] << 32) + nxt + 1, kind="stable")
        who, nxt = who[order], nxt[order]
        sa[tied] = who
        own = rank[who]
        fresh = np.r_[True, (own[1:] != own[:-1]) | (nxt[1:] != nxt[:-1])]
        new[tied] |= fresh
        head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        rank[sa[tied]] = head[tied]
        h *= 2
        if h == NEAR:
            near = ~new
    return sa, near


def common_prefixes(data: np.ndarray, off: np.ndarray, sa: np.ndarray, near: np.ndarray, most: int = SPAN) -> np.ndarray:
    """By position, the bytes that a suffix shares with the one before it in ``sa``, up to ``most``; 0 where not near.

    Kasai: in text order the shared length falls by one at most from a position to the next, so each comparison goes
    on where the last one ended. All texts are walked side by side, one position of each at a time.
    """
    n = len(sa)
    before = np.full(n, -1, np.int64)
    at = np.flatnonzero(near[1:]) + 1
    before[sa[at]] = sa[at - 1]
    size = np.diff(off)
    end = np.repeat(off[1:], size)
    out = np.zeros(n, np.int64)
    owner = np.repeat(np.arange(len(size)), size)
    p = np.flatnonzero(before >= 0)
    step = p - off[owner[p]]
    order = np.argsort(step, kind="stable")
    p, step = p[order], step[order]
    cut = np.flatnonzero(np.r_[True, step[1:] != step[:-1], True]) if len(p) else np.zeros(1, int)
    for s, e in zip(cut[:-1], cut[1:]):
        here, prior = p[s:e], before[p[s:e]]
        limit = np.minimum(np.minimum(end[here] - here, end[prior] - prior), most)
        # the length at the position before; where that position was not near it is short of NEAR anyway
        g = np.where(step[s] > 0, out[np.maximum(here - 1, 0)] - 1, 0)
        g = np.minimum(np.maximum(g, np.minimum(NEAR, limit)), limit)
        going = np.flatnonzero(g < limit)
        while len(going):
            same = data[here[going] + g[going]] == data[prior[going] + g[going]]
            going = going[same]
            g[going] += 1
            going = going[g[going] < limit[going]]
        out[here] = g
    return out


class Shard:
    """Distinct runs of at most ARRAY bytes: their 50-byte strings in order, each with its least document."""

    def __init__(self, runs: list[bytes], docs: np.ndarray):
        self.data = np.frombuffer(b"".join(runs), np.uint8)
        size = np.array([len(r) for r in runs], np.int64)
        self.off = np.r_[0, np.cumsum(size)]
        sa, near = suffix_array(self.data, self.off)
        shared = common_prefixes(self.data, self.off, sa, near)[sa]
        end = np.repeat(self.off[1:], size)
        owner = np.repeat(docs, size)
        whole = end[sa] - sa >= SPAN
        # between two whole windows the shared length is the least of those in between
        group = np.cumsum(shared < SPAN)[whole]
        sa = sa[whole]
        new = np.r_[True, group[1:] != group[:-1]] if len(sa) else np.zeros(0, bool)
        self.start, self.of = sa, np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.least = np.minimum.reduceat(owner[sa], first) if len(first) else np.zeros(0, np.int64)
        view = np.lib.stride_tricks.sliding_window_view(self.data, SPAN) if len(self.data) >= SPAN else np.zeros((0, SPAN), np.uint8)
        self.head = np.ascontiguousarray(view[sa[first]]).view(f"S{SPAN}").ravel()

    def merge(self, other: Shard) -> None:
        """Find this shard's strings in the other by binary search; both learn the lesser document."""
        if not len(self.head) or not len(other.head):
            return
        at = np.minimum(np.searchsorted(other.head, self.head), len(other.head) - 1)
        same = np.flatnonzero(other.head[at] == self.head)
        low = np.minimum(self.least[same], other.least[at[same]])
        self.least[same] = low
        other.least[at[same]] = low

    def window_least(self) -> np.ndarray:
        """For each position the least document of the window that starts there (undefined where none does)."""
        out = np.zeros(len(self.data), np.int64)
        out[self.start] = self.least[self.of]
        return out


def _digests(batches):
    """One thin row per document: piece, place in it, id, size, 128 bits of its text's hash."""
    for get, ids, known, off, data in unpacked(batches):
        raw = data.tobytes()
        dig = np.frombuffer(b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(off[:-1].tolist(), off[1:].tolist())), np.int64).reshape(-1, 2)
        n = len(ids)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, get("piece"))), pa.array(np.arange(n, dtype=np.int32)), pa.array(ids, mask=~known), pa.array(np.diff(off)), pa.array(dig[:, 0]), pa.array(dig[:, 1])], names=["piece", "place", "doc_id", "size", "d1", "d2"])


def _runs(get, ids, known, off, data):
    """The runs of the documents that take part: not copies of one with a smaller id, and not without an id."""
    live = known.copy()
    live[np.array(get("copies") or [], np.int64)] = False
    runs = anchors(data, off)
    keep = live[runs[0]] if len(runs[0]) else np.zeros(0, bool)
    return tuple(x[keep] for x in runs)


def _by_part(piece, hashes, docs, parts):
    """A piece's distinct hashes by part, those of several documents twice, as (part, piece, anchors) rows."""
    order = np.lexsort((docs, hashes))
    a, d = hashes[order], docs[order]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.zeros(0, int)
    many = d[np.r_[first[1:], len(a)] - 1] != d[first] if len(first) else np.zeros(0, bool)
    a = np.repeat(a[first], 1 + many)
    part = (a // np.uint32(2) % np.uint32(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    a, part = a[order], part[order]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(a) else np.zeros(1, int)
    return part[cut[:-1]], np.full(len(cut) - 1, piece), [a[s:e].tobytes() for s, e in zip(cut[:-1], cut[1:])]


def _announce(batches, parts):
    """Each piece's distinct anchors by part; those of several documents stand twice."""
    for got in unpacked(batches):
        text, _, _, anchor, *_ = _runs(*got)
        part, piece, found = _by_part(got[0]("piece"), anchor, got[1][text], parts)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(piece), pa.array(found, pa.binary())], names=["part", "piece", "anchors"])


def _shared(pdf):
    """Of one part's anchors, those of each piece that stand in two documents or more."""
    import pandas as pd

    each = [np.frombuffer(b, np.uint32) for b in pdf.anchors]
    every = np.sort(np.concatenate(each))
    twice = np.unique(every[1:][every[1:] == every[:-1]])
    out = []
    for a in each:
        a = np.unique(a)
        at = np.minimum(np.searchsorted(twice, a), max(len(twice) - 1, 0))
        out.append(a[twice[at] == a].tobytes() if len(twice) else b"")
    out = pd.DataFrame({"piece": pdf.piece, "shared": out})
    return out[out.shared.str.len() > 0]


def _in(x, blobs) -> np.ndarray:
    """Where x is one of the values in some blobs."""
    wanted = np.unique(np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(b, np.uint32) for b in blobs or [])]))
    if not len(wanted):
        return np.zeros(len(x), bool)
    return wanted[np.minimum(np.searchsorted(wanted, x), len(wanted) - 1)] == x


ENTRY = np.dtype([("anchor", "<u4"), ("left", "<u4"), ("right", "<u4"), ("digest", "<u8"), ("more", "<u8"), ("doc", "<i8")])


def _entries(got, parts):
    """A piece's runs with a shared anchor; their distinct contents as entries, each with its least document, in the
    order of parts; the entry of each run; and where the parts begin."""
    ids, data = got[1], got[4]
    text, first, last, anchor, left, right = _runs(*got)
    keep = _in(anchor, got[0]("shared"))
    text, first, last, anchor, left, right = (x[keep] for x in (text, first, last, anchor, left, right))
    raw = data.tobytes()
    digest, more = np.frombuffer(b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), (last + SPAN).tolist())), np.uint64).reshape(-1, 2).T
    part = (anchor // np.uint32(2) % np.uint32(parts)).astype(np.int32)
    order = np.lexsort((ids[text], more, digest, anchor, part))
    a, d, d2 = anchor[order], digest[order], more[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (d[1:] != d[:-1]) | (d2[1:] != d2[:-1])] if len(a) else np.zeros(0, bool)
    head = order[new]
    entry = np.empty(len(head), ENTRY)
    entry["anchor"], entry["left"], entry["right"], entry["digest"], entry["more"], entry["doc"] = anchor[head], left[head], right[head], digest[head], more[head], ids[text[head]]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    part = part[head]
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, int)
    return (text, first, last, anchor), entry, of, part[cut[:-1]], cut


def _tell(batches, parts):
    """Each piece's entries by part."""
    for got in unpacked(batches):
        _, entry, _, part, cut = _entries(got, parts)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(np.full(len(part), got[0]("piece"))), pa.array([entry[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())], names=["part", "piece", "entries"])


SETTLED, SENT = 1, 2


def _judge(pdf):
    """One part: whether each entry is settled, as a lesser document has the same run, or must be sent.

    A run is sent once, for its least document, if another run of its anchor shares its left or right hash; if none
    does, no window of it stands anywhere but in equal runs.
    """
    import pandas as pd

    every = np.concatenate([np.frombuffer(b, ENTRY) for b in pdf.entries])
    edge = np.r_[0, np.cumsum([len(b) // ENTRY.itemsize for b in pdf.entries])]
    order = np.lexsort((every["doc"], every["more"], every["digest"], every["anchor"]))
    e = every[order]
    new = np.r_[True, (e["anchor"][1:] != e["anchor"][:-1]) | (e["digest"][1:] != e["digest"][:-1]) | (e["more"][1:] != e["more"][:-1])]
    head = np.maximum.accumulate(np.where(new, np.arange(len(e)), 0))
    code = np.where(e["doc"] > e["doc"][head], SETTLED, 0).astype(np.uint8)
    one = np.flatnonzero(new)
    for side in ("left", "right"):
        x = e[side][one]
        o = np.lexsort((x, e["anchor"][one]))
        same = (e["anchor"][one[o]][1:] == e["anchor"][one[o]][:-1]) & (x[o][1:] == x[o][:-1]) & (x[o][1:] > 0)
        code[one[o[np.r_[same, False] | np.r_[False, same]]]] = SENT
    back = np.empty(len(code), np.uint8)
    back[order] = code
    return pd.DataFrame({"piece": pdf.piece, "part": pdf.part, "codes": [back[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]})


def _send(batches, parts, shards):
    """Runs that must be sent, and the spans that are settled here."""
    for got in unpacked(batches):
        get, ids, _, off, data = got
        (text, first, last, anchor), entry, of, part, cut = _entries(got, parts)
        codes = np.zeros(len(entry), np.uint8)
        told = {r["part"]: r["codes"] for r in get("verdicts") or []}
        for p, a, b in zip(part.tolist(), cut[:-1], cut[1:]):
            codes[a:b] = np.frombuffer(told[p], np.uint8)
        settled = (codes[of] == SETTLED) | (ids[text] > entry["doc"][of])
        whole = np.flatnonzero(settled)
        whole_text, whole_start, whole_stop = text[whole], first[whole], last[whole]
        keep = np.flatnonzero(~settled & (codes[of] == SENT))
        text, first, last, anchor = text[keep], first[keep], last[keep], anchor[keep]
        raw, least = data.tobytes(), {}
        order = np.argsort(ids[text], kind="stable")
        sent, done = [], []
        for i, d, s, e in zip(order.tolist(), ids[text[order]].tolist(), first[order].tolist(), (last[order] + SPAN).tolist()):
            run = raw[s:e]
            if least.setdefault(run, d) < d:
                done.append(i)
            else:
                sent.append(i)
        local = first - off[text]
        sent, done = np.array(sorted(sent), np.int64), np.array(done, np.int64)
        shard = anchor[sent] // np.uint32(7) % np.uint32(shards) if len(sent) else np.zeros(0, np.uint32)
        order = np.argsort(shard, kind="stable")
        sent, shard = sent[order], shard[order]
        cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(sent) else np.zeros(1, int)
        rows = []
        for s, e in zip(cut[:-1], cut[1:]):
            w = sent[s:e]
            rows.append((int(shard[s]), text[w].astype(np.int32).tobytes(), ids[text[w]].tobytes(), local[w].astype(np.int64).tobytes(), (last[w] - first[w] + 1).astype(np.int32).tobytes(), b"".join(raw[a : b + SPAN] for a, b in zip(first[w].tolist(), last[w].tolist()))))
        if len(done) or len(whole):
            # settled here: an empty run list with the spans to remove, dealt out like any shard
            t = np.r_[text[done], whole_text].astype(np.int32)
            start, size = np.r_[local[done], whole_start - off[whole_text]], np.r_[last[done] - first[done], whole_stop - whole_start] + 1
            rows.append((int(get("piece") % shards), t.tobytes(), b"", start.astype(np.int64).tobytes(), size.astype(np.int32).tobytes(), b""))
        cols = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array([get("piece")] * len(rows), pa.int64()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["shard", "piece", "text", "ids", "start", "windows", "runs"])


def _settle(pdf):
    """One shard: which windows also start in a lesser document, as spans (text, start, end) of each piece."""
    import pandas as pd

    piece, text, start, count, ids, runs = [], [], [], [], [], []
    out_piece, out = [], []
    for r in pdf.itertuples():
        t, s, w = np.frombuffer(r.text, np.int32), np.frombuffer(r.start, np.int64), np.frombuffer(r.windows, np.int32)
        if not len(r.ids):
            out_piece.append(r.piece)
            out.append(np.c_[t, s, s + w - 1 + SPAN].astype(np.int64).tobytes())
            continue
        at = np.r_[0, np.cumsum(w.astype(np.int64) + SPAN - 1)].tolist()
        runs += [r.runs[a:b] for a, b in zip(at[:-1], at[1:])]
        piece.append(np.full(len(t), r.piece))
        text.append(t)
        start.append(s)
        count.append(w)
        ids.append(np.frombuffer(r.ids, np.int64))
    if runs:
        piece, text, start, count, ids = map(np.concatenate, (piece, text, start, count, ids))
        number, least = {}, []
        which = np.empty(len(runs), np.int64)
        for i, (run, d) in enumerate(zip(runs, ids.tolist())):
            k = number.setdefault(run, len(least))
            if k == len(least):
                least.append(d)
            elif d < least[k]:
                least[k] = d
            which[i] = k
        least = np.array(least, np.int64)
        distinct = list(number)
        size = np.cumsum([len(x) for x in distinct])
        edge = np.unique(np.r_[0, np.searchsorted(size, np.arange(ARRAY, size[-1], ARRAY)), len(distinct)])
        shards = [Shard(distinct[a:b], least[a:b]) for a, b in zip(edge[:-1], edge[1:])]
        for i, a in enumerate(shards):
            for b in shards[i + 1 :]:
                a.merge(b)
        for i in range(len(shards) - 2, -1, -1):  # what a later merge learned goes back
            for b in shards[i + 1 :]:
                shards[i].merge(b)
        low = np.concatenate([s.window_least() for s in shards])
        base = np.r_[0, size][which]
        total = int(count.sum())
        row = np.repeat(np.arange(len(runs)), count)
        step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        gone = low[base[row] + step] < ids[row]
        edge = np.flatnonzero(gone & np.r_[True, ~gone[:-1] | (row[1:] != row[:-1])])
        stop = np.flatnonzero(gone & np.r_[~gone[1:] | (row[1:] != row[:-1]), True])
        who = row[edge]
        spans = np.c_[text[who], start[who] + step[edge], start[who] + step[stop] + SPAN].astype(np.int64)
        order = np.argsort(piece[who], kind="stable")
        spans, owner = spans[order], piece[who][order]
        cut = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1], True]) if len(owner) else np.zeros(1, int)
        out_piece += owner[cut[:-1]].tolist()
        out += [spans[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
    return pd.DataFrame({"piece": np.array(out_piece, np.int64), "spans": out})


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cleaned(batches, texts):
    """Each document without its spans."""
    for get, ids, known, off, data in unpacked(batches):
        raw = data.tobytes()
        spans = [np.frombuffer(b, np.int64).reshape(-1, 3) for b in get("spans") or []]
        spans = np.concatenate(spans) if spans else np.zeros((0, 3), np.int64)
        spans = spans[np.lexsort((spans[:, 2], spans[:, 1], spans[:, 0]))]
        by = np.searchsorted(spans[:, 0], np.arange(len(ids) + 1))
        copies = set(get("copies") or [])
        rows = []
        for i, (a, b) in enumerate(zip(off[:-1].tolist(), off[1:].tolist())):
            merged = [[0, b - a]] if i in copies else []
            for _, s, e in spans[by[i] : by[i + 1]].tolist():
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            kept, at = [], a
            for s, e in merged:
                kept.append(raw[at : a + s])
                at = a + e
            kept = b"".join([*kept, raw[at:b]])
            rows.append((b - a, sum(e - s for s, e in merged), len(merged), hashlib.sha256(kept).hexdigest(), kept if texts else None))
        cols = list(zip(*rows))
        arrays = [pa.array(ids, mask=~known), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
        names = [c.split()[0] for c in RESULT.split(", ")]
        if texts:
            arrays.append(pa.array(cols[4], pa.binary()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def remove_repeats(docs: DataFrame, scratch: Scratch, texts: bool = False) -> DataFrame:
    """(doc_id, text) -> doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, the bytes kept.

    Null and empty texts have no bytes; texts shorter than 50 bytes lose none. Rows that repeat an id are judged alike:
    neither is smaller than the other. A row with a null id is neither judged nor counts for others.
    """
    spark = scratch.spark
    packed, name = pack(docs, PIECE)
    try:
        thin = scratch.write(packed.mapInArrow(_digests, "piece long, place int, doc_id long, size long, d1 long, d2 long"), "digests")
        total = thin.agg(F.sum("size")).first()[0] or 0
        least = thin.where(F.col("size") >= SPAN).groupBy("d1", "d2", "size").agg(F.min("doc_id").alias("least"), F.count("*").alias("c")).where("c > 1")
        least = scratch.write(least, "least")  # from a table, the join deals both sides anew and splits a very frequent text
        copies = thin.join(least, ["d1", "d2", "size"]).where("doc_id > least").groupBy("piece").agg(F.collect_list("place").alias("copies"))
        copies = scratch.write(copies, "copies")
        known = packed.join(copies.hint("shuffle_hash"), "piece", "left")

        # about one byte in fourteen is an anchor
        parts, shards = max(12, total // 14 // ANCHORS_A_TASK + 1), max(12, total // TEXT_A_SHARD + 1)
        told = known.mapInArrow(lambda it: _announce(it, parts), "part int, piece long, anchors binary")
        shared = told.groupBy("part").applyInPandas(_shared, "piece long, shared binary").groupBy("piece").agg(F.collect_list("shared").alias("shared"))
        shared = scratch.write(shared, "shared")
        flagged = known.join(shared.hint("shuffle_hash"), "piece")
        kinds = max(12, total // TEXT_A_PART + 1)
        told = flagged.mapInArrow(lambda it: _tell(it, kinds), "part int, piece long, entries binary")
        verdicts = told.groupBy("part").applyInPandas(_judge, "piece long, part int, codes binary").groupBy("piece").agg(F.collect_list(F.struct("part", "codes")).alias("verdicts"))
        verdicts = scratch.write(verdicts, "verdicts")
        runs = flagged.join(verdicts.hint("shuffle_hash"), "piece", "left").mapInArrow(lambda it: _send(it, kinds, shards), "shard int, piece long, text binary, ids binary, start binary, windows binary, runs binary")
        spans = runs.groupBy("shard").applyInPandas(_settle, "piece long, spans binary").groupBy("piece").agg(F.collect_list("spans").alias("spans"))
        spans = scratch.write(spans, "spans")
        out = known.join(spans.hint("shuffle_hash"), "piece", "left").mapInArrow(lambda it: _cleaned(it, texts), RESULT + ", kept binary" * texts)
        return scratch.finish(out)
    finally:
        spark.sql(f"DROP TABLE {name}")


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings removed from all ``documents``."""
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), Scratch(spark, "repeats"))


#: 50-byte strings as 100 hexadecimal digits, from blocks of 1000 bytes so that no long text is walked from its begin for each.
OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
n AS (SELECT doc_id, h, CAST(len(h) // 2 AS BIGINT) AS n FROM d),
b AS (SELECT doc_id, k, substr(h, 2 * k + 1, 2 * 1049) AS s FROM (SELECT doc_id, h, unnest(range(0, n, 1000)) AS k FROM n)),
w AS MATERIALIZED (SELECT doc_id, k + i AS i, substr(s, 2 * i + 1, 100) AS s FROM (SELECT doc_id, k, s, unnest(range(0, least(1000, len(s) // 2 - 49))) AS i FROM b WHERE len(s) >= 100)),
m AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT w.doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY w.doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM w JOIN m USING (s) WHERE low < w.doc_id),
r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS z FROM r GROUP BY doc_id, k),
c AS (SELECT doc_id, sum(z - a) AS gone, count(*) AS spans FROM runs GROUP BY doc_id),
e AS (SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS s, a AS t FROM runs UNION ALL SELECT doc_id, coalesce(max(z), 0), max(n) FROM n LEFT JOIN runs USING (doc_id) GROUP BY doc_id),
k AS (SELECT e.doc_id, string_agg(substr(h, 2 * s + 1, 2 * (t - s)), '' ORDER BY s) AS h FROM e JOIN n ON n.doc_id = e.doc_id GROUP BY e.doc_id)
SELECT n.doc_id, n AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k.h)) AS kept_sha256
FROM n JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)
"""

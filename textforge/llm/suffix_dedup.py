"""Suffix dedup: bytes that are covered by a string of ``length`` bytes which also starts earlier are removed.

Every string of ``length`` bytes (a window) has an anchor: the place of its least k-gram by hash, the leftmost of equal
ones. Equal windows have their anchors at the same offset, so suffixes are compared at anchors only, about one place in
35, with the bytes to the left and right that the anchor's windows span (its context).

1. Sketch: k-grams at anchors are counted in a merged sketch; a window whose anchor's k-gram occurs once is unique.
2. Equal contexts: of those left, equal contexts (128-bit fingerprint) are one suffix; its first occurrence owns it and all
   others are duplicates as a whole. Anchors' k-grams with several different contexts are noted.
3. Sort: only for these are contexts compared byte by byte. Each task sorts its owned suffixes and sends them front-coded
   (common prefix length and the rest) to the bucket of their k-gram. A bucket combines the sorted runs with a loser tree
   that keeps the common prefix of every contender with the last winner and compares from there on, never what is known.
   The merged order with its common prefixes, and the same for the left sides, say for every offset which windows are
   equal; all but the first of them go.
4. Removal: a last pass covers the windows found by 2 and 3.

A k-gram with more than ``crowd`` different contexts is split: its windows are sent as suffixes of their own, to the
bucket of the window's hash, equal ones of a task as one. So neither a passage in a third of the documents nor a short line
that stands in all kinds of surroundings gathers in one task, and nothing is left out.

Defined cases: a null or empty text has no bytes; texts shorter than ``length`` stay; rows without a doc_id are left out;
rows that repeat a doc_id are each judged by (doc_id, start), equal places both being first; very long texts are taken in
overlapping pieces; empty tables work; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from textforge._ship import by_value
from textforge.llm.common import (INV, MULT, PACKED, Files, Sketch, SortedFiles, arrays_of, bucket_bits, edges_of, id_text, kept_slices, let_go, mix,
                                  pack_arrays, packed_batch, powers, save_array, shared_dir, text_rows, total_bytes, unkept, unpack_arrays,
                                  window_min, with_kept)
from textforge.session import materialize

by_value(__name__)

SECOND = 0xD6E8FEB86659FD93 | 1
PIECE = 500_000  # bytes worked on at once: a worker holds about a hundred times as many in arrays of numbers
BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)  # a number for each byte


class Contexts(NamedTuple):
    """Anchors of a group of pieces: arrays of one length, places in the group's bytes."""

    data: np.ndarray  # the bytes
    sums: list  # prefix sums of both hashes
    doc: np.ndarray  # index of the document in the batch
    shift: np.ndarray  # to get places in the document
    first: np.ndarray  # first window owned
    place: np.ndarray  # the anchor
    end: np.ndarray  # end of the last window owned
    kgram: np.ndarray  # hash of the k-gram

    def hashes(self, at: np.ndarray, first: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        return [(s[end] - s[first]) * powers(i, int(first.max(initial=0)) + 1)[first] for s, i in zip(self.sums, (INV, pow(SECOND, -1, 1 << 64)))]

    def take(self, at: np.ndarray) -> Contexts:
        return self._replace(**{x: getattr(self, x)[at] for x in ("doc", "shift", "first", "place", "end", "kgram")})

    def identity(self) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprint of each context: its bytes, and where the anchor and the end are."""
        shape = (self.place - self.first).astype(np.uint64) * np.uint64(MULT) + (self.end - self.first).astype(np.uint64) * np.uint64(SECOND)
        a, b = self.hashes(None, self.first, self.end)
        return mix(a + shape), mix(b ^ (shape + np.uint64(1)))


def batches_of(batches):
    """Lists of (doc_id, bytes) of about PIECE bytes, or one longer text."""
    let_go()
    held, size = [], 0
    for doc, text in text_rows(batches):
        held.append((doc, text or b""))
        size += len(held[-1][1])
        if size >= PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def numbered(lists):
    """(number of items before, list) of successive lists."""
    at = 0
    for x in lists:
        yield at, x
        at += len(x)


def groups(held, length: int):
    """Groups of pieces (index, offset, bytes) of a batch; pieces of a long text overlap by ``length - 1`` bytes."""
    out, size = [], 0
    for i, (_, text) in enumerate(held):
        for at in range(0, max(1, len(text) - length + 1), PIECE):
            piece = text[at : at + PIECE + length - 1]
            if size + len(piece) > 2 * PIECE and out:
                yield out
                out, size = [], 0
            out.append((i, at, piece))
            size += len(piece)
    if out:
        yield out


def contexts(pieces, length: int, k: int) -> Contexts | None:
    data = np.frombuffer(b"".join(x for _, _, x in pieces), np.uint8)
    n = len(data)
    if n < length:
        return None
    sizes = np.array([len(x) for _, _, x in pieces])
    ends = np.cumsum(sizes)
    v, sums = BYTE[data], []
    for base in (MULT, SECOND):
        s = np.zeros(n + 1, np.uint64)
        np.cumsum(v * powers(base, n), out=s[1:])
        sums.append(s)
    h = mix((sums[0][k:] - sums[0][:-k]) * powers(INV, n - k + 1))
    low = np.uint64(max(1, n.bit_length()))
    least = window_min(((h >> low) << low) | np.arange(len(h), dtype=np.uint64), length - k + 1) & ((np.uint64(1) << low) - np.uint64(1))
    piece = np.searchsorted(ends, np.arange(len(least)), side="right")
    ok = np.flatnonzero(np.arange(len(least)) + length <= ends[piece])
    if not len(ok):
        return None
    p = least[ok].astype(np.int64)
    begins = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (piece[ok[1:]] != piece[ok[:-1]])))
    lasts = np.append(begins[1:], len(p)) - 1
    place, first, own = p[begins], ok[begins], piece[ok[begins]]
    shift = np.array([at for _, at, _ in pieces]) - (ends - sizes)
    # anchors have the least hashes; mixed once more, they spread evenly over buckets and cells again
    return Contexts(data, sums, np.array([i for i, _, _ in pieces])[own], shift[own], first, place, ok[lasts] + length, mix(h[place] ^ np.uint64(MULT)))


# ---------------------------------------------------------------- sorted runs
def common_prefixes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the rows of two byte matrices."""
    same = a == b
    return np.where(same.all(axis=1), a.shape[1], same.argmin(axis=1))


def matrix(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x.ljust(width, b"\0") for x in strings), np.uint8).reshape(len(strings), width)


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of sorted strings: common prefix with the one before, length, and the bytes after the common prefix."""
    size = np.fromiter(map(len, strings), np.int64, len(strings))
    rows = matrix(strings, int(size.max(initial=1)))
    lcp = np.zeros(len(strings), np.int64)
    if len(strings) > 1:
        lcp[1:] = np.minimum(common_prefixes(rows[1:], rows[:-1]), np.minimum(size[1:], size[:-1]))
    return lcp, size, b"".join(x[n:] for x, n in zip(strings, lcp.tolist()))


def front_decode(lcp, size, rest: bytes):
    """(string, its common prefix with the one before) of a run, one by one."""
    at, last = 0, b""
    for n, m in zip(lcp.tolist(), size.tolist()):
        last = last[:n] + rest[at : at + m - n]
        at += m - n
        yield last, n


def compare(a: bytes, b: bytes, known: int) -> tuple[bool, int]:
    """(a <= b, their common prefix), reading from the ``known`` common prefix on."""
    if a[known:] == b[known:]:
        return True, len(a)
    n, most = known, min(len(a), len(b))
    step = 16
    while n < most and a[n : n + step] == b[n : n + step]:
        n = min(most, n + step)
    while n < most and a[n] == b[n]:
        n += 1
    return (a[n:] <= b[n:]), n


def merge_runs(runs: list):
    """(run, string, common prefix with the string before) in order: a loser tree over runs of (string, common prefix).

    Each loser keeps its common prefix with the winner that passed its node. Of two contenders the one with the longer
    common prefix with the last winner is the smaller; only if these are equal are bytes compared, from there on."""
    k = 1 << max(0, (len(runs) - 1).bit_length())
    heads = [next(r, None) for r in runs] + [None] * (k - len(runs))
    text = [h[0] if h else None for h in heads]
    prefix = [0] * k
    loser = [-1] * k

    def play(x: int, y: int) -> tuple[int, int]:
        """(winner, loser) of two runs; the loser's prefix becomes the one with the winner."""
        if text[y] is None:
            return x, y
        if text[x] is None:
            return y, x
        px, py = prefix[x], prefix[y]
        if px > py:
            return x, y
        if py > px:
            return y, x
        first, n = compare(text[x], text[y], px)
        if first:
            prefix[y] = n
            return x, y
        prefix[x] = n
        return y, x

    def build(node: int) -> int:
        if node >= k:
            return node - k
        w, lost = play(build(2 * node), build(2 * node + 1))
        loser[node] = lost
        return w

    winner = build(1) if k > 1 else 0
    known = 0
    while text[winner] is not None:
        yield winner, text[winner], known
        head = next(runs[winner], None)
        text[winner], prefix[winner] = head if head else (None, 0)
        node = (winner + k) >> 1
        while node:
            winner, loser[node] = play(winner, loser[node])
            node >>= 1
        known = prefix[winner]


# ---------------------------------------------------------------- equal windows of merged suffixes
def later_windows(lcp: np.ndarray, left: list[bytes], low: np.ndarray, high: np.ndarray, doc: np.ndarray, place: np.ndarray, length: int,
                  head: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix, offset) of every window that is equal to an earlier one.

    Suffixes stand in order of (class, bytes from the anchor) with ``lcp``, of which ``head`` bytes are the class; a suffix
    has the windows that start ``low`` to ``high`` bytes before its anchor, whose bytes are ``left``, reversed."""
    n = len(lcp)
    width = max(1, int(high.max()))
    rows = matrix(left, width)
    by_left = np.lexsort(rows.T[::-1])
    left_lcp = np.zeros(n, np.int64)
    left_lcp[1:] = common_prefixes(rows[by_left][1:], rows[by_left][:-1])
    order = np.lexsort((place, doc))
    which, offsets = [], []
    for o in range(int(low.min()), int(high.max()) + 1):
        right_node = np.cumsum(lcp < head + length - o)
        left_node = np.empty(n, np.int64)
        left_node[by_left] = np.cumsum(left_lcp < o) if o else 0
        sel = order[(low[order] <= o) & (o <= high[order])]
        if not len(sel):
            continue
        key = right_node[sel] * (n + 1) + left_node[sel]
        _, first, group = np.unique(key, return_index=True, return_inverse=True)
        earliest = sel[first[group]]
        later = (doc[sel] != doc[earliest]) | (place[sel] != place[earliest])
        which.append(sel[later])
        offsets.append(np.full(int(later.sum()), o))
    return (np.concatenate(which), np.concatenate(offsets)) if which else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def intervals(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching intervals of a document as one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    fresh = np.append(True, doc[1:] != doc[:-1])
    # running maximum of the ends within a document: add an offset that grows from document to document
    lift = np.cumsum(fresh) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + lift) - lift
    cut = np.flatnonzero(fresh | np.append(True, start[1:] > reach[:-1]))
    return doc[cut], start[cut], reach[np.append(cut[1:], len(doc)) - 1]


def pack_run(entries: list[tuple]) -> bytes:
    """Front-coded sorted run of (sorted string, left, low, high, doc, place)."""
    lcp, size, rest = front_code([e[0] for e in entries])
    left = [e[1] for e in entries]
    cols = [np.array([e[i] for e in entries], np.int64) for i in range(2, 6)]
    body = pack_arrays(lcp, size, np.array([len(x) for x in left]), *cols)
    return len(body).to_bytes(8, "little") + body + len(rest).to_bytes(8, "little") + rest + b"".join(left)


def unpack_run(payload: bytes):
    n = int.from_bytes(payload[:8], "little")
    lcp, size, lens, low, high, doc, place = (x.view(np.int64) for x in unpack_arrays(payload[8 : 8 + n], 7))
    m = int.from_bytes(payload[8 + n : 16 + n], "little")
    rest, tail = payload[16 + n : 16 + n + m], payload[16 + n + m :]
    at = np.append(0, np.cumsum(lens))
    return lcp, size, rest, [tail[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())], low, high, doc, place


class Plan(NamedTuple):
    """What the passes share: parameters and the files written so far."""

    folder: str
    length: int
    k: int
    crowd: int
    sketch: Sketch
    bits: int
    sketched: list
    owned: list = []
    crowded: list = []
    found: list = []


def candidates(plan: Plan, files, held):
    """Groups of contexts whose anchor's k-gram is estimated to occur twice or more."""
    for pieces in groups(held, plan.length):
        c = contexts(pieces, plan.length, plan.k)
        if c is not None:
            c = c.take(np.flatnonzero(plan.sketch.repeated(files, c.kgram)))
            if len(c.doc):
                yield c


def find_equal(texts: DataFrame, plan: Plan) -> Plan:
    """Step 2: owners of equal contexts, and the number of different contexts of each k-gram that has several."""
    folder, bits = plan.folder, plan.bits

    def send(batches):
        files = plan.sketch.open(plan.sketched)
        for held in batches_of(batches):
            parts = []
            ids = np.array([d for d, _ in held], np.int64)
            for c in candidates(plan, files, held):
                parts.append((*c.identity(), c.kgram, ids[c.doc], c.place + c.shift))
            if parts:
                a, b, g, doc, place = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((place, doc, b, a))
                a, b, g, doc, place = a[order], b[order], g[order], doc[order], place[order]
                first = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
                a, b, g, doc, place = a[first], b[first], g[first], doc[first], place[first]
                edges = edges_of(a, bits)
                yield packed_batch([(n, pack_arrays(a[x:y], b[x:y], g[x:y], doc[x:y], place[x:y])) for n, (x, y) in enumerate(zip(edges, edges[1:])) if y > x])

    def own(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        a, b, g, doc, place = (np.concatenate(x) for x in arrays_of(table, 5))
        doc, place = doc.view(np.int64), place.view(np.int64)
        order = np.lexsort((place, doc, b, a))
        a, b, g, doc, place = a[order], b[order], g[order], doc[order], place[order]
        first = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        for name, x in (("context", a), ("check", b), ("owner_doc", doc), ("owner_place", place)):
            save_array(folder, f"{name}-{bucket}", x[first])
        g, n = np.unique(g[first], return_counts=True)
        edges = edges_of(g, bits)
        rows = [(t, bucket, pack_arrays(g[x:y], n[x:y])) for t, (x, y) in enumerate(zip(edges, edges[1:])) if y > x]
        t, s, p = zip(*rows)
        return pa.table({"bucket": pa.array(t, pa.int32()), "source": pa.array(s, pa.int32()), "payload": pa.array(p, pa.binary())})

    def several(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        g, n = (np.concatenate(x) for x in arrays_of(table, 2))
        order = np.argsort(g, kind="stable")
        g, n = g[order], n[order]
        first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        g, n = g[first], np.add.reduceat(n, first)
        save_array(folder, f"kgram-{bucket}", g[n > 1])
        save_array(folder, f"variety-{bucket}", n[n > 1].astype(np.int64))
        return pa.table({"bucket": pa.array([bucket], pa.int32())})

    owners = materialize(texts.mapInArrow(send, PACKED).groupBy("bucket").applyInArrow(own, "bucket int, source int, payload binary"), "suffix-owners")
    crowded = sorted(r.bucket for r in owners.select("bucket", "payload").groupBy("bucket").applyInArrow(several, "bucket int").collect())
    return plan._replace(owned=sorted(r.source for r in owners.select("source").distinct().collect()), crowded=crowded)


def owners_of(plan: Plan) -> SortedFiles:
    return SortedFiles(plan.folder, "context", plan.bits, plan.owned, ["check", "owner_doc", "owner_place"])


def compare_suffixes(texts: DataFrame, plan: Plan) -> Plan:
    """Step 3: windows of different contexts that are equal to an earlier one, as intervals by document."""
    folder, bits, length = plan.folder, plan.bits, plan.length

    def flush(entries: list[tuple], flags: list[tuple]):
        """Sorted runs by bucket; equal suffixes of this task are sent once, the later ones are flagged here."""
        entries.sort(key=lambda e: (e[0], e[1], e[4], e[5]))
        kept, last = [], None
        for e in entries:
            if last is not None and e[:4] == last[:4]:
                if e[4:] != last[4:]:
                    flags.append((e[4], e[5] - e[3], e[5] - e[2] + length))
            else:
                kept.append(e)
                last = e
        runs: dict[int, list] = {}
        for e in kept:
            runs.setdefault(int.from_bytes(e[0][:8], "big") >> (64 - bits), []).append(e)
        rows = [(b, 0, pack_run(r)) for b, r in runs.items()]
        rows += flag_rows(*(np.array(x, np.int64) for x in zip(*flags))) if flags else []
        b, kind, p = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(kind, pa.int32()), pa.array(p, pa.binary())], names=["bucket", "kind", "payload"])

    def flag_rows(doc, start, end):
        doc, start, end = intervals(doc, start, end)
        key = mix(doc.view(np.uint64))
        order = np.argsort(key, kind="stable")
        edges = edges_of(key[order], bits)
        return [(n, 1, pack_arrays(doc[o], start[o], end[o] - start[o])) for n, (x, y) in enumerate(zip(edges, edges[1:])) if y > x for o in [order[x:y]]]

    def send(batches):
        files, owners = plan.sketch.open(plan.sketched), owners_of(plan)
        variety = SortedFiles(folder, "kgram", bits, plan.crowded, ["variety"])
        entries, flags = [], []
        for held in batches_of(batches):
            ids = np.array([d for d, _ in held], np.int64)
            for c in candidates(plan, files, held):
                many = variety.find(c.kgram)
                at = np.flatnonzero(many["found"])
                c, number = c.take(at), many["variety"][at]
                a, b = c.identity()
                owner = owners.find(a, b, "check")
                at = np.flatnonzero((owner["owner_doc"] == ids[c.doc]) & (owner["owner_place"] == c.place + c.shift))
                c, number = c.take(at), number[at]
                data = c.data.tobytes()
                for i, (f, p, e, s, d, g) in enumerate(zip(c.first.tolist(), c.place.tolist(), c.end.tolist(), c.shift.tolist(), c.doc.tolist(), c.kgram.tolist())):
                    if number[i] <= plan.crowd:
                        entries.append((g.to_bytes(8, "big") + data[p:e], data[f:p][::-1], p - (e - length), p - f, int(ids[d]), p + s))
                    else:  # a suffix for each window
                        for w in range(f, e - length + 1):
                            string = data[w : w + length]
                            entries.append((hashlib.blake2b(string, digest_size=8).digest() + string, b"", 0, 0, int(ids[d]), w + s))
                if len(entries) >= 50_000:
                    yield flush(entries, flags)
                    entries, flags = [], []
        if entries:
            yield flush(entries, flags)

    def combine(table: pa.Table) -> pa.Table:
        runs = [unpack_run(x.as_py()) for x in table.column("payload")]
        at, source, lcp = [0] * len(runs), [], []
        sizes = np.cumsum([0] + [len(r[0]) for r in runs])
        for r, _, n in merge_runs([front_decode(*x[:3]) for x in runs]):
            source.append(sizes[r] + at[r])
            lcp.append(n)
            at[r] += 1
        source = np.array(source, np.int64)
        low, high, doc, place = (np.concatenate([r[i] for r in runs])[source] for i in (4, 5, 6, 7))
        left = [x for r in runs for x in r[3]]
        which, o = later_windows(np.array(lcp), [left[i] for i in source.tolist()], low, high, doc, place, length, 8)
        start = place[which] - o
        rows = flag_rows(doc[which], start, start + length)
        b, kind, p = zip(*rows) if rows else ((), (), ())
        return pa.table({"bucket": pa.array(b, pa.int32()), "kind": pa.array(kind, pa.int32()), "payload": pa.array(p, pa.binary())})

    def keep(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        doc, start, size = (np.concatenate(x).view(np.int64) for x in arrays_of(table, 3))
        doc, start, end = intervals(doc, start, start + size)
        key = mix(doc.view(np.uint64))
        order = np.argsort(key, kind="stable")
        for name, x in (("flag", key), ("flag_start", start), ("flag_end", end)):
            save_array(folder, f"{name}-{bucket}", x[order])
        return pa.table({"bucket": pa.array([bucket], pa.int32())})

    kinds = "bucket int, kind int, payload binary"
    sent = materialize(texts.mapInArrow(send, kinds), "suffix-runs")
    merged = sent.filter("kind = 0").select("bucket", "payload").groupBy("bucket").applyInArrow(combine, kinds)
    flags = merged.union(sent.filter("kind = 1")).select("bucket", "payload")
    return plan._replace(found=sorted(r.bucket for r in flags.groupBy("bucket").applyInArrow(keep, "bucket int").collect()))


def dedup(docs: DataFrame, length: int = 100, k: int = 32, crowd: int = 2048, with_text: bool = False, bucket_bytes: float = 16_000_000,
          keep: list[str] | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and end byte of every removed run), and with
    ``with_text`` the kept bytes and the text of them, without the characters that lost a byte; then the columns ``keep`` of the input row."""
    rows_in = id_text(docs, keep=keep).filter("doc_id is not null")
    texts = rows_in.select("doc_id", "text")
    folder = shared_dir(texts.sparkSession, "suffix-dedup")
    amount = total_bytes(texts)
    anchors = 2 * amount / (length - k + 2)
    sketch = Sketch.sized(folder, anchors, 2)

    def count(batches):
        for held in batches_of(batches):
            for pieces in groups(held, length):
                c = contexts(pieces, length, k)
                if c is not None:
                    h, n = np.unique(c.kgram, return_counts=True)
                    yield packed_batch(sketch.counted(h, n))

    plan = Plan(folder, length, k, crowd, sketch, bucket_bits(amount, bucket_bytes), sketch.build(texts.mapInArrow(count, PACKED)))
    plan = compare_suffixes(texts, find_equal(texts, plan))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string()]
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", "kept_text"]

    def remove(batches):
        files, owners = plan.sketch.open(plan.sketched), owners_of(plan)
        flags, flagged = [Files(folder, x) for x in ("flag", "flag_start", "flag_end")], set(plan.found)
        for batch, row, held in ((b, n, h) for b in batches for n, h in numbered(batches_of([b]))):
            ids = np.array([d for d, _ in held], np.int64)
            parts = []
            for c in candidates(plan, files, held):
                a, b = c.identity()
                owner = owners.find(a, b, "check")
                at = np.flatnonzero((owner["owner_doc"] != ids[c.doc]) | (owner["owner_place"] != c.place + c.shift))
                parts.append((c.doc[at], c.first[at] + c.shift[at], c.end[at] + c.shift[at]))
            keys = mix(ids.view(np.uint64))
            for i, key in enumerate(keys.tolist()):
                bucket = key >> (64 - plan.bits)
                if bucket in flagged:  # the key is a bijection of the doc_id
                    found, first, last = (f[bucket] for f in flags)
                    x, y = np.searchsorted(found, np.uint64(key)), np.searchsorted(found, np.uint64(key), side="right")
                    if y > x:
                        parts.append((np.full(y - x, i), first[x:y], last[x:y]))
            doc, start, end = intervals(*(np.concatenate(x).astype(np.int64) for x in zip(*parts))) if parts else (np.zeros(0, np.int64),) * 3
            edges = np.searchsorted(doc, np.arange(len(held) + 1))
            rows = []
            for (d, text), x, y in zip(held, edges.tolist(), edges[1:].tolist()):
                at, kept, spans = 0, [], []
                for s, e in zip(start[x:y].tolist(), end[x:y].tolist()):
                    kept.append(text[at:s])
                    spans.append({"start": s, "end": e})
                    at = e
                kept = b"".join([*kept, text[at:]])
                rows.append((d, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans, *((kept, kept.decode("utf-8", "ignore")) if with_text else (None, None))))
            more, more_names = kept_slices(batch, row, len(held))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] + more, names=names + more_names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary, kept_text string"
    out = unkept(rows_in.mapInArrow(remove, with_kept(schema, rows_in)))
    return out if with_text else out.drop("kept", "kept_text")

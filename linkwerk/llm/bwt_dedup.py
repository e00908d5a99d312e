"""Removal of repeated byte strings with a Burrows-Wheeler transform.

*Inside one block* of text the suffixes are sorted to a bounded depth and give
the Burrows-Wheeler transform. Breadth-first backward extension starts from the
interval of the empty string and prepends one byte at a time: the intervals of
length l that end at a boundary not seen before give exactly the places where
the common prefix of neighbouring suffixes is l, for l = 0, 1, 2, ... The
search stops when l reaches the minimum length; suffixes between which no
boundary was found share that many bytes. Intervals are extended run by run of
the transform, all intervals of a level at once.

*Over the corpus* blocks are cut so that equal strings meet. The smallest gram
hash in each window of the minimum length anchors it; equal windows have equal
anchors. Windows whose anchor occurs once are dropped by a hash exchange, and
again with longer grams, so that common strings much shorter than the minimum
drop out; stretches of windows with the same (short) anchor are told to the bucket of
that anchor by a digest of 128 bits, equal ones of a part as one kind with a
count of one or many. Where all kinds of an anchor's stretches came more than
once the counts tell. Only of the others the bytes go to the bucket, those of
equal kinds from one part, and through the transform, in blocks: an anchor's
copies reach a bucket as bytes once.

A long passage inside very many different documents makes many different
stretches around one anchor. Buckets that would need more than ``PILE`` bytes
are therefore not transformed: their windows are asked about one by one, by a
keyed digest of 128 bits in two halves of which each must occur again, which
deals them evenly whatever their anchor. Buckets of more than ``PILE`` bytes of
digests go that way before their kinds are even compared. So no task holds more
than a part, or a bucket of ``PILE``.

Defined results: null text counts as empty; a repeated row counts as another
document; documents shorter than the minimum keep all; an empty table gives an
empty result; extra columns are ignored. Ids are integers or null. Rows equal in
id and text are counted before they are dealt if there are very many. Cuts may
fall inside a code point.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash as bh
from . import shared as sh

LENGTH = 400
GRAMS = (64, 320)
#: Bytes that go through one transform, about; one anchor's stretches stay together.
BLOCK = 1 << 20
#: Bytes of a bucket that go through transforms, and of the digests of its kinds, at most.
PILE = 16_000_000
KINDS = "bucket int, part int, base int, keys binary, sums binary, sizes binary, often binary, size long, first binary, starts binary, stops binary"
JUDGED = "part int, bucket int, base int, whole binary, need binary, size long, heap boolean"
PIECES = "bucket int, part int, keys binary, sizes binary, places binary, often binary, body binary"
RUNS = "part int, place binary, start binary, stop binary"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, copies long"


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of symbols (0 ends a text) sorted by their first ``depth`` symbols at least."""
    n = len(symbols)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = symbols
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : k + n]
    have = 8
    while True:
        order = np.argsort(key, kind="stable")
        there = key[order]
        fresh = np.r_[True, there[1:] != there[:-1]]
        if have >= depth or fresh.all():
            return order
        rank = np.empty(n + have, np.uint64)
        rank[order] = np.cumsum(fresh).astype(np.uint64)
        rank[n:] = 0
        key = rank[:n] * np.uint64(n + 1) + rank[have : have + n]
        have *= 2


def boundaries(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether each sorted suffix shares under ``length`` symbols with the one before it.

    Right for suffixes whose first ``length`` symbols hold no 0.
    """
    n = len(symbols)
    last = symbols[order - 1]  # the transform; order 0 wraps to the last symbol, a 0
    turn = np.flatnonzero(np.r_[True, last[1:] != last[:-1]])  # runs of the transform
    run = (np.cumsum(np.r_[True, last[1:] != last[:-1]], dtype=np.int32) - 1).astype(np.int32)
    run_end = np.r_[turn[1:], n] - 1
    run_symbol = last[turn].astype(np.int64)
    by = np.argsort(last, kind="stable")
    # where a row's suffix goes when its symbol is prepended
    forward = np.empty(n, np.int32 if n < 1 << 31 else np.int64)
    forward[by] = np.arange(n)
    del by
    set_ = np.zeros(n + 1, bool)
    set_[[0, n]] = True
    lo, hi = np.array([0]), np.array([n - 1])
    for _ in range(length):
        a, z = run[lo], run[hi]
        m = z - a + 1
        which = np.repeat(np.arange(len(lo)), m)
        r = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + a[which]
        sym = run_symbol[r]
        keep = sym > 0
        which, r, sym = which[keep], r[keep], sym[keep]
        if not len(r):
            break
        first = forward[np.maximum(turn[r], lo[which])]
        final = forward[np.minimum(run_end[r], hi[which])]
        if (which[1:] == which[:-1]).any():
            by = np.argsort(which * 256 + sym, kind="stable")
            first, final = first[by], final[by]
            head = np.r_[True, np.diff((which * 256 + sym)[by]) != 0]
            at = np.flatnonzero(head)
            first, final = first[at], np.maximum.reduceat(final, at)
        new = ~set_[final + 1]
        lo, hi = first[new], final[new]
        if not len(lo):
            break
        set_[hi + 1] = True
    return set_[:n]


def repeated_starts(texts: list[bytes], weights: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each text the starts whose ``length`` bytes start at two places or more; a text stands for ``weights`` copies."""
    size = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    at = np.r_[0, np.cumsum(size + 1)]
    ends = at[1:] - 1
    code = np.zeros(256, np.uint8)
    inside = np.ones(len(raw), bool)
    inside[ends] = False
    used = np.bincount(raw[inside], minlength=256) > 0
    if used.sum() > 255:
        raise ValueError("UTF-8 text cannot hold every byte")
    code[used] = np.arange(1, used.sum() + 1)
    symbols = np.where(inside, code[raw], 0).astype(np.uint8)
    order = suffix_order(symbols, length + 1)
    head = np.flatnonzero(boundaries(symbols, order, length))
    whose = np.repeat(np.arange(len(texts)), size + 1)
    whole = order + length <= ends[whose[order]]
    weight = np.add.reduceat(np.where(whole, weights[whose[order]], 0), head)
    again = np.zeros(len(raw), bool)
    again[order] = np.repeat(weight > 1, np.diff(np.r_[head, len(order)])) & whole
    return [np.flatnonzero(again[at[k] : at[k] + size[k]]) for k in range(len(texts))]


class _Part:
    """A part's bytes, its anchors, and the stretches that share a repeated one."""

    def __init__(self, table, length: int, grams: tuple[int, ...], n_buckets: int):
        self.data, self.offsets = sh.bodies(table)
        self.length, self.grams, self.n_buckets = length, grams, n_buckets
        self.wanted = bh.within(self.offsets, length, len(self.data))
        self.least = None

    def ask(self, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors of the wanted windows, whether each occurs twice here, and each window's anchor."""
        grams = bh.windows(self.data, self.grams[level])
        least, chosen = bh.anchors(grams, self.grams[level], self.length, self.wanted)
        return *bh.distinct(bh.mix(grams[chosen])), least

    def narrow(self, levels: int, replies) -> _Part:
        """Leaves windows whose anchors of the first levels occur twice in the corpus."""
        for level in range(levels):
            sent, _, least = self.ask(level)
            again = sent[sh.bits_of(replies, level, sent, self.n_buckets)]
            at = np.minimum(np.searchsorted(again, least), max(len(again) - 1, 0))
            self.wanted &= again[at] == least if len(again) else False
            self.least = least if level == 0 else self.least
        return self

    def stretches(self) -> dict[str, np.ndarray]:
        """Runs of wanted windows with the same first anchor: keys, starts, stops (ends of their bytes), sums; sorted, equal ones together."""
        none = {k: np.zeros(0, t) for k, t in (("keys", np.uint64), ("starts", np.int64), ("stops", np.int64))} | {"sums": np.zeros((0, 2), np.uint64)}
        on = self.wanted
        if not on.any():
            return none
        doc = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))[: len(on)]
        fresh = on.copy()
        fresh[1:] &= ~on[:-1] | (self.least[1:] != self.least[:-1]) | (doc[1:] != doc[:-1])
        close = on.copy()
        close[:-1] &= ~on[1:] | fresh[1:]
        starts, stops = np.flatnonzero(fresh), np.flatnonzero(close) + self.length
        keys, text = self.least[starts], self.data.tobytes()
        sums = np.frombuffer(b"".join(hashlib.blake2b(text[a:z], digest_size=16).digest() for a, z in zip(starts.tolist(), stops.tolist(), strict=True)), np.uint64).reshape(-1, 2)
        by = np.lexsort((starts, stops - starts, sums[:, 1], sums[:, 0], keys))
        return {"keys": keys[by], "starts": starts[by], "stops": stops[by], "sums": sums[by]}


def _kinds(s: dict[str, np.ndarray]) -> np.ndarray:
    """Where a new kind of stretch begins in the sorted stretches."""
    if not len(s["keys"]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(_new_kind(s["keys"], s["sums"], s["stops"] - s["starts"]))


def _new_kind(keys: np.ndarray, sums: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.r_[True, (np.diff(keys) != 0) | (np.diff(sums, axis=0) != 0).any(axis=1) | (np.diff(sizes) != 0)]


def _asker(level: int, length: int, grams: tuple[int, ...], n_buckets: int):
    def ask(docs, replies=None):
        if not docs.num_rows:
            return sh.requests(0, level, np.zeros(0, np.uint64), np.zeros(0, bool), n_buckets)
        part = _Part(sh.documents(docs)[0], length, grams, n_buckets).narrow(level, replies)
        sent, often, _ = part.ask(level)
        return sh.requests(docs.column("part")[0].as_py(), level, sent, often, n_buckets)

    return (lambda docs: ask(docs)) if level == 0 else (lambda docs, replies: ask(docs, replies))


def _sender(length: int, grams: tuple[int, ...], n_buckets: int, n_piles: int):
    """The digests of a part's kinds of stretches, by bucket; the part's own stretches are a row without a bucket."""

    def send(docs, replies):
        import pyarrow as pa

        names = ["bucket", "part", "base", "keys", "sums", "sizes", "often", "size", "first", "starts", "stops"]
        kinds_ = [*[pa.int32()] * 3, *[pa.binary()] * 4, pa.int64(), *[pa.binary()] * 3]
        if not docs.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, kinds_, strict=True)})
        part, no = _Part(sh.documents(docs)[0], length, grams, n_buckets).narrow(len(grams), replies), docs.column("part")[0].as_py()
        s = part.stretches()
        first = _kinds(s)
        many = np.diff(np.r_[first, len(s["keys"])]) > 1
        keys, sums, sizes = s["keys"][first], s["sums"][first], (s["stops"] - s["starts"])[first]
        edges, rows = sh.buckets_of(keys, n_piles), [(-1, no, 0, keys.tobytes(), None, None, None, None, *[x.astype(np.int64).tobytes() for x in (first, s["starts"], s["stops"])])]
        for b in np.flatnonzero(np.diff(edges)):
            a, z = edges[b], edges[b + 1]
            rows.append((int(b), no, int(a), *[x[a:z].tobytes() for x in (keys, sums, sizes)], np.packbits(many[a:z]).tobytes(), int(sizes[a:z].sum()), None, None, None))
        return pa.table({n: pa.array(c, t) for n, t, c in zip(names, kinds_, zip(*rows, strict=True), strict=True)})

    return send


def _judge(pile: int):
    """Tells the parts of a bucket which kinds repeat as a whole and of which the bytes are needed, each from one part.

    A kind that occurs twice repeats as a whole; others may meet another kind
    at their anchor, or themselves, so all kinds of their anchor are needed.
    """

    def work(table):
        import pyarrow as pa

        table = sh.ordered(table, "part")
        read = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        keys, sizes, sums = read("keys", np.uint64), read("sizes", np.int64), [x.reshape(-1, 2) for x in read("sums", np.uint64)]
        many = [np.unpackbits(x, count=len(k)) for x, k in zip(read("often", np.uint8), keys, strict=True)]
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        keys, sums, sizes, many = map(np.concatenate, (keys, sums, sizes, many))
        by = np.lexsort((sizes, sums[:, 1], sums[:, 0], keys))
        head = np.flatnonzero(_new_kind(keys[by], sums[by], sizes[by]))
        one = by[head]  # a stretch of each kind
        weight = np.add.reduceat(1 + many[by].astype(np.int64), head)
        group = np.cumsum(np.r_[True, np.diff(keys[one]) != 0]) - 1
        single = np.bincount(group, weight == 1) > 0
        whole, need = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
        whole[by] = np.repeat(weight > 1, np.diff(np.r_[head, len(by)]))
        need[one[single[group]]] = True
        heap = bool(sizes[need].sum() > pile)
        pack = lambda x: pa.array([np.packbits(y).tobytes() for y in np.split(x, cuts)], pa.binary())
        size = [int(y.sum()) for y in np.split(np.where(need, sizes, 0), cuts)]
        told = {k: table.column(k).cast(pa.int32()) for k in ("part", "bucket", "base")}
        return pa.table({**told, "whole": pack(whole), "need": pack(need), "size": pa.array(size, pa.int64()), "heap": pa.array([heap] * table.num_rows, pa.bool_())})

    return work


class _Known:
    """A part's own stretches, and what the buckets tell about their kinds."""

    def __init__(self, rows):
        columns = {c: rows.column(c).to_pylist() for c in ("bucket", "base", "whole", "need", "heap", "keys", "first", "starts", "stops")}
        own = next(k for k, x in enumerate(columns["first"]) if x is not None)
        self.keys = np.frombuffer(columns["keys"][own], np.uint64)
        self.first, self.starts, self.stops = (np.frombuffer(columns[c][own], np.int64) for c in ("first", "starts", "stops"))
        n = len(self.first)
        self.ends = np.r_[self.first[1:], len(self.starts)]  # of the stretches of a kind
        self.whole, self.need, self.heap, self.bucket = np.zeros(n, bool), np.zeros(n, bool), np.zeros(n, bool), np.full(n, -1)
        # a bucket has the kinds from its base to the next one's
        told = sorted((b, k) for k, (b, x) in enumerate(zip(columns["base"], columns["whole"], strict=True)) if x is not None)
        stops = [b for b, _ in told[1:]] + [n] * bool(told)
        for (a, k), z in zip(told, stops, strict=True):
            bits = lambda c: np.unpackbits(np.frombuffer(columns[c][k], np.uint8), count=z - a) > 0  # noqa: B023, E731
            self.whole[a:z], self.need[a:z], self.heap[a:z], self.bucket[a:z] = bits("whole"), bits("need"), columns["heap"][k], columns["bucket"][k]

    def body(self, data: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of a stretch of each kind, one after the other, and their sizes."""
        starts, stops = self.starts[self.first[kinds]], self.stops[self.first[kinds]]
        return np.concatenate([data[:0], *[data[a:z] for a, z in zip(starts, stops, strict=True)]]), stops - starts


def _bringer():
    """The needed bytes of a part, but those of heaps."""

    def bring(docs, known):
        import pyarrow as pa

        rows = []
        if docs.num_rows:
            data, own = sh.bodies(sh.documents(docs)[0])[0], _Known(known)
            kinds = np.flatnonzero(own.need & ~own.heap)
            for at in np.split(kinds, np.flatnonzero(np.diff(own.bucket[kinds])) + 1) if len(kinds) else []:
                body, sizes = own.body(data, at)
                rows.append((int(own.bucket[at[0]]), docs.column("part")[0].as_py(), own.keys[at].tobytes(), sizes.tobytes(), at.tobytes(), np.packbits(own.whole[at]).tobytes(), body.tobytes()))
        names, kinds_ = ["bucket", "part", "keys", "sizes", "places", "often", "body"], [pa.int32(), pa.int32(), *[pa.binary()] * 5]
        return pa.table({n: pa.array(c, t) for n, t, c in zip(names, kinds_, zip(*rows, strict=True) if rows else [[]] * 7, strict=True)})

    return bring


def _pile(length: int):
    """Different stretches of a bucket to the runs of starts that repeat in those that occur once, by part and place."""

    def work(table):
        table = sh.ordered(table, "part")
        read = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        keys, sizes, places = read("keys", np.uint64), read("sizes", np.int64), read("places", np.int64)
        weight = [1 + np.unpackbits(x, count=len(k)).astype(np.int64) for x, k in zip(read("often", np.uint8), keys, strict=True)]
        bodies, parts = table.column("body").to_pylist(), table.column("part").to_pylist()
        row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        begin = np.concatenate([np.cumsum(s) - s for s in sizes])
        keys, sizes, places, weight = map(np.concatenate, (keys, sizes, places, weight))
        todo = np.argsort(keys, kind="stable")
        held = np.cumsum(sizes[todo])
        out: dict[int, list] = {}
        at = 0
        while at < len(todo):
            before = held[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(held, before + BLOCK, "right")))
            while stop < len(todo) and keys[todo[stop]] == keys[todo[stop - 1]]:
                stop += 1
            block = todo[at:stop]
            for k, starts in zip(block, repeated_starts([bodies[row[k]][begin[k] : begin[k] + sizes[k]] for k in block], weight[block], length), strict=True):
                if weight[k] == 1 and len(starts):
                    out.setdefault(parts[row[k]], []).extend((int(places[k]), *r) for r in _runs(starts))
            at = stop
        return _told(out)

    return work


def _runs(starts) -> list[tuple[int, int]]:
    """Ascending starts as runs, ends exclusive."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(np.r_[starts[0], starts[cut + 1]].tolist(), (np.r_[starts[cut], starts[-1]] + 1).tolist(), strict=True))


def _told(out: dict[int, list]):
    """Rows of RUNS from the runs (place, start, stop) of each part."""
    import pyarrow as pa

    pack = lambda rows, k: pa.array([np.array([r[k] for r in x], np.int64).tobytes() for x in rows], pa.binary())
    return pa.table({"part": pa.array(list(out), pa.int32()), **{name: pack(out.values(), k) for k, name in enumerate(("place", "start", "stop"))}})


class _Heap:
    """A part's share of the buckets that are too large for transforms: the digests of its windows."""

    def __init__(self, data: np.ndarray, own: _Known, length: int, key: int):
        self.places = np.flatnonzero(own.need & own.heap)
        data, self.sizes = own.body(data, self.places)
        self.ends = np.cumsum(self.sizes)
        self.whose = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.at = np.flatnonzero(np.arange(len(data)) + length <= self.ends[self.whose])
        self.many = own.whole[self.places][self.whose[self.at]]
        self.halves = [bh.digests(data, length, key + half)[self.at] for half in (1, 2)]

    def asked(self, half: int):
        """Distinct digests and whether each occurs twice or more."""
        values, at, counts = np.unique(self.halves[half], return_inverse=True, return_counts=True)
        often = counts > 1
        often[at[self.many]] = True
        return values, often, at

    def runs(self, replies, n_buckets: int) -> list[tuple[int, int, int]]:
        """The runs (place, start, stop) whose two halves each occur again."""
        again, out = np.ones(len(self.at), bool), []
        for half in (0, 1):
            values, _, at = self.asked(half)
            again &= sh.bits_of(replies, half, values, n_buckets)[at]
        places, whose = self.at[again], self.whose[self.at[again]]
        edges = np.searchsorted(whose, np.arange(len(self.sizes) + 1))
        for k in np.flatnonzero(np.diff(edges)):
            starts = places[edges[k] : edges[k + 1]] - (self.ends[k] - self.sizes[k])
            out.extend((int(self.places[k]), *r) for r in _runs(starts))
        return out


def _heap_asker(length: int, key: int, n_buckets: int):
    """level is the half of the digest."""

    def ask(docs, known):
        import pyarrow as pa

        none = sh.requests(0, 0, np.zeros(0, np.uint64), np.zeros(0, bool), n_buckets)
        if not docs.num_rows or not ((own := _Known(known)).need & own.heap).any():
            return none
        heap = _Heap(sh.bodies(sh.documents(docs)[0])[0], own, length, key)
        return pa.concat_tables([sh.requests(docs.column("part")[0].as_py(), half, *heap.asked(half)[:2], n_buckets) for half in (0, 1)])

    return ask


def _finisher(length: int, with_text: bool, key: int, n_heaps: int):
    """replies: what _Known reads, rows of RUNS (place: not null) and answers about heaps (bits: not null)."""

    def finish(docs, replies):
        import pyarrow as pa

        docs, own_row = sh.documents(docs)
        data, offsets = sh.bodies(docs)
        own = _Known(replies)
        whole = np.flatnonzero(own.whole)
        place, start, stop = [whole], [np.zeros(len(whole), np.int64)], [(own.stops - own.starts)[own.first[whole]] - length + 1]
        for rest in zip(*(replies.column(c).to_pylist() for c in ("place", "start", "stop")), strict=True):
            if rest[0] is not None:
                for into, x in zip((place, start, stop), rest, strict=True):
                    into.append(np.frombuffer(x, np.int64))
        if n_heaps and (own.need & own.heap).any() and (runs := _Heap(data, own, length, key).runs(replies, n_heaps)):
            for into, x in zip((place, start, stop), zip(*runs, strict=True), strict=True):
                into.append(np.array(x, np.int64))
        step = np.zeros(len(data) + 1, np.int32)
        place, start, stop = map(np.concatenate, (place, start, stop))
        copies = (own.ends - own.first)[place]
        each = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies) + np.repeat(own.first[place], copies)
        np.add.at(step, own.starts[each] + np.repeat(start, copies), 1)
        np.subtract.at(step, own.starts[each] + np.repeat(stop, copies) - 1 + length, 1)
        gone = np.cumsum(step[:-1]) > 0
        heads = gone.copy()
        heads[1:] &= ~gone[:-1]
        inner = offsets[:-1][offsets[:-1] < len(gone)]
        heads[inner] = gone[inner]
        count = lambda x: np.diff(np.r_[0, np.cumsum(x)][offsets])
        removed, spans = count(gone), count(heads)
        sums, kept = [], []
        for k in np.flatnonzero(own_row):
            a, z = offsets[k], offsets[k + 1]
            rest = (data[a:z][~gone[a:z]] if removed[k] else data[a:z]).tobytes()
            sums.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest if with_text else None)
        docs = docs.filter(own_row)
        return pa.table({"doc_id": docs.column("id").cast(pa.int64()), "n_bytes": pa.array(np.diff(offsets)[own_row], pa.int64()), "n_removed": pa.array(removed[own_row], pa.int64()), "n_spans": pa.array(spans[own_row], pa.int64()), "kept_sha256": pa.array(sums, pa.string()), "kept": pa.array(kept, pa.binary()), "copies": docs.column("copies").cast(pa.int64())})

    return finish


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH, grams: tuple[int, ...] = GRAMS, part_bytes: int = sh.PART_BYTES // 2, with_text: bool = True, pile: int = PILE) -> DataFrame:
    """Per document the counts and digest of RESULT: bytes outside every string of ``length`` that starts twice."""
    n_bytes, equal = sh.text_bytes(df, id_col, text)
    n_buckets = sh.bucket_count(n_bytes / 100)
    n_piles, key = sh.part_count(2 * n_bytes, sh.PART_BYTES), int.from_bytes(os.urandom(7))
    parts = sh.in_parts(df, id_col, text, sh.part_count(n_bytes, part_bytes), equal).groupBy("part")
    told: DataFrame | None = None
    for level in range(len(grams)):
        ask = _asker(level, length, grams, n_buckets)
        asked = parts.applyInArrow(ask, sh.REQUEST) if told is None else parts.cogroup(told.groupBy("part")).applyInArrow(ask, sh.REQUEST)
        told = sh.answers(asked) if told is None else told.unionByName(sh.answers(asked))
    kinds = sh.cut(parts.cogroup(told.groupBy("part")).applyInArrow(_sender(length, grams, n_buckets, n_piles), KINDS))
    sh.tidy(df.sparkSession)  # the text is dealt once more for what follows, so what was dealt before may go
    sent, held = kinds.where("bucket >= 0"), F.sum(F.octet_length("keys") + F.octet_length("sums") + F.octet_length("sizes"))
    large = sh.cut(sent.groupBy("bucket").agg(held.alias("held")).where(F.col("held") > pile).select("bucket"))
    some, judge = not large.isEmpty(), lambda rows: rows.drop("first", "starts", "stops").groupBy("bucket").applyInArrow(_judge(pile), JUDGED)
    judged = judge(sent.join(F.broadcast(large), "bucket", "left_anti") if some else sent)
    if some:  # too many kinds for a task: all of them are a heap, and a part's own counts are all that is told
        every = F.unhex(F.expr("repeat('FF', octet_length(often))"))
        rest = sent.join(F.broadcast(large), "bucket", "left_semi")
        judged = judged.unionByName(rest.select("part", "bucket", "base", F.col("often").alias("whole"), every.alias("need"), "size", F.lit(True).alias("heap")))
    judged = sh.cut(judged)
    known = kinds.where("bucket = -1").select("part", "keys", "first", "starts", "stops").unionByName(judged.drop("size"), allowMissingColumns=True)
    told = lambda rows: parts.cogroup(rows.groupBy("part"))
    pieces = told(known).applyInArrow(_bringer(), PIECES)
    replies = known.unionByName(pieces.repartition(n_piles, "bucket").groupBy("bucket").applyInArrow(_pile(length), RUNS), allowMissingColumns=True)
    n_windows = 2 * (judged.where("heap").agg(F.sum("size")).first()[0] or 0)
    n_heaps = sh.bucket_count(n_windows) if n_windows else 0
    if n_heaps:
        asked = told(known).applyInArrow(_heap_asker(length, key, n_heaps), sh.REQUEST)
        replies = replies.unionByName(sh.answers(asked), allowMissingColumns=True)
    return sh.each_copy(told(replies).applyInArrow(_finisher(length, with_text, key, n_heaps), RESULT), equal)


def op9_bwt_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 400-byte strings of ``documents``."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False).drop("kept")


#: A digest of every string of LENGTH bytes, from digests of half the length.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b1 AS (SELECT rid, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS b, unnest(l) AS s FROM (SELECT rid, regexp_extract_all(x, '..') AS l FROM d)),
b2 AS (SELECT rid, i, b, s || lead(s, 1) OVER (PARTITION BY rid ORDER BY i) AS s FROM b1),
b4 AS (SELECT rid, i, b, s || lead(s, 2) OVER (PARTITION BY rid ORDER BY i) AS s FROM b2),
b8 AS (SELECT rid, i, b, s || lead(s, 4) OVER (PARTITION BY rid ORDER BY i) AS s FROM b4),
b16 AS (SELECT rid, i, b, s || lead(s, 8) OVER (PARTITION BY rid ORDER BY i) AS s FROM b8),
b32 AS (SELECT rid, i, b, md5(s || lead(s, 16) OVER (PARTITION BY rid ORDER BY i)) AS s FROM b16),
b64 AS (SELECT rid, i, b, md5(s || lead(s, 32) OVER (PARTITION BY rid ORDER BY i)) AS s FROM b32),
b128 AS (SELECT rid, i, b, md5(s || lead(s, 64) OVER (PARTITION BY rid ORDER BY i)) AS s FROM b64),
b256 AS (SELECT rid, i, b, md5(s || lead(s, 128) OVER (PARTITION BY rid ORDER BY i)) AS s FROM b128),
b400 AS (SELECT rid, i, b, md5(s || lead(s, 144) OVER (PARTITION BY rid ORDER BY i)) AS s FROM b256),
r AS (SELECT s FROM b400 WHERE s IS NOT NULL GROUP BY s HAVING count(*) > 1),
m AS (SELECT rid, i, b, max(CASE WHEN r.s IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 399 PRECEDING AND CURRENT ROW) AS gone FROM b400 LEFT JOIN r ON b400.s = r.s),
h AS (SELECT *, gone = 1 AND coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY i), 0) = 0 AS head FROM m),
k AS (SELECT rid, count(*) AS n_bytes, count(*) FILTER (WHERE gone = 1) AS n_removed, count(*) FILTER (WHERE head) AS n_spans, string_agg(b, '' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM h GROUP BY rid)
SELECT d.doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid
"""

"""Perplexity of documents under a Brown class-based bigram model.

P(word | previous) = P(class | class of previous) * P(word | class). Classes
are found in two steps. The seed is the exchange algorithm on the driver: each
element moves to the class that most raises the likelihood of the class
bigrams, until nothing moves; its elements are the ``FREQUENT`` most frequent
words, the end of a document, and ``SHAPES`` groups that all other words fall
into by their last two bytes. Then every other word of ``FLOOR`` training
tokens or more takes, in its bucket, the class that most raises the seed's
likelihood by the classes before and after the word. Only words below the floor
stay in the groups; a group spreads its probability over its words by their
counts, with one share for words never seen. Class transitions are counted anew
with all words in their final classes.

Words are counted by hash in buckets (each task sends a word once per flush),
and so are the classes next to them; the element bigrams, (FREQUENT + SHAPES +
1)^2 numbers at most, and the class bigrams are the only counts that reach the
driver. For scoring, each part of the corpus asks the buckets for the counts
and classes of its distinct words; a checkpoint holds the classes of all tokens,
two bytes each, from which transitions are counted and scored.

Defined results: null text counts as empty and scores its end token; a null id
has the check sum of the empty string (held out); with no training documents
all counts are zero and scores are those of the smoothing alone; repeated rows
are scored (and trained on) as often as they occur; an empty table gives an
empty result; extra columns are ignored. Ids are integers or null. Rows equal in
id and text are counted before they are dealt if there are very many. Words are
told apart by 58 bits of a hash (six more hold the shape): among V words V^2 /
2^59 pairs are expected to be taken for one (0.02 among 10^8).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bytehash as bh
from . import shared as sh

FREQUENT = 1000
CLASSES = 96
SHAPES = 64
#: Nothing moved any more after 20 on the test tables; each sweep that moves raises the likelihood, so the end is sure.
SWEEPS = 100
FOLDS = 10
#: Pseudo-count of a word in the base model and in a shape group.
ADD = 0.1
#: Weight of the class unigram in class transitions.
BACK_OFF = 10.0
END = np.uint64(0xE11D << 40)
#: Training tokens of a word from which it has a class of its own.
FLOOR = 5
#: Class of a word below the floor: that of its shape.
NONE = 0xFFFF
_FLUSH = 2_000_000
#: Words whose neighbours are held at once.
_BLOCK = 1 << 14
COUNTS = "bucket int, hashes binary, counts binary, n_words long, n_tokens long"
NEAR = "bucket int, hashes binary, sizes binary, slots binary, counts binary"
CLASSED = "bucket int, hashes binary, counts binary, classes binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, copies long"
READ = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, emitted double, classes binary, copies long"


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == 0


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each document's end included, and their offsets. A word's six low bits are its shape."""
    data = bh.LOWER[data]
    starts, ends, first = bh.word_bounds(data, offsets)
    h = bh.spans(data, starts, ends)
    last = data[ends - 1].astype(np.uint32) if len(ends) else np.zeros(0, np.uint32)
    before = np.where(ends - starts > 1, data[np.maximum(ends - 2, 0)] if len(data) else 0, 0).astype(np.uint32) if len(ends) else last
    shape = ((last * 31 + before * 17) % SHAPES).astype(np.uint64)
    h = (h & ~np.uint64(SHAPES - 1)) | shape
    n = len(offsets) - 1
    out = np.full(len(h) + n, END, np.uint64)
    at = np.arange(len(h)) + np.repeat(np.arange(n), np.diff(first))
    out[at] = h
    return out, first + np.arange(n + 1)


def _batch_tokens(batch):
    import pyarrow as pa

    return tokens(*sh.bodies(pa.table({"body": batch.column("body")})))


def _counter(n_buckets: int):
    def flush(hashes, counts):
        import pyarrow as pa

        values, totals, _ = sh.merge_counts(hashes, counts)
        edges = sh.buckets_of(values, n_buckets)
        full = [b for b in range(n_buckets) if edges[b + 1] > edges[b]]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(full, pa.int32()),
                pa.array([values[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()),
                pa.array([totals[edges[b] : edges[b + 1]].tobytes() for b in full], pa.binary()),
                pa.array([0] * len(full), pa.int64()),
                pa.array([0] * len(full), pa.int64()),
            ],
            ["bucket", "hashes", "counts", "n_words", "n_tokens"],
        )

    def count(batches):
        hashes, counts, held = [], [], 0
        for b in (x for whole in batches for x in sh.slices(whole, "body")):
            h, c = np.unique(_batch_tokens(b)[0], return_counts=True)
            hashes.append(h)
            counts.append(c)
            held += len(h)
            if held > _FLUSH:
                values, totals, _ = sh.merge_counts(hashes, counts)
                hashes, counts, held = [values], [totals], len(values)
                if held > _FLUSH // 2:
                    yield flush(hashes, counts)
                    hashes, counts, held = [], [], 0
        if held:
            yield flush(hashes, counts)

    return count


def _add_up(table):
    import pyarrow as pa

    hashes = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    counts = [np.frombuffer(x, np.int64) for x in table.column("counts").to_pylist()]
    values, totals, _ = sh.merge_counts(hashes, counts)
    return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "hashes": pa.array([values.tobytes()], pa.binary()), "counts": pa.array([totals.tobytes()], pa.binary()), "n_words": pa.array([len(values)], pa.int64()), "n_tokens": pa.array([int(totals.sum())], pa.int64())})


def _leaders(most: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for h, c in zip(b.column("hashes"), b.column("counts"), strict=True):
                h, c = np.frombuffer(h.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64)
                top = np.lexsort((h, -c))[:most]
                yield pa.RecordBatch.from_arrays([pa.array(h[top].view(np.int64)), pa.array(c[top])], ["hash", "n"])

    return run


class Elements:
    """Frequent words first (by hash), then shapes, then the end."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = np.sort(frequent)
        self.n = len(frequent) + SHAPES + 1

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = len(self.frequent) + (hashes & np.uint64(SHAPES - 1)).astype(np.int64)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            out = np.where(self.frequent[at] == hashes, at, out)
        return np.where(hashes == END, self.n - 1, out)


def _bigrams(elements: Elements):
    def run(batches):
        import pyarrow as pa

        n, total = elements.n, None
        for b in (x for whole in batches for x in sh.slices(whole, "body")):
            e = elements.of(_batch_tokens(b)[0])
            before = np.r_[n - 1, e[:-1]]  # each document begins after an end
            own = np.bincount(before * n + e, minlength=n * n)
            total = own if total is None else total + own
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    return run


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, n_classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each element. The last element keeps a class of its own, the last one."""
    n = len(bigrams)
    counts = bigrams.astype(float)
    rank = np.argsort(-(counts.sum(0) + counts.sum(1))[: n - 1], kind="stable")
    own = np.empty(n, np.int64)
    own[rank] = np.arange(n - 1) % (n_classes - 1)
    own[n - 1] = n_classes - 1
    left = np.zeros((n, n_classes))  # counts of class before element
    right = np.zeros((n, n_classes))  # counts of class after element
    np.add.at(left.T, own, counts)
    np.add.at(right.T, own, counts.T)
    table = np.zeros((n_classes, n_classes))
    np.add.at(table, own, right)
    k = np.arange(n_classes - 1)
    for _ in range(sweeps):
        moved = 0
        for e in rank:
            was, self_n = own[e], counts[e, e]
            row, col = right[e].copy(), left[e].copy()  # after and before e, by class, e itself in its class
            row[was] -= self_n
            col[was] -= self_n
            table[was] -= row
            table[:, was] -= col
            table[was, was] -= self_n
            t = table[k]
            u = table[:, k].T
            gain = (_xlogx(t + row) - _xlogx(t)).sum(1) + (_xlogx(u + col) - _xlogx(u)).sum(1)
            d = table[k, k]
            gain += _xlogx(d + row[k] + col[k] + self_n) + _xlogx(d) - _xlogx(d + row[k]) - _xlogx(d + col[k])
            out_n, in_n = table.sum(1)[k], table.sum(0)[k]
            gain -= _xlogx(out_n + row.sum() + self_n) - _xlogx(out_n) + _xlogx(in_n + col.sum() + self_n) - _xlogx(in_n)
            to = int(np.argmax(gain))
            if gain[to] <= gain[was] + 1e-9:
                to = was
            table[to] += row
            table[:, to] += col
            table[to, to] += self_n
            if to != was:
                moved += 1
                own[e] = to
                left[:, was] -= counts[e]
                left[:, to] += counts[e]
                right[:, was] -= counts[:, e]
                right[:, to] += counts[:, e]
        if not moved:
            break
    return own


def _transitions(table: np.ndarray, used: np.ndarray) -> np.ndarray:
    """P(class | class before), smoothed by the class unigram; classes without elements get nothing."""
    back = np.where(used, table.sum(0) + 0.5, 0)
    back = back / back.sum()
    return (table + BACK_OFF * back) / (table.sum(1, keepdims=True) + BACK_OFF)


class Seed:
    """Classes of the elements, and the gains by which the other words choose theirs."""

    def __init__(self, elements: Elements, bigrams: np.ndarray, classes: np.ndarray, n_classes: int):
        self.elements, self.classes, self.n_classes = elements, classes, n_classes
        table = np.zeros((n_classes, n_classes))
        np.add.at(table, (classes[:, None], classes[None, :]), bigrams)
        self.used = np.bincount(classes, minlength=n_classes) > 0
        step = _transitions(table, self.used)
        unigram = np.where(self.used, table.sum(0) + 0.5, 1.0)
        open_ = self.used.copy()
        open_[classes[-1]] = False  # the end stays alone
        with np.errstate(divide="ignore"):
            after, before = np.log(step), np.log(step / unigram)
        # slots: classes before a word, then classes after it; unused classes are in no slot
        gain = np.vstack([before, after.T])
        gain[~np.isfinite(gain)] = 0
        self.gain = np.where(open_, gain, 0)
        self.closed = ~open_

    def choose(self, near: np.ndarray) -> np.ndarray:
        """Class of each row of counts by slot: the one that most raises the likelihood of the seed's class bigrams."""
        return np.argmax(np.where(self.closed, -np.inf, near @ self.gain), axis=1).astype(np.uint16)


def _neighbours(seed: Seed, n_buckets: int):
    """Per bucket, the words that are no element by themselves and how often each class is before and after them."""
    width, elements = 2 * seed.n_classes, seed.elements

    def flush(hashes, slots):
        import pyarrow as pa

        words, at = np.unique(np.concatenate(hashes), return_inverse=True)
        near = np.concatenate(slots)
        cells, counts = np.unique(np.r_[at * width + near[:, 0], at * width + near[:, 1]], return_counts=True)
        sizes = np.bincount(cells // width, minlength=len(words)).astype(np.int32)
        first, edges = np.r_[0, np.cumsum(sizes)], sh.buckets_of(words, n_buckets)
        full = [b for b in range(n_buckets) if edges[b + 1] > edges[b]]
        slot, counts = (cells % width).astype(np.uint16), counts.astype(np.min_scalar_type(int(counts.max())))
        own = [(edges[b], edges[b + 1]) for b in full]
        packed = [[x[a:z].tobytes() for a, z in own] for x in (words, sizes)] + [[x[first[a] : first[z]].tobytes() for a, z in own] for x in (slot, counts)]
        return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(x, pa.binary()) for x in packed)], ["bucket", "hashes", "sizes", "slots", "counts"])

    def run(batches):
        hashes, slots, held = [], [], 0
        for b in (x for whole in batches for x in sh.slices(whole, "body")):
            h = _batch_tokens(b)[0]
            e = elements.of(h)
            c = seed.classes[e]
            rare = np.flatnonzero((e >= len(elements.frequent)) & (e < elements.n - 1))  # never a batch's last token, which is an end
            hashes.append(h[rare])
            slots.append(np.stack([np.r_[seed.classes[-1], c[:-1]][rare], seed.n_classes + c[rare + 1]], axis=1))
            held += len(rare)
            if held > _FLUSH // 2:
                yield flush(hashes, slots)
                hashes, slots, held = [], [], 0
        if held:
            yield flush(hashes, slots)

    return run


def _assigner(seed: Seed, floor: int):
    def assign(near, counted):
        import pyarrow as pa

        sh.give_back()
        own, counts = (np.frombuffer(counted.column(k)[0].as_py(), t) for k, t in (("hashes", np.uint64), ("counts", np.int64)))
        classes = np.full(len(own), NONE, np.uint16)
        e = seed.elements.of(own)
        fixed = (e < len(seed.elements.frequent)) | (own == END)
        classes[fixed] = seed.classes[e[fixed]]
        todo = np.flatnonzero(~fixed & (counts >= floor))
        told = []
        for h, sizes, slots, n in zip(*(near.column(k).to_pylist() for k in ("hashes", "sizes", "slots", "counts")), strict=True):
            slots = np.frombuffer(slots, np.uint16)
            told.append((np.frombuffer(h, np.uint64), np.r_[0, np.cumsum(np.frombuffer(sizes, np.int32))], slots, np.frombuffer(n, f"u{len(n) // len(slots)}")))
        width = 2 * seed.n_classes
        for at in range(0, len(todo), _BLOCK):
            block = todo[at : at + _BLOCK]
            words, table = own[block], np.zeros(len(block) * width)
            for h, first, slots, n in told:
                a, z = np.searchsorted(h, words[0]), np.searchsorted(h, words[-1], "right")
                place = np.minimum(np.searchsorted(words, h[a:z]), len(words) - 1)
                place = np.where(words[place] == h[a:z], place, -1)
                place = np.repeat(place, np.diff(first[a : z + 1]))
                here = place >= 0
                np.add.at(table, place[here] * width + slots[first[a] : first[z]][here], n[first[a] : first[z]][here])
            classes[block] = seed.choose(table.reshape(-1, width))
        return pa.table({"bucket": pa.array([counted.column("bucket")[0].as_py()], pa.int32()), "hashes": pa.array([own.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()), "classes": pa.array([classes.tobytes()], pa.binary())})

    return assign


def _totals(n_classes: int):
    """Words and tokens of each class, then of each shape, which holds the words without a class."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for h, c, k in zip(b.column("hashes"), b.column("counts"), b.column("classes"), strict=True):
                h, c, k = np.frombuffer(h.as_py(), np.uint64), np.frombuffer(c.as_py(), np.int64), np.frombuffer(k.as_py(), np.uint16)
                at = np.where(k == NONE, n_classes + (h & np.uint64(SHAPES - 1)).astype(np.int64), k)
                n = n_classes + SHAPES
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.bincount(at, minlength=n)), pa.array(np.bincount(at, c, n).astype(np.int64))], ["k", "words", "n"])

    return run


class Model:
    """What emissions need: the totals of classes and shapes, and the numbers of the base model."""

    def __init__(self, seed: Seed, words: np.ndarray, tokens_: np.ndarray, n_tokens: int, n_words: int):
        k, self.n_tokens, self.n_words = seed.n_classes, n_tokens, n_words
        self.end = int(seed.classes[-1])
        self.shape_class = seed.classes[len(seed.elements.frequent) : -1]
        own = tokens_[:k] + ADD * words[:k]
        np.add.at(own, self.shape_class, tokens_[k:] + ADD)
        self.total = np.log10(np.maximum(own, ADD))
        # of a word in a shape: the shape in its class, then the word in the shape
        self.shape = np.log10(tokens_[k:] + ADD) - np.log10(tokens_[k:] + ADD * (words[k:] + 1))

    def emit(self, hashes: np.ndarray, counts: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class of each token, and its log10 probability in the class. classes: as looked up."""
        shape = (hashes & np.uint64(SHAPES - 1)).astype(np.int64)
        rare, end = classes == NONE, hashes == END
        c = np.where(end, self.end, np.where(rare, self.shape_class[shape], classes)).astype(np.int64)
        out = np.log10(counts + ADD) - self.total[c] + np.where(rare, self.shape[shape], 0)
        return c, np.where(end, 0.0, out)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADD) / (self.n_tokens + ADD * (self.n_words + 1)))


def count_words(docs: DataFrame, n_buckets: int) -> DataFrame:
    """docs: column body. Rows of COUNTS, one per bucket, kept in a checkpoint."""
    return sh.cut(docs.mapInArrow(_counter(n_buckets), COUNTS).groupBy("bucket").applyInArrow(_add_up, COUNTS))


def train(docs: DataFrame, counted: DataFrame, n_buckets: int, frequent: int = FREQUENT, n_classes: int = CLASSES, floor: int = FLOOR) -> tuple[Seed, Model, DataFrame]:
    """The seed, the model and, kept in a checkpoint, rows of CLASSED: all words, with the classes of those above the floor."""
    own = counted.where("n_words > 0").select("hashes", "counts")
    n_words, n_tokens = counted.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    top = own.mapInArrow(_leaders(frequent + 1), "hash long, n long").orderBy(F.desc("n"), "hash").limit(frequent + 1).toPandas()
    h = top["hash"].to_numpy(np.int64).view(np.uint64)
    elements = Elements(h[h != END][:frequent])
    cells = docs.mapInArrow(_bigrams(elements), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    bigrams = np.zeros(elements.n**2)
    bigrams[cells["cell"].to_numpy(np.int64)] = cells["n"]
    bigrams = bigrams.reshape(elements.n, elements.n)
    seed = Seed(elements, bigrams, exchange(bigrams, n_classes), n_classes)
    near = docs.mapInArrow(_neighbours(seed, n_buckets), NEAR)
    classed = sh.cut(near.groupBy("bucket").cogroup(counted.groupBy("bucket")).applyInArrow(_assigner(seed, floor), CLASSED))
    sums = classed.mapInArrow(_totals(n_classes), "k long, words long, n long").groupBy("k").agg(F.sum("words").alias("words"), F.sum("n").alias("n")).toPandas()
    words, n = np.zeros(n_classes + SHAPES), np.zeros(n_classes + SHAPES)
    words[sums["k"].to_numpy(int)], n[sums["k"].to_numpy(int)] = sums["words"], sums["n"]
    return seed, Model(seed, words, n, n_tokens, n_words), classed


def _ask(n_buckets: int):
    def ask(docs):
        h, _ = tokens(*sh.bodies(docs))
        return sh.requests(docs.column("part")[0].as_py(), 0, *bh.distinct(h), n_buckets)

    return ask


def _look_up(asked, classed):
    import pyarrow as pa

    there = classed.num_rows > 0
    known, counts, classes = (np.frombuffer(classed.column(k)[0].as_py(), t) if there else np.zeros(0, t) for k, t in (("hashes", np.uint64), ("counts", np.int64), ("classes", np.uint16)))
    found, of = [], []
    for x in asked.column("hashes").to_pylist():
        x = np.frombuffer(x, np.uint64)
        at = np.minimum(np.searchsorted(known, x), max(0, len(known) - 1))
        hit = known[at] == x if len(known) else np.zeros(len(x), bool)
        n, c = np.zeros(len(x), np.int64), np.full(len(x), NONE, np.uint16)
        n[hit], c[hit] = counts[at[hit]], classes[at[hit]]
        found.append(n.tobytes())
        of.append(c.tobytes())
    return pa.table({"part": asked.column("part").cast(pa.int32()), "bucket": asked.column("bucket").cast(pa.int32()), "counts": pa.array(found, pa.binary()), "classes": pa.array(of, pa.binary())})


def _reader(model: Model, n_buckets: int):
    """Rows of READ: all of a document's scores but the class transitions, for which its classes are kept."""

    def read(docs, replies):
        import pyarrow as pa

        docs = sh.ordered(docs, "id", "body")
        h, first = tokens(*sh.bodies(docs))
        sent, back = np.unique(h, return_inverse=True)
        edges, counts, classes = sh.buckets_of(sent, n_buckets), np.zeros(len(sent), np.int64), np.full(len(sent), NONE, np.uint16)
        for b, n, k in zip(*(replies.column(x).to_pylist() for x in ("bucket", "counts", "classes")), strict=True):
            counts[edges[b] : edges[b + 1]], classes[edges[b] : edges[b + 1]] = np.frombuffer(n, np.int64), np.frombuffer(k, np.uint16)
        c, emit = model.emit(sent, counts, classes)
        own = c.astype(np.uint16)[back]
        total = lambda x: np.add.reduceat(x[back], first[:-1])  # noqa: E731  every document has its end at least
        return pa.table(
            {
                "doc_id": docs.column("id").cast(pa.int64()),
                "held_out": docs.column("held_out"),
                "n_tokens": pa.array(np.diff(first), pa.int64()),
                "n_known": pa.array(total((counts > 0).astype(np.int64)), pa.int64()),
                "train_tokens": pa.array(np.full(len(first) - 1, model.n_tokens), pa.int64()),
                "base_score": pa.array(total(model.base(counts))),
                "emitted": pa.array(total(emit)),
                "classes": pa.array([own[a:z].tobytes() for a, z in zip(first, first[1:], strict=False)], pa.binary()),
                "copies": docs.column("copies").cast(pa.int64()),
            }
        )

    return read


def _steps(batch, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class before each token, class of each token, and where each row's begin."""
    rows = batch.column("classes").to_pylist()
    c = np.frombuffer(b"".join(rows), np.uint16).astype(np.int64)
    return np.r_[end, c[:-1]], c, np.cumsum([0, *(len(x) // 2 for x in rows)])  # a document begins after an end


def _class_bigrams(n_classes: int, end: int):
    def run(batches):
        import pyarrow as pa

        total = np.zeros(n_classes**2, np.int64)
        for b in batches:
            if b.num_rows:
                before, c, first = _steps(b, end)
                copies = np.repeat(b.column("copies").to_numpy(), np.diff(first))
                total += np.bincount(before * n_classes + c, copies, n_classes**2).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])

    return run


def _scorer(step: np.ndarray, end: int):
    def score(batches):
        import pyarrow as pa

        for b in batches:
            if not b.num_rows:
                continue
            before, c, first = _steps(b, end)
            total = np.add.reduceat(step[before, c], first[:-1]) + b.column("emitted").to_numpy()
            kept = b.schema.names[:6]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in kept), pa.array(total), b.column("copies")], [*kept, "score", "copies"])

    return score


def score_documents(df: DataFrame, id_col: str = "doc_id", text: str = "text", frequent: int = FREQUENT, n_classes: int = CLASSES, part_bytes: int = sh.PART_BYTES, floor: int = FLOOR) -> DataFrame:
    """Rows of RESULT; perplexity is 10 ** (-score / n_tokens)."""
    n_bytes, equal = sh.text_bytes(df, id_col, text)
    n_buckets = sh.bucket_count(n_bytes / 16)
    learn = df.where(~held_out(F.col(id_col))).select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    counted = count_words(learn, n_buckets)
    seed, model, classed = train(learn, counted, n_buckets, frequent, n_classes, floor)
    docs = sh.in_parts(df, id_col, text, sh.part_count(n_bytes, part_bytes), equal).withColumn("held_out", held_out(F.col("id")))
    parts = docs.groupBy("part")
    replies = parts.applyInArrow(_ask(n_buckets), sh.REQUEST).groupBy("bucket").cogroup(classed.groupBy("bucket")).applyInArrow(_look_up, "part int, bucket int, counts binary, classes binary")
    read = sh.cut(parts.cogroup(replies.groupBy("part")).applyInArrow(_reader(model, n_buckets), READ))
    cells = read.where(~F.col("held_out")).select("classes", "copies").mapInArrow(_class_bigrams(n_classes, model.end), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(n_classes**2)
    table[cells["cell"].to_numpy(np.int64)] = cells["n"]
    with np.errstate(divide="ignore"):
        step = np.log10(_transitions(table.reshape(n_classes, n_classes), seed.used))
    return sh.each_copy(read.mapInArrow(_scorer(step, model.end), RESULT), equal)


def op10_class_lm(spark, sf_dir: str) -> DataFrame:
    """Contract query: all ``documents``, learning from nine folds of ten."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Benchmark decontamination: a BM25 index of test items, block-max WAND, overlap check.

Terms are pairs of neighbouring words. Test items are cut into pieces of at
most ``PIECE`` words, which the index holds like documents: postings in piece
order, in stretches that each keep their largest contribution. Every passage of
every document (``PASSAGE`` words, each half overlapping the next, so that any
piece lies in one whole) is a query. Block-max WAND returns all pieces whose
BM25 score reaches the threshold: cursors are kept in order, the pivot is the
first piece at which the terms' largest contributions add up to the threshold,
and the stretches' maxima then decide whether it is scored or skipped. Passages
whose terms cannot add up to the threshold at all have no pivot; that is
decided for all passages of a batch at once before any cursor moves.

A piece's threshold is what its cheapest shingle scores: the least sum of the
weights of the pairs in five words of the piece that follow each other. Scores
are divided by it, so the threshold is 1 for all, and a passage that holds any
whole shingle of a piece retrieves it. Items with a retrieved piece are verified
in the whole document: of the five-word shingles of the question (all but the
last sentence) and of the answer (the last sentence) each, 0.8 or more must
occur in the document. A part shorter than five words is one shingle. Retrieval
loses no document that verification would accept: the longer part of an item of
several pieces has 17 words at least, so of its shingles that are found one lies
within a piece (borders cut 4 each, and 0.2 may be missing), and it lies within
a passage.

One changed word kills five shingles, which a short part does not survive. The
stage for training data (``clean``) therefore also takes an item as held if 0.8
of all its shingles occur, or 0.8 of its question's where that has ``ALONE``
words or more; for that, questions are pieces of their own too. The contract
query keeps to the rule of its SQL.

Statistics (document frequencies, mean length) are those of all pieces. Indexes
of ``BLOCK_PIECES`` pieces at most are sent to all tasks, one at a time: with
more pieces each block is a pass whose result is written before the next block
is sent, so one index is held at any time.

Defined results: null text counts as empty and matches nothing; items of fewer
than two words match nothing, as a single word is no overlap; repeated rows
repeat their result; empty tables give an empty result; extra columns are
ignored or kept as they are, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bytehash as bh
from . import shared as sh

PASSAGE = 64
K1, B = 1.2, 0.75
PIECE = PASSAGE // 2
SHINGLE, SIMILAR = 5, 0.8
#: Words of a question from which it counts without its answer.
ALONE = 10
STRETCH = 32
BLOCK_PIECES = 20_000
_TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")


#: The threshold, less what sums may lose.
ENOUGH = 1 - 1e-9


def tokens(text: str) -> list[bytes]:
    return _TOKEN.findall(text.encode().translate(bh.LOWER.tobytes()))


def _pairs(words: list[bytes]) -> list[int]:
    data, size = b"".join(words), np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(size)
    return bh.windows(bh.spans(np.frombuffer(data, np.uint8), ends - size, ends), 2).tolist()


def _shingles(words: list[bytes]) -> set[bytes]:
    return {b" ".join(words[k : k + SHINGLE]) for k in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def question(text: str) -> str:
    """All sentences but the last."""
    cuts = [m.end() for m in re.finditer(r"[.?!]\s+", text)]
    return text[: cuts[-1]] if cuts else ""


def question_and_answer(text: str) -> list[set[bytes]]:
    """Shingles of all sentences but the last, and of the last."""
    at = len(question(text))
    return [s for s in (_shingles(tokens(text[:at])), _shingles(tokens(text[at:]))) if s]


def pieces(text: str) -> list[list[bytes]]:
    """The item's words in pieces of even length, at most ``PIECE``."""
    words = tokens(text)
    if len(words) < 2:
        return []
    size = -(-len(words) // -(-len(words) // PIECE))
    own = [words[k : k + size] for k in range(0, len(words), size)]
    return [w for w in own if len(w) > 1]


def pieces_of(text: str, near: bool = False) -> tuple[list[list[bytes]], list[set[bytes]]]:
    """An item's pieces and, if ``near``, the sets of shingles of which any suffices."""
    own = pieces(text)
    if not near or not own:
        return own, []
    alone = question(text)
    long = len(tokens(alone)) >= ALONE
    return own + (pieces(alone) if long else []), [_shingles(tokens(text)), *([_shingles(tokens(alone))] if long else [])]


class Index:
    """Inverted index of pieces by term hash, with the maxima that WAND needs.

    stats: number of pieces, their mean length and how many hold a term, over
    all blocks; without, those of the items given.
    """

    def __init__(self, items: list[tuple[int, str]], near: bool = False, stats: tuple[int, float, dict[int, int]] | None = None):
        self.ids, self.whose, docs, self.parts, self.any = [], [], [], [], []
        for k, (item, text) in enumerate(items):
            self.ids.append(item)
            self.parts.append(question_and_answer(text or ""))
            own, any_ = pieces_of(text or "", near)
            self.any.append(any_)
            for words in own:
                self.whose.append(k)
                docs.append(_pairs(words))
        self.n = len(docs)
        lists: dict[int, list[tuple[int, int]]] = {}
        for d, terms in enumerate(docs):
            for t in set(terms):
                lists.setdefault(t, []).append((d, terms.count(t)))
        n, mean, held = stats or (self.n, sum(map(len, docs)) / max(1, self.n), {t: len(x) for t, x in lists.items()})
        self.terms = np.array(sorted(lists), np.uint64)
        self.best, weights, scored = np.zeros(len(lists)), [{} for _ in docs], []
        for t in self.terms.tolist():
            d, tf = (np.array(x) for x in zip(*lists[t], strict=True))
            idf = np.log(1 + (n - held[t] + 0.5) / (held[t] + 0.5))
            length = np.array([len(docs[x]) for x in d])
            scored.append((d, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))))
            for x, w in zip(d.tolist(), scored[-1][1].tolist(), strict=True):
                weights[x][t] = w
        span = SHINGLE - 1  # pairs of a shingle
        need = np.array([min(sum(w[t] for t in set(terms[k : k + span])) for k in range(max(1, len(terms) - span + 1))) for terms, w in zip(docs, weights, strict=True)])
        self.postings = []
        for k, (d, score) in enumerate(scored):
            score = score / need[d]
            peaks = np.maximum.reduceat(score, np.arange(0, len(score), STRETCH))
            self.best[k] = score.max()
            self.postings.append((d.tolist(), score.tolist(), peaks.tolist(), d[np.minimum(np.arange(STRETCH, len(d) + STRETCH, STRETCH), len(d)) - 1].tolist()))

    def search(self, terms: list[int]) -> list[int]:
        """Pieces that reach the threshold for the distinct terms of a passage: block-max WAND."""
        found, end = [], self.n
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]  # item, place in the list, term
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, (item, _, t) in enumerate(cursors):
                if item >= end:
                    break
                total += self.best[t]
                if total >= ENOUGH:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            peak, bound = 0.0, end  # of the stretches that hold the pivot item, and where the first of them ends
            for c in cursors[: pivot + 1]:
                _, _, peaks, ends = self.postings[c[2]]
                s = bisect_left(ends, item, c[1] // STRETCH)
                if s < len(ends):
                    peak += peaks[s]
                    bound = min(bound, ends[s] + 1)
            if peak < ENOUGH:
                bound = min(bound, cursors[pivot + 1][0]) if pivot + 1 < len(cursors) else bound
                target = max(bound, item + 1)
            else:
                if cursors[0][0] == item:
                    if sum(self.postings[t][1][at] for _, at, t in cursors[: pivot + 1]) >= ENOUGH:
                        found.append(item)
                    target = item + 1
                else:
                    target = item
            for c in cursors[: pivot + 1]:
                if c[0] < target:
                    d = self.postings[c[2]][0]
                    c[1] = bisect_left(d, target, c[1])
                    c[0] = d[c[1]] if c[1] < len(d) else end
            cursors = [c for c in cursors if c[0] < end]
        return found


def _candidates(index: Index, term: np.ndarray, first: np.ndarray) -> dict[int, set[int]]:
    """term: each word's pair's place in the index or -1; first: offsets of documents. Document to retrieved pieces."""
    weight = np.where(term >= 0, index.best[np.maximum(term, 0)], 0.0) if len(index.terms) else np.zeros(len(term))
    before = np.r_[0.0, np.cumsum(weight)]
    n = np.diff(first)
    step = PASSAGE // 2
    count = np.where(n > 0, np.maximum(1, -(-(n - PASSAGE) // step) + 1), 0)
    doc = np.repeat(np.arange(len(n)), count)
    a = first[doc] + step * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
    z = np.minimum(a + PASSAGE, first[doc + 1])
    able = np.flatnonzero(before[z] - before[a] >= ENOUGH)
    out: dict[int, set[int]] = {}
    for k in able.tolist():
        own = np.unique(term[a[k] : z[k] - 1])
        own = own[own >= 0]
        if index.best[own].sum() >= ENOUGH and (got := index.search(own.tolist())):
            out.setdefault(int(doc[k]), set()).update(got)
    return out


def _held(parts: list[set[bytes]], there: set[bytes], how) -> bool:
    return how(len(p & there) >= SIMILAR * len(p) for p in parts)


def _finder(handle, at_text: int):
    def run(batches):
        import pyarrow as pa

        index = handle.value
        for b in (x for whole in batches for x in sh.slices(whole, at_text)):
            found: list[list[int]] = [[] for _ in range(b.num_rows)]
            body = b.column(at_text).cast(pa.binary()).fill_null(b"")
            data, offsets = sh.bodies(pa.table({"body": body}))
            data = bh.LOWER[data]
            starts, ends, first = bh.word_bounds(data, offsets, bh.ALNUM)
            h = bh.windows(bh.spans(data, starts, ends), 2)
            if len(h) and len(index.terms):
                at = np.minimum(np.searchsorted(index.terms, h), len(index.terms) - 1)
                term = np.full(len(starts), -1)
                term[:-1] = np.where((index.terms[at] == h) & bh.within(first, 2, len(starts)), at, -1)
                for d, items in _candidates(index, term, first).items():
                    words = tokens(body[d].as_py().decode("utf-8", "replace"))
                    there = _shingles(words) | {b" ".join(words[k : k + m]) for m in range(1, SHINGLE) for k in range(len(words) - m + 1)}
                    found[d] = sorted({index.ids[i] for i in {index.whose[x] for x in items} if _held(index.parts[i], there, all) or _held(index.any[i], there, any)})
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.list_(pa.int64()))], [str(k) for k in range(b.num_columns + 1)])

    return run


def _counter(near: bool):
    """Pieces and their lengths under term null, then the pieces that hold each term."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            docs = [_pairs(w) for x in b.column("text") for w in pieces_of(x.as_py() or "", near)[0]]
            terms, n = np.unique(np.array([t for d in docs for t in set(d)], np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([None, *terms.view(np.int64).tolist()], pa.int64()), pa.array([len(docs), *n.tolist()], pa.int64()), pa.array([sum(map(len, docs)), *([0] * len(n))], pa.int64())], ["term", "n", "pairs"])

    return run


def item_blocks(items: DataFrame, id_col: str, text: str, block: int = BLOCK_PIECES, near: bool = False):
    """Indexes of about ``block`` pieces each, and whether it is the last. Items stream through the driver, one block held at a time."""
    spark = items.sparkSession
    counted = sh.cut(items.select(F.col(text).alias("text")).mapInArrow(_counter(near), "term long, n long, pairs long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("pairs").alias("pairs")))
    n, pairs = next(((r.n, r.pairs) for r in counted.where("term IS NULL").collect()), (0, 0))

    def index(held):
        terms = sorted({t for _, x in held for w in pieces_of(x or "", near)[0] for t in _pairs(w)})
        own = spark.createDataFrame([(t - (1 << 64) if t >> 63 else t,) for t in terms], "term long")
        known = {r.term % (1 << 64): r.n for r in counted.join(own, "term", "left_semi").collect()}  # of one block
        return Index(held, near, (n, pairs / max(1, n), known))

    held, size, left = [], 0, n
    for row in items.select(id_col, text).orderBy(id_col, text).toLocalIterator():
        own = len(pieces_of(row[1] or "", near)[0])
        if own:
            held.append((row[0], row[1]))
            size, left = size + own, left - own
        if held and (size >= block or not left):
            yield Index(held, near) if size == n else index(held), not left
            held, size = [], 0


def with_items(df: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", near: bool = False, block: int = BLOCK_PIECES) -> tuple[DataFrame, str]:
    """``df`` with a column, named second: ascending ids of the test items it holds, near copies and questions alone too if ``near``."""
    spark, columns = df.sparkSession, df.columns
    name, added = sh.fresh("items", columns), sh.fresh("more_items", [*columns, sh.fresh("items", columns)])
    empty = F.array().cast("array<bigint>")
    out = df.withColumn(name, empty)
    for index, last in item_blocks(items, item_id, item_text, block, near):
        handle = spark.sparkContext.broadcast(index)
        schema = T.StructType([*out.schema.fields, T.StructField(added, T.ArrayType(T.LongType()))])
        out = out.mapInArrow(_finder(handle, columns.index(text)), schema)
        out = out.select(*(F.col(f"`{c}`") for c in columns), F.array_sort(F.array_union(F.col(name), F.coalesce(F.col(added), empty))).alias(name))
        if not last:
            out = sh.cut(out)
            handle.destroy()
    return out, name


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_items, item_ids) of every document that holds a test item."""
    own, found = with_items(df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")), items)
    return own.where(F.size(found) > 0).select("doc_id", F.size(found).cast("long").alias("n_items"), F.concat_ws(",", F.col(found).cast("array<string>")).alias("item_ids"))


def clean(df: DataFrame, items: DataFrame, text: str = "text", block: int = BLOCK_PIECES) -> DataFrame:
    """The rows of ``df`` that hold no test item, no near copy of one and no question alone."""
    own, found = with_items(df, items, text, near=True, block=block)
    return own.where(F.size(found) == 0).drop(found)


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` against all ``benchmark`` items."""
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: What verification alone finds among all pairs: retrieval must lose none of them.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark),
h AS (SELECT *, regexp_extract(text, '(?s)^.*[.?!]\s+', 0) AS head FROM i),
p AS (SELECT iid, item_id, part, regexp_extract_all(own, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (SELECT iid, item_id, 0 AS part, head AS own FROM h UNION ALL SELECT iid, item_id, 1, substr(text, length(head) + 1) FROM h)),
n AS (SELECT iid FROM p GROUP BY iid HAVING sum(len(w)) > 1),
s AS (SELECT DISTINCT iid, item_id, part, least(len(w), 5) AS size, array_to_string(w[j:j + 4], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS j FROM p WHERE len(w) > 0) WHERE iid IN (SELECT iid FROM n)),
f AS (SELECT iid, item_id, part, count(*) AS need FROM s GROUP BY ALL),
z AS (SELECT DISTINCT size FROM s),
u AS (SELECT rid, doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x FROM d),
v AS (SELECT rid, doc_id, x, x || ' ' || lead(x, 1) OVER q AS x2, lead(x, 2) OVER q AS x3, lead(x, 3) OVER q AS x4, lead(x, 4) OVER q AS x5 FROM u WINDOW q AS (PARTITION BY rid ORDER BY j)),
t AS (SELECT DISTINCT rid, doc_id, size, g FROM (SELECT rid, doc_id, size, CASE size WHEN 1 THEN x WHEN 2 THEN x2 WHEN 3 THEN x2 || ' ' || x3 WHEN 4 THEN x2 || ' ' || x3 || ' ' || x4 ELSE x2 || ' ' || x3 || ' ' || x4 || ' ' || x5 END AS g FROM v, z) WHERE g IS NOT NULL),
o AS (SELECT rid, doc_id, s.iid, s.part, count(*) AS have FROM t JOIN s ON t.g = s.g AND t.size = s.size GROUP BY ALL),
e AS (SELECT iid, count(*) AS parts FROM f GROUP BY iid),
c AS (SELECT rid, doc_id, f.iid, f.item_id, count(*) AS parts FROM o JOIN f ON o.iid = f.iid AND o.part = f.part WHERE have >= 0.8 * need GROUP BY ALL),
y AS (SELECT c.* FROM c JOIN e ON c.iid = e.iid AND c.parts = e.parts)
SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS item_ids FROM y GROUP BY rid, doc_id
"""

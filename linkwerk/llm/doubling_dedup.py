"""Removal of repeated word windows by level-wise doubling.

Windows that occur once at a short length cannot be part of anything longer
that repeats, so only windows repeated at one length are extended to twice that
length. Here a level of length g looks at the g-word grams inside each
candidate window of the final length; of those it asks the corpus about one,
the gram with the smallest hash, since equal windows agree on it (about 2 in
w - g words are asked about). Candidates whose gram occurs once are dropped,
the rest go on to the next level, until the gram is the whole window. There all
candidates are asked about by a digest of 128 bits, in two halves of which each
must occur again; those that survive are the repeats.

Each level is one hash exchange between parts of the corpus (see shared): the
text is dealt once, a part sends each hash once, and answers are single bits.

Defined results: null text counts as empty; a repeated row counts as another
document; documents shorter than the window keep all; an empty table gives an
empty result; extra columns are ignored. Ids are integers or null. Rows equal in
id and text are counted before they are dealt if there are very many. Digests are
keyed anew in each run, and not polynomial: no text can be made to collide. With
n candidate windows at the last level, about n * (n / 2^64)^2 of those that do
not repeat are expected to be taken for repeats, and a window whose words differ
but have equal 64-bit digests counts as equal.
"""

from __future__ import annotations

import hashlib
import os
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytehash as bh
from . import shared as sh

WINDOW = 35
FIRST = 9
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, copies long"


def levels(window: int = WINDOW, first: int = FIRST) -> list[int]:
    """first, twice that, ... and last the window itself."""
    out = []
    while first < window:
        out.append(first)
        first *= 2
    return [*out, window]


class _Part:
    """The words of a part and which windows are still candidates."""

    def __init__(self, table, window: int, n_buckets: int, key: int):
        self.data, self.offsets = sh.bodies(table)
        self.starts, self.ends, self.first = bh.word_bounds(self.data, self.offsets)
        self.hashes = bh.spans(self.data, self.starts, self.ends)
        self.window, self.n_buckets, self.key = window, n_buckets, key
        self.wanted = bh.within(self.first, window, len(self.hashes))
        self.asked = np.zeros(0, np.uint64)

    def ask(self, gram: int) -> tuple[np.ndarray, np.ndarray]:
        self.asked, chosen = bh.anchors(bh.windows(self.hashes, gram), gram, self.window, self.wanted)
        return bh.distinct(bh.mix(bh.windows(self.hashes, gram)[chosen]))

    def ask_whole(self):
        """For each half of the digest: of each window, and the distinct ones of the candidates."""
        words = bh.word_digests(self.data, self.starts, self.ends, self.key)
        for half in (1, 2):
            asked = bh.digests(words, self.window, self.key + half)
            yield asked, bh.distinct(asked[self.wanted])

    def leave(self, asked: np.ndarray, again: np.ndarray) -> None:
        """Drops the candidates whose gram is not in ``again``."""
        if not len(again):
            self.wanted[:] = False
            return
        at = np.searchsorted(again, asked)
        self.wanted &= again[np.minimum(at, len(again) - 1)] == asked

    def narrow(self, grams: list[int], replies) -> _Part:
        for level, gram in enumerate(grams):
            sent, _ = self.ask(gram)
            self.leave(self.asked, sent[sh.bits_of(replies, level, sent, self.n_buckets)])
        return self


def _asker(level: int, grams: list[int], window: int, n_buckets: int, key: int):
    def ask(docs, replies=None):
        import pyarrow as pa

        if not docs.num_rows:
            return sh.requests(0, level, np.zeros(0, np.uint64), np.zeros(0, bool), n_buckets)
        part_no = docs.column("part")[0].as_py()
        part = _Part(sh.documents(docs)[0], window, n_buckets, key).narrow(grams[:level], replies)
        if level < len(grams):
            return sh.requests(part_no, level, *part.ask(grams[level]), n_buckets)
        return pa.concat_tables([sh.requests(part_no, level + k, *sent, n_buckets) for k, (_, sent) in enumerate(part.ask_whole())])

    return (lambda docs: ask(docs)) if level == 0 else (lambda docs, replies: ask(docs, replies))


def _finisher(grams: list[int], window: int, n_buckets: int, key: int, with_text: bool):
    def finish(docs, replies):
        import pyarrow as pa

        docs, own_row = sh.documents(docs)
        part = _Part(docs, window, n_buckets, key).narrow(grams, replies)
        for k, (asked, (sent, _)) in enumerate(list(part.ask_whole())):
            part.leave(asked, sent[sh.bits_of(replies, len(grams) + k, sent, n_buckets)])
        gone = bh.covered(np.flatnonzero(part.wanted), window, len(part.hashes))
        removed = np.diff(np.r_[0, np.cumsum(gone)][part.first])
        n_words, sums, texts = np.diff(part.first), [], []
        for k, body in enumerate(docs.column("body")):
            if not own_row[k]:
                continue
            own = body.as_py().split()
            if removed[k]:
                own = compress(own, ~gone[part.first[k] : part.first[k + 1]])
            kept = b" ".join(own)
            sums.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept.decode("utf-8", "replace") if with_text else None)
        docs = docs.filter(own_row)
        return pa.table({"doc_id": docs.column("id").cast(pa.int64()), "n_words": pa.array(n_words[own_row], pa.int64()), "n_removed": pa.array(removed[own_row], pa.int64()), "kept_sha256": pa.array(sums, pa.string()), "kept": pa.array(texts, pa.string()), "copies": docs.column("copies").cast(pa.int64())})

    return finish


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW, first: int = FIRST, part_bytes: int = sh.PART_BYTES, with_text: bool = True) -> DataFrame:
    """Per document (doc_id, n_words, n_removed, kept_sha256, kept): words outside every repeated window."""
    n_bytes, equal = sh.text_bytes(df, id_col, text)
    n_buckets = sh.bucket_count(n_bytes / 8)
    grams, key = levels(window, first)[:-1], int.from_bytes(os.urandom(7))
    parts = sh.in_parts(df, id_col, text, sh.part_count(n_bytes, part_bytes), equal).groupBy("part")
    replies: DataFrame | None = None
    for level in range(len(grams) + 1):
        ask = _asker(level, grams, window, n_buckets, key)
        asked = parts.applyInArrow(ask, sh.REQUEST) if replies is None else parts.cogroup(replies.groupBy("part")).applyInArrow(ask, sh.REQUEST)
        told = sh.answers(asked)
        replies = told if replies is None else replies.unionByName(told)
    return sh.each_copy(parts.cogroup(replies.groupBy("part")).applyInArrow(_finisher(grams, window, n_buckets, key, with_text), RESULT), equal)


def op5_doubling_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: 35-word windows of ``documents``."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False).select("doc_id", F.col("n_words"), "n_removed", "kept_sha256")


SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT rid, doc_id, w, unnest(range(1, greatest(len(w) - 33, 1))) AS i FROM d),
g AS (SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM p),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY h) AS c FROM g) WHERE c > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS j FROM r),
t AS (SELECT d.rid, d.doc_id, len(d.w) AS n, unnest(range(1, len(d.w) + 1)) AS j, unnest(d.w) AS word FROM d),
k AS (SELECT t.rid, count(*) FILTER (WHERE gone.j IS NOT NULL) AS n_removed, string_agg(t.word, ' ' ORDER BY t.j) FILTER (WHERE gone.j IS NULL) AS kept
      FROM t LEFT JOIN gone ON t.rid = gone.rid AND t.j = gone.j GROUP BY t.rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid
"""

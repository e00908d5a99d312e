"""Pieces that several corpus operators need: checkpoints, parts, hash exchange.

*Parts.* Operators that must ask the rest of the corpus about what they read
deal documents into parts by a hash of their content. A part holds about
``PART_BYTES`` of text, its content is the same whenever it is computed again
(after an executor is lost, or in a later pass), and the shuffle that deals it
is written once: later passes of one query reuse the exchange.

*Exchange.* A part sends, per bucket of the hash space, its sorted distinct
64-bit hashes. A bucket merges what all parts sent and answers each part in the
order of its request, so that answers need no keys. A hash is sent once per
part however often it occurs there, which is what bounds a hot one.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import cut, fresh, numbered, run_count, tidy  # noqa: F401

#: Bytes of text in a part: a worker holds a few times as much.
PART_BYTES = 4_000_000
#: Distinct hashes that a bucket merges at once, about.
BUCKET_HASHES = 2_000_000
#: Equal rows up to which they are dealt one by one.
EQUAL = 256
#: Bytes of text that a worker looks at at once, about, where rows are independent.
SLICE = 4_000_000
#: Words are separated by these six bytes, in every operator that splits words.
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for the row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only, unlike lower()."""
    return F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(df: DataFrame, id_col: str, text: str) -> tuple[int, bool]:
    """Bytes of all texts, and whether some row occurs more often than a part may hold it."""
    row = F.xxhash64(F.col(id_col), F.coalesce(F.col(text), F.lit("")))
    each = df.groupBy(row.alias("row")).agg(F.count("*").alias("n"), F.sum(F.octet_length(text)).alias("size"))
    size, most = each.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return size, most > EQUAL


def part_count(n_bytes: int, part_bytes: int = PART_BYTES) -> int:
    return max(1, math.ceil(n_bytes / part_bytes))


def bucket_count(n_hashes: float) -> int:
    return max(1, math.ceil(n_hashes / BUCKET_HASHES))


def in_parts(df: DataFrame, id_col: str, text: str, n_parts: int, equal: bool) -> DataFrame:
    """(part, id, body, copies): body is the text as UTF-8, null as empty; the part follows from both.

    With ``equal``, rows equal in id and text are counted, before they are
    dealt, and go as one row with their number.
    """
    own = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    own = own.groupBy("id", "body").agg(F.count("*").alias("copies")) if equal else own.withColumn("copies", F.lit(1).cast("long"))
    part = F.pmod(F.xxhash64("id", "body"), F.lit(n_parts)).cast("int")
    return own.select(part.alias("part"), "id", F.col("body").cast("binary").alias("body"), "copies")


def each_copy(df: DataFrame, equal: bool) -> DataFrame:
    """``df`` without column copies, each row as often as that says."""
    if equal:
        df = df.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return df.drop("copies")


def documents(table):
    """The rows of a part in an order that any run repeats, those that stand for several twice, and which come first.

    Twice is enough for whatever they hold to occur again.
    """
    table = ordered(table, "id", "body")
    again = np.minimum(table.column("copies").to_numpy(), 2)
    at = np.repeat(np.arange(table.num_rows), again)
    first = np.r_[True, at[1:] != at[:-1]] if len(at) else np.zeros(0, bool)
    return (table if (again == 1).all() else table.take(at)), first


def buckets_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each bucket begins in sorted ``hashes``: n + 1 offsets."""
    which = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    return np.searchsorted(which, np.arange(n + 1, dtype=np.uint64))


def ordered(table, *keys: str):
    """The rows of an Arrow table in an order that any run of the query repeats."""
    return table.sort_by([(k, "ascending") for k in keys]) if table.num_rows > 1 else table


def give_back() -> None:
    """Returns what earlier groups left in this worker's allocators to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):  # GNU only
        libc.malloc_trim(0)


def bodies(table) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of column body after each other, and where each row's begin: n + 1 offsets."""
    import pyarrow as pa

    give_back()
    column = table.column("body").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    every = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return every, at - at[0]


def small_batches(spark) -> None:
    """Arrow batches of 2,000 rows and 8 MB at most, in this session from now on.

    Workers and the JVM each hold a batch of texts or of sets more than once;
    the usual 10,000 rows have no bound in bytes.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def slices(batch, column: int | str):
    """The rows of an Arrow batch a few at a time, so that ``column`` has ``SLICE`` bytes at most, or one row."""
    import pyarrow.compute as pc

    give_back()
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, before + SLICE, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def merge_counts(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct hashes of all requests, their total counts, and for each request its totals in its own order."""
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    if not len(every):
        return every, np.zeros(0, np.int64), [np.zeros(0, np.int64) for _ in hashes]
    order = np.argsort(every, kind="stable")
    there = every[order]
    first = np.flatnonzero(np.r_[True, there[1:] != there[:-1]])
    total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), first)
    back = np.empty(len(every), np.int64)
    back[order] = np.repeat(total, np.diff(np.r_[first, len(every)]))
    return there[first], total, np.split(back, np.cumsum([len(x) for x in hashes])[:-1])


REQUEST = "bucket int, part int, level int, hashes binary, often binary"
REPLY = "part int, level int, bucket int, bits binary"


def requests(part: int, level: int, hashes: np.ndarray, often: np.ndarray, n_buckets: int):
    """Arrow table of REQUEST. hashes: sorted, distinct; often: whether each occurs twice or more in the part."""
    import pyarrow as pa

    edges = buckets_of(hashes, n_buckets)
    full = np.flatnonzero(np.diff(edges))
    cut_ = [(edges[b], edges[b + 1]) for b in full]
    return pa.table(
        {
            "bucket": pa.array(full.astype(np.int32)),
            "part": pa.array(np.full(len(full), part, np.int32)),
            "level": pa.array(np.full(len(full), level, np.int32)),
            "hashes": pa.array([hashes[a:z].tobytes() for a, z in cut_], pa.binary()),
            "often": pa.array([np.packbits(often[a:z]).tobytes() for a, z in cut_], pa.binary()),
        }
    )


def repeated(table):
    """Answers every request of a bucket with a bit for each hash: it occurs twice or more in the corpus."""
    import pyarrow as pa

    give_back()
    asked = [np.frombuffer(x, np.uint64) for x in table.column("hashes").to_pylist()]
    counts = [1 + np.unpackbits(np.frombuffer(x, np.uint8), count=len(h)) for x, h in zip(table.column("often").to_pylist(), asked, strict=True)]
    _, _, back = merge_counts(asked, counts)
    return pa.table(
        {
            "part": table.column("part").cast(pa.int32()),
            "level": table.column("level").cast(pa.int32()),
            "bucket": table.column("bucket").cast(pa.int32()),
            "bits": pa.array([np.packbits(x > 1).tobytes() for x in back], pa.binary()),
        }
    )


def answers(asked: DataFrame) -> DataFrame:
    return asked.groupBy("bucket").applyInArrow(repeated, REPLY)


def bits_of(replies, level: int, hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The answers to a part's request at ``level``, as a boolean for each of its hashes."""
    edges, out = buckets_of(hashes, n_buckets), np.zeros(len(hashes), bool)
    for lv, b, bits in zip(*(replies.column(c).to_pylist() for c in ("level", "bucket", "bits")), strict=True):
        if lv == level:
            out[edges[b] : edges[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=edges[b + 1] - edges[b]).astype(bool)
    return out

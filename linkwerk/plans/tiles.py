"""Pairs of records with similar names, compared group by group in tiles.

The similarity of two names depends on their words alone, and words recur. So
groups are dealt whole to Python, large ones in tiles of two bands of rows; each
tile compares its distinct words once (``ratio_table``) and looks all its pairs
up there. Every pair of a group is in exactly one tile. Only pairs at or above
``least`` return, with the columns of both records; None returns all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import ratio_table, ratios, rounded

#: Rows of a band; of a band where a few rows meet many.
BAND, NARROW, WIDE = 2048, 512, 8192
#: Groups of so few rows share a table of words; pairs looked up at once; pairs of a task and of a batch returned, about.
FEW, AT_ONCE, TASK, BATCH = 24, 1 << 17, 1 << 21, 1 << 17
_OWN = ["tile_group", "tile_lo", "tile_hi", "tile_side"]


def _group(keys: list[str]) -> Column:
    """One text for the keys, which but for the last are never null; only the first may hold any characters."""
    return F.concat_ws("\x00", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))


def _band(n: Column) -> Column:
    return F.pmod(F.xxhash64("row_id"), n).cast("int")


def _bands(n: Column, rows: int) -> Column:
    return F.greatest(F.ceil(n / rows), F.lit(1)).cast("int")


def _up_to(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), n - 1))


def within(df: DataFrame, keys: list[str], keep: list[str], least: float | None = None, digits: int | None = None) -> DataFrame:
    """Pairs a before b of rows that agree on ``keys``: ``keep`` of both, normal_score, swapped_score and is_swapped."""
    rows = df.where("row_id is not null").withColumn("tile_group", _group(keys))
    sizes = rows.groupBy("tile_group").agg(F.count("*").alias("n")).where("n > 1")
    total, work = sizes.agg(F.sum("n"), F.sum(F.col("n").cast("double") * F.col("n") / 2)).first()
    sizes = sizes.select("tile_group", _bands(F.col("n"), BAND).alias("bands"))
    rows = rows.join(sizes, "tile_group").withColumn("band", _band(F.col("bands"))).withColumn("other", _up_to(F.col("bands")))
    side = F.when(F.col("band") == F.col("other"), 0).when(F.col("band") < F.col("other"), 1).otherwise(2)
    dealt = rows.withColumns({"tile_lo": F.least("band", "other"), "tile_hi": F.greatest("band", "other"), "tile_side": side})
    return _compared(dealt, total or 0, work or 0.0, keep, least, digits)


def across(left: DataFrame, right: DataFrame, keys: list[str], keep: list[str], least: float | None = None, digits: int | None = None) -> DataFrame:
    """The same for pairs of one row of ``left``, of which there are few, and one of ``right``."""
    rows = left.withColumn("tile_side", F.lit(1)).unionByName(right.withColumn("tile_side", F.lit(2)))
    rows = rows.where("row_id is not null").withColumn("tile_group", _group(keys))
    is_left = F.col("tile_side") == 1
    sizes = rows.groupBy("tile_group").agg(F.count_if(is_left).alias("l"), F.count_if(~is_left).alias("r")).where("l > 0 and r > 0")
    total, work = sizes.agg(F.sum(F.col("l") + F.col("r")), F.sum(F.col("l").cast("double") * F.col("r"))).first()
    sizes = sizes.select("tile_group", _bands(F.col("l"), NARROW).alias("ls"), _bands(F.col("r"), WIDE).alias("rs"))
    rows = rows.join(sizes, "tile_group")
    rows = rows.withColumn("band", _band(F.when(is_left, F.col("ls")).otherwise(F.col("rs")))).withColumn("other", _up_to(F.when(is_left, F.col("rs")).otherwise(F.col("ls"))))
    of = lambda own, other: F.when(is_left, F.col(own)).otherwise(F.col(other))
    return _compared(rows.withColumns({"tile_lo": of("band", "other"), "tile_hi": of("other", "band")}), total or 0, work or 0.0, keep, least, digits)


def _compared(dealt: DataFrame, total: int, work: float, keep: list[str], least: float | None, digits: int | None) -> DataFrame:
    columns = list(dict.fromkeys(["row_id", "v", "n", *keep]))
    fields = [T.StructField(f"{s}_{c}", dealt.schema[c].dataType) for s in "ab" for c in keep]
    schema = T.StructType([*fields, T.StructField("normal_score", T.DoubleType()), T.StructField("swapped_score", T.DoubleType()), T.StructField("is_swapped", T.BooleanType())])
    n = int(max(1, min(20_000, max(-(-work // TASK), -(-total // 200_000)))))
    by = _OWN[:3]
    return dealt.select(*_OWN, *columns).repartition(n, *by).sortWithinPartitions(*by).mapInArrow(partial(_matches, keep=keep, least=least, digits=digits), schema)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole tiles, and where each tile begins; a tile's rows are consecutive."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        starts = _starts(table)
        yield table.slice(0, starts[-1]), starts[:-1]
        held = table.slice(starts[-1])
    if held is not None:
        yield held.combine_chunks(), np.array([0])


def _starts(table: pa.Table) -> np.ndarray:
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for c in _OWN[:3]:
        col = table.column(c).combine_chunks()
        new[1:] |= pc.not_equal(col[1:], col[:-1]).to_numpy(zero_copy_only=False)
    return np.flatnonzero(new)


def _codes(table: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of both names, and each row's two."""
    text = lambda c: pc.fill_null(table.column(c), "").cast(pa.string())
    both = pa.chunked_array([*text("v").chunks, *text("n").chunks], pa.string()).combine_chunks().dictionary_encode()
    codes = both.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return both.dictionary.to_pylist(), codes[: table.num_rows], codes[table.num_rows :]


def _matches(batches: Iterator[pa.RecordBatch], keep: list[str], least: float | None, digits: int | None) -> Iterator[pa.RecordBatch]:
    for table, starts in _whole(batches):
        if not table.num_rows:
            continue
        ids, sides = (table.column(c).to_numpy() for c in ("row_id", "tile_side"))
        held, n = [], 0
        for found in _pairs(table, starts, ids, sides, least):
            held.append(found)
            n += len(found[0])
            if n >= BATCH:
                yield from _returned(table, ids, held, keep, digits)
                held, n = [], 0
        if n:
            yield from _returned(table, ids, held, keep, digits)


def _pairs(table: pa.Table, starts: np.ndarray, ids: np.ndarray, sides: np.ndarray, least: float | None) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of pairs, and both scores, a piece at a time."""
    words, v, n = _codes(table)
    few: list[np.ndarray] = []
    for start, end in zip(starts, [*starts[1:], table.num_rows], strict=True):
        rows = np.arange(start, end)
        if sides[start] == 0:
            if len(rows) <= FEW:
                few.append(start + np.stack(np.triu_indices(len(rows), 1)))
                continue
            rows = rows[np.argsort(ids[rows], kind="stable")]
            yield from _tile(rows, rows, True, words, v, n, ids, least)
        else:
            yield from _tile(rows[sides[rows] == 1], rows[sides[rows] == 2], False, words, v, n, ids, least)
    if few:
        l, r = np.concatenate(few, axis=1)
        for at in range(0, len(l), AT_ONCE):
            yield _some(l[at : at + AT_ONCE], r[at : at + AT_ONCE], words, v, n, least)


def _some(l: np.ndarray, r: np.ndarray, words: list[str], v: np.ndarray, n: np.ndarray, least: float | None) -> tuple[np.ndarray, ...]:
    of = [(v[l], v[r]), (n[l], n[r]), (v[l], n[r]), (n[l], v[r])]
    code, place = np.unique(np.concatenate([x * len(words) + y for x, y in of]), return_inverse=True)
    known = ratios([words[k] for k in code // len(words)], [words[k] for k in code % len(words)])[place].reshape(4, -1)
    normal, swapped = (known[0] + known[1]) / 2, (known[2] + known[3]) / 2
    if least is None:
        return l, r, normal, swapped
    k = np.flatnonzero(np.maximum(normal, swapped) >= least)
    return l[k], r[k], normal[k], swapped[k]


def _tile(left: np.ndarray, right: np.ndarray, same: bool, words: list[str], v: np.ndarray, n: np.ndarray, ids: np.ndarray, least: float | None) -> Iterator[tuple[np.ndarray, ...]]:
    """All pairs of ``left`` and ``right``; if they are the ``same``, sorted by id, each pair once."""
    if not len(left) or not len(right):
        return

    def vocabulary(rows: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        code, place = np.unique(np.concatenate([v[rows], n[rows]]), return_inverse=True)
        return [words[k] for k in code], place[: len(rows)], place[len(rows) :]

    lw, lv, ln = vocabulary(left)
    rw, rv, rn = (lw, lv, ln) if same else vocabulary(right)
    score = ratio_table(lw, rw)
    step = max(1, AT_ONCE // len(right))
    for at in range(0, len(left), step):
        first = at if same else 0
        k, fv, fn = slice(at, at + step), rv[first:], rn[first:]
        of_v, of_n = score[lv[k]], score[ln[k]]
        normal = np.take(of_v, fv, axis=1)
        normal += np.take(of_n, fn, axis=1)
        normal /= 2
        swapped = np.take(of_v, fn, axis=1)
        swapped += np.take(of_n, fv, axis=1)
        swapped /= 2
        if same:
            ok = ids[left[k]][:, None] < ids[right[first:]][None, :]
            if least is not None:
                ok &= np.maximum(normal, swapped) >= least
        elif least is not None:
            ok = np.maximum(normal, swapped) >= least
        else:
            ok = np.ones(normal.shape, bool)
        flat = np.flatnonzero(ok)
        i, j = np.divmod(flat, len(fv))
        yield left[at + i], right[first + j], normal.ravel()[flat], swapped.ravel()[flat]


def _returned(table: pa.Table, ids: np.ndarray, held: list[tuple[np.ndarray, ...]], keep: list[str], digits: int | None) -> Iterator[pa.RecordBatch]:
    l, r, normal, swapped = (np.concatenate(x) for x in zip(*held, strict=True))
    if (ids[l] == ids[r]).any():  # repeated ids are no pair
        l, r, normal, swapped = (x[ids[l] != ids[r]] for x in (l, r, normal, swapped))
    turned = ids[l] > ids[r]
    a, b = np.where(turned, r, l), np.where(turned, l, r)
    scores = [normal, swapped] if digits is None else [rounded(normal, digits), rounded(swapped, digits)]
    columns = [pa.array(ids[x]) if c == "row_id" else table.column(c).combine_chunks().take(pa.array(x)) for x in (a, b) for c in keep]
    names = [f"{s}_{c}" for s in "ab" for c in keep]
    yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, scores), pa.array(swapped > normal)], names=[*names, "normal_score", "swapped_score", "is_swapped"])

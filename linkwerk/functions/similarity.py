"""Normalised Indel similarity of two strings, 0 to 1."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, a word of bits at a time."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & where.get(ch, 0)
        row = (row + hit | row - hit) & full
    return (row ^ full).bit_count()


def ratio(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    total = len(a) + len(b)
    return (1.0 - (total - 2 * lcs(a, b)) / total) * 100.0 / 100.0


def ratios(a: list[str | None], b: list[str | None]) -> np.ndarray:
    """ratio() of each pair: the same bit steps for all pairs at once; strings over 64 letters one by one."""
    out = np.zeros(len(a))
    size = np.array([(len(x or ""), len(y or "")) for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    short = np.flatnonzero((size.min(axis=1) > 0) & (size.max(axis=1) <= 64))
    for at in range(0, len(short), 1 << 14):
        k = short[at : at + (1 << 14)]
        n, m = size[k].T
        letters = [np.array([x[i] for i in k], dtype="U64").view(np.uint32).reshape(len(k), 64) for x in (a, b)]
        full = np.where(n < 64, (np.uint64(1) << (n % 64).astype(np.uint64)) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
        row = full.copy()
        for j in range(int(m.max())):
            same = letters[0] == np.where(j < m, letters[1][:, j], 0xFFFFFFFF)[:, None]
            hit = row & np.packbits(same, axis=1, bitorder="little").view(np.uint64)[:, 0]
            row = (row + hit | row - hit) & full
        total = n + m
        out[k] = (1.0 - (total - 2 * np.bitwise_count(row ^ full).astype(np.int64)) / total) * 100.0 / 100.0
    for k in np.flatnonzero((size.min(axis=1) > 0) & (size.max(axis=1) > 64)):
        out[k] = ratio(a[k], b[k])
    return out


def ratio_table(a: list[str], b: list[str]) -> np.ndarray:
    """ratio() of each of ``a`` with each of ``b``, in rows and columns; strings over 64 letters one by one."""
    out = np.zeros((len(a), len(b)))
    size = [np.array([len(x) for x in s], np.int64) for s in (a, b)]
    rows, columns = (np.flatnonzero((n > 0) & (n <= 64)) for n in size)
    if len(rows) and len(columns):
        columns = columns[np.argsort(-size[1][columns], kind="stable")]  # the longest first: later steps take fewer
        n, m = size[0][rows], size[1][columns]
        letters = lambda s, at: np.array([s[k] for k in at], dtype="U64").view(np.uint32).reshape(len(at), 64)
        la, lb = letters(a, rows), letters(b, columns)[:, : m[0]]
        alphabet, code = np.unique(lb, return_inverse=True)
        code = np.ascontiguousarray(code.reshape(lb.shape).T)
        where = np.zeros((len(rows), len(alphabet)), np.uint64)
        for i in range(int(n.max())):
            at = np.minimum(np.searchsorted(alphabet, la[:, i]), len(alphabet) - 1)
            k = np.flatnonzero((alphabet[at] == la[:, i]) & (i < n))
            where[k, at[k]] |= np.uint64(1 << i)
        full = np.where(n < 64, (np.uint64(1) << (n % 64).astype(np.uint64)) - np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF))
        live = [int(np.searchsorted(-m, -j, side="left")) for j in range(int(m[0]))]  # columns of over j letters
        step = max(1, (1 << 15) // len(columns))
        for at in range(0, len(rows), step):
            k = slice(at, at + step)
            row = np.repeat(full[k, None], len(columns), axis=1)
            for j, wide in enumerate(live):
                part = row[:, :wide]
                hit = np.take(where[k], code[j, :wide], axis=1)
                hit &= part
                less = part - hit
                part += hit
                part |= less
            total = n[k, None] + m
            same = np.bitwise_count((row ^ full[k, None]) & full[k, None]).astype(np.int64)
            out[rows[k, None], columns] = (1.0 - (total - 2 * same) / total) * 100.0 / 100.0
    for i in np.flatnonzero(size[0] > 64):
        out[i] = [ratio(a[i], y) for y in b]
    for j in np.flatnonzero(size[1] > 64):
        out[:, j] = [ratio(x, b[j]) for x in a]
    return out


def rounded(x: np.ndarray, digits: int) -> np.ndarray:
    """As round() of Spark: halves, of the shortest decimal, go up."""
    scaled = x * 10.0**digits
    whole = np.rint(scaled)
    out = whole / 10.0**digits
    for k in np.flatnonzero(np.abs(np.abs(scaled - whole) - 0.5) < 1e-5):
        out[k] = float(Decimal(repr(float(x[k]))).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))
    return out


@F.pandas_udf(T.DoubleType())
def indel(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(ratios(a.tolist(), b.tolist()))


def indel_native(a: Column, b: Column) -> Column:
    """The same without Python: one row of the table per letter. Slower; a cross-check."""
    codes = F.transform(F.split(b, ""), lambda c: c)

    def step(row: Column, ch: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), F.size(codes)),
            F.array(F.lit(0)),
            lambda acc, j: F.concat(acc, F.array(F.when(codes[j - 1] == ch, row[j - 1] + 1).otherwise(F.greatest(row[j], acc[j - 1])))),
        )

    last = F.aggregate(F.split(a, ""), F.array_repeat(F.lit(0), F.size(codes) + 1), step)
    total = F.length(a) + F.length(b)
    found = (F.lit(1.0) - (total - 2 * F.element_at(last, -1)) / total) * 100.0 / 100.0
    return F.when((F.length(a) == 0) | (F.length(b) == 0) | a.isNull() | b.isNull(), F.lit(0.0)).otherwise(found)

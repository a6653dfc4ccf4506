"""Exact order statistics of many columns by radix selection: no value is ever shuffled or sorted.

A double's bits, with the sign turned, order as the doubles do; so do those of
64-bit whole numbers.  Each pass cuts
the range of bit patterns that may still hold a wanted rank into ``SLICES``
equal slices and counts, per column and slice, how many values fall in, with
their least and greatest.  The slice that holds the rank is the next range,
shrunk to its own least and greatest value; when these are equal, the rank's
value is found.  A pass keeps fixed-width arrays per column, whatever the number
of rows; 64 bits need six passes at most, columns of few distinct values one.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 12
SLICES = 1 << BITS
_SIGN = np.uint64(1 << 63)


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Unsigned whole numbers in the order of the doubles (-0.0 as 0.0) or of the signed whole numbers."""
    if x.dtype.kind == "i":
        return x.astype(np.int64).view(np.uint64) ^ _SIGN
    bits = (x + 0.0).view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def from_bits(key: int, integral: bool = False) -> float | int:
    if integral:
        return key - (1 << 63)
    bits = key & ~(1 << 63) if key >> 63 else ~key & (1 << 64) - 1
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _key(x: float | int) -> int:
    return int(ordered_bits(np.array([x], np.int64 if isinstance(x, int) else np.float64))[0])


@dataclass(frozen=True)
class Place:
    """A rank's value, the number of values below it and of values equal to it."""
    value: float | int
    below: int
    equal: int


def counts_and_bounds(df: DataFrame, columns: dict[str, Column]) -> dict[str, tuple[int, float | None, float | None]]:
    """(values, least, greatest) of each column, missing values left out; one aggregate."""
    names = list(columns)
    if not names:
        return {}
    row = df.agg(*[f(columns[c]).alias(f"{t}{i}") for i, c in enumerate(names)
                   for f, t in ((F.count, "n"), (F.min, "a"), (F.max, "b"))]).first()
    return {c: (row[f"n{i}"], row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(names)}


def _pass(df: DataFrame, columns: list[Column], ranges: list[tuple[int, int, int]]) -> dict[int, dict[int, tuple[int, int, int]]]:
    """Per range (column number, least key, greatest key): slice -> (values, least key, greatest key)."""
    shifts = [max(0, (hi - lo).bit_length() - BITS) for _, lo, hi in ranges]

    def run(batches: Iterator[pa.RecordBatch]):
        n = np.zeros((len(ranges), SLICES), np.int64)
        low = np.full((len(ranges), SLICES), np.uint64(0xFFFFFFFFFFFFFFFF))
        high = np.zeros((len(ranges), SLICES), np.uint64)
        for b in batches:
            keys = {}
            for r, (c, lo, hi) in enumerate(ranges):
                if c not in keys:
                    keys[c] = ordered_bits(b.column(c).drop_null().to_numpy(zero_copy_only=False))
                k = keys[c]
                k = k[(k >= np.uint64(lo)) & (k <= np.uint64(hi))]
                at = ((k - np.uint64(lo)) >> np.uint64(shifts[r])).astype(np.int64)
                n[r] += np.bincount(at, minlength=SLICES)
                np.minimum.at(low[r], at, k)
                np.maximum.at(high[r], at, k)
        r, at = np.nonzero(n)
        yield pa.record_batch([pa.array(r.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(n[r, at]),
                               pa.array((low[r, at] ^ _SIGN).view(np.int64)), pa.array((high[r, at] ^ _SIGN).view(np.int64))],
                              ["range", "slice", "n", "low", "high"])
    parts = df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(run, "range int, slice int, n long, low long, high long")
    found: dict[int, dict[int, tuple[int, int, int]]] = {}
    turn = lambda x: (x + (1 << 63)) & (1 << 64) - 1  # noqa: E731 - the sign bit back
    for x in parts.groupBy("range", "slice").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect():
        found.setdefault(x["range"], {})[x["slice"]] = (x["n"], turn(x["low"]), turn(x["high"]))
    return found


def select_ranks(df: DataFrame, columns: dict[str, Column], ranks: dict[str, list[int]],
                 known: dict[str, tuple[int, float | None, float | None]]) -> dict[tuple[str, int], Place]:
    """(column, 0-based rank) -> its place.  ``columns``: double or long expressions; ``known``: ``counts_and_bounds``."""
    done: dict[tuple[str, int], Place] = {}
    # (column, least key, greatest key, values below) -> ranks still to find in that range
    open_ranges: dict[tuple[str, int, int, int], list[int]] = {}
    for c, wanted in ranges_of(ranks, known):
        _, least, greatest = known[c]
        lo, hi = _key(least), _key(greatest)
        if lo == hi:
            done.update({(c, r): Place(from_bits(lo, isinstance(least, int)), 0, known[c][0]) for r in wanted})
        else:
            open_ranges[c, lo, hi, 0] = wanted
    while open_ranges:
        names = list(dict.fromkeys(k[0] for k in open_ranges))
        keys = list(open_ranges)
        found = _pass(df, [columns[c] for c in names], [(names.index(c), lo, hi) for c, lo, hi, _ in keys])
        further: dict[tuple[str, int, int, int], list[int]] = {}
        for i, (c, lo, hi, below) in enumerate(keys):
            slices = sorted(found[i].items())
            for rank in open_ranges[c, lo, hi, below]:
                before = below
                for _, (n, low, high) in slices:
                    if rank < before + n:
                        if low == high:
                            done[c, rank] = Place(from_bits(low, isinstance(known[c][1], int)), before, n)
                        else:
                            further.setdefault((c, low, high, before), []).append(rank)
                        break
                    before += n
        open_ranges = further
    return done


def ranges_of(ranks: dict[str, list[int]], known: dict) -> Iterator[tuple[str, list[int]]]:
    for c, wanted in ranks.items():
        inside = sorted({r for r in wanted if 0 <= r < known[c][0]})
        if inside:
            yield c, inside


def column_quantiles(df: DataFrame, columns: dict[str, Column], qs: list[float],
                     known: dict[str, tuple[int, float | None, float | None]] | None = None) -> dict[str, dict[float, float | None]]:
    """Linear-interpolated quantiles (as numpy) of each column: name -> {q: value}; None for columns without values.

    The result is a few numbers per column, so it is kept on the driver."""
    known = known or counts_and_bounds(df, columns)
    places = {c: {q: (known[c][0] - 1) * q for q in qs} for c in columns if known[c][0]}
    ranks = {c: [r for h in p.values() for r in (math.floor(h), math.ceil(h))] for c, p in places.items()}
    values = select_ranks(df, columns, ranks, known)
    out: dict[str, dict[float, float | None]] = {c: {q: None for q in qs} for c in columns}
    for c, p in places.items():
        for q, h in p.items():
            low, high = values[c, math.floor(h)].value, values[c, math.ceil(h)].value
            out[c][q] = low + (h - math.floor(h)) * (high - low)
    return out

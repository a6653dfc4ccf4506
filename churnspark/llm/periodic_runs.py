"""Periodic runs of words: stretches that repeat one block at least four times.

A run of smallest period q and length l holds at its start s two suffixes, s
and s + q, whose common prefix is l - q words long.  So runs come out of the
classes of suffixes that share a prefix, taken by decreasing length: pairs of
neighbours in suffix order are edges weighted by their longest common prefix
(LCP), a union-find merges the classes from the heaviest edge down, each class
keeps its positions in order, and two positions that become neighbours in
their class at LCP L and lie d <= L words apart seed a run of period d and
length d + L.  L is exact there, so the run ends where it must; one comparison
of the words before both positions tells whether it begins there.

Everything happens inside one text, so no row is shuffled.  Texts are taken in
chunks of about a megabyte; a longer text is a chunk of its own, with about
150 bytes of working memory a word.
"""
from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, ids, pieces, raw

#: A run is at least this long, and at least this many periods long.
LEAST, REPEATS = 6, 4
#: Two suffixes that seed a run share at least this many words (period 1: 6 - 1, period q > 1: 3 q).
SHARED = min(LEAST - 1, 2 * (REPEATS - 1))

Run = tuple[int, int, int]


def suspects(codes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Texts in which some ``SHARED`` consecutive words stand twice: no other text can hold a run.

    Stretches are compared by a 64-bit mix, so a chance hit may add a text, none is missed."""
    n = len(codes) - SHARED + 1
    if n < 2:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        mixed = owner[:n].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(SHARED):
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ codes[k:n + k].astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    inside = np.flatnonzero(owner[:n] == owner[SHARED - 1:])
    mixed = mixed[inside]
    order = np.argsort(mixed, kind="stable")
    same = mixed[order[1:]] == mixed[order[:-1]]
    return np.unique(owner[inside[order[1:][same]]])


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all positions by their first 1, 2, 4, ... symbols, until all differ.

    A rank is the place of the first of its equals, so that only positions that
    still share theirs are sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    levels, width = [rank], 1
    shared = np.r_[~first[1:], False] | ~first
    active = order[shared]
    while len(active):
        ahead = active + width
        tail = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        head = rank[active]
        by = np.lexsort((tail, head))
        active, head, tail = active[by], head[by], tail[by]
        group = np.r_[True, head[1:] != head[:-1]]
        part = group | np.r_[True, tail[1:] != tail[:-1]]
        at = np.arange(len(active))
        since = at - np.maximum.accumulate(np.where(group, at, 0))
        new = head + np.maximum.accumulate(np.where(part, at, 0)) - (at - since)
        rank = rank.copy()
        rank[active] = new
        levels.append(rank)
        active = active[np.r_[~part[1:], False] | ~part]
        width *= 2
    return levels


def neighbour_prefixes(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and the common prefix of each suffix with the next, by halving widths over the ranks."""
    rank = levels[-1]
    n = len(rank)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    left, right = order[:-1].copy(), order[1:].copy()
    long = np.zeros(max(n - 1, 0), np.int64)
    for k in range(len(levels) - 2, -1, -1):
        width, r = 1 << k, levels[k]
        fits = np.flatnonzero((left < n) & (right < n))
        fits = fits[r[left[fits]] == r[right[fits]]]
        left[fits] += width
        right[fits] += width
        long[fits] += width
    return order, long


def classes_by_falling_prefix(order: np.ndarray, long: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(i, j, LCP) for positions i < j that become neighbours in their class when it forms at this LCP, if j - i <= LCP / 3."""
    edges = np.flatnonzero(long >= SHARED)
    edges = edges[np.argsort(-long[edges], kind="stable")]
    parent = {}
    members: dict[int, list[int]] = {}
    share = REPEATS - 1
    for a, b, shared in zip(order[edges].tolist(), order[edges + 1].tolist(), long[edges].tolist()):
        for x in (a, b):
            if x not in parent:
                parent[x] = x
                members[x] = [x]
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        big, small = members[a], members[b]
        if len(big) < len(small):
            a, b, big, small = b, a, small, big
        parent[b] = a
        del members[b]
        reach = shared // share
        size, last = len(big), len(small) - 1
        places = []
        for k, x in enumerate(small):
            at = bisect_left(big, x)
            places.append(at)
            if at and x - big[at - 1] <= reach and (k == 0 or small[k - 1] < big[at - 1]):
                yield big[at - 1], x, shared
            if at < size and big[at] - x <= reach and (k == last or small[k + 1] > big[at]):
                yield x, big[at], shared
        if places[0] == size:
            big += small
        elif len(small) * 16 > size:
            big += small
            big.sort()  # two ordered stretches: merged in one pass
        else:
            for x, at in zip(reversed(small), reversed(places)):
                big.insert(at, x)


def runs_of(texts: list[np.ndarray]) -> list[list[Run]]:
    """Runs (start, length, period) of each text, given as codes of its words, by start, then period."""
    found: list[list[Run]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.sum():
        return found
    owners = np.repeat(np.arange(len(texts)), sizes)
    held = suspects(np.concatenate(texts), owners)
    if not len(held):
        return found
    # One line of symbols: every text's own alphabet, each text closed by a symbol of its own.
    starts, parts, at, offset = [], [], 0, 0
    for t in held.tolist():
        codes = texts[t]
        starts.append(at)
        parts += [codes + offset, np.array([offset + codes.max() + 1])]
        offset += int(codes.max()) + 2
        at += len(codes) + 1
    line = np.concatenate(parts)
    begins = np.array(starts, np.int64)
    order, long = neighbour_prefixes(suffix_ranks(line))
    seeds = list(classes_by_falling_prefix(order, long))
    if not seeds:
        return found
    i, j, shared = np.array(seeds, np.int64).T
    text = np.searchsorted(begins, i, "right") - 1
    first = i == begins[text]
    d = j - i
    good = (first | (line[i - 1] != line[j - 1])) & (d + shared >= np.maximum(LEAST, REPEATS * d))
    for t, s, n, q in sorted(zip(text[good].tolist(), (i - begins[text])[good].tolist(), (d + shared)[good].tolist(), d[good].tolist())):
        found[held[t]].append((s, n, q))
    for r in found:
        r.sort(key=lambda x: (x[0], x[2]))
    return found


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """True for words that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def scan(texts: list[bytes | None]) -> Iterator[tuple[list[bytes], list[Run]]]:
    """(words, runs) of each text of a chunk."""
    numbers: dict[bytes, int] = {}
    words = [(t or b"").split() for t in texts]
    codes = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in ws), np.int64, len(ws)) for ws in words]
    yield from zip(words, runs_of(codes))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    if runs:
        words = [words[k] for k in np.flatnonzero(kept_words(len(words), runs))]
    return b" ".join(words)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per run: the document's id, start (word number), length, period.

    Null, empty and blank texts have no runs; rows that repeat an id are read
    one by one, each with its own runs; further columns of ``docs`` are not read."""
    def run(batches):
        for b in pieces(batches, text_col):
            out = [(i, *r) for i, (_, runs) in zip(ids(b, id_col), scan(raw(b, text_col))) for r in runs]
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], ["id", "start", "length", "period"])
    out = docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(run, "id long, start long, length long, period long")
    return out.withColumnRenamed("id", id_col)


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every run cut to its first period; the words of such a text are joined by one space.

    Texts without a run, null ones too, stay as they are; all other columns pass through."""
    at = docs.columns.index(text_col)

    def run(batches):
        for b in pieces(batches, text_col):
            texts = raw(b, text_col)
            new = [collapsed(words, runs) if runs else t for t, (words, runs) in zip(texts, scan(texts))]
            yield b.set_column(at, b.schema.field(at), pa.array(new, pa.binary()).cast(b.schema.field(at).type))
    return docs.mapInArrow(run, docs.schema)


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``find_runs`` and ``collapse_runs`` digested in one pass, one row per row of ``docs``: n_runs; start, length,
    period and exponent_milli of the longest run (ties: least start, then period; none: nulls); runs_sha256, collapsed_sha256."""
    def run(batches):
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for b in pieces(batches, text_col):
            rows = []
            for words, runs in scan(raw(b, text_col)):
                start, length, period = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
                rows.append((len(runs), start, length, period, 1000 * length // period if runs else None,
                             sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(collapsed(words, runs))))
            *numbers, a, c = zip(*rows)
            yield pa.record_batch([pa.array(ids(b, id_col), pa.int64()), *(pa.array(x, pa.int64()) for x in numbers), pa.array(a), pa.array(c)],
                                  ["id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])
    out = docs.select(F.col(id_col).cast("long").alias(id_col), text_col).mapInArrow(
        run, "id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string")
    return out.withColumnRenamed("id", id_col)


def with_planted_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The contract's test texts, id and text only: where crc32(id) is a multiple of 10, the words from a on repeat with period p.

    With g = floor(crc32 / 10) and n words: a = g mod n, p = 1 + floor((n - a) / (3 + g mod 8)).  Built-in functions
    only; documents without words or without an id stay as they are."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    chosen = docs.select(id_col, text_col, F.when(F.pmod(h, F.lit(10)) == 0, F.regexp_extract_all(
        F.col(text_col), F.lit(f"({WORD})"), 1)).alias("words of the text"), F.floor(h / 10).alias("g of the id"))
    words, g = F.col("words of the text"), F.col("g of the id")
    n = F.size(words)
    a = F.pmod(g, F.nullif(n, F.lit(0))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))).cast("int")
    cycle = F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int"))
    planted = F.concat(F.slice(words, 1, a), F.slice(F.flatten(cycle), 1, n - a))
    return chosen.select(id_col, F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col(text_col)).alias(text_col))

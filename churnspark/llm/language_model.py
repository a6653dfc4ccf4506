"""Language-model scoring: causal self-attention over subword ids, with word counts of the whole corpus.

A text's probability is that of its ids' classes, times that of every word
given the classes of its ids.  The first factor is a one-layer causal
self-attention model trained in numpy on all learning documents, in rounds of
weight averaging over the partitions; it reads windows of 32 ids that overlap
by 16 and scores every id once.  The second comes
from all training words with their counts over the corpus, smoothed towards
P(id | class, class before it in the word).
"""
from __future__ import annotations

import base64

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, ids, pieces, save, small_batches

STEP, WIDTH = 16, 32  # ids scored by a window, ids it reads
CLASSES, UNITS, DIM = 48, 1024, 16
START, LONE = UNITS + CLASSES, CLASSES  # the unit before a text's first id; the "class" before a word's first id
HEAD = 1 << 18  # commonest words that every task holds; the others are joined, with the same scores
END_WORD = b" "  # no word: words hold no space
CHUNK = 2 << 20
WORDS = 20_000  # words that the tokenizer gets as one text
COMMON = 128  # ids that count as neighbours of their own
ROUNDS = (0.003, 0.001)  # learning rate of each round; a learning document is in one round


class Subwords:
    """Byte-level BPE ids of single words, each with a space before it, from a ranks file's bytes."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.size = max(table.values()) + 1
        self.encoding = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        space = {i for t, i in table.items() if t[:1] == b" "}
        self.opens = np.array([i in space for i in range(self.size + 1)])

    def many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids of each word).

        Words without white space of any script are encoded as one text: no id reaches over a space and only
        the ids that open a word begin with one."""
        return self.many_in(pa.array(words, pa.binary()).cast(pa.string()))

    def many_in(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``many`` of words in Arrow's memory."""
        encode = self.encoding._core_bpe.encode_ordinary
        tokens, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for k in range(0, len(words), WORDS):
            some = words[k:k + WORDS]
            text = " " + pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), " ")[0].as_py()
            parts = text.split()
            if len(parts) == len(some) and sum(map(len, parts)) + len(some) == len(text):
                tokens.append(np.array(encode(text), np.int32))
                sizes.append(np.diff(np.flatnonzero(self.opens[tokens[-1]]), append=len(tokens[-1])))
            else:
                found = [encode(" " + w) for w in some.to_pylist()]
                sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
                tokens.append(np.fromiter((i for f in found for i in f), np.int32, int(sizes[-1].sum())))
        return np.concatenate(tokens), np.concatenate(sizes)


def split_words(b: pa.RecordBatch, text_col: str) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct lower-cased words of a batch, the place there of every word of its texts, number of words of each text)."""
    words, flat, lengths = word_array(b, text_col)
    return words.cast(pa.binary()).to_pylist(), flat, lengths


def word_array(b: pa.RecordBatch, text_col: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """``split_words`` with the words left in Arrow's memory.

    Null texts have no words.  Arrow's ASCII white space is the contracts'."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(b.column(b.schema.get_field_index(text_col)), "")))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)  # white space at a text's ends leaves empty words
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    lengths = np.bincount(owner[real.to_numpy(zero_copy_only=False)], minlength=len(lists))
    found = flat.filter(real).dictionary_encode()
    return found.dictionary, found.indices.to_numpy().astype(np.int64), lengths


def steady_memory() -> None:
    """From now on the C library keeps some MB that are freed, as it does once a block of 8 MB was.

    Else every step of a model gives its arrays back to the system and has them cleared page by page again."""
    np.empty(8 << 20, np.uint8)


def spread(sizes: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in flat lists of ``sizes`` of the picked lists one after another, and the picked sizes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    n = sizes[pick]
    total = int(n.sum())
    begin = np.repeat(offsets[pick] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n)
    return begin + np.arange(total), n


# --- texts as ids ------------------------------------------------------------------------------------------------


def encode(docs: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A table with one row per document: row, id, ids of its words (``tokens``) and one bit for each, set where a word
    begins (``starts``).

    Texts are split and tokenized here only; ``learn`` and ``score`` take the table in place of the documents."""
    small_batches(docs.sparkSession)

    def run(batches):
        sub = Subwords(ranks, pattern)
        for b in pieces(batches, text_col, limit=CHUNK, rows=20_000):
            words, flat, lengths = word_array(b, text_col)
            pool, sizes = sub.many_in(words)
            where, n_ids = spread(sizes, flat)
            cut = np.concatenate([[0], np.cumsum(n_ids)])[np.concatenate([[0], np.cumsum(lengths)])]
            begin = (np.cumsum(n_ids) - n_ids).astype(np.int64)
            held = np.diff(cut)
            bits = (held + 7) // 8  # bytes of a document's bits
            ends = np.concatenate([[0], np.cumsum(bits)])
            flags = np.zeros(int(ends[-1]) * 8, np.uint8)
            flags[begin + np.repeat(ends[:-1] * 8 - cut[:-1], lengths)] = 1
            tokens = pool[where].astype(id_type(sub.size))
            yield pa.record_batch([b.column(b.schema.get_field_index("row")), b.column(b.schema.get_field_index(id_col)),
                                   binaries(tokens, cut), binaries(np.packbits(flags), ends)], ["row", id_col, "tokens", "starts"])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias(id_col), text_col)
    return save(rows.mapInArrow(run, f"row long, `{id_col}` long, tokens binary, starts binary"), "lm-ids")


def is_encoded(docs: DataFrame) -> bool:
    return docs.columns[2:] == ["tokens", "starts"]


def id_type(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.int32


def binaries(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """Parts of an array, which end at ``cut``, as binary values."""
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * values.itemsize).astype(np.int32)), pa.py_buffer(values)])


def parts(b: pa.RecordBatch, name: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """(values of all binaries of a column one after another, where each ends, from 0 on)."""
    column = b.column(b.schema.get_field_index(name)).cast(pa.large_binary())
    _, cut, data = column.buffers()
    cut = np.frombuffer(cut, np.int64)[column.offset:column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, np.uint8)[cut[0]:cut[-1]] if data else np.zeros(0, np.uint8)
    return values.view(kind), (cut - cut[0]) // np.dtype(kind).itemsize


def first_ids(b: pa.RecordBatch, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first id of every word, number of words of each text) of a batch whose texts' ids end at ``cut``."""
    bits, ends = parts(b, "starts", np.uint8)
    n = np.diff(cut)
    flags = np.unpackbits(bits)
    if (n % 8).any():
        flags = flags[np.arange(int(cut[-1])) + np.repeat(ends[:-1] * 8 - cut[:-1], n)]
    begin = np.flatnonzero(flags)
    return begin, np.diff(np.searchsorted(begin, cut))


def place_keys(n: int) -> np.ndarray:
    """Odd 64-bit factors of the places of a word's ids."""
    x = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


def word_hashes(tokens: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """64-bit hash of every word by its ids, which are the word's alone; ``begin``: places of the words' first ids."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    sizes = np.diff(begin, append=len(tokens))
    x = (tokens.astype(np.uint64) + np.uint64(1)) * place_keys(int(sizes.max()))[np.arange(len(tokens)) - np.repeat(begin, sizes)]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return np.add.reduceat(x, begin)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different hashes in rising order, a place of each, for every hash its place among the different ones)."""
    coded = pa.array(hashes).dictionary_encode()
    values, which = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    order = np.argsort(values)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    which, at = rank[which], np.empty(len(order), np.int64)
    at[which] = np.arange(len(which))
    return values[order], at, which


#: Hash of a text's end, which is counted as a word without ids.
END = np.uint64(xxhash.xxh3_64_intdigest(END_WORD))


# --- the attention model -----------------------------------------------------------------------------------------


def new_weights(seed: int = 3) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    shape = {"e": (START + 1, DIM), "q": (DIM, DIM), "k": (DIM, DIM), "v": (DIM, DIM), "o": (DIM, CLASSES),
             "x": (DIM, CLASSES), "g": (CLASSES + 1, CLASSES), "d": (WIDTH,)}
    w = {k: (r.normal(0, 0.3 if k == "e" else 0.25, s) if k not in "gd" else np.zeros(s)).astype(np.float32) for k, s in shape.items()}
    return w


#: Query t of the scored half reads window places up to STEP + t; the distance picks its bias.
PLACE = np.arange(WIDTH)[None, :] <= STEP + np.arange(STEP)[:, None]
DISTANCE = np.clip(STEP + np.arange(STEP)[:, None] - np.arange(WIDTH)[None, :], 0, WIDTH - 1)


BLOCK = 128  # windows whose arrays a core's own cache holds
SAFE = 60  # exponents whose exponentials single precision holds, sums of them too


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a @ b`` for a matrix ``b``, as one product of matrices instead of one for each window."""
    return (a.reshape(-1, a.shape[-1]) @ b).reshape(*a.shape[:-1], b.shape[1])


def exponentials(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """(exp(a - top) in place, their sums over the last axis, top): top is 0 unless an exponential could over- or underflow."""
    top = 0.0
    if max(a.max(initial=0), -a.min(initial=0)) > SAFE:
        top = a.max(2, keepdims=True)
        a -= top
    np.exp(a, out=a)
    return a, product(a, np.ones((a.shape[-1], 1), a.dtype)), top


SCALE = DIM ** -0.5


class Projected:
    """What every unit's embedding gives: queries (scaled), keys beside values, shares of the logits.  A place reads its
    row here instead of a product of its own.  kind_of: class of every unit's ids, if the classes before the scored
    places follow from the units.  ``calm``: no exponential can over- or underflow, whatever the places read."""

    def __init__(self, w, kind_of: np.ndarray | None = None):
        e = w["e"]
        self.q, self.kv, self.z = e @ (w["q"] * e.dtype.type(SCALE)), e @ np.concatenate([w["k"], w["v"]], 1), e @ w["x"]
        longest = lambda a, axes="ij,ij->i": float(np.sqrt(np.einsum(axes, a, a).max()))
        most = lambda a: float(max(a.max(), -a.min()))
        inside = longest(self.q) * longest(self.kv[:, :DIM]) + most(w["d"])
        last = longest(self.kv[:, DIM:]) * longest(w["o"], "ij,ij->j") + most(self.z) + most(w["g"])
        self.calm = inside < SAFE and last < SAFE
        self.near = np.exp(w["d"])[DISTANCE] * PLACE if self.calm else None
        self.kind_of = kind_of
        if kind_of is not None:
            self.z += w["g"].take(kind_of, 0)


def kinds_of_units(unit_of: np.ndarray, class_of: np.ndarray) -> np.ndarray:
    """Class of every unit's ids, which is one for each; the unit before a text's first id has none."""
    kind_of = np.full(START + 1, CLASSES)
    kind_of[unit_of] = class_of
    kind_of[START] = CLASSES
    return kind_of


def logits(w, of: Projected, units: np.ndarray, before: np.ndarray, alone: np.ndarray):
    """(logits of the next class at the scored places, what the gradient needs).

    units: (n, 32) input units; before: (n, 16) class of the scored places'
    inputs; alone: windows without anything before their scored half."""
    last = units[:, STEP:]
    q, kv = of.q.take(last, 0), of.kv.take(units, 0)
    k, v = kv[:, :, :DIM], kv[:, :, DIM:]
    s = q @ k.transpose(0, 2, 1)
    if of.calm:
        np.exp(s, out=s)
        s *= of.near
        if alone.any():
            s[alone, :, :STEP] = 0
        total = product(s, np.ones((WIDTH, 1), s.dtype))
    else:
        s += np.where(PLACE, w["d"][DISTANCE], np.float32(-1e9))
        s[alone, :, :STEP] = -1e9
        s, total, _ = exponentials(s)
    h = s @ v
    h /= total
    z = product(h, w["o"])
    z += of.z.take(last, 0)
    if of.kind_of is None:
        z += w["g"].take(before, 0)
    return z, (of, q, k, v, s, total, h)


def softmax(of: Projected, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """``exponentials`` of logits, without a look at them where ``of`` is calm."""
    if not of.calm:
        return exponentials(z)
    np.exp(z, out=z)
    return z, product(z, np.ones((CLASSES, 1), z.dtype)), 0.0


def forward(w, units: np.ndarray, before: np.ndarray, alone: np.ndarray):
    """Log probabilities of the next class at the scored places."""
    z, kept = logits(w, Projected(w), units, before, alone)
    _, total, top = exponentials(z.copy())
    return z - (np.log(total) + top), kept


def backward(w, units, before, target, mask, z, kept):
    """Gradients from the log probabilities of ``forward``."""
    sums = Sums(w)
    sums.add(w, units, before, target, mask / max(1, mask.sum()), np.exp(z), 1.0, kept)
    return sums.gradients(w)


PAIRS = np.arange(CLASSES // 2)  # two numbers are added at once, as one complex number


def add_rows(table: np.ndarray, at: np.ndarray, rows: np.ndarray, column: int) -> None:
    """Add every row to the row ``at`` of the table, from ``column`` on."""
    kind, pairs = (np.complex64 if table.dtype == np.float32 else np.complex128), PAIRS[:rows.shape[-1] // 2] + column // 2
    places = (np.arange(len(table))[:, None] * (table.shape[1] // 2) + pairs).take(at.reshape(-1), 0)
    np.add.at(table.view(kind).reshape(-1), places.reshape(-1), rows.view(kind).reshape(-1))


class Sums:
    """Gradients of a step; those of queries, keys, values and logits are added up by unit."""

    def __init__(self, w):
        self.g = {k: np.zeros_like(w[k]) for k in "ogd"}
        self.units = np.zeros((len(w["e"]), 3 * DIM + CLASSES), w["e"].dtype)  # queries, keys, values, logits

    def add(self, w, units, before, target, weight, p, p_total, kept) -> None:
        """weight: share of every place in the loss; p: next classes' probabilities times ``p_total``, overwritten."""
        of, q, k, v, s, total, h = kept
        last, dz = units[:, STEP:], p
        s /= total
        dz *= weight[:, :, None] / p_total
        dz.reshape(-1)[np.arange(target.size) * CLASSES + target.ravel()] -= weight.ravel()
        dz = dz.reshape(-1, CLASSES)
        self.g["o"] += h.reshape(-1, DIM).T @ dz
        if of.kind_of is None:
            self.g["g"] += (before.ravel() == np.arange(CLASSES + 1)[:, None]).astype(dz.dtype) @ dz
        dh = (dz @ np.ascontiguousarray(w["o"].T)).reshape(h.shape)
        ds = dh @ v.transpose(0, 2, 1)
        ds -= product(dh * h, np.ones((DIM, 1), dh.dtype))
        ds *= s
        self.g["d"] += np.bincount(DISTANCE.ravel(), (ds.sum(0) * PLACE).ravel(), WIDTH).astype(dz.dtype)
        add_rows(self.units, last, ds @ k, 0)
        add_rows(self.units, units, ds.transpose(0, 2, 1) @ q, DIM)  # q holds the scale already
        add_rows(self.units, units, s.transpose(0, 2, 1) @ dh, 2 * DIM)
        add_rows(self.units, last, dz, 3 * DIM)

    def gradients(self, w, kind_of: np.ndarray | None = None) -> dict[str, np.ndarray]:
        self.units[:, :DIM] *= w["e"].dtype.type(SCALE)
        q, k, v, x = np.split(w["e"].T @ self.units, (DIM, 2 * DIM, 3 * DIM), 1)
        g = {**self.g, "q": q, "k": k, "v": v, "x": x}
        g["e"] = self.units @ np.concatenate([w["q"], w["k"], w["v"], w["x"]], 1).T
        if kind_of is not None:
            order = np.argsort(kind_of, kind="stable")
            found, first = np.unique(kind_of[order], return_index=True)
            g["g"][found] = np.add.reduceat(self.units[order, 3 * DIM:], first)
        return g


class Adam:
    def __init__(self, w, kind_of: np.ndarray | None = None):
        self.w, self.kind_of, self.step = w, kind_of, 0
        self.m, self.u = (np.zeros(sum(a.size for a in w.values()), np.float32) for _ in range(2))

    def move(self, units, before, target, mask, alone, rate: float) -> None:
        self.step += 1
        of, sums, weight = Projected(self.w, self.kind_of), Sums(self.w), mask / max(1, mask.sum())
        z, kept = logits(self.w, of, units, before, alone)
        p, total, _ = softmax(of, z)
        sums.add(self.w, units, before, target, weight, p, total, kept)
        g = sums.gradients(self.w, self.kind_of)
        g = np.concatenate([g[k].ravel() for k in self.w])
        self.m *= 0.9
        self.m += 0.1 * g
        self.u *= 0.99
        g *= g
        self.u += 0.01 * g
        change = np.sqrt(self.u / (1 - 0.99 ** self.step))
        change += 1e-8
        np.divide(self.m, change, out=change)
        change *= rate / (1 - 0.9 ** self.step)
        at = 0
        for k, a in self.w.items():
            self.w[k] = a - change[at:at + a.size].reshape(a.shape)
            at += a.size


def train(units, before, target, mask, alone, kind_of, steps: int = 500, size: int = 256, rate: float = 0.01, seed: int = 5):
    """Starting weights: Adam over random groups of windows."""
    steady_memory()
    r, adam = np.random.default_rng(seed), Adam(new_weights(), kind_of)
    for step in range(1, steps + 1):
        take = r.integers(0, len(units), min(size, len(units)))
        adam.move(units[take], before[take], target[take], mask[take], alone[take], rate * min(1.0, step / 30) * (1 - step / (steps + 1)))
    return adam.w


def train_further(w, texts, unit_of, class_of, end: int, rate: float, size: int = 256, seed: int = 7) -> tuple[dict, int]:
    """(weights after Adam over every window of ``texts`` once, number of windows); texts: (ids, lengths) of some documents each."""
    steady_memory()
    r, adam, seen = np.random.default_rng(seed), Adam({k: a.copy() for k, a in w.items()}, kinds_of_units(unit_of, class_of)), 0
    for tokens, lengths in texts:
        units, before, target, mask, alone = windows(tokens, lengths, unit_of, class_of, end)
        target = class_of[target]
        order = r.permutation(len(units))
        for take in np.array_split(order, -(-len(order) // size)):
            adam.move(units[take], before[take], target[take], mask[take], alone[take], rate * min(1.0, (adam.step + 1) / 30))
        seen += len(units)
    return adam.w, seen


def windows(tokens: np.ndarray, lengths: np.ndarray, unit_of: np.ndarray, class_of: np.ndarray, end: int):
    """Texts of ids, one after another, as overlapping windows.

    Each text reads START id1 .. idn and predicts id1 .. idn END, padded to
    whole steps.  Returns units, before, target ids, mask, alone."""
    steps = (lengths + 1 + STEP - 1) // STEP
    base = np.concatenate([[0], np.cumsum(steps)])
    total = int(base[-1])
    inputs = np.full(total * STEP, START, np.int32)
    target = np.full(total * STEP, end, np.int32)
    mask = np.zeros(total * STEP, np.float32)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = base[:-1][owner] * STEP + inside
    target[at] = tokens
    mask[at] = 1
    mask[base[:-1] * STEP + lengths] = 1
    before = np.full(total * STEP, CLASSES, np.int32)
    inputs[at + 1 - (at + 1 >= len(inputs))] = unit_of[tokens]  # the last place of all is never an input of a later one
    before[at + 1 - (at + 1 >= len(inputs))] = class_of[tokens]
    inputs[base[:-1] * STEP], before[base[:-1] * STEP] = START, CLASSES
    blocks = inputs.reshape(-1, STEP)
    units = np.concatenate([np.concatenate([np.full((1, STEP), START, np.int32), blocks[:-1]]), blocks], 1)
    alone = np.zeros(total, bool)
    alone[base[:-1]] = True
    return units, before.reshape(-1, STEP), target.reshape(-1, STEP), mask.reshape(-1, STEP), alone


def places(n: np.ndarray) -> np.ndarray:
    """Number of every id among the commonest ones, else the number after theirs."""
    top = np.argsort(-n, kind="stable")[:COMMON]
    place = np.full(len(n), COMMON)
    place[top] = np.arange(len(top))
    return place


def id_classes(n: np.ndarray, slot: np.ndarray, times: np.ndarray, opens: np.ndarray, size: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(class of every id, unit of every id): ids that stand between the same neighbours share a class.

    n: count of every id; slot, times: counts of (id, side and place of its
    neighbour).  k-means over the places of the commonest ids before and
    after; ids that the learning documents lack get one of two classes, by
    whether they open a word.  The last class is the end's alone."""
    seen = np.flatnonzero(n)
    row = np.full(size + 1, -1)
    row[seen] = np.arange(len(seen))
    c = np.zeros((len(seen), 2 * (COMMON + 1)), np.float32)
    c[row[slot // c.shape[1]], slot % c.shape[1]] = times
    np.sqrt(c, out=c)
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-6)
    r = np.random.default_rng(seed)
    class_of = np.where(opens, CLASSES - 3, CLASSES - 2)
    half = (CLASSES - 3) // 2
    for base, member in ((0, opens[seen]), (half, ~opens[seen])):  # a class opens words or never does
        x, weight, k = c[member], np.sqrt(n[seen][member]), half if base == 0 else CLASSES - 3 - half
        if len(x) <= k:
            continue
        centre = x[r.choice(len(x), k, replace=False, p=weight / weight.sum())]
        for _ in range(12):
            own = (x @ centre.T).argmax(1)
            total = np.zeros_like(centre)
            np.add.at(total, own, x * weight[:, None])
            norm = np.linalg.norm(total, axis=1, keepdims=True)
            centre = np.where(norm > 0, total / np.maximum(norm, 1e-6), centre)
        class_of[seen[member]] = base + (x @ centre.T).argmax(1)
    class_of[size] = CLASSES - 1
    unit_of = UNITS + class_of
    often = np.argsort(-n, kind="stable")[:UNITS]
    unit_of[often] = np.arange(len(often))
    return class_of.astype(np.int32), unit_of.astype(np.int32)


def score_classes(w, tokens, lengths, unit_of, class_of, end) -> np.ndarray:
    """Natural log probability of the classes of each text's ids and its end."""
    units, before, target, mask, alone = windows(tokens, lengths, unit_of, class_of, end)
    of = Projected(w, kinds_of_units(unit_of, class_of))
    wanted = (np.arange(mask.size) * CLASSES + class_of[target.ravel()]).reshape(mask.shape)
    value = np.zeros(mask.shape, np.float32)
    for g in range(0, len(units), BLOCK):
        part = slice(g, g + BLOCK)
        z, _ = logits(w, of, units[part], before[part], alone[part])
        chosen = z.take(wanted[part] - g * STEP * CLASSES)
        _, total, top = softmax(of, z)
        value[part] = chosen - (np.log(total) + top)[:, :, 0]
    value *= mask
    steps = (lengths + STEP) // STEP
    return np.add.reduceat(value.sum(1, dtype=np.float64), np.concatenate([[0], np.cumsum(steps)[:-1]]))


def by_word(tokens: np.ndarray, sizes: np.ndarray, inner: np.ndarray, class_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log probability of each word's ids by the smooth table, hash of the word's class sequence)."""
    if not len(sizes):
        return np.zeros(0), np.zeros(0, np.uint64)
    first = np.cumsum(sizes) - sizes
    classes = class_of[tokens]
    before = np.concatenate([[LONE], classes[:-1]])
    before[first] = LONE
    smooth = np.add.reduceat(inner[before, tokens], first).astype(np.float64)
    place = np.arange(len(tokens)) - np.repeat(first, sizes)
    odd = np.uint64(0x9E3779B97F4A7C15) * (np.arange(int(sizes.max()), dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    mixed = (classes.astype(np.uint64) + np.uint64(1)) * odd[place]
    mixed ^= mixed >> np.uint64(29)
    return smooth, np.add.reduceat(mixed * np.uint64(0xBF58476D1CE4E5B9), first)


# --- counts over the corpus --------------------------------------------------------------------------------------


def word_counts(texts: DataFrame, kind: type) -> DataFrame:
    """(h, tokens, n) of all words of an encoded table and of its texts' ends, added up in each task first."""
    def run(batches):
        held, texts_seen = [], 0

        def merged():
            h, n, sizes, tokens = (np.concatenate(a) for a in zip(*held))
            values, at, which = distinct(h)
            where, new = spread(sizes, at)
            return values, np.bincount(which, n, len(values)).astype(np.int64), new, tokens[where]

        def flush(h, n, sizes, tokens):
            for k in range(0, len(h), 100_000):
                part = slice(k, k + 100_000)
                where, some = spread(sizes, np.arange(len(h))[part])
                yield pa.record_batch([pa.array(h[part].view(np.int64)), binaries(tokens[where], np.concatenate([[0], np.cumsum(some)])),
                                       pa.array(n[part])], ["h", "tokens", "n"])
        for b in pieces(batches, "tokens", limit=CHUNK, rows=20_000):
            tokens, cut = parts(b, "tokens", kind)
            begin, _ = first_ids(b, cut)
            texts_seen += len(b)
            if not len(begin):
                continue
            values, at, which = distinct(word_hashes(tokens, begin))
            where, sizes = spread(np.diff(begin, append=len(tokens)), at)
            held.append((values, np.bincount(which, minlength=len(values)), sizes, tokens[where]))
            if sum(len(h[0]) for h in held) > 400_000:
                held = [merged()]
                if len(held[0][0]) > 200_000:
                    yield from flush(*held.pop())
        if held:
            yield from flush(*merged())
        if texts_seen:
            yield pa.record_batch([pa.array([int(END.view(np.int64))]), pa.array([b""], pa.binary()), pa.array([texts_seen], pa.int64())], ["h", "tokens", "n"])
    counted = texts.select("tokens", "starts").mapInArrow(run, "h long, tokens binary, n long")
    return counted.groupBy("h", "tokens").agg(F.sum("n").alias("n"))


def counted_words(b: pa.RecordBatch, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all ids, number of ids of each word, its count) of a batch of ``word_counts`` without the ends."""
    tokens, cut = parts(b, "tokens", kind)
    sizes, n = np.diff(cut), b.column(b.schema.get_field_index("n")).to_numpy()
    return tokens, sizes[sizes > 0], n[sizes > 0]


def token_lists(batches, kind: type, most: int = 65_536):
    """(ids, lengths) of some documents at a time, of about ``most`` ids together."""
    for b in batches:
        values, cut = parts(b, "tokens", kind)
        lo = 0
        while lo < len(cut) - 1:
            hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + most, "right")) - 1)
            yield values[cut[lo]:cut[hi]].astype(np.int32), np.diff(cut[lo:hi + 1])
            lo = hi


class Model:
    """Everything that scoring needs.  What the tasks hold is bounded by the vocabulary and by HEAD; ``totals``,
    the counts of all class sequences, is a table and stays behind when the model goes to a task."""

    def __init__(self, **parts):
        self.__dict__.update(parts)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "totals"}


def learn(docs: DataFrame, learning: Column, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text",
          sample: int = 1500) -> tuple[Model, DataFrame]:
    """(model, word counts).  Counts, classes and attention weights come from every learning document.  Training starts
    on the ``sample`` documents of the smallest id hashes, in one task; then each round deals its documents to
    the tasks as they lie and averages their weights by windows, so weights depend a little on the partitions."""
    small_batches(docs.sparkSession)
    sub = Subwords(ranks, pattern)
    size, kind, opens = sub.size, id_type(sub.size), sub.opens
    own = None if is_encoded(docs) else encode(docs.where(learning), ranks, pattern, id_col, text_col)
    tokens = docs.where(learning) if own is None else own
    counts = save(word_counts(tokens, kind), "lm-counts")

    def id_counts(batches):
        total = np.zeros(size, np.int64)
        for b in batches:
            found, sizes, times = counted_words(b, kind)
            np.add.at(total, found, np.repeat(times, sizes))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["id", "n"])
    found = counts.select("tokens", "n").mapInArrow(id_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(size + 1, np.int64)
    n[found.column("id").to_numpy()] = found.column("n").to_numpy()
    tokens = tokens.select(F.col(id_col).alias("id"), F.pmod(F.xxhash64(id_col), F.lit(len(ROUNDS))).cast("int").alias("round"), "tokens")
    place, wide = places(n).astype(np.int32), 2 * (COMMON + 1)

    def neighbours(batches):
        total = np.zeros(size * wide, np.int32)
        for t, lengths in token_lists(batches, kind, 1 << 20):
            inside = np.ones(len(t), bool)
            inside[np.cumsum(lengths[:-1])[np.cumsum(lengths[:-1]) < len(t)]] = False  # nothing stands before a text's first id
            at = np.flatnonzero(inside[1:]) + 1
            slots, beside = t * wide, place[t]
            keys = np.sort(np.concatenate([slots[at] + beside[at - 1], slots[at - 1] + beside[at] + (COMMON + 1)]))
            first = np.flatnonzero(np.diff(keys, prepend=-1))
            total[keys[first]] += np.diff(first, append=len(keys)).astype(np.int32)
        some = np.flatnonzero(total)
        for k in range(0, len(some), 100_000):
            part = some[k:k + 100_000]
            yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(total[part])], ["slot", "n"])
    # One row at most for each id and place, however large the corpus is.
    near = tokens.select("tokens").mapInArrow(neighbours, "slot int, n int").groupBy("slot").agg(F.sum("n").cast("float").alias("n")).toArrow()
    class_of, unit_of = id_classes(n, near.column("slot").to_numpy(), near.column("n").to_numpy(), opens, size)
    chosen = tokens.select("id").orderBy(F.xxhash64("id"), "id").limit(sample).distinct()

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        texts = [np.frombuffer(t, kind).astype(np.int32) for t in frame["tokens"]]
        frame = frame.assign(text=texts, key=[t.tobytes() for t in texts]).sort_values(["id", "key"])
        lengths = np.array([len(t) for t in frame["text"]], np.int64)
        flat = np.concatenate([*frame["text"], np.zeros(0, np.int32)])
        units, before, target, mask, alone = windows(flat, lengths, unit_of, class_of, size)
        w = train(units, before, class_of[target], mask, alone, kinds_of_units(unit_of, class_of))
        return pd.DataFrame({"name": list(w), "value": [np.ascontiguousarray(a).tobytes() for a in w.values()]})
    rows = tokens.join(F.broadcast(chosen), "id").select("id", "tokens", F.lit(0).alias("all")).groupBy("all").applyInPandas(
        fit, "name string, value binary").collect()
    got = {r["name"]: r["value"] for r in rows}
    w = new_weights()
    if got:
        w = {k: np.frombuffer(got[k], np.float32).reshape(a.shape).copy() for k, a in w.items()}
    for k, rate in enumerate(ROUNDS):
        def further(batches, w=w, rate=rate):
            new, seen = train_further(w, token_lists(batches, kind), unit_of, class_of, size, rate)
            if seen:
                flat = np.concatenate([a.ravel() for a in new.values()]).astype(np.float64) * seen
                yield pa.record_batch([pa.array(np.arange(len(flat))), pa.array(flat), pa.array(np.full(len(flat), seen))], ["slot", "value", "seen"])
        mean = tokens.where(F.col("round") == k).select("tokens").mapInArrow(further, "slot long, value double, seen long").groupBy("slot").agg(
            (F.sum("value") / F.sum("seen")).alias("value")).orderBy("slot").toArrow().column("value").to_numpy()
        if len(mean):
            cuts = np.cumsum([a.size for a in w.values()])[:-1]
            w = {name: part.reshape(a.shape).astype(np.float32) for (name, a), part in zip(w.items(), np.split(mean, cuts))}
    if own is not None:
        discard(own)

    def transitions(batches):
        total = np.zeros((CLASSES + 1) * size, np.int64)
        for b in batches:
            found, sizes, times = counted_words(b, kind)
            if len(found):
                before = np.concatenate([[LONE], class_of[found[:-1]]])
                before[np.cumsum(sizes) - sizes] = LONE
                np.add.at(total, before * size + found, np.repeat(times, sizes))
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["slot", "n"])
    # One row at most for each class and id, however large the corpus is.
    table = counts.select("tokens", "n").mapInArrow(transitions, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    pair = np.zeros((CLASSES + 1) * size)
    pair[table.column("slot").to_numpy()] = table.column("n").to_numpy()
    inner = inner_table(pair.reshape(CLASSES + 1, size), class_of, size)

    def sequence_sums(batches):
        for b in batches:
            found, sizes, times = counted_words(b, kind)
            found, which = np.unique(by_word(found, sizes, inner, class_of)[1], return_inverse=True)
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(np.bincount(which, times, len(found)).astype(np.int64)),
                                   pa.array(np.bincount(which, minlength=len(found)))], ["sequence", "seen", "kinds"])
    totals = save(counts.select("tokens", "n").mapInArrow(sequence_sums, "sequence long, seen long, kinds long").groupBy("sequence").agg(
        F.sum("seen").alias("seen"), F.sum("kinds").alias("kinds")), "lm-sequences")

    head = counts.orderBy(F.desc("n"), "h", "tokens").limit(HEAD).toArrow().combine_chunks()
    h = head.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(h)
    head = head.take(pa.array(order)).combine_chunks()
    n = head.column("n").to_numpy()
    smooth, sequence, real = np.zeros(len(n)), np.zeros(len(n), np.uint64), h[order] != END
    for b in head.to_batches():
        found, sizes, _ = counted_words(b, kind)
        smooth[real], sequence[real] = by_word(found, sizes, inner, class_of)
    sequences, which = np.unique(sequence[real], return_inverse=True)
    seen, kinds = np.zeros(len(sequences)), np.zeros(len(sequences))
    if len(sequences):
        wanted = docs.sparkSession.createDataFrame(pa.table({"sequence": sequences.view(np.int64)}))
        found = totals.join(F.broadcast(wanted), "sequence").toArrow()
        at = np.searchsorted(sequences, found.column("sequence").to_numpy().astype(np.int64).view(np.uint64))
        seen[at], kinds[at] = found.column("seen").to_numpy(), found.column("kinds").to_numpy()
    given = np.zeros(len(n))
    given[real] = np.log((n[real] + (kinds[which] + 1) * np.exp(smooth[real])) / (seen[which] + kinds[which] + 1))
    every = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    return Model(w=w, inner=inner, class_of=class_of, unit_of=unit_of, ranks=ranks, pattern=pattern, size=size, head=h[order], head_n=n,
                 given=given, sequences=sequences, seen=seen, kinds=kinds, total=every["n"] or 0, distinct=every["v"] or 0, totals=totals), counts


def inner_table(pair: np.ndarray, class_of: np.ndarray, size: int, own: float = 0.1, strength: float = 20.0) -> np.ndarray:
    """log P(id | its class, class before): counts smoothed towards the id's share of its class."""
    alone = pair.sum(0)
    of = class_of[:size]
    in_class = np.bincount(of, alone + own, CLASSES)
    share = (alone + own) / in_class[of]
    out = np.zeros((CLASSES + 1, size + 1), np.float32)  # the end is alone in its class: log 1
    for c in range(CLASSES + 1):
        seen = np.bincount(of, pair[c], CLASSES)
        out[c, :size] = np.log((pair[c] + strength * share) / (seen[of] + strength))
    return out


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score, score.

    Tokens: lower-cased words, then one end.  base_score: add-half unigram
    log10 probability with counts over the learning documents; score: the
    model's log10 probability of the same words (as subword ids) and the end.
    Null and empty texts are an end only.  Common words are scored from the
    model's head, the others are joined with the tables of word counts and of
    class sequences and added up per document; rows that repeat an id are
    scored apart.
    """
    size, kind = model.size, id_type(model.size)

    def run(batches):
        steady_memory()
        head_log = np.log10(model.head_n + 0.5)
        end_n = model.head_n[np.searchsorted(model.head, END)] if model.distinct else 0
        for b in pieces(batches, "tokens", limit=CHUNK, rows=20_000):
            tokens, cut_ids = parts(b, "tokens", kind)
            begin, lengths = first_ids(b, cut_ids)
            words, place, flat = distinct(word_hashes(tokens, begin))
            where, own_sizes = spread(np.diff(begin, append=len(tokens)), place)
            pool = tokens[where].astype(np.int32)
            n_docs = len(lengths)
            # base: words in the head are looked up here
            h = words
            at = np.minimum(np.searchsorted(model.head, h), max(0, len(model.head) - 1))
            known = model.head[at] == h if len(model.head) and len(words) else np.zeros(len(words), bool)
            value = np.where(known, head_log[at], 0.0) if len(words) and len(model.head) else np.zeros(len(words))
            owner = np.repeat(np.arange(n_docs), lengths)
            common = np.bincount(owner, value[flat], n_docs).astype(float) + np.log10(end_n + 0.5)
            n_known = np.bincount(owner, known[flat], n_docs).astype(np.int64) + (1 if end_n else 0)
            rare = ~known[flat]
            spot, times = np.unique(owner[rare] * max(1, len(words)) + flat[rare], return_counts=True)
            doc, word = spot // max(1, len(words)), spot % max(1, len(words))
            cut = np.searchsorted(doc, np.arange(n_docs + 1)).astype(np.int32)
            lists = lambda a, kind: pa.ListArray.from_arrays(pa.array(cut), pa.array(a, kind))
            # model: each distinct word once, then spread over the texts
            smooth, sequence = by_word(pool, own_sizes, model.inner, model.class_of)
            kinds, seen = np.full(len(words), -1, np.int64), np.full(len(words), -1, np.int64)  # -1: to be joined
            if len(model.sequences) and len(words):
                k = np.minimum(np.searchsorted(model.sequences, sequence), len(model.sequences) - 1)
                met = model.sequences[k] == sequence
                kinds, seen = np.where(met, model.kinds[k], -1).astype(np.int64), np.where(met, model.seen[k], -1).astype(np.int64)
            here = np.where(known, model.given[at], 0.0) if len(words) and len(model.head) else np.zeros(len(words))
            length = np.diff(cut_ids)
            logs = np.bincount(owner, here[flat], n_docs).astype(float)
            lo = 0
            while lo < n_docs:  # about 64,000 ids at a time
                hi = max(lo + 1, int(np.searchsorted(cut_ids, cut_ids[lo] + 65_536, "right")) - 1)
                part = tokens[cut_ids[lo]:cut_ids[hi]].astype(np.int32)
                logs[lo:hi] += score_classes(model.w, part, length[lo:hi], model.unit_of, model.class_of, size)
                lo = hi
            yield pa.record_batch([pa.array(ids(b, "row"), pa.int64()), pa.array(ids(b, id_col), pa.int64()), pa.array(lengths + 1),
                                   pa.array(n_known), pa.array(common), pa.array(logs / np.log(10)),
                                   lists(h[word].astype(np.int64), pa.int64()), lists(times, pa.int64()), lists(smooth[word], pa.float64()),
                                   lists(sequence[word].view(np.int64), pa.int64()), lists(seen[word], pa.int64()), lists(kinds[word], pa.int64())],
                                  ["row", "id", "n_tokens", "n_known", "common", "score", "h", "times", "smooth", "sequence", "seen", "kinds"])
    small_batches(docs.sparkSession)
    own = None if is_encoded(docs) else encode(docs, model.ranks, model.pattern, id_col, text_col)
    rows = docs if own is None else own
    scored = save(rows.mapInArrow(run, "row long, id long, n_tokens long, n_known long, common double, score double, "
                                       "h array<long>, times array<long>, smooth array<double>, sequence array<long>, seen array<long>, "
                                       "kinds array<long>"), "lm-scores")
    if own is not None:
        discard(own)
    rare = ["h", "times", "smooth", "sequence", "seen", "kinds"]
    tail = scored.select("row", F.inline(F.arrays_zip(*rare)))
    far = tail.where("seen < 0").drop("seen", "kinds").join(model.totals, "sequence", "left").fillna(0, ["seen", "kinds"])
    tail = tail.where("seen >= 0").unionByName(far)
    n, seen, kinds = F.coalesce("n", F.lit(0)), F.col("seen"), F.col("kinds") + 1
    given = F.when(n > 0, F.log((n + kinds * F.exp("smooth")) / (seen + kinds))).otherwise(F.log(kinds / (seen + kinds)) + F.col("smooth"))
    sums = tail.join(counts.select("h", "n"), "h", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare_sum"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * given).alias("rare_given"))
    spread_over = float(np.log10(model.total + 0.5 * (model.distinct + 1)))
    out = scored.drop(*rare).join(sums, "row", "left")
    return out.select(F.col("id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
                      F.lit(model.total).cast("long").alias("train_tokens"),
                      (F.col("common") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(spread_over)).alias("base_score"),
                      (F.col("score") + F.coalesce("rare_given", F.lit(0.0)) / F.lit(float(np.log(10)))).alias("score"))

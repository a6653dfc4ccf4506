"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = w0 + sum w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2): all pairwise
interactions through low-rank factors, in time linear in the features of a text.
"""
from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, free_name, ids, pieces, raw, small_batches

#: Bytes that are ASCII signs, digits, capitals (for structure statistics).
SIGNS, DIGITS, CAPITALS = b"!#$%&*+/<=>?@\\^_`{|}~", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
N_STATISTICS = 12
META = "given length"


def statistics(text: bytes, words: list[bytes], n_chars: float | None) -> list[float]:
    """Structure statistics, all of order 1; the last is the given length (metadata), if any."""
    n, size = max(1, len(words)), max(1, len(text))
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [math.log1p(len(words)) / 8, min(3.0, sum(map(len, words)) / n / 8), min(1.0, 5 * share(SIGNS)), min(1.0, 5 * share(DIGITS)),
            min(1.0, 3 * share(CAPITALS)), len(set(words)) / n, 1 - len(set(lines)) / max(1, len(lines)),
            min(1.0, len(lines) / n * 10), min(1.0, sum(map(text.count, (b".", b",", b";", b":"))) / n),
            min(1.0, text.count(b"!!") / n), min(1.0, text.count(b"|") / n),
            math.log1p(size if n_chars is None or n_chars != n_chars else max(0, n_chars)) / 12]


def features(text: bytes | None, n_chars, memory: WordHashes, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): statistics first, then distinct hashed words, the words' part of length 1."""
    text = text or b""
    words = text.split()
    lower = re.sub(rb"[.,;:]+(?=\s|$)", b"", text.lower()).split()
    slot, n = np.unique(np.fromiter(map(memory.__getitem__, lower), np.uint64) % np.uint64(slots), return_counts=True)
    weight = np.log1p(n)
    return (np.concatenate([np.arange(N_STATISTICS), slot.astype(np.int64) + N_STATISTICS]),
            np.concatenate([statistics(text, words, n_chars), weight / max(1e-9, math.sqrt((weight * weight).sum()))]))


class Machine:
    """Weights of the factorisation machine; everything is scored in groups of texts with flat arrays."""

    def __init__(self, w0: float, w: np.ndarray, v: np.ndarray):
        self.w0, self.w, self.v = w0, w, v

    def raw_scores(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        i = np.concatenate([r[0] for r in rows])
        x = np.concatenate([r[1] for r in rows])
        starts = np.concatenate([[0], np.cumsum([len(r[0]) for r in rows])[:-1]])
        vx = self.v[i] * x[:, None]
        s = np.add.reduceat(vx, starts, axis=0)
        pairs = (s * s - np.add.reduceat(vx * vx, starts, axis=0)).sum(1) / 2
        return self.w0 + np.add.reduceat(self.w[i] * x, starts) + pairs, i, x, vx, s

    def scores(self, rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw_scores(rows)[0], -30, 30)))


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, slots: int, rank: int = 8, epochs: int = 12,
          step: float = 0.1, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Logistic loss, AdaGrad over shuffled groups of 64."""
    rng = np.random.default_rng(seed)
    size = slots + N_STATISTICS
    m = Machine(0.0, np.zeros(size), rng.normal(0, 0.05, (size, rank)))
    g0, gw, gv = 1.0, np.ones(size), np.ones((size, rank))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 64):
            take = order[k:k + 64]
            part = [rows[j] for j in take]
            raw_score, i, x, vx, s = m.raw_scores(part)
            err = 1 / (1 + np.exp(-np.clip(raw_score, -30, 30))) - labels[take]
            each = np.repeat(err, [len(r[0]) for r in part])
            own = np.repeat(s, [len(r[0]) for r in part], axis=0)
            spot, where = np.unique(i, return_inverse=True)
            dw = np.bincount(where, each * x) + decay * m.w[spot]
            term = each[:, None] * x[:, None] * (own - vx)
            dv = np.stack([np.bincount(where, term[:, f]) for f in range(rank)], 1) + decay * m.v[spot]
            g0 += err.sum() ** 2
            gw[spot] += dw ** 2
            gv[spot] += dv ** 2
            m.w0 -= step * err.sum() / math.sqrt(g0)
            m.w[spot] -= step * dw / np.sqrt(gw[spot])
            m.v[spot] -= step * dv / np.sqrt(gv[spot])
    return m


def with_meta(docs: DataFrame, meta_col: str | None) -> Column:
    return F.col(meta_col).cast("double") if meta_col and meta_col in docs.columns else F.lit(None).cast("double")


def learn(docs: DataFrame, labels: DataFrame, learning: Column, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", meta_col: str | None = "n_chars", slots: int = 1 << 15, sample: int = 6000) -> Machine | None:
    """Fit on at most ``sample`` labelled documents, those of the smallest id hashes where ``learning`` holds.

    The bound keeps the fit in one task; its ids (at most ``sample``) are
    broadcast, so documents are not shuffled.  A document with several labels
    counts with the smallest.  None without both labels to learn from."""
    small_batches(docs.sparkSession)
    chosen = (labels.where(learning & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
              .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("double").alias("label"))
              .orderBy(F.xxhash64("id"), "id").limit(sample))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), with_meta(docs, meta_col).alias("meta")).join(
        F.broadcast(chosen), "id")

    def extract(batches):
        memory = WordHashes()
        for b in pieces(batches):
            got = [features(t, m, memory, slots) for t, m in zip(raw(b), b.column(b.schema.get_field_index("meta")).to_pylist())]
            memory.trim()
            yield pa.record_batch([pa.array(ids(b, "id"), pa.int64()), b.column(b.schema.get_field_index("label")),
                                   pa.array([i.astype(np.int32).tobytes() for i, _ in got], pa.binary()),
                                   pa.array([x.astype(np.float32).tobytes() for _, x in got], pa.binary())], ["id", "label", "i", "x"])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", kind="stable")
        data = [(np.frombuffer(i, np.int32).astype(np.int64), np.frombuffer(x, np.float32).astype(float)) for i, x in zip(frame["i"], frame["x"])]
        y = frame["label"].to_numpy()
        if len(set(y)) < 2:
            return pd.DataFrame({"w0": [], "w": [], "v": []})
        m = train(data, y, slots)
        return pd.DataFrame({"w0": [m.w0], "w": [m.w.astype(np.float32).tobytes()], "v": [m.v.astype(np.float32).tobytes()]})
    sampled = rows.mapInArrow(extract, "id long, label double, i binary, x binary").withColumn("all", F.lit(0))
    found = sampled.groupBy("all").applyInPandas(lambda f: fit(f), "w0 double, w binary, v binary").collect()
    if not found:
        return None
    w, v = (np.frombuffer(found[0][k], np.float32) for k in ("w", "v"))
    return Machine(found[0]["w0"], w, v.reshape(len(w), -1))


def predict(docs: DataFrame, model: Machine | None, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
            meta_col: str | None = "n_chars") -> DataFrame:
    """One row per document: id, score, predicted (1 from ``threshold`` on).

    Empty and null texts are scored by their statistics.  Without a model
    every score is 0.5.  One pass, no shuffle; labels, language, source and
    id do not enter the score."""
    small_batches(docs.sparkSession)
    run = scorer(model, text_col)

    def rows(batches):
        for b, s in run(batches):
            yield pa.record_batch([pa.array(ids(b, id_col), pa.int64()), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                  ["id", "score", "predicted"])
    out = docs.select(id_col, text_col, with_meta(docs, meta_col).alias(META)).mapInArrow(rows, "id long, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def scorer(model: Machine | None, text_col: str):
    slots = len(model.w) - N_STATISTICS if model else 1

    def run(batches):
        memory = WordHashes()
        for b in pieces(batches, text_col, limit=1 << 19, rows=2000):
            meta = b.column(b.num_columns - 1).to_pylist()  # the callers put it last
            if model is None:
                yield b, np.full(b.num_rows, 0.5)
                continue
            s = model.scores([features(t, m, memory, slots) for t, m in zip(raw(b, text_col), meta)])
            memory.trim()
            yield b, np.asarray(s, float)
    return run


def keep_good(docs: DataFrame, model: Machine | None, threshold: float = 0.3, text_col: str = "text",
              meta_col: str | None = "n_chars") -> DataFrame:
    """The documents that score at least ``threshold``, all columns as they are."""
    small_batches(docs.sparkSession)
    run, columns = scorer(model, text_col), docs.columns

    def rows(batches):
        for b, s in run(batches):
            yield b.select(columns).filter(pa.array(s >= threshold))
    return docs.select("*", with_meta(docs, meta_col).alias(free_name(docs, META))).mapInArrow(rows, docs.schema)

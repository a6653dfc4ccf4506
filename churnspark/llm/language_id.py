"""Language identification by the nearest of several centroids per language.

Texts become L2-normalised TF-IDF vectors of hashed byte n-grams.  Document
frequencies are counted over all learning documents; each language's
vectors of a bounded sample are clustered, and a text takes the language of
the centroid with the greatest cosine.  A text further from its centroid
than that centroid's own members lie is marked as rejected.
"""
from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ids, pieces, raw

#: ASCII: A-Z lower-cased, all that is no letter becomes a space; other bytes stay.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Documents whose dense vectors a task holds at a time.
ROWS = 128


def counts(texts: list[bytes], dims: int) -> np.ndarray:
    """Hashed counts of runs of 1 to 3 bytes, one row per text."""
    folded = [re.sub(rb"  +", b" ", t.translate(FOLD)) + b"  " for t in texts]
    out = np.zeros(len(texts) * dims, np.float32)
    a = np.frombuffer(b"".join([*folded, b"  "]), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in folded])
    ends = np.cumsum([len(t) for t in folded])
    own = np.ones(len(row), bool)  # runs begin at a text's own bytes, so none reaches into the next text
    own[ends - 1] = own[ends - 2] = False
    row, one, second, third = row[own], a[:-2][own], a[1:-1][own], a[2:][own]
    two = one * np.uint32(257) + second + np.uint32(1000)
    three = (one * np.uint32(257) + second) * np.uint32(257) + third + np.uint32(70000)
    base = row * dims
    for code in (one, two, three):
        mixed = code * np.uint32(2654435761)
        mixed ^= mixed >> np.uint32(15)
        slot = base + (mixed % np.uint32(dims)).astype(np.int64)
        out += np.bincount(slot, minlength=len(out)).astype(np.float32)
    return out.reshape(len(texts), dims)


def vectors(texts: list[bytes], idf: np.ndarray) -> np.ndarray:
    tf = counts(texts, len(idf))
    np.log1p(tf, out=tf)
    tf *= idf
    norm = np.sqrt((tf * tf).sum(1, keepdims=True))
    return tf / np.maximum(norm, 1e-9)


def has_letter(text: bytes | None) -> bool:
    """True with a character of the Unicode category L (``str.isalpha``; digits, fractions and Roman numerals are of category N)."""
    return bool(text) and (re.search(rb"[A-Za-z]", text) is not None or any(map(str.isalpha, set(text.decode()))))


def cluster(v: np.ndarray, k: int, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means; starts from the vectors farthest from those chosen before.  (centroids, least own cosine)"""
    chosen = [v.mean(0)]
    while len(chosen) < min(k, len(v)):
        near = np.max(v @ np.stack(chosen).T, axis=1)
        chosen.append(v[int(near.argmin())])
    c = np.stack(chosen)
    for _ in range(rounds):
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        own = (v @ c.T).argmax(1)
        c = np.stack([v[own == j].mean(0) if (own == j).any() else c[j] for j in range(len(c))])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    cos = v @ c.T
    own = cos.argmax(1)
    least = np.array([cos[own == j, j].min() if (own == j).any() else 0.0 for j in range(len(c))])
    return c, least


class Centroids:
    def __init__(self, idf: np.ndarray, langs: list[str], matrix: np.ndarray, least: np.ndarray):
        self.idf, self.langs, self.matrix, self.least = idf, langs, matrix, least


def learn(docs: DataFrame, learning: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          dims: int = 4096, clusters: int = 4, sample: int = 400) -> Centroids:
    """Fit on rows where ``learning`` holds and the language is known.

    Document frequencies: all of them.  Clusters: about ``sample`` documents
    of each language, those of the smallest id hashes (so at most a few
    megabytes of vectors for each language, clustered in one task each)."""
    known = docs.where(learning & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def frequencies(batches):
        total, n = np.zeros(dims, np.int64), 0
        for b in pieces(batches, rows=ROWS):
            c = counts([t or b"" for t in raw(b)], dims)
            total += (c > 0).sum(0)
            n += len(c)
        yield pa.record_batch([pa.array(np.arange(dims + 1)), pa.array(np.append(total, n))], ["slot", "n"])
    found = known.select("text").mapInArrow(frequencies, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(dims + 1)
    for r in found:
        df[r["slot"]] = r["n"]
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)

    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # one row per language
    langs = sorted(sizes)
    if not langs:
        return Centroids(idf, [], np.zeros((0, dims), np.float32), np.zeros(0))
    part = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample / sizes[k]))])
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    taken = known.where(chance < part[F.col("lang")])

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        texts = [t.encode() for t in frame["text"]]
        v = np.concatenate([vectors(texts[i:i + ROWS], idf) for i in range(0, len(texts), ROWS)])
        c, least = cluster(v, clusters)
        return pd.DataFrame({"lang": frame["lang"].iloc[0], "j": range(len(c)), "least": least.astype(float),
                             "centre": [x.astype(np.float32).tobytes() for x in c]})
    rows = sorted(taken.groupBy("lang").applyInPandas(fit, "lang string, j int, least double, centre binary").collect(),
                  key=lambda r: (r["lang"], r["j"]))
    return Centroids(idf, [r["lang"] for r in rows], np.stack([np.frombuffer(r["centre"], np.float32) for r in rows])
                     if rows else np.zeros((0, dims), np.float32), np.array([r["least"] for r in rows]))


def predict(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text", slack: float = 0.8) -> DataFrame:
    """One row per document: id, lang_pred, score (cosine with the nearest centroid), rejected.

    ``und`` with score 0 if the text is null or has no letter (or nothing was
    learned).  rejected: nearer to no centroid than ``slack`` times the
    cosine of that centroid's farthest member; lang_pred still names the
    nearest.  Only the text is read.  One pass, no shuffle."""
    def run(batches):
        for b in pieces(batches, text_col, rows=ROWS):
            texts = raw(b, text_col)
            v = vectors([t or b"" for t in texts], model.idf)
            lang, score, far = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            if len(model.langs):
                cos = v @ model.matrix.T
                near = cos.argmax(1)
                for i, t in enumerate(texts):
                    if has_letter(t):
                        j = near[i]
                        lang[i], score[i] = model.langs[j], min(1.0, max(0.0, float(cos[i, j])))
                        far[i] = cos[i, j] < slack * model.least[j]
            yield pa.record_batch([pa.array(ids(b, id_col), pa.int64()), pa.array(lang), pa.array(score), pa.array(far)],
                                  ["id", "lang_pred", "score", "rejected"])
    out = docs.select(id_col, text_col).mapInArrow(run, "id long, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("id", id_col)

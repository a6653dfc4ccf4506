"""Removal of long repeated passages with a sparse De Bruijn graph of token k-mers.

Every window of 50 words holds 35 runs of 16 words.  The run with the least
hash of each window is an edge of the graph; links join an edge to the next
one in a document.  Edges that occur in one document only are dropped,
nonbranching paths are compacted by joins (pointer doubling), and an
occurrence of a path in a document is one row: path, diagonal, begin, end.
Back at those source coordinates the 50-word windows are compared, each by 96
bits of two hashes over its words' 64-bit hashes; a window that also starts in
a document of smaller id is removed.  Rows are told apart by id and text, so an
id may come with several texts: each keeps its own passages, and the id alone
decides which document is the earlier one.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, discard, discard_since, free_name, ids, open_tables, pieces, raw, save

WINDOW, EDGE = 50, 16
REACH = WINDOW - EDGE + 1
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def runs(h: np.ndarray, n: int, factor: np.uint64) -> np.ndarray:
    """Hashes of all runs of ``n`` word hashes, by doubling: a run of a + b words from runs of a and of b."""
    out, have, block, size = None, 0, h, 1
    left = n
    while left:
        if left & 1:
            if out is None:
                out = block
            else:
                reach = len(h) - have - size + 1
                out = out[:reach] * power(factor, size) + block[have:have + reach]
            have += size
        left >>= 1
        if left:
            reach = len(h) - 2 * size + 1
            block = block[:reach] * power(factor, size) + block[size:size + reach]
            size *= 2
    out = out ^ (out >> np.uint64(32))
    out = out * M2
    return out ^ (out >> np.uint64(29))


def power(factor: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(factor), n, 1 << 64))


def sliding_least(x: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every ``n`` neighbours, from running minima of blocks in both directions."""
    blocks = np.concatenate([x, np.full(-len(x) % n, 0xFFFFFFFFFFFFFFFF, np.uint64)]).reshape(-1, n)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:len(x) - n + 1], ahead[n - 1:len(x)])


def edges_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, lo, hi) of the least 16-word run of every 50-word window, neighbours with the same one together.

    The windows inside words [lo, hi) have this run as their least.  It depends on the window's words
    alone, so equal windows have equal edges; a window can only repeat if its edge does."""
    e = runs(h, EDGE, M1)
    low = np.uint64(63)  # the place's last bits ride along; equal runs may tie, their hash is the same
    least = sliding_least((e & ~low) | (np.arange(len(e), dtype=np.uint64) & low), REACH)
    start = np.arange(len(least))
    place = start + (((least & low).astype(np.int64) - start) & 63)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    at = place[first]
    return e[at], at, first, last + WINDOW


def row_key(text_col: str):
    """128 bits of a text; with the id it names a row."""
    return F.unhex(F.md5(F.col(text_col).cast("binary")))


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row, n_words, sha (of all words), print (of all words), and the edges: key, pos, lo, hi.

    [lo, hi): words whose windows have this edge."""
    def run(batches):
        memory = WordHashes()
        for b in pieces(batches):
            out = []
            for t in raw(b):
                words = (t or b"").split()
                whole = b" ".join(words)
                row = [len(words), hashlib.sha256(whole).hexdigest(), xxhash.xxh3_128_digest(whole), [], [], [], []]
                if len(words) >= WINDOW:
                    h = np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))
                    key, *places = edges_of(h)
                    row[3:] = [key.astype(np.int64), *[x.astype(np.int32) for x in places]]
                out.append(row)
                memory.trim()
            c = list(zip(*out))
            yield pa.record_batch([pa.array(ids(b, "id"), pa.int64()), b.column(b.schema.get_field_index("row")), pa.array(c[0], pa.int64()),
                                   pa.array(c[1]), pa.array(c[2], pa.binary()),
                                   pa.array(c[3], pa.list_(pa.int64())), *[pa.array(x, pa.list_(pa.int32())) for x in c[4:]]],
                                  ["id", "row", "n_words", "sha", "print", "key", "pos", "lo", "hi"])
    return keyed(docs, id_col, text_col).mapInArrow(
        run, "id long, row binary, n_words long, sha string, print binary, key array<long>, pos array<int>, lo array<int>, hi array<int>")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row_key(text_col).alias("row"))


def compact(links: DataFrame, edges: DataFrame) -> DataFrame:
    """(key, head, offset): the nonbranching path of each edge and its distance in words from the path's head.

    links: distinct (key, next, gap).  A link is kept if it is the only one
    out of its edge and the only one into the next; then every edge has at
    most one predecessor and pointers double: each round joins every edge to
    the predecessor of its predecessor.  Rings have no head; once only rings
    are left their edges stay alone."""
    single_out = links.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("key")
    single_in = links.groupBy("next").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("next")
    back = (links.join(single_out, "key").join(single_in, "next").where("key != next")
            .select(F.col("next").alias("key"), F.col("key").alias("head"), F.col("gap").cast("long").alias("offset")))
    now = save(edges.join(back, "key", "left"), "paths")  # head: null at a path's start
    open_before = None
    while True:
        up = now.where("head is not null").select(F.col("key").alias("head"), F.col("head").alias("further"), F.col("offset").alias("more"))
        step = now.join(up, "head", "left").select(
            "key", F.coalesce("further", "head").alias("head"),
            (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"), F.col("further").isNotNull().alias("moved"))
        new = save(step, "paths")
        discard(now)
        unfinished = new.where("moved").count()
        now = new.drop("moved")
        now.__dict__["scratch"] = new.__dict__["scratch"]
        if unfinished == 0:
            return now.select("key", F.coalesce("head", "key").alias("head"), F.coalesce("offset", F.lit(0)).alias("offset"))
        if unfinished == open_before:  # rings only
            return new.select("key", F.when(F.col("moved"), F.col("key")).otherwise(F.coalesce("head", "key")).alias("head"),
                              F.when(F.col("moved"), F.lit(0)).otherwise(F.coalesce("offset", F.lit(0))).alias("offset"))
        open_before = unfinished


def repeats(docs: DataFrame, id_col: str, text_col: str):
    """(id, row, n_words, sha of every document, texts with candidate passages, (id, row, starts) of windows to remove, (id, row) of copies).

    Nothing here has a size bound, so the large sides are never joined by broadcast: one plan at every size."""
    mark = open_tables()
    every = save(scan(docs, id_col, text_col), "substring-scan")
    long = every.where(f"n_words >= {WINDOW} and id is not null")
    first = long.groupBy("print").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    copies = save(long.select("id", "row", "print").join(first, "print").where("id > first").select("id", "row").distinct(), "substring-copies")
    # Whole copies lose everything; their windows also stand in the first one, so they add no edges.
    first_ones = save(long.select("id", "row", "key", "pos", "lo", "hi").hint("merge").join(copies, ["id", "row"], "left_anti"), "substring-first")
    sizes = save(every.select("id", "row", "n_words", "sha"), "substring-sizes")  # all that is read of the scan from now on
    discard(every)
    single = first_ones.select("id", "row", F.explode(F.arrays_zip("key", "pos", "lo", "hi")).alias("e")).select("id", "row", "e.*")
    shared = save(single.groupBy("key").agg(F.min("id").alias("x"), F.max("id").alias("y")).where("x < y").select("key"), "substring-edges")
    found = save(single.hint("merge").join(shared, "key"), "substring-places")
    discard(first_ones)
    following = Window.partitionBy("id", "row").orderBy("pos")
    links = save(found.select("key", F.lead("key").over(following).alias("next"),
                              (F.lead("pos").over(following) - F.col("pos")).alias("gap")).where("next is not null").distinct(), "substring-links")
    paths = compact(links, shared)
    spans = (found.join(paths, "key").groupBy("id", "row", "head", (F.col("pos") - F.col("offset")).alias("diagonal"))
             .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .groupBy("id", "row").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))  # a document's spans: fewer than its words
    spans = save(spans, "substring-spans")
    discard(shared, found, links, paths)
    # A number for each text, written with it: shorter than its key in the many rows of its windows.
    texts = save(keyed(docs, id_col, text_col).hint("merge").join(spans, ["id", "row"]).withColumn("number", F.monotonically_increasing_id()), "substring-texts")
    discard(spans)

    def windows(batches):
        memory = WordHashes()
        for b in pieces(batches):
            for i, number, t, s in zip(ids(b, "id"), ids(b, "number"), raw(b), ids(b, "spans")):
                h = np.fromiter(map(memory.__getitem__, t.split()), np.uint64)
                inside = np.zeros(len(h) + 1, np.int64)
                end = -1
                for x in sorted((x["lo"], x["hi"]) for x in s):  # overlapping spans are one: a window may hold edges of several paths
                    if x[0] > end:
                        begin, end = x
                    end = max(end, x[1])
                    if end - begin >= WINDOW:
                        inside[begin:end - WINDOW + 1] = 1
                at = np.flatnonzero(inside)
                a, c = runs(h, WINDOW, M1)[at], runs(h, WINDOW, M2)[at]
                memory.trim()
                yield pa.record_batch([pa.array(a.astype(np.int64)), pa.array((c >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                                       pa.array(np.full(len(at), i, np.int64)), pa.array(np.full(len(at), number, np.int64)),
                                       pa.array(at.astype(np.int32))], ["h", "g", "id", "number", "at"])
    exact = save(texts.mapInArrow(windows, "h long, g int, id long, number long, at int"), "substring-windows")
    # Written first, so that the join below reads two plain exchanges and a hot window's rows can be split.
    least = save(exact.groupBy("h", "g").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
                 .select("h", "g", "first"), "substring-least")
    starts = exact.join(least, ["h", "g"]).where("id > first").groupBy("number").agg(F.collect_set("at").alias("starts"))
    remove = save(starts.join(texts.select("number", "id", "row"), "number").select("id", "row", "starts").dropDuplicates(["id", "row"]),
                  "substring-starts")
    discard_since(mark, sizes, texts, remove, copies)
    return sizes, texts, remove, copies


def removed_mask(n: int, starts: list[int]) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    at = np.array(starts, np.int64)
    edge[at] += 1
    edge[at + WINDOW] -= 1
    return np.cumsum(edge[:-1]) > 0


def digest_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 (of the kept words, one space between).

    Removed: every word in a window of 50 words that also starts in a
    document of smaller id, judged on the input.  Null and empty texts have
    no words; texts under 50 words keep all.  Rows that repeat an id do not
    remove each other's words.  Empty input: no rows."""
    mark = open_tables()
    every, texts, remove, copies = repeats(docs, id_col, text_col)

    def run(batches):
        for b in pieces(batches):
            out = []
            for t, s in zip(raw(b), ids(b, "starts")):
                words = t.split()
                gone = removed_mask(len(words), s)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest()))
            c = list(zip(*out))
            yield pa.record_batch([b.column(b.schema.get_field_index("id")), b.column(b.schema.get_field_index("row")),
                                   pa.array(c[0], pa.int64()), pa.array(c[1])], ["id", "row", "removed", "kept"])
    changed = save(texts.select("id", "row", "text").join(remove, ["id", "row"]).mapInArrow(
        run, "id long, row binary, removed long, kept string").dropDuplicates(["id", "row"]), "substring-kept")
    discard(texts, remove)
    n = F.col("n_words")
    out = (every.select("id", "row", "n_words", "sha").join(copies.withColumn("copy", F.lit(True)), ["id", "row"], "left")
           .join(changed, ["id", "row"], "left"))
    gone = F.when(F.col("copy"), n).otherwise(F.coalesce("removed", F.lit(0)))
    result = save(out.select(F.col("id").alias(id_col), "n_words", gone.cast("long").alias("n_removed"),
                             F.when(F.col("copy"), F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256")), "substring-result")
    discard_since(mark, result)
    return result


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """The documents with repeated passages cut out of their texts, all columns as they are.

    Kept stretches keep their own white space and are joined by one space;
    texts that lose nothing stay as they are, null texts stay null.
    ``size_col``, if the table has it, becomes the new text's length."""
    every, texts, remove, copies = repeats(docs, id_col, text_col)
    discard(every, texts)
    key, row, starts_col = (free_name(docs, n) for n in ("marked id", "marked row", "marked starts"))
    marks = remove.unionByName(copies.withColumn("starts", F.array(F.lit(-1)))).select(
        F.col("id").alias(key), F.col("row").alias(row), F.col("starts").alias(starts_col))
    joined = docs.hint("merge").join(marks, (F.col(id_col) == F.col(key)) & (row_key(text_col) == F.col(row)), "left").drop(key, row)
    columns = docs.columns

    def cut(text: bytes, starts: list[int]) -> bytes:
        if starts == [-1]:
            return b""
        words = text.split()
        gone = removed_mask(len(words), starts).tolist()
        out, at, begin = [], 0, None
        for w, g in zip(words, gone):
            at = text.index(w, at)
            if g:
                if begin is not None:
                    out.append(text[begin:end])
                begin = None
            else:
                begin = at if begin is None else begin
            at += len(w)
            end = at
        if begin is not None:
            out.append(text[begin:])
        return b" ".join(out)

    def run(batches):
        for b in pieces(batches, text_col):
            new = [t if t is None or s is None else cut(t, s) for t, s in zip(raw(b, text_col), ids(b, starts_col))]
            new = [None if t is None else t.decode() for t in new]
            out = b.select(columns)
            out = out.set_column(out.schema.get_field_index(text_col), text_col, pa.array(new, pa.string()))
            if size_col in columns:
                at = out.schema.get_field_index(size_col)
                old = out.column(at).to_pylist()
                sizes = [o if s is None or t is None else len(t) for o, t, s in zip(old, new, ids(b, starts_col))]
                out = out.set_column(at, size_col, pa.array(sizes, out.schema.field(at).type))
            yield out
    return joined.mapInArrow(run, docs.schema)

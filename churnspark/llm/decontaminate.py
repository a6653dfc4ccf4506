"""Benchmark decontamination: rare word pairs join passages to test items, then Smith-Waterman alignment of words.

Seeds are pairs of words at most two places apart.  Every alignment that
reaches the threshold holds at least ``need`` of its item's seeds.  The index
leaves the ``common`` most frequent seeds of an item out, by their number in the
corpus, two thirds of those that a passage could miss; so a passage holds at
least ``need - common`` of the rare ones that it keeps, and none is lost.

1. The items' seeds are a table; a bitmap of fixed size marks their hashes.
2. One pass over the documents writes the seeds whose bit is set, with their
   places, and these are counted.
3. The rare seeds of each item are joined to the places.  Enough hits close
   together mark a passage; only texts with such passages are read again, and cut.
4. Passages join their items, are sifted by the number of all seeds they hold, and
   aligned; the alignment's score tells copies, also edited ones, from chance.

Neither items nor hits ever meet on the driver: only the bitmap does.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, discard_since, free_name, ids, open_tables, pieces, raw, save

PUNCTUATION = b".,;:!?\"'()[]{}"
MATCH, MISMATCH, GAP = 2, -1, -1
STEP = np.uint64(0x9E3779B97F4A7C15)
#: The bitmap's bits: 4 MB, whatever the number of items.  A larger benchmark sets more of them; the join stays exact.
BITMAP = 1 << 25


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(None, PUNCTUATION).split()


def seeds(h: np.ndarray, gap: int) -> np.ndarray:
    """64-bit hashes of each word hash with the one ``gap`` places on; gap 0: of single words."""
    out = h[:max(0, len(h) - gap)] * STEP
    out += h[gap:] if gap else np.uint64(1)
    return out ^ (out >> np.uint64(31))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and where it ends in the passage (Smith-Waterman, linear gaps).

    Row by row; gaps along the row are a running maximum."""
    row = np.zeros(len(passage) + 1, np.int64)
    slope = GAP * np.arange(len(passage) + 1)
    best = end = 0
    for w in item:
        new = np.zeros_like(row)
        new[1:] = np.maximum(row[:-1] + np.where(passage == w, MATCH, MISMATCH), row[1:] + GAP)
        np.maximum(new, 0, out=new)
        new = np.maximum.accumulate(new - slope) + slope
        top = int(new.argmax())
        if new[top] > best:
            best, end = int(new[top]), top
        row = new
    return best, end


MATCHES = "id long, row binary, item long, score double, first_word long, end_word long"


def shape(size: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(need, reach, single) of items of ``size`` words.

    Let an alignment of ``n`` words score ``least = threshold * 2n`` with ``m``
    matches.  Its edits cost one each, so the m - 1 gaps between following
    matches hold at most 2m - least edits, and at least least / 2 - 1 of the
    gaps hold one edit or none: there the two matched words stand one or two
    places apart in the item as well as in the passage.  Such word pairs are
    the seeds; each starts at its own word of the item and of the passage.
    Items that one matched word already lets pass have their words as seeds.
    reach: words that an accepted alignment spans at most."""
    least = np.maximum(1, np.ceil(threshold * MATCH * size - 1e-9).astype(np.int64))
    return np.maximum(1, (least + 1) // 2 - 1), size + np.maximum(0, MATCH * size - least), least <= MATCH


def gaps_of(single: bool) -> tuple[int, ...]:
    return (0,) if single else (1, 2)


def all_seeds(h: np.ndarray, gaps=(0, 1, 2)) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, place of each one's first word)."""
    found = [seeds(h, g) for g in gaps]
    return np.concatenate(found), np.concatenate([np.arange(len(f)) for f in found])


def row_key(id_col: str, text_col: str):
    """128 bits of an id and its text; null ids have a name of their own."""
    return F.unhex(F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(" "), F.col(text_col)).cast("binary")))


def item_table(items: DataFrame, threshold: float, item_id: str, text_col: str) -> DataFrame:
    """item, words (their hashes), need, reach, single, seeds, key: a number for each distinct item and words.  Items without words are left out."""
    def run(batches):
        memory = WordHashes()
        for b in pieces(batches, "text"):
            hs = [np.fromiter(map(memory.__getitem__, words_of(t)), np.uint64) for t in raw(b)]
            need, reach, single = shape(np.array([len(h) for h in hs], np.int64), threshold)
            found = [all_seeds(h, gaps_of(one))[0].view(np.int64) for h, one in zip(hs, single)]
            yield pa.record_batch([pa.array(ids(b, "item"), pa.int64()), pa.array([h.tobytes() for h in hs], pa.binary()),
                                   pa.array(need), pa.array(reach), pa.array(single), pa.array(found, pa.list_(pa.int64()))],
                                  ["item", "words", "need", "reach", "single", "seeds"])
            memory.trim()
    table = items.select(F.col(item_id).cast("long").alias("item"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        run, "item long, words binary, need long, reach long, single boolean, seeds array<long>").where(F.length("words") > 0)
    return table.groupBy("item", "words").agg(*[F.first(c).alias(c) for c in ("need", "reach", "single", "seeds")]).withColumn(
        "key", F.monotonically_increasing_id())


def bitmap(seeds_of: DataFrame) -> np.ndarray:
    """One bit for each hash of ``seed``, as BITMAP / 64 words: all that the driver sees of the items."""
    spot = F.pmod("seed", F.lit(BITMAP))
    rows = seeds_of.select(F.shiftright(spot, 6).alias("word"), F.expr("shiftleft(1L, cast(pmod(seed, 64) as int))").alias("bit")).groupBy("word").agg(
        F.bit_or("bit").alias("bits")).toArrow()
    words = np.zeros(BITMAP // 64, np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return words.view(np.uint64)


def marked(bits: np.ndarray, found: np.ndarray) -> np.ndarray:
    spot = found & np.uint64(BITMAP - 1)
    return bits[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63)) & np.uint64(1) == 1


def seed_places(docs: DataFrame, bits: np.ndarray, gaps: tuple[int, ...], id_col: str, text_col: str) -> DataFrame:
    """row, seed, place of every marked seed of every document."""
    def run(batches):
        memory = WordHashes()
        for b in pieces(batches, "text"):
            for row, t in zip(ids(b, "row"), raw(b)):
                h = np.fromiter(map(memory.__getitem__, words_of(t)), np.uint64)
                found, place = all_seeds(h, gaps)
                hit = np.flatnonzero(marked(bits, found))
                if len(hit):
                    yield pa.record_batch([pa.array([row] * len(hit), pa.binary()), pa.array(found[hit].view(np.int64)),
                                           pa.array(place[hit].astype(np.int32))], ["row", "seed", "place"])
            memory.trim()
    return keyed(docs, id_col, text_col).where("text is not null").select("text", "row").mapInArrow(
        joined(run), "row binary, seed long, place int")


def joined(run, rows: int = 65_536):
    """Batches of ``run``, gathered to about ``rows`` rows."""
    def gathered(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, n = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
    return gathered


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), row_key(id_col, text_col).alias("row"))


def rarest(items: DataFrame, places: DataFrame) -> DataFrame:
    """(seed, key, reach, hits): each item's seeds without its most frequent ones in the corpus, and how many of these an accepted passage holds at least."""
    each = items.select("key", "need", "reach", F.posexplode("seeds").alias("at", "seed"))
    counted = places.groupBy("seed").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("key").orderBy(F.coalesce("n", F.lit(0)), "seed", "at")  # the seeds of one item
    common = F.floor((F.col("need") - 1) * 2 / 3)
    ranked = each.join(counted, "seed", "left").withColumn("rank", F.row_number().over(order)).withColumn("all", F.count(F.lit(1)).over(Window.partitionBy("key")))
    kept = ranked.where(F.col("n").isNotNull() & (F.col("rank") <= F.col("all") - common))
    return kept.select("seed", "key", "reach", (F.col("need") - common).cast("int").alias("hits")).distinct()


def cut_passages(docs: DataFrame, hits: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, row, key, first, words: the stretches of texts around their hits, overlapping ones as one."""
    met = hits.groupBy("row", "key").agg(F.first("reach").alias("reach"), F.first("hits").alias("hits"),
                                         F.sort_array(F.collect_set("place")).alias("at")).where(F.size("at") >= F.col("hits"))
    # The hits from which on enough others follow within the reach; an accepted passage lies around one of them.
    close = F.transform(F.sequence(F.lit(0), F.size("at") - F.col("hits")), lambda i: F.when(
        F.get("at", i + F.col("hits") - 1) - F.get("at", i) <= F.col("reach"), F.get("at", i)))
    spans = met.select("row", "key", "reach", F.array_compact(close).alias("places")).where(F.size("places") > 0)
    spans = save(spans.groupBy("row").agg(F.collect_list(F.struct("key", "reach", "places")).alias("spans")), "leak-spans")  # a text's own hits
    texts = keyed(docs, id_col, text_col).join(spans.hint("merge"), "row")  # one plan at every size: texts are shuffled this once

    def run(batches):
        memory = WordHashes()
        for b in pieces(batches, "text"):
            for i, row, t, found in zip(ids(b, "id"), ids(b, "row"), raw(b), ids(b, "spans")):
                h = np.fromiter(map(memory.__getitem__, words_of(t)), np.uint64)
                out = []
                for s in found:
                    lo = hi = None
                    for p in s["places"]:
                        if hi is not None and p - s["reach"] <= hi:
                            hi = min(len(h), p + s["reach"])
                            continue
                        if hi is not None:
                            out.append((s["key"], lo, hi))
                        lo, hi = max(0, p - s["reach"]), min(len(h), p + s["reach"])
                    out.append((s["key"], lo, hi))
                yield pa.record_batch([pa.array([i] * len(out), pa.int64()), pa.array([row] * len(out), pa.binary()),
                                       pa.array([k for k, _, _ in out], pa.int64()), pa.array([lo for _, lo, _ in out], pa.int64()),
                                       pa.array([h[lo:hi].tobytes() for _, lo, hi in out], pa.binary())], ["id", "row", "key", "first", "passage"])
            memory.trim()
    return texts.select("id", "row", "text", "spans").mapInArrow(joined(run, 4096), "id long, row binary, key long, first long, passage binary")


def enough_seeds(item: np.ndarray, passage: np.ndarray, need: int, reach: int, single: bool) -> bool:
    """Some stretch of ``reach`` words of the passage holds ``need`` starts of the item's seeds."""
    own, _ = all_seeds(item, gaps_of(single))
    found, place = all_seeds(passage, gaps_of(single))
    starts = np.unique(place[np.isin(found, own)])
    last = np.arange(need - 1, len(starts))
    return bool(len(last)) and bool((starts[last] - starts[last - need + 1] <= reach).any())


def scored(passages: DataFrame, items: DataFrame, threshold: float) -> DataFrame:
    """id, row, item, score, first_word, end_word of the passages that reach the threshold."""
    def run(batches):
        for b in batches:
            out = []
            for i, row, item, words, need, reach, single, first, passage in zip(*(b.column(c).to_pylist() for c in range(9))):
                h, p = np.frombuffer(words, np.uint64), np.frombuffer(passage, np.uint64)
                if not enough_seeds(h, p, need, reach, single):
                    continue
                score, end = align(h, p)
                if score / (MATCH * len(h)) >= threshold:
                    _, back = align(h[::-1], p[:end][::-1])
                    out.append((i, row, item, score / (MATCH * len(h)), first + end - back, first + end))
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.binary(), pa.int64(), pa.float64(), pa.int64(), pa.int64()))],
                                      ["id", "row", "item", "score", "first_word", "end_word"])
    both = passages.join(items.select("key", "item", "words", "need", "reach", "single"), "key").select(
        "id", "row", "item", "words", "need", "reach", "single", "first", "passage")
    return both.mapInArrow(run, MATCHES)


def matches(docs: DataFrame, items: DataFrame, threshold: float, id_col: str, text_col: str, item_id: str, item_text: str) -> DataFrame:
    """id, row, item, score, first_word, end_word: the best passage of each item in each distinct text, a written table."""
    mark = open_tables()
    table = save(item_table(items, threshold, item_id, item_text), "leak-items")
    every = table.select(F.explode("seeds").alias("seed"))
    kinds = table.agg(F.max("single"), F.max(~F.col("single"))).first()
    if kinds[0] is None:  # no items
        discard_since(mark)
        return docs.sparkSession.createDataFrame([], MATCHES)
    gaps = tuple(g for g, some in ((0, kinds[0]), (1, kinds[1]), (2, kinds[1])) if some)
    places = save(seed_places(docs, bitmap(every), gaps, id_col, text_col), "leak-places")
    hits = places.join(save(rarest(table, places), "leak-seeds"), "seed").select("row", "key", "reach", "hits", "place")
    passages = save(cut_passages(docs, hits, id_col, text_col), "leak-passages")
    best = F.max_by(F.struct("score", "first_word", "end_word"), F.struct("score", -F.col("end_word")))
    found = scored(passages, table, threshold).groupBy("row", "item").agg(F.first("id").alias("id"), best.alias("best")).select(
        "id", "row", "item", "best.*")
    out = save(found, "leak-matches")
    discard_since(mark, out)
    return out


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.5, id_col: str = "doc_id",
                 text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per (document, item) whose best passage scores at least ``threshold``.

    Columns: id, item_id, score (alignment score over that of a full copy),
    first_word, end_word (the passage, counted in words of the document
    without punctuation marks; ties: the one that ends first).  The rows are
    those of a Smith-Waterman alignment of every item with every document: at
    0.5, one word of an item of two is enough.  Null or empty texts and items
    match nothing; repeated documents give a row each, repeated items are taken
    once.  Without items or documents there are no rows."""
    found = matches(docs, items, threshold, id_col, text_col, item_id, item_text)
    own = keyed(docs, id_col, text_col).select("row").join(found.select("row").distinct(), "row", "left_semi")
    rows = found.join(own.groupBy("row").agg(F.count(F.lit(1)).alias("times")), "row").withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return rows.select(F.col("id").alias(id_col), F.col("item").alias(item_id), "score", "first_word", "end_word")


def without_contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                         item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that hold no passage of any item, all columns as they are.  Null texts stay."""
    name = free_name(docs, "leaked row")
    found = matches(docs, items, threshold, id_col, text_col, item_id, item_text).select(F.col("row").alias(name)).distinct()
    return docs.join(found, row_key(id_col, text_col) == F.col(name), "left_anti")

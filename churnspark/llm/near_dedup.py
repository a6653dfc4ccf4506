"""Near-duplicate detection with HyperMinHash sketches.

A document is the set of its distinct word shingles.  A shingle's hash picks
one of 256 buckets; a bucket keeps its least remaining value as leading-zero
count plus ten mantissa bits.  Bands of compressed registers give candidates;
a collision-corrected Jaccard estimate drops the hopeless ones, whole sets
confirm the rest.

Copies are never expanded into all pairs.  Equal sets are one class.  Every
band group first links its members to its least one.  Groups of the same least
member, at most one in each band, then are one, in which a member stands once;
only those that still hold several components compare members of different
components, in blocks of bounded size: first by their sketches alone, then, for
members that may have a link, by whole sets, returning no more links than join
the block's components.  A large group's main component is only laid beside
the rest, not beside itself.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, discard, discard_since, ids, open_tables, pieces, raw, save, small_batches
from .components import components

REGISTERS, MANTISSA, VALUE_BITS = 256, 10, 56
BANDS, ROWS = 40, 5  # 200 of the registers: a pair of similarity 0.8 shares no band once in 7 million
MARGIN = 6.0  # standard deviations that an estimate may lie below the threshold: once in a billion for a pair that reaches it
#: What a member's registers weigh, in shingles.
SKETCH = REGISTERS * 2 // 8
#: Sets up to this size meet by their rarest shingles: their sketches say little.
SHORT = 128
#: Their shingles are counted in so many slots (2 to this power), by their upper bits.
SLOT_BITS = 18
BLOCK = 1_500_000  # shingles of a block of a band group, 12 MB
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * B
    x = (x ^ (x >> np.uint64(29))) * A
    return x ^ (x >> np.uint64(32))


def shingle_set(text: bytes | None, k: int, memory: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``k`` words; fewer words are one run; no words, none."""
    h = np.fromiter(map(memory.__getitem__, (text or b"").lower().split()), np.uint64)
    if not len(h):
        return h
    n = min(k, len(h))
    s = h[:len(h) - n + 1].copy()
    for j in range(1, n):
        s = s * A + h[j:len(h) - n + 1 + j]
    return np.unique(mixed(s + np.uint64(n)))


def probes() -> np.ndarray:
    """For every register the fixed order in which it looks for a filled one when its bucket is empty."""
    return np.stack([np.random.default_rng(1000 + j).permutation(REGISTERS) for j in range(REGISTERS)]).astype(np.int64)


def sketch(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """256 registers of 16 bits: leading zeros of the bucket's least value, then its mantissa bits."""
    bucket = (s >> np.uint64(VALUE_BITS)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))  # s is sorted: the first is the least
    value = (s[first] & np.uint64((1 << VALUE_BITS) - 1)).astype(np.float64) + 0.5  # 53 bits suffice for what is kept
    fraction, exponent = np.frexp(value)
    zeros = VALUE_BITS - exponent
    mantissa = ((fraction * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    full = np.full(REGISTERS, -1, np.int64)
    full[bucket[first]] = (np.minimum(zeros, 63) << MANTISSA) | np.minimum(mantissa, (1 << MANTISSA) - 1)
    empty = np.flatnonzero(full < 0)
    if len(empty):
        look = order[empty]
        full[empty] = full[look[np.arange(len(empty)), (full[look] >= 0).argmax(1)]]
    return full.astype("<u2")


def chance_matches(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Probability that two registers of unrelated sets of these sizes agree: same leading zeros, same mantissa."""
    z = np.arange(1, 50)
    upper, lower = 2.0 ** -(z - 1), 2.0 ** -z

    def octave(size):
        load = np.maximum(1.0, np.asarray(size, float) / REGISTERS)[:, None]
        return np.exp(-load * lower) - np.exp(-load * upper)
    return (octave(n) * octave(m)).sum(1) / (1 << MANTISSA)


def estimate(equal: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard similarity from the share of equal registers."""
    c = chance_matches(n, m)
    return np.clip((equal - c) / (1 - c), 0, 1)


def hopeful(equal: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    """Pairs that the estimate and the sizes cannot rule out.  Small sets fill few registers: they get more room."""
    small, large = np.minimum(n, m), np.maximum(n, m)
    filled = REGISTERS * (1 - np.exp(-small / REGISTERS))
    room = MARGIN * np.sqrt(threshold * (1 - threshold) / np.maximum(1, filled))
    return (small >= threshold * large - 1e-9) & (estimate(equal, n, m) >= threshold - room)


def sketches(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """id, n (set size), print (of the whole set), registers, bands (one key per band)."""
    def run(batches):
        memory, order = WordHashes(), probes()
        for b in pieces(batches, text_col):
            n, mark, regs, bands = [], [], [], []
            for t in raw(b, text_col):
                s = shingle_set(t, k, memory)
                n.append(len(s))
                if not len(s):
                    mark.append(None), regs.append(None), bands.append([])
                    continue
                mark.append(xxhash.xxh3_128_digest(s.tobytes()))
                r = sketch(s, order)
                regs.append(r.tobytes())
                keys = [xxhash.xxh3_64_intdigest(r[j * ROWS:(j + 1) * ROWS].tobytes(), seed=j) for j in range(BANDS)]
                bands.append(np.array(keys, np.uint64).astype(np.int64))
            memory.trim()
            yield pa.record_batch([pa.array(ids(b, id_col), pa.int64()), pa.array(n, pa.int64()), pa.array(mark, pa.binary()),
                                   pa.array(regs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                                  ["id", "n", "print", "registers", "bands"])
    return docs.select(id_col, text_col).mapInArrow(run, "id long, n long, print binary, registers binary, bands array<long>")


def numbers(b: pa.RecordBatch, name: str) -> np.ndarray:
    return b.column(b.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def registers_of(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<u2").reshape(-1, REGISTERS)


def estimated(pairs: DataFrame, sig: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sketches may reach the threshold."""
    both = pairs.join(sig.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("registers").alias("ra")), "a").join(
        sig.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("registers").alias("rb")), "b")

    def run(batches):
        for b in batches:
            x, y = registers_of(raw(b, "ra")), registers_of(raw(b, "rb"))
            yield b.select(["a", "b"]).filter(pa.array(hopeful((x == y).mean(1), numbers(b, "na"), numbers(b, "nb"), threshold)))
    return both.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long")


def texts_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text of the wanted ids.  They have no size bound, so they are never broadcast: one plan at every size."""
    every = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).hint("merge")
    return every.join(wanted, "id", "left_semi").dropDuplicates(["id"])


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, threshold: float) -> DataFrame:
    """The pairs whose whole sets reach the threshold: 100 * intersection >= 100 * threshold * union."""
    percent = round(100 * threshold)
    both = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")

    def run(batches):
        memory, last = WordHashes(), {}
        for b in pieces(batches, "ta"):
            good = []
            for a, ta, tb in zip(ids(b, "a"), raw(b, "ta"), raw(b, "tb")):
                if last.get("id") != a:
                    last = {"id": a, "set": shingle_set(ta, k, memory)}
                other = shingle_set(tb, k, memory)
                common = len(np.intersect1d(last["set"], other, assume_unique=True))
                good.append(100 * common >= percent * (len(last["set"]) + len(other) - common))
            memory.trim()
            yield b.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    return save(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), "near-links")


def with_sets(texts: DataFrame, k: int) -> DataFrame:
    """id, shingles (the whole set) of every text."""

    def run(batches):
        memory = WordHashes()
        for b in pieces(batches):
            sets = [shingle_set(t, k, memory).tobytes() for t in raw(b)]
            memory.trim()
            yield pa.record_batch([b.column(b.schema.get_field_index("id")), pa.array(sets, pa.binary())], ["id", "shingles"])
    return texts.mapInArrow(run, "id long, shingles binary")


def linked_in_block(held: list[tuple], i: int, j: int, percent: int) -> list[tuple[int, int]]:
    """Links between members of different components in blocks i and j of one group.

    Estimates first, then whole sets.  Once a link joins two components they
    count as one here, so at most one link fewer than members is returned."""
    side = np.array([r[0] for r in held])
    own, comp, n = (np.array([r[c] for r in held], np.int64) for c in (1, 2, 3))
    x = registers_of([r[4] for r in held])
    flat, codes = np.unique(np.frombuffer(b"".join([r[5] for r in held]), np.uint64), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(n)])
    has = np.zeros(len(flat), bool)
    right_of = np.flatnonzero(side == j)
    out = []
    for p in np.flatnonzero(side == i):
        q = right_of[right_of > p] if i == j else right_of
        q = q[comp[q] != comp[p]]
        if not len(q):
            continue
        same = x[q] == x[p]
        ok = hopeful(same.mean(1), np.full(len(q), n[p]), n[q], percent / 100)
        q = q[ok]
        if not len(q):
            continue
        mine = codes[starts[p]:starts[p + 1]]
        has[mine] = True
        common = np.array([np.count_nonzero(has[codes[starts[z]:starts[z + 1]]]) for z in q])
        has[mine] = False
        for z in q[100 * common >= percent * (n[p] + n[q] - common)]:
            if comp[z] != comp[p]:
                out.append((int(min(own[p], own[z])), int(max(own[p], own[z]))))
                comp[comp == comp[z]] = comp[p]
    return out


def hopeful_in_block(held: list[tuple], i: int, j: int, percent: int) -> list[int]:
    """Places of the members that some member of another component and of the other side may be near to, by their sketches."""
    side = np.array([r[0] for r in held])
    comp, n = (np.array([r[c] for r in held], np.int64) for c in (2, 3))
    x = registers_of([r[4] for r in held])
    right_of = np.flatnonzero(side == j)
    found = np.zeros(len(held), bool)
    for p in np.flatnonzero(side == i):
        q = right_of[right_of > p] if i == j else right_of
        q = q[comp[q] != comp[p]]
        if not len(q):
            continue
        same = x[q] == x[p]
        ok = hopeful(same.mean(1), np.full(len(q), n[p]), n[q], percent / 100)
        if ok.any():
            found[p] = True
            found[q[ok]] = True
    return np.flatnonzero(found).tolist()


def blocks_of(rows: Iterator[pa.RecordBatch], payload: list[str], by_size: str) -> Iterator[tuple[tuple, list]]:
    """((band, key, i, j), its rows) of rows sorted by these four; the rows of one block alone are held."""
    at, held = None, []
    for big in rows:
        for b in pieces([big], by_size, limit=4 << 20):
            columns = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("band", "key", "i", "j", *payload)]
            for band, key, i, j, *rest in zip(*columns):
                if (band, key, i, j) != at:
                    if len(held) > 1:
                        yield at, held
                    at, held = (band, key, i, j), []
                held.append(rest)
    if len(held) > 1:
        yield at, held


def block_hopes(rows: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``blocks_of`` that may have a link in their block; no more than come in."""
    for at, held in blocks_of(rows, ["side", "id", "component", "n", "registers"], "registers"):
        found = hopeful_in_block(held, at[2], at[3], percent)
        if found:
            out = [(*at, *held[p][:3]) for p in found]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), HOPES.values())], list(HOPES))


HOPES = {"band": pa.int32(), "key": pa.int64(), "i": pa.int32(), "j": pa.int32(), "side": pa.int32(), "id": pa.int64(), "component": pa.int64()}


def block_links(rows: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The links of each block, at most one fewer than its members."""
    for at, held in blocks_of(rows, ["side", "id", "component", "n", "registers", "shingles"], "shingles"):
        done = linked_in_block(held, at[2], at[3], percent)
        if done:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*done)], ["a", "b"])


def may_differ(percent: int):
    """True where a set of ``n`` members can reach the threshold with a set other than itself: at best with one member more."""
    return 100 * F.col("n") >= percent * (F.col("n") + 1)


def slots_of(shingles: np.ndarray) -> np.ndarray:
    """The slot in which a shingle is counted."""
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def slot_counts(sets: DataFrame) -> np.ndarray:
    """How often the shingles of each slot occur in ``sets``; one row for each slot at most reaches the driver."""
    def run(batches):
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for b in batches:
            np.add.at(total, slots_of(np.frombuffer(b"".join(raw(b, "shingles")), np.uint64)), 1)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["slot", "n"])
    found = sets.select("shingles").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(1 << SLOT_BITS, np.int64)
    total[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return total


def rare_groups(sets: DataFrame, percent: int) -> DataFrame:
    """Groups (band 1; key: the least id) of sets that share one of their rarest shingles, where they are not all connected.

    Two sets at the threshold share at least ``ceil(t n)`` of either one's n
    shingles, so among its ``n - ceil(t n) + 1`` first in any order that holds
    for all sets is one that is among the other's first too: no pair is lost,
    however common the rest is.  The order: by the count of a shingle's slot,
    so that rare shingles come first, then by the shingle.  Each set picks its
    own; the others are never made rows."""
    times = slot_counts(sets)

    def prefixes(batches):
        for b in batches:
            first = []
            for x in raw(b, "shingles"):
                s = np.frombuffer(x, np.uint64)  # sorted: a stable order by count is by shingle too
                first.append(s[np.argsort(times[slots_of(s)], kind="stable")[:len(s) - -(-len(s) * percent // 100) + 1]])
            at = pa.array(np.repeat(np.arange(len(first)), [len(s) for s in first]))
            yield pa.record_batch([b.column(b.schema.get_field_index(c)).take(at) for c in ("id", "component", "n")]
                                  + [pa.array(np.concatenate([*first, np.zeros(0, np.uint64)]).view(np.int64))], ["id", "component", "n", "key"])
    chosen = save(sets.select("id", "component", "n", "shingles").mapInArrow(prefixes, "id long, component long, n long, key long"), "near-prefixes")
    mixed = chosen.groupBy("key").agg(F.min("id").alias("least"), F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    together = chosen.join(mixed.select("key", "least"), "key").select(F.col("least").alias("key"), "id", "component", "n").distinct()
    return with_sides(together.withColumn("band", F.lit(1)))


def with_sides(rows: DataFrame) -> DataFrame:
    """Members (band, key, id, component, n) of groups of several components: band, key, id, component, mass (of the group),
    blocks (it is laid beside the first so many parts), side (its own part).

    A group that fits is one part.  In a larger one the heaviest component has parts of its own, after those of the
    others, which it meets; while the others fit into one part, the rows laid out grow as the group does."""
    group = ["band", "key"]
    masses = rows.groupBy(*group, "component").agg(F.sum(F.col("n") + SKETCH).alias("mass")).groupBy(*group).agg(
        F.sum("mass").alias("mass"), F.max("mass").alias("most"), F.max_by("component", "mass").alias("main"),
        F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    large = F.col("mass") > BLOCK
    parts = masses.select(*group, "mass", F.when(large, F.col("main")).alias("main"),
                          F.when(large, F.ceil((F.col("mass") - F.col("most")) / BLOCK)).otherwise(1).alias("rest"),
                          F.when(large, F.ceil(F.col("most") / BLOCK)).otherwise(0).alias("own"))
    in_main = F.coalesce(F.col("component") == F.col("main"), F.lit(False))
    side = F.when(in_main, F.col("rest") + F.pmod(F.xxhash64("id"), F.greatest("own", F.lit(1)))).otherwise(F.pmod(F.xxhash64("id"), F.col("rest")))
    blocks = F.when(in_main, F.col("rest")).otherwise(F.col("rest") + F.col("own"))
    return rows.join(parts, group).select(*group, "id", "component", "mass", blocks.cast("int").alias("blocks"), side.cast("int").alias("side"))


def in_parts(side: DataFrame) -> DataFrame:
    """Every member once for each part that it is laid beside: band, key, id, component, side, i, j."""
    return side.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "key", "id", "component", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (least id reachable over links), kept (id is the component's).

    Links: similarity of the shingle sets of at least ``threshold``,
    confirmed on whole sets.  Null, empty and blank texts have no shingles
    and link with nothing.  Equal texts are one class whatever their number;
    rows that repeat an id are one document (with different texts: any one of them decides).  Rows without an id keep a null
    component and are not linked.  Empty input: no rows.
    """
    mark = open_tables()
    small_batches(docs.sparkSession)
    every = save(sketches(docs, k, id_col, text_col), "near-sketches")
    classed = every.where("n > 0 and id is not null")
    heads = save(classed.groupBy("print").agg(F.min("id").alias("head"), F.count(F.lit(1)).alias("copies")), "near-classes")
    # Neither the classes nor the groups have a size bound, so they are never broadcast: one plan at every size.
    sig = classed.select("id", "n", "registers", "bands").hint("merge").join(heads.select(F.col("head").alias("id")), "id", "left_semi")
    banded = sig.select("id", "n", F.explode("bands").alias("key"))
    groups = save(banded.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1"), "near-groups")
    members = save(banded.hint("merge").join(groups, "key"), "near-members")
    discard(groups)
    grouped = save(sig.select("id", "n", "registers").join(members.select("id").distinct(), "id", "left_semi"), "near-grouped")
    sizes = save(every.select("id", "n", "print"), "near-sizes")  # all that is read of the other sketches from now on
    discard(every)
    stars = members.where("id > least").select(F.col("least").alias("a"), F.col("id").alias("b")).distinct()
    texts = save(texts_of(docs, grouped.select("id"), id_col, text_col), "near-texts")  # whole texts are shuffled this once

    links = confirmed(save(estimated(stars, grouped, threshold), "near-pairs"), texts, k, threshold)

    # Second pass: groups whose members are not all connected yet.
    labels = save(components(links), "near-labels")
    tagged = members.where("size > 2").select(F.lit(0).alias("band"), F.col("least").alias("key"), "id", "n").distinct().join(
        labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    tagged = save(tagged, "near-tagged")
    discard(members, labels)
    mixed_groups = tagged.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key")
    side = save(tagged.join(mixed_groups, "key"), "near-mixed")
    discard(tagged)
    percent = round(100 * threshold)
    # Pairs of long sets meet in their band groups, all others in groups of a rare shingle.
    few = side.where((F.col("n") * percent <= 100 * SHORT) & may_differ(percent)).select("id", "component", "n").distinct()
    few_texts = texts.join(few.select("id"), "id", "left_semi")
    few_sets = save(with_sets(few_texts, k).join(few, "id"), "near-few")
    rare = save(rare_groups(few_sets, percent), "near-rare")
    discard(few_sets)
    spread = in_parts(with_sides(side.where(F.col("n") > SHORT))).unionByName(in_parts(rare))

    def in_blocks(rows: DataFrame) -> DataFrame:
        return rows.repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "id")
    # Sketches go to the blocks first; whole sets, many times their size, only for members that they leave some hope.
    thin = in_blocks(spread.join(grouped, "id"))
    hopes = save(thin.mapInArrow(lambda rows: block_hopes(rows, percent), "band int, key long, i int, j int, side int, id long, component long"),
                 "near-hopes")
    sets = save(with_sets(texts.join(hopes.select("id").distinct(), "id", "left_semi"), k).join(grouped, "id"), "near-sets")
    wide = in_blocks(hopes.join(sets, "id"))
    more = save(wide.mapInArrow(lambda rows: block_links(rows, percent), "a long, b long"), "near-more")
    discard(side, hopes, sets, texts)
    links = links.unionByName(more)

    found = save(components(links), "near-components")
    discard_since(mark, sizes, heads, found)
    head = heads.where("copies > 1").select("print", "head")
    placed = sizes.join(head, "print", "left").withColumn("head", F.coalesce("head", "id"))
    placed = placed.join(found.withColumnRenamed("id", "head"), "head", "left")
    component = F.coalesce("component", "head")
    result = save(placed.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                                F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")), "near-result")
    discard_since(mark, result)
    return result

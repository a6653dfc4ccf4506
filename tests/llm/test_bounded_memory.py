"""Batches between Spark and Python tasks are bounded by bytes; short sets pick their rarest shingles where they lie."""
import numpy as np
import pyarrow as pa

from churnspark.llm import common, language_model, near_dedup, quality_model, substring_dedup


def test_batches_of_long_texts_are_bounded_by_bytes(spark):
    held = spark.conf.get(common.MAX_BATCH)
    try:
        for enter in (lambda d: quality_model.keep_good(d, None), lambda d: quality_model.predict(d, None),
                      lambda d: near_dedup.near_duplicates(d.limit(0))):
            spark.conf.set(common.MAX_BATCH, "64m")
            docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', 1000) as text").coalesce(1)
            enter(docs)

            def sizes(batches):
                for b in batches:
                    yield pa.record_batch([pa.array([b.nbytes]), pa.array([b.num_rows])], ["n", "rows"])
            got = docs.mapInArrow(sizes, "n long, rows long").collect()
            assert sum(r["rows"] for r in got) == 3000 and max(r["n"] for r in got) < 1.5 * common.BATCH_BYTES
        spark.conf.set(common.MAX_BATCH, "1m")  # a session that asks for less keeps it
        common.small_batches(spark)
        assert spark.conf.get(common.MAX_BATCH) == "1m"
    finally:
        spark.conf.set(common.MAX_BATCH, held)


def test_tasks_remember_few_words():
    memory = common.WordHashes()
    for i in range(150_000):
        memory[b"%d" % i]
    memory.trim()
    assert len(memory) <= 100_000 and language_model.WORDS <= 100_000


def test_short_sets_are_never_expanded_into_rows_of_all_shingles(spark, monkeypatch):
    """Every pair at the threshold meets in a group; the rows that are written or joined are prefixes only."""
    rng = np.random.default_rng(5)
    common_part = rng.integers(1, 1 << 63, 40, np.uint64)
    sets = {}
    for i in range(60):  # near copies that share a frequent part, and others that are all their own
        own = rng.integers(1, 1 << 63, 4 if i % 2 else 60, np.uint64)
        sets[i] = np.unique(np.concatenate([common_part, own]) if i % 2 else own)
    rows = [(i, i, len(s), bytearray(s.tobytes())) for i, s in sets.items()]
    written = {}
    save = near_dedup.save

    def seen(df, name):
        out = save(df, name)
        written[name] = out.count()
        return out
    monkeypatch.setattr(near_dedup, "save", seen)
    df = spark.createDataFrame(rows, "id long, component long, n long, shingles binary")
    got = near_dedup.rare_groups(df, 80)
    groups = {}
    for r in got.collect():
        groups.setdefault(r["key"], set()).add(r["id"])
    met = {(a, b) for g in groups.values() for a in g for b in g if a < b}
    near = {(a, b) for a in sets for b in sets if a < b
            and 100 * (c := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - c)}
    assert near and near <= met
    assert sum(written.values()) <= sum(len(s) - -(-len(s) * 80 // 100) + 1 for s in sets.values())
    assert got.schema.names == ["band", "key", "id", "component", "mass", "blocks", "side"]


def test_members_of_a_group_are_laid_out_once_however_many_bands_they_share(spark, monkeypatch):
    """Near copies of one text, many too far from each other for a link: rows follow the members, not members times bands."""
    base = [f"w{i}" for i in range(300)]
    data = [(0, " ".join(base))]
    for i in range(1, 41):
        data.append((i, " ".join(f"x{i}_{j}" if j % 12 == i % 12 else w for j, w in enumerate(base))))
    written = {}
    save = near_dedup.save

    def seen(df, name):
        out = save(df, name)
        written[name] = out.count()
        return out
    monkeypatch.setattr(near_dedup, "save", seen)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs, k=2).collect()}
    sets = {i: {tuple(w[j:j + 2]) for j in range(len(w) - 1)} for i, t in data for w in [t.split()]}
    want = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert written["near-members"] > 2 * len(data)  # they share many bands
    assert written["near-mixed"] <= 5 * len(data) and written["near-hopes"] <= 5 * len(data)


def test_the_main_component_of_a_large_group_is_laid_beside_the_rest_alone(spark, monkeypatch):
    """Every pair of different components meets in a part; the rows grow as the group does while the rest is one part."""
    monkeypatch.setattr(near_dedup, "BLOCK", 2000)
    for n in (200, 400):
        rows = [(0, 1, i, 5 if i >= 12 else i % 4, 36) for i in range(n)]
        got = near_dedup.in_parts(near_dedup.with_sides(spark.createDataFrame(rows, "band int, key long, id long, component long, n long"))).collect()
        parts = {}
        for r in got:
            parts.setdefault((r["i"], r["j"]), {})[r["id"]] = r["side"]
        met = {frozenset((a, b)) for (i, j), held in parts.items() for a, x in held.items() for b, y in held.items() if a != b and (x, y) == (i, j)}
        component = {r[2]: r[3] for r in rows}
        assert {frozenset((a, b)) for a in component for b in component if component[a] != component[b]} <= met
        assert len(got) <= n + 12 * (2 + n * 100 // 2000)
    one = near_dedup.with_sides(spark.createDataFrame([(0, 1, i, i, 10) for i in range(5)] + [(0, 2, i, 7, 10) for i in range(5)],
                                                      "band int, key long, id long, component long, n long")).collect()
    assert sorted((r["key"], r["blocks"], r["side"]) for r in one) == [(1, 1, 0)] * 5  # it fits; a group of one component is left out


def test_wide_tables_go_before_whole_texts_are_shuffled_and_small_inputs_have_the_plan_of_large_ones(spark, monkeypatch):
    import corpus_pipeline
    held = {}
    for module in (near_dedup, substring_dedup):
        def seen(df, name, save=module.save):
            out = save(df, name)
            held.setdefault(name, [p.rpartition("/")[2].rpartition("-")[0] for p in common.open_tables()])
            return out
        monkeypatch.setattr(module, "save", seen)
    passage = " ".join(f"p{i}" for i in range(70))
    docs = spark.createDataFrame([(i, f"a{i // 2} b{i // 2} {passage} c{i // 2}") for i in range(8)], "doc_id long, text string")
    for stage, join in ((corpus_pipeline.near_duplicates, "LeftAnti"), (corpus_pipeline.repeated_passages, "LeftOuter")):
        out = stage(spark, docs, "")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and join in plan and "BroadcastHashJoin" not in plan
        docs = out
    assert [r["doc_id"] for r in docs.orderBy("doc_id").collect()] == [0]
    assert "near-sketches" not in held["near-texts"] and "near-members" in held["near-texts"]
    assert not {"substring-scan", "substring-first"} & set(held["substring-texts"])

"""Operators against brute-force versions on the smallest tables and on odd rows."""
import hashlib
import re
import zlib

import pytest

from churnspark.llm import decontaminate, near_dedup, quality_rules, sharding, substring_dedup, url_filter

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def docs_of(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def jaccard_components(data, k):
    sets = {}
    for i, t in data:
        w = (t or "").encode().lower().split()
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    order = sorted(sets)
    for x, a in enumerate(order):
        for b in order[x + 1:]:
            s, t = sets[a], sets[b]
            if s and t and min(len(s), len(t)) >= 0.8 * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= 80 * (len(s) + len(t) - both):
                    u, v = root(a), root(b)
                    parent[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, k):
    docs = docs_of(spark)
    want = jaccard_components(rows(docs), k)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(docs, k=k).collect()}
    assert got == want


def test_near_duplicates_in_one_hot_group(spark, make):
    base = [f"word{i}" for i in range(300)]
    data = [(10_000 + j, " ".join(base), "en") for j in range(400)]
    for j in range(150):  # copies that differ from the base and from one another, some too much
        data.append((j, " ".join(w if (i * 7 + j * 13) % (9 + j % 40) else f"new{j}_{i}" for i, w in enumerate(base)), "en"))
    want = jaccard_components([(i, t) for i, t, _ in data], 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(make(data), k=2).collect()}
    assert got == want


def test_near_duplicates_odd_rows(make, odd_rows):
    got = [tuple(r) for r in near_dedup.near_duplicates(make(odd_rows), k=2).collect()]
    assert len(got) == len(odd_rows)
    by = {r[0]: r for r in got}
    assert by[1][1:] == (0, 1, True) and by[3][1:] == (0, 3, True)
    assert by[6][2] == 5 and by[8][2] == 7 and not by[8][3] and by[4][2] == 4
    assert near_dedup.near_duplicates(make([]), k=2).count() == 0


def brute_windows(data):
    seen, out = {}, {}
    for i, t in sorted(((i, t) for i, t in data if i is not None), key=lambda x: x[0]):
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for j in range(len(w) - 49):
            if seen.setdefault(tuple(w[j:j + 50]), i) < i:
                gone[j:j + 50] = [True] * 50
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def test_substring_dedup(spark, make):
    docs = docs_of(spark)
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digest_documents(docs).collect()}
    assert got == brute_windows(rows(docs))
    passage = " ".join(f"p{i}" for i in range(70))
    ring = " ".join(f"r{i % 60}" for i in range(400))  # a ring in the graph
    data = [(j, f"{' '.join(f'a{j}_{i}' for i in range(j % 7))} {passage if j % 3 else ring} tail{j} " * (1 + j % 2), "en") for j in range(60)]
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digest_documents(make(data)).collect()}
    assert got == brute_windows([(i, t) for i, t, _ in data])


def test_substring_dedup_odd_rows(make, odd_rows):
    got = {r[0]: tuple(r)[1:] for r in substring_dedup.digest_documents(make(odd_rows)).collect()}
    want = brute_windows(odd_rows_of(odd_rows))
    assert {k: v for k, v in got.items() if k is not None} == want
    assert substring_dedup.digest_documents(make([])).count() == 0
    out = substring_dedup.remove_repeats(make(odd_rows))
    assert out.columns == make(odd_rows).columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[1] is None and texts[8] == "" and texts[5] == "one two" and len(texts[7]) > 100_000


def odd_rows_of(data):
    return [(i, t) for i, t, _ in data]


def test_remove_repeats_keeps_white_space(make):
    passage = " ".join(f"p{i}" for i in range(55))
    data = [(1, f"start  of\none {passage}", "en"), (2, f"other\n\nhead  x {passage} and\ttail", "en")]
    texts = {r["doc_id"]: r["text"] for r in substring_dedup.remove_repeats(make(data)).collect()}
    assert texts[1] == data[0][1] and texts[2] == "other\n\nhead  x and\ttail"


def test_rules(spark, make, odd_rows):
    for docs in (docs_of(spark), make(odd_rows)):
        got = sorted(map(str, ((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
                               for r in quality_rules.apply_rules(docs).collect())))
        want = []
        for i, t in rows(docs):
            t = t or ""
            w = WORDS.findall(t)
            count, cover = {}, set()
            for j in range(len(w) - 4):
                count.setdefault(tuple(w[j:j + 5]), []).append(j)
            for places in count.values():
                if len(places) > 1:
                    for j in places:
                        cover.update(range(j, j + 5))
            lines = [x for x in t.split("\n") if WORDS.search(x)]
            want.append((i, len(w), sum(map(len, w)), sum(map(t.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(cover),
                         len(w) < 10 or 100 * len(cover) > 20 * len(w)))
        assert got == sorted(map(str, want))


def test_shards(spark, make, odd_rows):
    for docs in (docs_of(spark), make(odd_rows), make([])):
        data = rows(docs)
        out = sharding.shard_by_bytes(docs, 8).collect()
        assert len(out) == len(data)
        assert sorted(((r["doc_id"] is None, r["doc_id"]), r["size"], r["text_crc32"]) for r in out if r["doc_id"] is not None) == sorted(
            ((False, i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in data if i is not None)
        for s in range(8):
            assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
        ordered = sorted(out, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["shard"], r["slot"]))
        assert [r["shard"] for r in ordered] == sorted(r["shard"] for r in out)
    sizes = [0] * 8
    for r in sharding.shard_by_bytes(docs_of(spark), 8).collect():
        sizes[r["shard"]] += r["size"]
    assert max(sizes) - min(sizes) <= 2 * 18_100 * 4


def test_urls(spark):
    allow, block = ["org/", "com/fr/"], ["example.org/es/", "example.org/en/1", "com/de/"]
    urls = [r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("url").collect()]
    urls += [None, "", "no scheme", "://", "http://", "HTTP://A.Example.ORG/es/1?x#y", "https://example.org", "x://a.com/de/", "http://.org/",
             "http://badexample.org/es/", "a://b://c.org/", "http://example.org/en/12#/es/", "http://org/", urls[0]]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, allow, block).collect()}
    for i, u in enumerate(urls):
        m = re.match(r"(?s)(.*?)://([^/?#]*)([^?#]*)", u or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[2]), m[3]) if m else ("", "")
        fits = [r for r in allow + block if host and (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
                and path.startswith(r[r.index("/"):])]
        rule = max(fits, key=len) if fits else None
        assert got[i] == (host, path, rule, "block" if rule in block else "allow")


def test_cascade_is_exact_for_its_universe(spark):
    listed = spark.range(300).selectExpr("concat('k', id) key")
    universe = spark.range(20_000).selectExpr("concat('k', id) key")
    cascade = url_filter.build_cascade(listed, universe, bits_per_key=4)
    assert len(cascade.levels) > 2
    found = universe.where(cascade.contains(universe["key"])).collect()
    assert sorted(r["key"] for r in found) == sorted(f"k{i}" for i in range(300))


def test_decontamination(spark, make, odd_rows):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items).collect()}
    plain = lambda t: b" ".join(decontaminate.words_of((t or "").encode()))
    texts = [(i, plain(t)) for i, t in rows(docs)]
    exact = {(i, r["item_id"]) for r in items.collect() for i, t in texts if plain(r["text"]) in t}
    assert exact and exact <= got and len(got - exact) <= 5
    words = items.first()["text"].split()
    edited = " ".join("changed" if k % 6 == 3 else w for k, w in enumerate(words))
    data = [*odd_rows, (50, f"before it {edited} and after", "en"), (51, " ".join(words[::-1]), "en")]
    hits = decontaminate.contaminated(make(data), items).collect()
    assert {r["doc_id"] for r in hits} == {50} and hits[0]["first_word"] <= 4
    clean = decontaminate.without_contaminated(make(data), items)
    assert clean.columns == make(data).columns and clean.count() == len(data) - 1
    assert decontaminate.contaminated(make(odd_rows), items.limit(0)).count() == 0
    assert decontaminate.without_contaminated(make([]), items).count() == 0


def test_alignment_scores():
    import numpy as np
    a = np.arange(10, dtype=np.uint64)
    assert decontaminate.align(a, a) == (20, 10)
    assert decontaminate.align(a, np.delete(a, 5))[0] == 17  # one gap
    assert decontaminate.align(a, np.array([], np.uint64)) == (0, 0)


def test_every_passage_that_reaches_the_score_is_found(spark, make):
    """Against the alignment of every item with every document; edits at every 2nd to 6th word."""
    import random
    r = random.Random(3)
    common = [f"c{i}" for i in range(40)]  # words that all texts share
    lines = [[r.choice(common) if r.random() < 0.5 else f"w{r.randrange(4000)}" for _ in range(n)] for n in (15, 15, 20, 38, 59, 8, 5, 3)]
    edits = {"replace": lambda w, j: [f"new{j}"], "drop": lambda w, j: [], "insert": lambda w, j: [w, f"new{j}"], "common": lambda w, j: [common[j % 40]]}
    texts = []
    for line in lines:
        for step in range(2, 7):
            for edit in edits.values():
                copy = [x for j, w in enumerate(line) for x in (edit(w, j) if j % step == step - 1 else [w])]
                texts.append([r.choice(common) for _ in range(30)] + copy + [r.choice(common) for _ in range(30)])
        for _ in range(15):  # words replaced at random
            texts.append([w if r.random() > 0.3 else f"new{r.randrange(99)}" for w in line])
        texts.append([x for j, w in enumerate(line) for x in (w, f"new{j}")])  # a word after every word
    docs = make([(i, " ".join(t), "en") for i, t in enumerate(texts)])
    items = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(lines)], "item_id long, text string")
    code = decontaminate.WordHashes()
    hashed = lambda t: decontaminate.np.array([code[w.encode()] for w in t], decontaminate.np.uint64)
    want = {}
    for i, t in enumerate(texts):
        for k, line in enumerate(lines):
            score = decontaminate.align(hashed(line), hashed(t))[0] / (2 * len(line))
            if score >= 0.5:
                want[i, k] = score
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(docs, items).collect()}
    assert len(want) > 150 and got == want
    assert {r["doc_id"] for r in decontaminate.without_contaminated(docs, items).collect()} == set(range(len(texts))) - {i for i, _ in want}


def test_a_hot_edited_copy_beside_an_exact_one(spark, make):
    words = [f"w{i}" for i in range(15)]
    edited = ["new" if i in (5, 8, 11, 14) else w for i, w in enumerate(words)]  # two runs of four words are left
    docs = make([(0, " ".join(words), "en")] + [(1 + i, f"start {' '.join(edited)} n{i}", "en") for i in range(1000)])
    items = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    got = {r["doc_id"]: r["score"] for r in decontaminate.contaminated(docs, items).collect()}
    assert got == {0: 1.0, **{1 + i: 19 / 30 for i in range(1000)}}


def test_estimates_five_deviations_low_are_still_compared():
    import numpy as np
    n = np.array([3000, 3000, 3000])
    c = near_dedup.chance_matches(n, n)
    deviation = np.sqrt(0.8 * 0.2 / near_dedup.REGISTERS)
    equal = (0.8 - np.array([3, 5, 7]) * deviation) * (1 - c) + c
    assert near_dedup.hopeful(equal, n, n, 0.8).tolist() == [True, True, False]


def windows_removed(data):
    """op4's contract by brute force: (id, text) rows -> sorted (id, n_words, n_removed, kept text)."""
    starts = {}
    for i, t in data:
        w = (t or "").encode().split()
        for x in range(len(w) - 49):
            starts.setdefault(tuple(w[x:x + 50]), []).append(i)
    out = []
    for i, t in data:
        w = (t or "").encode().split()
        gone = set()
        for x in range(len(w) - 49):
            if i is not None and min(v for v in starts[tuple(w[x:x + 50])] if v is not None) < i:
                gone.update(range(x, x + 50))
        out.append((i, len(w), len(gone), b" ".join(v for x, v in enumerate(w) if x not in gone)))
    return sorted(out, key=repr)


def test_repeated_ids_with_different_texts(spark, make):
    p = " ".join(f"p{i}" for i in range(60))
    q = " ".join(f"q{i}" for i in range(55))
    data = [(1, p), (2, p + " x"), (2, "h " + p + " y"), (2, "h " + p + " y"), (3, q), (3, q + " " + p), (4, q), (None, p), (None, q + " z")]
    docs = make([(i, t, "en") for i, t in data])
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring_dedup.digest_documents(docs).collect()), key=repr)
    want = [(i, n, g, hashlib.sha256(k).hexdigest()) for i, n, g, k in windows_removed(data)]
    assert got == sorted(want, key=repr)
    cut = sorted(((r["doc_id"], (r["text"] or "").split()) for r in substring_dedup.remove_repeats(docs).collect()), key=repr)
    assert cut == sorted(((i, k.decode().split()) for i, _, _, k in windows_removed(data)), key=repr)


def test_columns_named_like_the_marks(spark, make):
    p = " ".join(f"p{i}" for i in range(60))
    docs = make([(1, p, "en"), (2, "h " + p, "en")]).selectExpr("*", "1 as _id", "2 as `marked id`", "3 as starts", "4 as `row`", "5 as number")
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: p, 2: "h"}


def test_short_texts_with_one_shingle_in_common(spark, make):
    """Thousands of lines that share a shingle and nothing else: no pair of them is compared, and none is linked."""
    import time
    data = [(i, f"terms of use{i}", "en") for i in range(20_000)] + [(30_000 + i, f"a b c d e f g h i j k{i % 7}", "en") for i in range(50)]
    t = time.time()
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(make(data), k=2).collect()}
    assert time.time() - t < 300
    assert all(got[i] == i for i in range(20_000))
    want = jaccard_components([(i, x) for i, x, _ in data[20_000:]], 2)
    assert {i: c for i, c in got.items() if i >= 30_000} == {i: c for i, (_, c) in want.items()}


def test_short_and_long_sets_around_the_limit(spark, make):
    """Pairs of sets of 100 to 200 shingles, below and above the size at which rare shingles take over."""
    data = []
    for g in range(6):
        base = [f"g{g}w{i}" for i in range(120 + 10 * g)]
        for j in range(12):
            data.append((100 * g + j, " ".join(w if (i * 5 + j * 11) % (20 + 3 * j) else f"x{g}_{j}_{i}" for i, w in enumerate(base[:len(base) - 3 * j])), "en"))
    want = jaccard_components([(i, t) for i, t, _ in data], 2)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.near_duplicates(make(data), k=2).collect()}
    assert got == want

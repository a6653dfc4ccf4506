"""Trained operators: held-out accuracy, base scores against brute force, exact round trips, odd rows."""
import collections
import hashlib
import math
import os
import subprocess
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from churnspark.llm import language_id, language_model, piece_encoding, quality_model
from churnspark.llm.common import training_row

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def piece_model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def test_language_id(docs, make, odd_rows):
    model = language_id.learn(docs, training_row(0))
    out = language_id.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(~training_row(0)).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97 and all(0 <= r["score"] <= 1 for r in out)
    odd = {r["doc_id"]: r for r in language_id.predict(make(odd_rows), model).collect()}
    assert [odd[i]["lang_pred"] for i in (1, 2, 3, 9)] == ["und"] * 4 and odd[4]["lang_pred"] in model.langs
    nothing = language_id.learn(make([]), training_row(0))
    assert {r["lang_pred"] for r in language_id.predict(make(odd_rows), nothing).collect()} == {"und"}


def test_quality_model(spark, docs, make, odd_rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_model.learn(docs, labels, training_row(0))
    out = quality_model.predict(docs, model).join(labels, "doc_id").where(~training_row(0)).collect()
    assert np.mean([r["quality"] == r["predicted"] for r in out]) > 0.95
    assert len(quality_model.predict(make(odd_rows), model).where("score between 0 and 1").collect()) == len(odd_rows)
    kept = quality_model.keep_good(make(odd_rows), model)
    assert kept.columns == make(odd_rows).columns
    assert quality_model.learn(docs, labels.limit(0), training_row(0)) is None
    assert quality_model.predict(make(odd_rows), None).where("predicted = 1").count() == len(odd_rows)


def test_factorisation_identity():
    r = np.random.default_rng(1)
    m = quality_model.Machine(0.3, r.normal(size=20), r.normal(size=(20, 4)))
    i, x = np.array([1, 4, 7, 19]), r.normal(size=4)
    slow = 0.3 + m.w[i] @ x + sum(m.v[i[a]] @ m.v[i[b]] * x[a] * x[b] for a in range(4) for b in range(a))
    assert m.raw_scores([(i, x), (i[:1], x[:1])])[0][0] == pytest.approx(slow)


def test_language_model(docs, make, odd_rows):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    model, counts = language_model.learn(docs, training_row(1), ranks, public_tokenizers.PATTERN, sample=200)
    out = {r["doc_id"]: r for r in language_model.score(docs, model, counts).collect()}
    c, words = collections.Counter(), {}
    for r in docs.collect():
        words[r["doc_id"]] = (r["text"] or "").encode().lower().split() + [b" "]
        if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1:
            c.update(words[r["doc_id"]])
    total, v = sum(c.values()), len(c)
    for i, w in words.items():
        assert (out[i]["n_tokens"], out[i]["n_known"], out[i]["train_tokens"]) == (len(w), sum(c[x] > 0 for x in w), total)
        assert out[i]["base_score"] == pytest.approx(sum(math.log10((c[x] + 0.5) / (total + 0.5 * (v + 1))) for x in w))
    held = [i for i in words if zlib.crc32(str(i).encode()) % 5 == 1]
    assert sum(out[i]["score"] for i in held) > sum(out[i]["base_score"] for i in held)
    odd = language_model.score(make(odd_rows), model, counts).collect()
    assert len(odd) == len(odd_rows) and all(r["score"] < 0 for r in odd)
    assert sorted(r["n_tokens"] for r in odd)[:3] == [1, 1, 1]
    empty, none = language_model.learn(make([]), training_row(1), ranks, public_tokenizers.PATTERN)
    assert all(math.isfinite(r["score"]) for r in language_model.score(make(odd_rows), empty, none).collect())


def test_every_id_is_scored_once():
    r = np.random.default_rng(2)
    lengths = np.array([0, 1, 15, 16, 17, 40])
    tokens = r.integers(0, 50, lengths.sum())
    units, before, target, mask, alone = language_model.windows(tokens, lengths, np.arange(60), np.arange(60) % 7, 59)
    assert mask.sum() == lengths.sum() + len(lengths) and alone.sum() == len(lengths)
    scored = target[mask > 0].tolist()
    want, at = [], 0
    for n in lengths:
        want += tokens[at:at + n].tolist() + [59]
        at += n
    assert scored == want


def test_attention_gradient():
    r = np.random.default_rng(4)
    w = {k: a.astype(np.float64) for k, a in language_model.new_weights().items()}
    units = r.integers(0, language_model.START + 1, (3, 32))
    before, target = r.integers(0, 48, (3, 16)), r.integers(0, 48, (3, 16))
    mask, alone = np.ones((3, 16)), np.array([True, False, False])

    def loss(w):
        z, _ = language_model.forward(w, units, before, alone)
        return -(z[np.arange(3)[:, None], np.arange(16)[None, :], target]).mean()
    z, kept = language_model.forward(w, units, before, alone)
    g = language_model.backward(w, units, before, target, mask, z, kept)
    for k, spot in (("q", (2, 3)), ("k", (1, 5)), ("v", (0, 7)), ("o", (3, 9)), ("x", (4, 4)), ("e", (units[1, 20], 3)), ("d", (4,)), ("g", (before[0, 0], 5))):
        up, down = ({**w, k: w[k].copy()} for _ in range(2))
        up[k][spot] += 1e-5
        down[k][spot] -= 1e-5
        assert g[k][spot] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-3, abs=1e-7)


def test_piece_encoding(docs, make, odd_rows, piece_model):
    lib = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
    strange = [(20, "▁x  y ▁ z", "en"), (21, "\x00a\u3000b\U0001f600é ", "en"), (22, "   ", "en")]
    data = make([*odd_rows, *strange])
    full = piece_encoding.encode_documents(data, piece_model).collect()
    texts = {i: t or "" for i, t, _ in [*odd_rows, *strange]}
    for r in full:
        t = texts[r["doc_id"]]
        assert r["ids"] == lib.encode(t) and r["decoded"] == lib.decode(r["ids"])
        raw = t.encode()
        assert b"".join(raw[a:b] for a, b in zip(r["begins"], r["ends"])) == raw
    got = {r["doc_id"]: r for r in piece_encoding.digest_documents(docs, piece_model).collect()}
    for r in docs.limit(100).collect():
        found = lib.encode(r["text"])
        d = got[r["doc_id"]]
        assert (d["n_tokens"], d["spans_ok"]) == (len(found), True)
        assert d["ids_sha256"] == hashlib.sha256(",".join(map(str, found)).encode()).hexdigest()
        assert d["decoded_sha256"] == hashlib.sha256(lib.decode(found).encode()).hexdigest()


def test_character_map_longest_prefix():
    # A hand-made double array for the keys "a" -> "x" and "ab" -> "y".
    import struct
    from types import SimpleNamespace
    units = [0] * 512
    shift = lambda n: n << 10
    units[0] = shift(128)
    a = 128 ^ 0x61
    units[a] = shift(256) | 0x100 | 0x61
    base = a ^ 256
    units[base] = 0 | 1 << 31
    b = base ^ 0x62
    units[b] = shift(16) | 0x100 | 0x62
    units[b ^ 16] = 2 | 1 << 31
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"x\0y\0"
    spec = SimpleNamespace(precompiled_charsmap=blob, add_dummy_prefix=True, remove_extra_whitespaces=True, escape_whitespaces=True)
    n = piece_encoding.Normaliser(spec)
    out, where = n.normalise(b" ab  ca ")
    assert out == "▁y▁cx".encode()
    assert where.tolist() == [1, 1, 1, 1, 3, 3, 3, 5, 6, 7]


def test_pipeline_stages(spark, make, odd_rows):
    import corpus_pipeline
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert 0 < len(out) <= 200 and all(r["spans_ok"] for r in out)
    docs = make(odd_rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns, name
    kept = corpus_pipeline.near_duplicates(spark, docs, "").select(F.count(F.lit(1))).first()[0]
    assert kept == len(odd_rows) - 2  # one of the two long texts goes, and the one that differs in case only
    assert corpus_pipeline.repeated_passages(spark, docs, "").count() == len(odd_rows)


def test_scores_do_not_depend_on_the_words_that_tasks_hold(docs, make, odd_rows, monkeypatch):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    some = docs.where("doc_id < 200").unionByName(make(odd_rows).select(docs.columns))
    got = []
    for head in (1 << 18, 300):
        monkeypatch.setattr(language_model, "HEAD", head)
        model, counts = language_model.learn(some, training_row(1), ranks, public_tokenizers.PATTERN, sample=20)
        assert len(model.head) <= head
        got.append(sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["score"]) for r in language_model.score(some, model, counts).collect()))
    for a, b in zip(*got, strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-6)


def test_every_learning_document_trains_the_model(docs, make):
    """Ids that stand only outside the starting sample get classes by their neighbours, and their texts move the weights."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    base = [(r["doc_id"], r["text"], "en") for r in docs.where("doc_id < 150").collect()]
    order = [r[0] for r in make(base).where(training_row(1)).orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").collect()]
    late = set(order[20:])
    other = [(i, f"zebra quantum {t} zebra quantum" if i in late else t, lang) for i, t, lang in base]
    (one, _), (two, _) = (language_model.learn(make(rows), training_row(1), ranks, public_tokenizers.PATTERN, sample=20) for rows in (base, other))
    new = language_model.Subwords(ranks, public_tokenizers.PATTERN).many([b"zebra", b"quantum"])[0]
    assert all(two.class_of[i] < language_model.CLASSES - 3 for i in new) and any(one.class_of[i] != two.class_of[i] for i in new)
    assert not np.allclose(one.w["d"], two.w["d"])


def test_signs_that_are_no_letters(make, docs):
    model = language_id.learn(docs, training_row(0))
    rows = [(1, "½ ² Ⅷ ① 12 ٣ _", "en"), (2, "½ ª", "en"), (3, "12 ж", "en"), (4, "中", "en"), (None, "a null id", None)]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(make(rows), model).collect()}
    assert got[1] == "und" and all(got[i] in model.langs for i in (2, 3, 4, None))
    assert language_id.learn(make([(None, "some words", "xx")]), training_row(0)).langs in ([], ["xx"])


def plain_grams(text, dims):
    """Hashed counts of runs of 1 to 3 bytes of the folded text, one run at a time."""
    low = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text)
    while b"  " in low:
        low = low.replace(b"  ", b" ")
    low += b"  "
    total = collections.Counter()
    for at in range(len(low) - 2):
        a, b, c = low[at:at + 3]
        for code in (a, a * 257 + b + 1000, (a * 257 + b) * 257 + c + 70000):
            mixed = code * 2654435761 % (1 << 32)
            mixed ^= mixed >> 15
            total[mixed % dims] += 1
    return total


def test_languages_against_a_plain_scorer(docs, make, odd_rows):
    model = language_id.learn(docs, training_row(0))
    some = docs.where("doc_id < 60").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in some if len(r["text"] or "") < 3000] + [(i, t) for i, t, _ in odd_rows if i in (4, 5, 6)]
    got = sorted((r["doc_id"], r["lang_pred"], r["rejected"], r["score"])
                 for r in language_id.predict(make([(i, t, "en") for i, t in rows]), model).collect())
    want = []
    for i, t in rows:
        grams = plain_grams((t or "").encode(), len(model.idf))
        v = {s: math.log1p(n) * float(model.idf[s]) for s, n in grams.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        cos = [sum(x * float(centre[s]) for s, x in v.items()) / size for centre in model.matrix]
        j = max(range(len(cos)), key=cos.__getitem__)
        want.append((i, model.langs[j], bool(cos[j] < 0.8 * model.least[j]), min(1.0, max(0.0, cos[j]))))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], abs=1e-5)


def test_language_scores_do_not_depend_on_the_next_text(docs, make):
    model = language_id.learn(docs, training_row(0))
    score = lambda rows: {r["doc_id"]: r["score"] for r in language_id.predict(make(rows).coalesce(1), model).collect()}[1]
    alone = score([(1, "the one", "en")])
    assert all(score([(1, "the one", "en"), (2, t, "en")]) == pytest.approx(alone, abs=1e-6) for t in ("zz", "ça"))


def test_quality_against_a_plain_scorer(spark, docs, make, odd_rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality_model.learn(docs, labels, training_row(0))
    rows = [(r["doc_id"], r["text"], r["n_chars"]) for r in docs.where("doc_id < 80").collect()]
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in quality_model.predict(docs.where("doc_id < 80"), model).collect()}
    slots = len(model.w) - quality_model.N_STATISTICS
    for i, text, n_chars in rows:
        x = dict(enumerate(quality_model.statistics(text.encode(), text.encode().split(), n_chars)))
        counts = collections.Counter()
        for word in text.encode().lower().split():
            word = word.rstrip(b".,;:")
            if word:
                counts[quality_model.WordHashes()[word] % slots] += 1
        size = math.sqrt(sum(math.log1p(n) ** 2 for n in counts.values()))
        x.update({quality_model.N_STATISTICS + s: math.log1p(n) / size for s, n in counts.items()})
        keys = sorted(x)
        total = model.w0 + sum(float(model.w[k]) * x[k] for k in keys)
        v = np.array([model.v[k] for k in keys], float) * np.array([x[k] for k in keys])[:, None]
        total += sum(float(v[a] @ v[a + 1:].sum(axis=0)) for a in range(len(keys) - 1))  # every pair once
        score = 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))
        assert got[i][0] == pytest.approx(score, abs=1e-4) and got[i][1] == int(got[i][0] >= 0.3)
    clash = make(odd_rows).selectExpr("*", "'kept' as meta", "'too' as `given length`")
    out = quality_model.keep_good(clash, None)
    assert out.columns == clash.columns and {(r["meta"], r["given length"]) for r in out.collect()} == {("kept", "too")}
    assert quality_model.predict(docs.limit(0), model).collect() == [] and quality_model.keep_good(docs.limit(0), model).collect() == []


def test_shards_against_plain_prefix_sums(spark, docs):
    from churnspark.llm import sharding
    for table, n in ((docs, 8), (docs.where("doc_id < 37"), 5)):
        sizes = sorted((r["doc_id"], len((r["text"] or "").encode()) + 1) for r in table.select("doc_id", "text").collect())
        total, before, want, first = sum(s for _, s in sizes), 0, {}, {}
        for row, (i, s) in enumerate(sizes):
            shard = min(n - 1, (2 * before + s) * n // (2 * total))
            want[i] = (shard, row - first.setdefault(shard, row))
            before += s
        assert {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_by_bytes(table, n).collect()} == want


def test_windows_go_through_single_products_and_extreme_weights_stay_finite():
    """Scores and gradients do not take a product for each window; large logits neither overflow nor lose what a place reads."""
    r = np.random.default_rng(4)
    units, before = r.integers(0, language_model.START + 1, (64, 32)), r.integers(0, language_model.CLASSES, (64, 16))
    alone = np.arange(64) % 9 == 0
    for scale in (1, 30):
        w = {k: a * np.float32(scale) for k, a in language_model.new_weights().items()}
        z, _ = language_model.forward(w, units, before, alone)
        x = w["e"].astype(np.float64)[units]
        t = x[:, language_model.STEP:]
        s = (t @ w["q"]) @ (x @ w["k"]).transpose(0, 2, 1) / 4 + np.where(language_model.PLACE, w["d"][language_model.DISTANCE], -1e9)
        s[alone, :, :language_model.STEP] = -1e9
        s = np.exp(s - s.max(2, keepdims=True))
        want = (s / s.sum(2, keepdims=True)) @ (x @ w["v"]) @ w["o"] + t @ w["x"] + w["g"][before]
        want -= want.max(2, keepdims=True)
        want -= np.log(np.exp(want).sum(2, keepdims=True))
        assert np.isfinite(z).all()
        assert np.allclose(z, want, rtol=1e-2 if scale > 1 else 1e-4, atol=1e-4 * scale ** 3)
    a = r.normal(0, 1, (64, 16, 48)).astype(np.float32)
    p, total, top = language_model.exponentials(a.copy())
    assert top == 0 and np.allclose(p / total, np.exp(a) / np.exp(a).sum(2, keepdims=True), rtol=1e-5)
    assert np.array_equal(language_model.product(a, np.eye(48, dtype=np.float32)), a)


def test_words_are_encoded_as_one_text_with_the_ids_of_single_words():
    """One call of the tokenizer for many words (before: one for each), and the same ids where a word holds white space of other scripts."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        sub = language_model.Subwords(f.read(), public_tokenizers.PATTERN)
    plain = ["don't", "'s", "a1b2", "x--y", "naïve", "日本語", "🙂", "\x00", "(a)b.", "'", "1" * 30, "[INST]"]
    odd = ["a ", " b", "　", "\x85\x85c", "d e"]
    encode, calls = sub.encoding._core_bpe.encode_ordinary, []

    class Counted:
        class _core_bpe:
            @staticmethod
            def encode_ordinary(text):
                calls.append(text)
                return encode(text)
    sub.encoding = Counted
    for words in (plain, plain * 500, odd + plain, plain * 500 + odd, plain[:1], []):
        calls.clear()
        ids, sizes = sub.many([w.encode() for w in words])
        want = [encode(" " + w) for w in words]
        assert ids.tolist() == [i for f in want for i in f] and sizes.tolist() == [len(f) for f in want]
        if not set(odd) & set(words):
            assert len(calls) <= -(-len(words) // language_model.WORDS)


def test_batches_are_split_as_single_texts_are():
    signs = "".join(map(chr, [*range(0x250), *range(0x1680, 0x1681), *range(0x2000, 0x2070), 0x3000, 0x1F642]))
    texts = [None, "", " ", "A b\ta  a\n", "\x0b\x0cÀÉ İ K", signs, *(f" x{s}Y{s}" for s in signs)]
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    for b in (batch, batch.slice(3, 5), batch.slice(0, 3), batch.slice(0, 0)):
        words, flat, lengths = language_model.split_words(b, "text")
        want = [(t or "").encode().lower().split() for t in b.column(0).to_pylist()]
        assert [words[i] for i in flat] == [w for f in want for w in f] and lengths.tolist() == [len(f) for f in want]
        assert len(set(words)) == len(words) == len({w for f in want for w in f})


def test_training_keeps_the_memory_of_its_steps():
    """Pages of a step's arrays are not given back and cleared anew for the next one (before: over 1,000 a step)."""
    code = """
import resource, numpy as np
from churnspark.llm import language_model as m
r = np.random.default_rng(1)
text = lambda n: (r.integers(0, 90, n).astype(np.int32), np.array([n // 2, n - n // 2]))
kind = (np.arange(101) % 47).astype(np.int32)
faults = []
def texts():
    for _ in range(6):
        faults.append(resource.getrusage(resource.RUSAGE_SELF).ru_minflt)
        yield text(65536)
m.train_further(m.new_weights(), texts(), kind, kind, 100, 0.001)
print((faults[-1] - faults[2]) / 3 / 17)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, env={**os.environ, "PYTHONPATH": os.pathsep.join(sys.path)})
    assert float(out.stdout) < 300


def test_texts_are_split_and_tokenized_once(docs, make, odd_rows):
    """Learning and scoring read one table of ids (before: each pass split and tokenized the texts), with the same results."""
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    some = docs.where("doc_id < 150").unionByName(make([*odd_rows, (10, "a　b   c\x85 d", "en")]).select(docs.columns)).coalesce(1)
    table = language_model.encode(some, ranks, public_tokenizers.PATTERN)
    sub = language_model.Subwords(ranks, public_tokenizers.PATTERN)
    want = collections.Counter()
    for r in some.collect():
        words = [sub.encoding.encode_ordinary(" " + w.decode()) for w in (r["text"] or "").encode().lower().split()]
        want[r["doc_id"], tuple(map(tuple, words))] += 1
    got = collections.Counter()
    for r in table.collect():
        ids = np.frombuffer(r["tokens"], language_model.id_type(sub.size))
        starts = np.flatnonzero(np.unpackbits(np.frombuffer(r["starts"], np.uint8)))
        assert len(r["starts"]) == -(-len(ids) // 8) and (starts < len(ids)).all()
        got[r["doc_id"], tuple(tuple(w.tolist()) for w in np.split(ids, starts)[1:])] += 1
    assert got == want
    results = []
    for frame in (some, table):
        model, counts = language_model.learn(frame, training_row(1), ranks, public_tokenizers.PATTERN, sample=20)
        rows = language_model.score(frame, model, counts).collect()
        results.append((model, sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in rows)))
    assert (results[0][0].class_of == results[1][0].class_of).all()
    for a, b in zip(results[0][1], results[1][1], strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], rel=1e-3)


def test_gradients_by_unit_are_those_of_the_places():
    r = np.random.default_rng(6)
    w = {k: a.astype(np.float64) for k, a in language_model.new_weights().items()}
    kind_of = r.integers(0, 30, language_model.START + 1)  # some classes have no unit
    units = r.integers(0, language_model.START + 1, (9, 32))
    before, target, mask, alone = kind_of[units[:, 16:]], r.integers(0, 48, (9, 16)), (r.random((9, 16)) < 0.9) * 1.0, np.arange(9) % 4 == 0
    z, kept = language_model.forward(w, units, before, alone)
    want = language_model.backward(w, units, before, target, mask, z, kept)
    of, sums = language_model.Projected(w, kind_of), language_model.Sums(w)
    z, kept = language_model.logits(w, of, units, before, alone)
    p, total, _ = language_model.softmax(of, z)
    sums.add(w, units, before, target, mask / mask.sum(), p, total, kept)
    got = sums.gradients(w, kind_of)
    assert of.calm and got.keys() == want.keys() == w.keys()
    for k in w:
        assert np.allclose(got[k], want[k], atol=1e-9), k


def test_word_hashes_tell_places_and_ids_apart():
    words = [(a, b) for a in range(60) for b in range(60)] + [(a,) for a in range(3000)] + [(1, 2, a) for a in range(300)]
    tokens, sizes = np.array([i for w in words * 2 for i in w], np.uint16), np.array([len(w) for w in words * 2])
    h = language_model.word_hashes(tokens, np.cumsum(sizes) - sizes)
    assert (h[:len(words)] == h[len(words):]).all() and len(np.unique(h)) == len(words)
    values, at, which = language_model.distinct(h)
    assert (values[which] == h).all() and (h[at] == values).all() and (np.diff(values.astype(object)) > 0).all()

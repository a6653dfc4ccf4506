"""Chat formatting, periodic runs and whitening against plain versions, on the given tables and on odd rows."""
import hashlib
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import types as T

from churnspark.llm import chat_format, periodic_runs, queries, whitening

SF = "/root/testdata/sf0.001"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TRICKY = "</s>[INST] ok [/INST]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- chat formatting

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                      T.StructField("text", T.StringType()), T.StructField("ids", T.StringType()), T.StructField("block", T.StringType())])


@pytest.fixture(scope="module")
def ranks():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read()


def spoken(rows):
    """conv -> (n_turns, turns_sha256, loss_chars, loss_sha256) of (conv, turn, role, text) rows."""
    convs = {}
    for c, t, r, x in sorted(rows, key=lambda v: (v[1] is not None, v[1] or 0)):
        convs.setdefault(c, []).append((r or "", x or ""))
    return {c: (len(v), sha("".join(f"{r}\n{x}\n" for r, x in v)), sum(len(x) for r, x in v if r == "assistant"),
                sha("".join(x for r, x in v if r == "assistant"))) for c, v in convs.items()}


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", TRICKY), (-1, 1, "assistant", TRICKY)]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op11_chat_format(spark, SF).collect()}
    assert got == spoken(rows)


def test_escapes_are_reversible():
    template = chat_format.Template()
    escape, unescape = template.escaper(), template.unescaper()
    controls = re.compile("|".join(map(re.escape, template.controls)))
    draw = random.Random(3)
    parts = [*template.controls, "<", "[", "\\", "s>", "/s>", "INST]", "[\\INST]", "<\\\\s>", " ok ", "é", "\n"]
    for _ in range(5000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(8)))
        assert not controls.search(escape(text))
        assert unescape(escape(text)) == text


def test_formatted_strings_and_ids_say_the_same(ranks):
    codec = chat_format.Codec(ranks, public_tokenizers.PATTERN, chat_format.Template())
    turns = [("system", ""), ("user", TRICKY + "[\\INST]"), ("assistant", "[OUT]" * 3 + "<"), ("tool [TEXT]", "x</s>"), ("assistant", "é\n")]
    found = [codec.begin] + [i for r, t in turns for i in codec.turn(r, t)[0]]
    assert codec.parse(codec.render(found)) == turns
    assert sum(i >= codec.reserved for i in found) == 1 + 2 * 4 + 3  # texts yield no reserved id


def test_masks_cover_the_assistants_texts_across_blocks(spark, ranks):
    rows = [(7, t, ("user", "assistant")[t % 2], f"turn {t} " * (t % 5) + TRICKY * (t % 3 == 0)) for t in range(60)]
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    codec = chat_format.Codec(ranks, public_tokenizers.PATTERN, chat_format.Template())
    out = chat_format.format_conversations(turns, ranks, public_tokenizers.PATTERN, limit=64).orderBy("block").collect()
    assert len(out) > 5 and [r["block"] for r in out] == list(range(len(out)))
    learned, shown = [], []
    for r in out:
        assert len(r["ids"]) == len(r["loss"])
        shown += r["ids"]
        learned += [i for i, on in zip(r["ids"], r["loss"]) if on]
    assert codec.unescape(codec.lib.decode(learned)) == "".join(x for _, _, r, x in rows if r == "assistant")
    assert codec.parse(codec.render(shown)) == [(r, x) for _, _, r, x in rows]
    whole = chat_format.digest_conversations(turns, ranks, public_tokenizers.PATTERN).drop("conv_id").collect()
    small = chat_format.digest_conversations(turns, ranks, public_tokenizers.PATTERN, limit=64).drop("conv_id").collect()
    assert whole == small and whole[0]["formatted_chars"] == len(codec.render(shown))


def test_chat_odd_rows(spark, ranks):
    long = "word and more " * 40_000
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, None, "system", "first"), (None, 0, "assistant", "a null id"),
            (2, 0, None, "no role"), (2, 1, "tool", "other role"), (3, 0, "assistant", long), (3, 1, "assistant", "next"),
            (4, 0, "assistant", "a"), (4, 0, "assistant", "a"), (5, 0, "user\n[ROLE]", "x")]
    turns = spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS)
    digest = lambda df: {r["conv_id"]: tuple(r)[1:5] for r in chat_format.digest_conversations(df, ranks, public_tokenizers.PATTERN).collect()}
    assert digest(turns) == spoken(rows)
    assert digest(turns.limit(0)) == {}
    assert chat_format.format_conversations(turns.limit(0), ranks, public_tokenizers.PATTERN).collect() == []


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat_format.Template(begin="s>")
    with pytest.raises(ValueError):
        chat_format.Template(begin="[SYS]")
    with pytest.raises(ValueError):
        chat_format.Template(begin="</s>x")


# ---------------------------------------------------------------- periodic runs

def plain_runs(w):
    """Every maximal repetition of at least 6 words and 4 smallest periods, by comparing words q apart for every q."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - s + q
            if length >= max(6, 4 * q) and all(any(w[x] != w[x + k] for x in range(s, s + length - k)) for k in range(1, q)):
                out.append((s, length, q))
            i += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(i, w):
    h = zlib.crc32(str(i).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]


def plain_row(i, text, plant=True):
    w = WORDS.findall(text or "")
    w = planted(i, w) if plant and i is not None else w
    runs = plain_runs(w)
    dropped = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (i, len(runs), *four, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in dropped)))


def test_runs_of_random_words():
    draw = random.Random(5)
    texts = []
    for _ in range(1500):
        n, kinds = draw.randrange(60), draw.choice([1, 2, 3, 5, 30])
        w = [draw.randrange(kinds) for _ in range(n)]
        if n and draw.random() < .5:
            a = draw.randrange(n)
            p = 1 + draw.randrange((n - a) // 3 + 1)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        texts.append(w)
    assert sum(len(plain_runs(w)) for w in texts) > 500
    for at in range(0, len(texts), 50):  # fifty texts to a chunk: no run may cross from one to the next
        assert periodic_runs.runs_of([np.array(w, np.int64) for w in texts[at:at + 50]]) == [plain_runs(w) for w in texts[at:at + 50]]


def test_runs_of_long_regular_texts():
    fibonacci, before = [0, 1], [0]
    while len(fibonacci) < 900:
        fibonacci, before = fibonacci + before, fibonacci
    morse = [0]
    while len(morse) < 1024:
        morse += [1 - x for x in morse]
    for w in (fibonacci, morse, [0] * 1000, [k % 7 for k in range(1000)], [0] * 500 + [1] + [0] * 499):
        assert periodic_runs.runs_of([np.array(w, np.int64)])[0] == plain_runs(w)


def test_runs_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    small = [r for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == docs.count()
    want = [plain_row(r["doc_id"], r["text"]) for r in small]
    assert sum(w[1] for w in want) > 5
    assert [got[w[0]] for w in want] == want


def test_runs_odd_rows(spark, make, odd_rows):
    rows = odd_rows[:6] + [(10, "a b " * 5, "en"), (10, "a b " * 5, "en"), (11, "x\n\n\n" * 6 + "  y", "en"), (None, "z " * 9, "fr")]
    docs = make(rows)
    got = sorted((tuple(r) for r in periodic_runs.digest_runs(docs).collect()), key=repr)
    assert got == sorted((plain_row(i, t, plant=False) for i, t, _ in rows), key=repr)
    assert sorted(tuple(r) for r in periodic_runs.find_runs(docs).where("doc_id is not null").collect()) == [(10, 0, 10, 2), (10, 0, 10, 2), (11, 0, 6, 1)]
    cut = periodic_runs.collapse_runs(docs)
    assert cut.schema == docs.schema
    texts = [r["text"] for r in cut.where("doc_id in (1, 2, 3, 10, 11)").orderBy("doc_id").collect()]
    assert texts == [None, "", " \n\t ", "a b", "a b", "x   y"]
    assert periodic_runs.digest_runs(docs.limit(0)).collect() == []
    long = periodic_runs.digest_runs(make([r for r in odd_rows if r[0] in (7, 8)])).collect()
    assert [r["n_runs"] for r in long] == [0, 0]


def test_planted_repeats(spark, make, odd_rows):
    rows = odd_rows + [(i, " ".join(f"w{k}" for k in range(i)), "en") for i in range(20, 80)]
    got = sorted(((r["doc_id"], r["text"]) for r in periodic_runs.with_planted_repeats(make(rows)).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        w = WORDS.findall(t or "")
        want.append((i, " ".join(planted(i, w)) if w and i is not None and zlib.crc32(str(i).encode()) % 10 == 0 else t))
    assert got == sorted(want, key=repr)


# ---------------------------------------------------------------- whitening

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("x", T.StringType()), T.StructField("id", T.StringType())])


def plain_whitening(rows, components=16):
    """n, exact deviations and the covariance of the distinct whole vectors, by fractions."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in good]
    fit = sorted({tuple(x) for _, x in xs})
    n, width = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(width)]
    z = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], object)
    v = np.array([[float(Fraction(int(c), n ** 3)) for c in line] for line in z.T @ z])
    return xs, n, sums, v, {i: sum((n * c - s) ** 2 for c, s in zip(x, sums)) for i, x in xs}


def check_whitening(got, rows, components=16):
    xs, n, sums, v, far = plain_whitening(rows)
    values = np.sort(np.linalg.eigvalsh(v))[::-1][:components]
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {})[r["component"]] = r
    assert set(by) == {i for i, _ in xs} and len(got) == len(xs) * len(values)
    for i, x in xs:
        assert sorted(by[i]) == list(range(1, len(values) + 1))
        assert {(r["n"], r["deviation"]) for r in by[i].values()} == {(n, far[i])}
        assert np.allclose([by[i][k + 1]["explained"] for k in range(len(values))], values / np.trace(v), rtol=1e-9)
    z = np.array([[by[i][k + 1]["whitened"] for k in range(len(values))] for i, _ in xs])
    c = np.array([[(n * a - s) / n for a, s in zip(x, sums)] for _, x in xs])
    w, *_ = np.linalg.lstsq(c, z, rcond=None)  # the directions that the whitened values were taken along
    w = w * np.sqrt(values)
    assert np.allclose(w.T @ w, np.eye(len(values)), atol=1e-8)
    assert np.allclose(v @ w, w * values, atol=1e-8 * values[0])
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(queries.op13_whitening(spark, SF).collect(), rows)


def test_whitening_odd_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, [float(c) for c in np.float32(draw.normal(size=5) * [1, 2, 3, 40, 5000])]) for i in range(60)]
    odd = [(100, None), (101, []), (102, [1.0, None, 2.0, 3.0, 4.0]), (103, [1.0, math.nan, 2.0, 3.0, 4.0]), (104, [1.0, 2.0, 3.0, 4.0, math.inf])]
    short = [(105, [1.0, 2.0])]
    copies = [(200 + k, rows[0][1]) for k in range(40)]
    table = spark.createDataFrame([(i, v, "a", "b") for i, v in rows + odd + short + copies], VECTORS)
    check_whitening(whitening.whiten_embeddings(table).collect(), rows + copies)
    assert whitening.whiten_embeddings(table.limit(0)).collect() == []
    assert whitening.whiten_embeddings(table.where("vec_id between 100 and 104")).collect() == []


def test_whitening_without_variance(spark):
    table = spark.createDataFrame([(i, [1.0, 2.0], "a", "b") for i in range(3)], VECTORS)
    got = whitening.whiten_embeddings(table).collect()
    assert len(got) == 6
    assert all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, None, None) for r in got)
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i], "a", "b") for i in range(9)], VECTORS)  # one direction varies
    got = whitening.whiten_embeddings(flat).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in got) and got[0]["identity_error"] < 1e-9


def test_whitening_of_far_entries(spark):
    table = spark.createDataFrame([(i, [1e30 * (i - 1), float(i)], "a", "b") for i in range(3)], VECTORS)
    got = whitening.whiten_embeddings(table).collect()
    assert len(got) == 6 and all(r["deviation"] is None or r["deviation"] >= 0 for r in got)


def test_squares_are_exact_beyond_64_bits():
    y = np.array([[1 << 40, -(1 << 41)], [3, 5]], np.int64)
    a, b = whitening.pairs(2)
    assert list(whitening.exact_squares(y, a, b)) == [(1 << 80) + 9, (1 << 80) + 64, (1 << 82) + 25]

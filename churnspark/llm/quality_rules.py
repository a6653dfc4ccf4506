"""Quality rules: a threshold table compiled into one projection (built-in functions only)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE

SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for on was with as be by this are from or an at have not but they which "
    "der die das und ist nicht ein eine zu den von mit auf für im dem des sich auch es "
    "le la les et est une un du dans que qui pour pas sur au avec ce il en "
    "el los las y es una de por con para del se no lo su al como más").split()
#: As they stand in texts: also capitalised, also before a punctuation mark.
STOP_FORMS = [w + mark for word in STOP_WORDS for w in (word, word.capitalize()) for mark in ("", ".", ",", ";", ":", "!", "?")]

#: (rule, measure, worst value still kept, as ">=" or "<="); a document is kept if every rule holds.
THRESHOLDS = [
    ("short_words", "mean_word_chars", ">=", 2.0),
    ("long_words", "mean_word_chars", "<=", 25.0),
    ("symbols", "symbols_per_word", "<=", 0.3),
    ("exclaimed", "exclamations_per_word", "<=", 0.5),
    ("stop_words", "stop_word_ratio", ">=", 0.02),
    ("repeated_lines", "dup_line_ratio", "<=", 0.3),
]


def count_of(text: Column, characters: str) -> Column:
    without = text
    for c in characters:
        without = F.replace(without, F.lit(c), F.lit(""))
    return (F.length(text) - F.length(without)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def computed(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``df`` with columns computed once.  Plain intermediate columns would be inlined again by the
    optimiser, once for each use, also inside loops over array elements; a one-row generator is not."""
    one = F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("_")
    return df.select(*keep, one).select(*keep, *[F.col(f"_.{k}").alias(k) for k in columns])


def split_words(text: Column) -> Column:
    """Words between any of the six white characters: every one becomes a space, then a plain split."""
    for c in WHITE[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return F.filter(F.split(text, " "), lambda x: x != "")


def window_hashes(words: Column, size: int) -> Column:
    starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))


LOW = 24  # bits that hold a window's place while sorting


def repeat_words(df: DataFrame, keep: list[str], hashes: str, size: int) -> DataFrame:
    """Replaces ``hashes`` by ``n_repeat_words``: words in windows found twice or more, the first included.

    Sorted by hash, equal windows are neighbours.  A plain sort of longs, the
    hash's upper bits with the place below them, finds the few places that
    may repeat (texts without any repeat skip it, texts too long for the
    place's bits take all places); those are compared by whole hashes.
    The covered words are the union of [p, p + size) over the repeated places p."""
    h, o = F.col(hashes), F.col("_o")
    low = F.lit((1 << LOW) - 1)
    packed = F.transform(h, lambda x, i: x.bitwiseAND(F.lit(-(1 << LOW))).bitwiseOR(i.cast("long")))
    some = F.size(h) != F.size(F.array_distinct(h))
    short = F.size(h) < (1 << LOW)
    df = computed(df, [*keep, hashes], _some=some, _o=F.when(some & short, F.sort_array(packed)))

    def near(x, j):
        before = F.when(j > 0, F.get(o, F.greatest(j - 1, F.lit(0))))
        same = lambda y: F.coalesce(F.shiftright(x, LOW) == F.shiftright(y, LOW), F.lit(False))
        return same(before) | same(F.get(o, j + 1))
    few = F.transform(F.filter(o, near), lambda x: x.bitwiseAND(low).cast("int"))
    everywhere = F.sequence(F.lit(0), F.size(h) - 1)
    df = computed(df, [*keep, hashes], _p=F.when(F.col("_some"), F.when(short, few).otherwise(everywhere)))

    def twins(ordered: Column) -> Column:
        def twin(x, j):
            before = F.when(j > 0, F.get(ordered, F.greatest(j - 1, F.lit(0)))["h"])
            return F.coalesce(x["h"] == before, F.lit(False)) | F.coalesce(x["h"] == F.get(ordered, j + 1)["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, j: F.least(F.lit(size), F.coalesce(F.get(p, j + 1), x + size) - x))
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)
    by_hash = F.sort_array(F.transform("_p", lambda i: F.struct(F.get(h, i).alias("h"), i.alias("i"))))
    n = F.when(F.col("_p").isNull(), F.lit(0)).otherwise(let(let(by_hash, twins), total))
    return df.withColumn("n_repeat_words", n.cast("long")).drop(hashes, "_p")


def measure(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), window: int = 5) -> DataFrame:
    """Counts of every text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_stop_words,
    n_exclamations.  A null text has no words and no lines."""
    keep = list(keep)
    text = F.coalesce(F.col(text_col), F.lit(""))
    # [^\x20\x09-\x0D] finds the first character of a word at once.
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    parts = computed(docs, keep, words=split_words(text), lines=lines,
                     n_symbols=count_of(text, SYMBOLS),
                     n_exclamations=count_of(text, "!"))
    words, lines = F.col("words"), F.col("lines")
    counts = computed(
        parts, [*keep, "n_symbols", "n_exclamations"], n_words=F.size(words).cast("long"),
        word_chars=F.length(F.array_join(words, "")).cast("long"),
        n_stop_words=F.size(F.filter(words, lambda x: x.isin(STOP_FORMS))).cast("long"),
        n_lines=F.size(lines).cast("long"), n_dup_lines=(F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        hashes=window_hashes(words, window))
    done = [*keep, "n_symbols", "n_exclamations", "n_words", "word_chars", "n_stop_words", "n_lines", "n_dup_lines"]
    return repeat_words(counts, done, "hashes", window)


def ratios(words: str = "n_words") -> dict[str, Column]:
    per = lambda c, of: F.when(F.col(of) > 0, F.col(c) / F.col(of)).otherwise(F.lit(0.0))
    return {"mean_word_chars": per("word_chars", words), "symbols_per_word": per("n_symbols", words),
            "exclamations_per_word": per("n_exclamations", words), "stop_word_ratio": per("n_stop_words", words),
            "dup_line_ratio": per("n_dup_lines", "n_lines")}


def compile_rules(table=THRESHOLDS) -> Column:
    """The threshold table as one array column: names of the rules that a row breaks."""
    values = ratios()
    broken = [F.when(~(values[m] >= v if op == ">=" else values[m] <= v), F.lit(name)) for name, m, op, v in table]
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def apply_rules(docs: DataFrame, table=THRESHOLDS, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
                min_words: int = 10, max_repeat_percent: int = 20) -> DataFrame:
    """Counts, ``base_failed``, ``broken`` (names of broken rules) and ``kept`` for every document.

    base_failed: under ``min_words`` words, or more than ``max_repeat_percent``
    of the words in 5-word windows found twice or more.  Ratios of an empty
    text are 0.  One projection over one scan: no shuffle, no user function.
    Rows repeat as they come; other columns of the input are not read.
    """
    m = measure(docs, text_col, keep)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    out = m.withColumns({"base_failed": failed, "broken": compile_rules(table)})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))

"""URL rules looked up in a cascade of Bloom filters (built-in functions only).

Level 1 encodes the listed keys.  Every key of the corpus that level 1
accepts although it is not listed is encoded in level 2, listed keys that
level 2 accepts wrongly in level 3, and so on until a level makes no error.
As the levels are built against every key that occurs in the corpus,
membership is exact for that corpus and needs no join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, discard, is_empty, save

HASHES = 3


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to / ? # or the end, A-Z lower-cased; path: from there up to ? or #."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def candidate_keys(rules: list[str]):
    """Column function: the keys of a url (host suffix + path prefix) that a rule of these shapes could equal,
    the longest first (of equal length: the longer host)."""
    shapes = sorted({(h.count(".") + 1, len(p)) for h, p in map(split_rule, rules)})

    def keys(host: Column, path: Column) -> Column:
        labels = F.split(host, r"\.")
        found = []
        for n, length in shapes:
            suffix = F.array_join(F.slice(labels, F.lit(-n), F.lit(n)), ".")
            fits = (F.size(labels) >= n) & (F.length(path) >= length) & (host != "")
            found.append(F.when(fits, F.struct((-F.length(suffix) - length).alias("o"), (-F.length(suffix)).alias("h"),
                                               F.concat(suffix, F.substring(path, 1, length)).alias("key"))))
        if not found:
            return F.array().cast("array<string>")
        return F.transform(F.sort_array(F.array_compact(F.array(*found))), lambda x: x["key"])
    return keys


def bit_places(key: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(HASHES)]


def level_accepts(key: Column, level: int, bits: int, words: list[int]) -> Column:
    table = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")  # folds to one literal
    accepted = F.lit(True)
    for place in bit_places(key, level, bits):
        word = F.get(table, F.shiftright(place, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, place.bitwiseAND(F.lit(63)).cast("int"))
        accepted = accepted & (bit.bitwiseAND(F.lit(1)) == 1)
    return accepted


class Cascade:
    """Bloom filter levels as lists of 64-bit words, and the expression that asks them."""

    def __init__(self, levels: list[tuple[int, list[int]]]):
        self.levels = levels

    def contains(self, key: Column) -> Column:
        """Level 1 and not (level 2 and not (level 3 ...))."""
        answer = F.lit(False)
        for level in range(len(self.levels) - 1, -1, -1):
            answer = level_accepts(key, level, *self.levels[level]) & ~answer
        return answer


def build_cascade(listed: DataFrame, universe: DataFrame, bits_per_key: int = 10, max_filter_mb: int = 64) -> Cascade:
    """Cascade over ``listed.key`` that is exact for every ``universe.key``.

    Only the filter's words reach the driver: ``bits_per_key`` bits for each
    encoded key, refused above ``max_filter_mb`` (then split the list and
    build one cascade for each part)."""
    inside = listed.select("key").distinct()
    outside = universe.select("key").join(inside, "key", "left_anti").distinct()
    include, exclude, levels, made = inside, outside, [], []
    while not is_empty(include):
        level, n = len(levels), include.count()
        bits = 64 * max(1, -(-n * bits_per_key // 64))
        if bits > max_filter_mb * 8 << 20:
            raise ValueError(f"{n} listed keys need a filter over {max_filter_mb} MB: split the list")
        place = F.explode(F.array(*bit_places(F.col("key"), level, bits))).alias("place")
        one = F.expr("shiftleft(1L, cast(place & 63 as int))")
        rows = (include.select(place).groupBy(F.shiftright("place", 6).alias("word"))
                .agg(F.bit_or(one).alias("bits")).collect())
        words = [0] * (bits // 64)
        for r in rows:
            words[r["word"]] = r["bits"]
        levels.append((bits, words))
        wrong = save(exclude.where(level_accepts(F.col("key"), level, bits, words)), f"cascade-{level}")
        made.append(wrong)
        include, exclude = wrong, include
    discard(*made)
    return Cascade(levels)


def filter_urls(pages: DataFrame, allow: list[str], block: list[str], default: str = "allow",
                id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule (the longest that fits, else null), verdict.

    A rule ``host/path`` fits its host and all subdomains if the url's path
    starts with the rule's path.  Without a fitting rule the url's keys are
    in no list and the verdict is ``default``.  A null url or one without
    ``://`` has empty host and path and fits no rule.  A rule in both lists
    blocks.  Repeated pages give a row each; an empty table gives no rows.
    Both passes read only ids and urls.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    keyed = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    keyed = keyed.withColumn("keys", candidate_keys([*allow, *block])(F.col("host"), F.col("path")))
    universe = save(keyed.select(F.explode("keys").alias("key")).distinct(), "url-keys")
    as_keys = lambda rules: spark.range(1).select(F.explode(
        F.array(*[F.lit("".join(split_rule(r))) for r in rules]).cast("array<string>")).alias("key"))
    blocked, allowed = build_cascade(as_keys(block), universe), build_cascade(as_keys(allow), universe)
    discard(universe)
    member = F.filter("keys", lambda k: blocked.contains(k) | allowed.contains(k))
    found = keyed.withColumn("rule", F.get(member, F.lit(0)))
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(blocked.contains(F.col("rule")), "block").otherwise("allow")
    return found.select(id_col, "host", "path", "rule", verdict.alias("verdict"))

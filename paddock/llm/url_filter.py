"""URL verdicts: explicit rules first, then a block list held in a Bloom filter cascade.

The cascade is built over every key of the corpus.  Level 1 holds the listed keys, level 2
the unlisted keys that level 1 lets through, level 3 the listed keys that level 2 lets
through, and so on until no key is wrong.  A key's verdict is the parity of the first level
that turns it away, which is exact for every key of the corpus; no join is needed to look
it up.  A level reaches the tasks as the value of a scalar subquery.  Its size is known
beforehand: a list that needs more than ``MAX_WORDS`` words is split by hash into parts
with a cascade each, and the rows are judged part by part.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
MAX_WORDS = 1 << 20  # 64-bit words of one level: 8 MB
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and the path without query and fragment; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    none = F.coalesce(at, F.lit(0)) == 0
    return (
        F.when(none, "").otherwise(F.translate(host, UPPER, LOWER)),
        F.when(none, "").otherwise(path),
    )


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def site(host: Column) -> Column:
    """The key that lists hold: the host without a leading www, m or blog label."""
    return F.regexp_replace(host, r"^(www|m|blog)\.", "")


@dataclass(frozen=True)
class Level:
    """Bits of one level, stored as one row of ``words``; ``size`` words, ``probes`` a key."""

    table: DataFrame
    size: int
    probes: int


def _places(key: Column, level: int, size: int, probes: int) -> list[Column]:
    """Bit numbers of a key: double hashing with two seeds of the level."""
    total = F.lit(size * 64).cast("long")
    one, two = (F.pmod(F.xxhash64(key, F.lit(2 * level + k)), total) for k in (0, 1))
    return [F.pmod(one + k * two, total) for k in range(probes)]


def _has(words: Column, places: list[Column]) -> Column:
    bits = [F.bit_get(F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1 for p in places]
    return reduce(lambda a, b: a & b, bits)


def _level(keys: DataFrame, level: int, n: int, bits: float, probes: int) -> Level:
    size = max(1, math.ceil(n * bits / 64))
    places = _places(F.col("key"), level, size, probes)
    each = keys.select(F.explode(F.array(*places)).alias("place"))
    some = each.select(
        F.shiftright("place", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("place") % 64).cast("int")).alias("bits"),
    )
    none = keys.sparkSession.range(size).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    # one row, of at most MAX_WORDS words
    rows = some.union(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    row = rows.agg(F.transform(F.sort_array(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("words"))
    return Level(materialize(row, "bloom_level"), size, probes)


def cascade(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """Levels for the distinct keys of ``universe``, of which ``listed`` are on the list.

    Both are stored tables of one column ``key``, ``listed`` a subset of ``universe``.
    """
    inside, total = listed.count(), universe.count()
    if not inside:
        return []
    outside = universe.join(listed, "key", "left_anti")
    # the first level lets through so few others that the rest stays small
    wanted = min(0.5, max(math.sqrt(0.5) * inside / max(1, total - inside), 1e-4))
    probes = max(1, round(-math.log2(wanted)))
    levels: list[Level] = []
    now, other, n, bits = listed, outside, inside, probes / math.log(2)
    while n:
        levels.append(_level(now, len(levels) + 1, n, bits, probes))
        new = levels[-1]
        passed = _has(new.table.scalar(), _places(F.col("key"), len(levels), new.size, probes))
        now, other = materialize(other.where(passed), "bloom_passed"), now
        # from here on a level of about one bit and a half a key halves what is left
        n, bits, probes = now.count(), 1 / math.log(2), 1
    return levels


def in_cascade(key: Column, levels: Sequence[Level]) -> Column:
    """Whether a key of the universe is listed."""
    verdict = F.lit(len(levels) % 2 == 1)
    for number, level in reversed(list(enumerate(levels, 1))):
        passed = _has(level.table.scalar(), _places(key, number, level.size, level.probes))
        verdict = F.when(~passed, F.lit(number % 2 == 0)).otherwise(verdict)
    return verdict


def parts_for(listed: int, max_words: int = MAX_WORDS) -> int:
    """Parts that keep every level within ``max_words``: at most 14 probes a listed key."""
    return max(1, math.ceil(listed * 14 / math.log(2) / 64 / max_words))


def marked(rows: DataFrame, key: str, listed: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """``rows`` with ``listed``: whether the value of ``key`` is among the keys listed.

    ``rows`` is a stored table, ``listed`` has one column ``key``.  Null keys are not listed.
    """
    universe = materialize(rows.select(F.col(key).alias("key")).where("key is not null").distinct(), "keys")
    chosen = materialize(universe.join(listed.distinct(), "key", "left_semi"), "listed")
    parts = parts_for(chosen.count(), max_words)
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))
    out = []
    for k in range(parts):
        own = [t if parts == 1 else t.where(part(F.col("key")) == k) for t in (universe, chosen)]
        levels = cascade(*own)
        here = rows if parts == 1 else rows.where(F.coalesce(part(F.col(key)), F.lit(0)) == k)
        out.append(here.withColumn("listed", F.coalesce(in_cascade(F.col(key), levels), F.lit(False))))
    return reduce(DataFrame.unionAll, out)


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    The longest fitting rule decides, else the block list of sites in ``listed`` (column
    ``key``), else ``allow``.  A null url, or one without ``://``, has an empty host and
    path, fits no rule and is allowed unless the empty site is listed.  Rows are judged one
    by one, so repeated and null page ids keep their rows; an empty table gives none.
    """
    host, path = host_and_path(pages["url"])
    parsed = pages.select(pages["page_id"], host.alias("host"), path.alias("path"))
    stored = materialize(parsed.withColumn("site", site(F.col("host"))), "urls")
    found = marked(stored, "site", listed, max_words).withColumn(
        "found", rule_of(F.col("host"), F.col("path"), rules)
    )
    return found.select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )


def sites_with(pages: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Sites of the corpus with one of the given words in a label, as a block list."""
    host, _ = host_and_path(pages["url"])
    wanted = r"(^|[.-])(" + "|".join(labels) + r")([.-]|$)"
    return pages.select(site(host).alias("key")).where(F.col("key").rlike(wanted)).distinct()



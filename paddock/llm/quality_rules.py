"""Quality rules whose limits follow each language and source.

A document is measured once.  Integer rates go into mergeable quantile sketches: counts
per log-linear bucket (64 buckets for the first two octaves, then 32 an octave, so a
quantile is off by 1/32 at most), which merge by adding and depend on no order.  From the
quartiles of a (language, source) follows the range in which its documents usually lie;
rows outside are rejected by a join with these limits.

Few rows say little about a group.  A limit is therefore a mean of that of the group, weighed
by its rows, and that of its language, weighed as ``PRIOR_ROWS`` rows; that of the language
one of its own and that of the corpus.  It moves smoothly from one to the other as a group grows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import SPACE, identified, materialize, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_OCTAVE = 32


@dataclass(frozen=True)
class Rate:
    """A measure, the least width of its usual range, and whether low values fail too."""

    name: str
    least: int
    both_sides: bool = False


# per thousand words, letters or lines; word_length in hundredths of a character
RATES = (
    Rate("symbol_rate", 20),
    Rate("mark_rate", 20),
    Rate("upper_rate", 20),
    Rate("dup_line_rate", 100),
    Rate("word_length", 100, both_sides=True),
)
FENCE = 3  # widths of the middle half beyond the quartiles
PRIOR_ROWS = 10  # rows as which the limits of the language count beside a group's own


def _without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measured(docs: DataFrame, **more: Column) -> DataFrame:
    """tag, doc_id, lang, source, base counts and rates of every document."""
    text = F.coalesce(docs["text"], F.lit(""))
    first = identified(
        docs,
        doc_id=docs["doc_id"],
        lang=docs["lang"],
        source=docs["source"],
        _words=words(docs["text"]),
        _lines=F.filter(
            F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""
        ),
        word_chars=F.length(F.translate(text, SPACE, "")).cast("long"),
        n_symbols=_without(text, SYMBOLS).cast("long"),
        _marks=_without(text, "!"),
        _upper=F.regexp_count(text, F.lit(r"\p{Lu}")),
        **more,
    )
    n = F.size("_words")
    # every word after the first four ends a window; its hash covers the words one by one
    ends = F.when(n > WINDOW, F.sequence(F.lit(WINDOW), n)).otherwise(F.array().cast("array<int>"))
    second = first.withColumns(
        {
            "n_words": n.cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_hashes": F.transform(
                ends,
                lambda i: F.xxhash64(
                    *[F.element_at("_words", i - k) for k in reversed(range(WINDOW))]
                ),
            ),
        }
    )
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    by_hash = F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    third = second.withColumn("_by_hash", F.when(repeats, by_hash))
    twice = F.filter(
        "_by_hash",
        lambda p, j: (p["h"] == F.get("_by_hash", j - 1)["h"])
        | (p["h"] == F.get("_by_hash", j + 1)["h"]),
    )
    starts = F.sort_array(F.transform(twice, lambda p: p["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("total")),
        lambda seen, i: F.struct(
            i.alias("last"),
            (seen["total"] + F.least(F.lit(WINDOW), i - seen["last"])).alias("total"),
        ),
        lambda seen: seen["total"],
    )
    fourth = third.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))

    def rate(part: str, whole: str, scale: int = 1000) -> Column:
        return F.expr(f"{part} * {scale}L div greatest({whole}, 1L)")

    return fourth.select(
        "tag", "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words",
        (
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
        ).alias("base_failed"),
        rate("n_symbols", "n_words").alias("symbol_rate"),
        rate("_marks", "n_words").alias("mark_rate"),
        rate("_upper", "word_chars").alias("upper_rate"),
        rate("n_dup_lines", "n_lines").alias("dup_line_rate"),
        rate("word_chars", "n_words", 100).alias("word_length"),
        *more,
    )


def bucket(value: Column) -> Column:
    """Bucket of a whole number >= 0."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return (shift * _OCTAVE + F.call_function("shiftright", value, shift)).cast("int")


def top_of(number: Column) -> Column:
    """The largest value that falls into a bucket."""
    shift = F.greatest(F.floor(number / _OCTAVE) - 1, F.lit(0)).cast("int")
    return F.call_function("shiftleft", (number - shift * _OCTAVE + 1).cast("long"), shift) - 1


def sketch(rows: DataFrame) -> DataFrame:
    """Counts by (lang, source, rate, bucket); sketches of parts merge by adding counts."""
    each = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rate"), bucket(F.col(r.name)).alias("bucket")) for r in RATES])
    )
    return (
        rows.select("lang", "source", each.alias("one"))
        .groupBy("lang", "source", "one.rate", "one.bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quartiles(sketched: DataFrame, keys: list[str]) -> DataFrame:
    """First and third quartile, and rows, by ``keys`` and rate.

    A window holds the buckets of one group and rate, of which there are under 2,000.
    """
    merged = sketched.groupBy(*keys, "rate", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*keys, "rate")
    ranked = merged.withColumns(
        {"upto": F.sum("n").over(whole.orderBy("bucket")), "rows": F.sum("n").over(whole)}
    )
    reached = [F.min(F.when(F.col("upto") * 4 >= F.col("rows") * k, F.col("bucket"))) for k in (1, 3)]
    return ranked.groupBy(*keys, "rate").agg(
        top_of(reached[0]).alias("low"), top_of(reached[1]).alias("high"), F.max("rows").alias("rows")
    )


def limits(sketched: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """One row for each (lang, source): ``<rate>_min`` and ``<rate>_max``."""
    least = F.create_map(*[F.lit(x) for r in RATES for x in (r.name, r.least)])
    levels = (["lang", "source"], ["lang"], [])

    def fences(keys: list[str]) -> DataFrame:
        found = quartiles(sketched, keys)
        width = F.greatest(F.col("high") - F.col("low"), least[F.col("rate")].cast("long")) * FENCE
        depth = len(keys)
        return found.select(
            *[F.col(k).alias(f"{k}_{depth}") for k in keys],
            F.col("rate").alias(f"rate_{depth}"),
            F.struct(
                F.col("rows"),
                # no rate is below 0
                F.greatest(F.col("low") - width, F.lit(0)).cast("long").alias("min"),
                (F.col("high") + width).cast("long").alias("max"),
            ).alias(f"at_{depth}"),
        )

    by_source, by_lang, everywhere = (fences(keys) for keys in levels)
    joined = by_source.join(
        by_lang,
        F.col("lang_2").eqNullSafe(F.col("lang_1")) & (F.col("rate_2") == F.col("rate_1")),
    ).join(everywhere, F.col("rate_2") == F.col("rate_0"))

    def blended(end: str) -> str:
        of_lang = f"((at_1.rows * at_1.{end} + {prior_rows}L * at_0.{end}) div (at_1.rows + {prior_rows}L))"
        return f"(at_2.rows * at_2.{end} + {prior_rows}L * {of_lang}) div (at_2.rows + {prior_rows}L)"

    ends = ("min", "max")
    rows = joined.select(
        "lang_2", "source_2", F.col("rate_2").alias("rate"), *[F.expr(blended(end)).alias(end) for end in ends]
    )
    return rows.groupBy("lang_2", "source_2").agg(
        *[F.max(F.when(F.col("rate") == r.name, F.col(end))).alias(f"{r.name}_{end}") for r in RATES for end in ends]
    )


def judged(rows: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """Adds ``kept`` to a stored table with the columns of ``measured()``."""
    usable = rows.where(~F.col("base_failed"))
    # small and with a true size once stored, so that Spark can choose the join by it
    fences = materialize(limits(sketch(usable), prior_rows), "limits")
    inside = ~F.col("base_failed")
    for r in RATES:
        inside &= F.col(r.name) <= F.col(f"{r.name}_max")
        if r.both_sides:
            inside &= F.col(r.name) >= F.col(f"{r.name}_min")
    joined = rows.join(
        fences,
        F.col("lang").eqNullSafe(F.col("lang_2")) & F.col("source").eqNullSafe(F.col("source_2")),
        "left",
    )
    return joined.withColumn("kept", F.coalesce(inside, F.lit(False))).select(*rows.columns, "kept")


def judge(docs: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """Base counts, rates, base_failed and kept of every document.

    Null and empty texts have no words and fail.  A null language or source is a group of
    its own.  Repeated rows are judged alike.  An empty table gives no rows.
    """
    return judged(materialize(measured(docs), "measured"), prior_rows)


def keep_good(docs: DataFrame, prior_rows: int = PRIOR_ROWS) -> DataFrame:
    """The documents that pass, with all their columns."""
    stored = materialize(measured(docs, row=F.struct("*")), "measured")
    return judged(stored, prior_rows).where("kept").select("row.*")

"""Secret scan with an incremental ledger of blobs.

A text version is a blob, known by its SHA-256.  The ledger says which rules, in which
version, have read which blob and what they found.  A scan takes each blob once, whatever
the number of rows that hold it, and applies only the rule versions that have not read it
yet; findings then join back to every row of the blob.  A new version of a rule replaces
the findings of the earlier one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, identified, materialize


@dataclass(frozen=True)
class Rule:
    """A pattern whose matches count if they, or one of their groups, are long enough.

    ``hints`` are lower-case byte strings, one of which every match contains in some case;
    ``hex_run`` says that every match contains that many hexadecimal digits in a row.
    """

    kind: str
    version: int
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False
    hints: tuple[bytes, ...] = ()
    hex_run: int = 0

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


BASE = (
    Rule(
        "assign", 1,
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6, group=2, any_case=True,
        hints=(b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 20, hints=(b"akia",)),
    Rule("hex", 1, r"[0-9a-f]+", 24, hex_run=24),
)
MORE = (
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, hints=(b"private key-----",)),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", 0, hints=(b"eyj",)),
    Rule("hosted_token", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, hints=(b"ghp_", b"gho_", b"ghu_", b"ghs_", b"ghr_")),
    Rule("chat_token", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, hints=(b"xox",)),
)
RULES = BASE + MORE

LEDGER = "blob binary, rules array<string>, found array<struct<rule:string,start:long,end:long>>"

_RUNS = bytes(49 if chr(b) in "0123456789abcdef" else 48 for b in range(256))


class Scanner:
    """The rules, compiled once for each task."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = {r.name: (r, re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0))) for r in rules}

    def find(self, text: str, wanted: Sequence[str]) -> list[tuple[str, int, int]]:
        """(rule, start, end) in code points of the matches of the wanted rules."""
        data = text.encode("utf-8", "surrogatepass")
        low, runs = data.lower(), data.translate(_RUNS)
        found = []
        for name in wanted:
            rule, pattern = self.rules[name]
            if rule.hints and not any(h in low for h in rule.hints):
                continue
            if rule.hex_run and b"1" * rule.hex_run not in runs:
                continue
            for m in pattern.finditer(text):
                if len(m.group(rule.group)) >= rule.least:
                    found.append((name, m.start(), m.end()))
        return found


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to blob and packed text."""
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column("text").to_pylist()]
        blobs = pa.array([hashlib.sha256(d).digest() for d in data], pa.binary())
        packed = pa.array([pack.compress(d) for d in data], pa.binary())
        yield pa.RecordBatch.from_arrays([blobs, packed], names=["blob", "packed"])


def _scanned(rules: Sequence[Rule]):
    """(blob, packed, missing) to ledger rows."""
    kind = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, unpack = Scanner(rules), zstandard.ZstdDecompressor()
        for batch in batches:
            found = [
                [
                    {"rule": r, "start": a, "end": b}
                    for r, a, b in scanner.find(unpack.decompress(p).decode("utf-8", "surrogatepass"), missing)
                ]
                for p, missing in zip(batch.column("packed").to_pylist(), batch.column("missing").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("missing"), pa.array(found, kind)], names=["blob", "rules", "found"]
            )

    return run


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def scan(
    docs: DataFrame,
    ledger: DataFrame | None = None,
    rules: Sequence[Rule] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """Findings of every row, and the rows to append to the ledger.

    Findings have tag, id, blob and ``found``: structs of rule, start and end in code
    points, by start and then by the order of ``rules``.  A null text is scanned as the
    empty one, whose row has no findings.  Repeated rows get the same findings; an empty
    table gives none and adds nothing to the ledger.
    """
    spark = docs.sparkSession
    ledger = empty_ledger(spark) if ledger is None else ledger
    names = [r.name for r in rules]
    blob = F.unhex(F.sha2(F.coalesce(docs[text_col], F.lit("")), 256))
    slim = materialize(identified(docs, id=docs[id_col], blob=blob), "blobs")
    # copies meet before the shuffle; what arrives lies by blob, as the ledger does
    texts = docs.select(docs[text_col].alias("text")).mapInArrow(_packed, "blob binary, packed binary")
    texts = texts.groupBy("blob").agg(F.first("packed").alias("packed"))
    done = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))
    wanted = F.array(*[F.lit(n) for n in names])
    missing = F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>")))
    unseen = texts.join(done, "blob", "left").select("blob", "packed", missing.alias("missing"))
    added = unseen.where("size(missing) > 0").mapInArrow(_scanned(rules), LEDGER)
    added = materialize(added, "ledger")
    each = ledger.unionByName(added).select("blob", F.explode("found").alias("one")).where(F.col("one.rule").isin(names))
    position = F.array_position(wanted, F.col("one.rule"))
    in_order = F.sort_array(F.collect_list(F.struct("one.start", position.alias("at"), "one.end", "one.rule")))
    by_blob = materialize(each.groupBy("blob").agg(in_order.alias("found")), "findings")
    hits = attach(slim, by_blob, ["blob"]).select("tag", "found")
    joined = slim.join(hits, "tag", "left")
    found = F.transform("found", lambda f: F.struct(f["rule"].alias("rule"), f["start"].alias("start"), f["end"].alias("end")))
    return joined.withColumn("found", F.coalesce(found, F.array().cast("array<struct<rule:string,start:long,end:long>>"))), added

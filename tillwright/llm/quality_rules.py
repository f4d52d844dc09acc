"""Quality rules as a ledger of bitmasks (operator 6).

Every rule is evaluated once per document. The ledger keeps its measurements and one long whose bit
i says that rule i failed. Policies are sets of rules with a version; they are applied to the stored
bits, and ablations are bitwise aggregates over them, so neither reads a text again.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.common import SPACES, text_or_empty

_CAPITALS = string.ascii_uppercase.encode()
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_shouted",
    "n_bars",
)
MEASURE_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])

Measure = Callable[[str], Column]

# Rules in bit order: a name, and when a document fails, given its measurements.
RULES: tuple[tuple[str, Callable[[Measure], Column]], ...] = (
    ("few_words", lambda m: m("n_words") < 50),
    ("repeated_windows", lambda m: 100 * m("n_repeat_words") > 50 * m("n_words")),
    ("symbols", lambda m: 100 * m("n_symbols") > 10 * m("word_chars")),
    ("duplicate_lines", lambda m: (m("n_lines") >= 4) & (100 * m("n_dup_lines") > 30 * m("n_lines"))),
    ("long_words", lambda m: m("word_chars") > 20 * m("n_words")),
    ("short_words", lambda m: m("word_chars") < 2 * m("n_words")),
    ("capitals", lambda m: 100 * m("n_upper") > 40 * m("word_chars")),
    ("shouting", lambda m: 100 * m("n_shouted") > 30 * m("n_words")),
    ("bars", lambda m: 100 * m("n_bars") > 15 * m("n_words")),
)
BASE_RULES = ("few_words", "repeated_windows")


@dataclass(frozen=True)
class Policy:
    """A version and the rules of which none may fail."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [name for name, _ in RULES]
        return sum(1 << names.index(rule) for rule in set(self.rules))


DEFAULT_POLICY = Policy("1", tuple(name for name, _ in RULES))


def _repeat_words(words: list[str]) -> int:
    """Words that lie in a window of three words which occurs at least twice."""
    if len(words) < 4:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
    _, kinds, counts = np.unique(
        pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True
    )
    again = counts[kinds] > 1
    inside = np.zeros(len(words), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def _measure(text: str) -> tuple[int, ...]:
    raw = text.encode()
    words = raw.split()  # bytes split at exactly the six ASCII white-space characters
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(raw.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">"))),
        len(lines) - len(set(lines)),
        _repeat_words(words),
        len(lines),
        len(raw) - len(raw.translate(None, _CAPITALS)),
        raw.count(b"!! ") + raw.count(b"!!\n"),
        sum(w == b"|" for w in words) if b"|" in raw else 0,
    )


@F.pandas_udf(MEASURE_TYPE)
def measurements(texts: pd.Series) -> pd.DataFrame:
    """The measurements of whole texts, in one pass each; a null text counts as empty."""
    return pd.DataFrame([_measure(text or "") for text in texts], columns=MEASURES, dtype="int64")


def failed_bits(measure: Measure = F.col) -> Column:
    """Bit i is set if rule i fails."""
    bits = F.lit(0).cast("long")
    for bit, (_, fails) in enumerate(RULES):
        bits = bits.bitwiseOR(F.when(fails(measure), F.lit(1 << bit)).otherwise(0).cast("long"))
    return bits


def ledger(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, the measurements, failed_bits.

    A null or empty text has no words and fails ``few_words``. Repeated rows and null ids get a row
    each. Other columns of ``docs`` are not looked at.
    """
    measured = docs.select("doc_id", measurements(text_or_empty()).alias("_m"))
    return measured.select("doc_id", "_m.*").withColumn("failed_bits", failed_bits())


def apply_policy(rows: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Add ``policy`` and ``kept``: no rule of the policy failed."""
    hit = F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    return rows.withColumn("policy", F.lit(policy.version)).withColumn("kept", hit == 0)


def keep_good(docs: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """The rows of ``docs`` that a policy keeps, with the same columns."""
    measured = docs.withColumn("_m", measurements(text_or_empty()))
    hit = failed_bits(lambda name: F.col("_m")[name]).bitwiseAND(F.lit(policy.mask).cast("long"))
    return measured.filter(hit == 0).select(*docs.columns)


def ablations(rows: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: documents it fails, and documents that only it removes.

    The ledger shrinks to its distinct bit patterns first, so one pass serves all rules.
    """
    hit = F.col("failed_bits").bitwiseAND(F.lit(policy.mask).cast("long"))
    patterns = rows.groupBy(hit.alias("bits")).agg(F.count("*").alias("n"))
    names = [name for name, _ in RULES]
    chosen = [(name, 1 << names.index(name)) for name in policy.rules]
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in chosen]))
    pairs = patterns.select("bits", "n", each.alias("r"))
    fails = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return pairs.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(fails, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
    )

"""URL filters (operator 1), built from DataFrame functions only.

A rule is a host pattern and a path prefix, or a free regular expression, each with a literal token.
Rules are indexed by their rarest token. The tokens of a URL fetch candidate rules from the index, and
only those run their regular expression. An index of bounded size (INDEX_BYTES) is one literal of the plan, hashed into
buckets, so a URL is judged within its row: no join and no shuffle, whatever the hosts' skew. A larger one is a
table that the tokens of different URLs are joined with.
"""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
# An index up to this size travels with the plan; a larger one is a table.
INDEX_BYTES = 16 << 20
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TOKEN = r"[a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """``host`` fits itself and its subdomains, ``path`` is a prefix; or ``pattern`` is searched for.

    ``pattern`` is a regular expression over host, ``#`` and path, and must contain one of its ``literals``.
    """

    verdict: str
    host: str = ""
    path: str = "/"
    pattern: str | None = None
    literals: tuple[str, ...] = ()

    @property
    def name(self) -> str:
        return self.host + self.path if self.pattern is None else self.pattern

    @property
    def tokens(self) -> list[str]:
        """Tokens that every URL which the rule fits has."""
        if self.pattern is not None:
            return list(self.literals)
        # A path prefix can end within a token of the URL; its last token counts only if closed.
        whole = self.path if not self.path or not self.path[-1].isalnum() else re.sub(r"[A-Za-z0-9]+\Z", "", self.path)
        return re.findall(_TOKEN, self.host) + re.findall(_TOKEN, whole.lower())

    @property
    def regex(self) -> str:
        """A Java regular expression over host, ``#``, which neither can hold, and path."""
        if self.pattern is not None:
            return self.pattern
        return rf"(?s)\A(?:[^#]*\.)?{_quoted(self.host)}#{_quoted(self.path)}"


def _quoted(text: str) -> str:
    """The text as a part of a Java regular expression."""
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def _word_rule(word: str) -> Rule:
    return Rule(BLOCK, pattern=rf"(?s)\A[^#]*(?<![a-z0-9]){word}(?![a-z0-9])[^#]*#", literals=(word,))


# Verdict of the method where no listed rule fits: hosts with one of these words are blocked.
BLOCKED_HOST_WORDS = ("casino", "cheap", "pills", "porn", "spam", "viagra", "xxx")
METHOD_RULES = tuple(map(_word_rule, BLOCKED_HOST_WORDS))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for null or without ``://``."""
    parts = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url.cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(known, parts, 1), _CAPITALS, _CAPITALS.lower())
    return host, F.regexp_extract(known, parts, 2)


def _tokens(host: Column, path: Column) -> Column:
    lowered = F.translate(F.concat(host, F.lit(" "), path), _CAPITALS, _CAPITALS.lower())
    return F.array_distinct(F.regexp_extract_all(lowered, F.lit(f"({_TOKEN})"), F.lit(1)))


def token_counts(urls: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """How many URLs have each token that occurs in a rule; at most one row per rule token comes back."""
    wanted = sorted({(token,) for rule in rules for token in rule.tokens})
    host, path = host_and_path(F.col("url"))
    each = urls.select(F.explode(_tokens(host, path)).alias("token"))
    known = each.join(urls.sparkSession.createDataFrame(wanted, "token string"), "token", "left_semi")
    return {row["token"]: row["n"] for row in known.groupBy("token").agg(F.count("*").alias("n")).collect()}


_ENTRY = "listed boolean, length int, name string, verdict string, token string, regex string"


def _entries(rules: Sequence[Rule], counts: dict[str, int]) -> list[tuple]:
    """Each rule under its rarest token."""
    rarest = [min(rule.tokens, key=lambda t: (counts.get(t, 0), t)) for rule in rules]
    return [(r.pattern is None, len(r.name), r.name, r.verdict, token, r.regex) for r, token in zip(rules, rarest, strict=True)]


def _index(entries: Sequence[tuple], buckets: int) -> str:
    """JSON of the buckets, each an array of entries."""
    names = [field.split(" ")[0] for field in _ENTRY.split(", ")]
    filled: list[list[dict]] = [[] for _ in range(buckets)]
    for entry in entries:
        filled[_bucket(entry[4], buckets)].append(dict(zip(names, entry, strict=True)))
    return json.dumps(filled)


def _bucket(token: str, buckets: int) -> int:
    """The same number as ``_bucket_of`` gives in Spark: CRC-32 of the token."""
    import zlib

    return zlib.crc32(token.encode()) % buckets


def _bucket_of(token: Column, buckets: int) -> Column:
    return (F.crc32(token.cast("binary")) % buckets).cast("int")


def judge(urls: DataFrame, rules: Sequence[Rule], method_rules: Sequence[Rule] = METHOD_RULES) -> DataFrame:
    """Add host, path, rule and verdict to ``urls`` (which keep their own columns but these four).

    The longest listed rule that fits gives rule and verdict. If none fits, rule is null and the
    verdict is block if a method rule fits, else allow. Of two rules of equal length that fit, the
    greater name wins, then the greater verdict (block). Null urls, urls without ``://`` and empty
    hosts fit no rule. Rows are judged one by one, so repeated rows and null ids are no special case.
    """
    every = [*rules, *method_rules]
    if any(not rule.tokens for rule in every):
        raise ValueError("a rule needs a literal token")
    host, path = host_and_path(F.col("url"))
    kept = [F.col(c) for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    split = urls.select(*kept, host.alias("host"), path.alias("path"))
    if not every:
        return split.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(ALLOW)})
    entries = _entries(every, token_counts(urls, every))
    buckets = 1 << max(0, len(every) - 1).bit_length()
    index = _index(entries, buckets)
    judged = split.withColumn("_best", _best_in_row(index, buckets)) if len(index) <= INDEX_BYTES else _best_by_join(split, entries)
    listed = F.coalesce(F.col("_best.listed"), F.lit(False))
    return judged.select(
        *[F.col(c) for c in split.columns],
        F.when(listed, F.col("_best.name")).alias("rule"),
        F.coalesce(F.col("_best.verdict"), F.lit(ALLOW)).alias("verdict"),
    )


def _subject() -> Column:
    return F.concat(F.col("host"), F.lit("#"), F.col("path"))


def _best_in_row(index: str, buckets: int) -> Column:
    """The greatest entry that fits a row's host and path, out of the index as a literal, which is parsed once."""
    held = F.from_json(F.lit(index), f"array<array<struct<{_ENTRY}>>>")
    candidates = F.flatten(
        F.transform(
            _tokens(F.col("host"), F.col("path")),
            lambda token: F.filter(F.element_at(held, _bucket_of(token, buckets) + 1), lambda r: r["token"] == token),
        )
    )
    subject = _subject()
    return F.array_max(F.filter(candidates, lambda r: F.rlike(subject, r["regex"])))


def _best_by_join(split: DataFrame, entries: Sequence[tuple]) -> DataFrame:
    """The same by joins: tokens of the different (host, path) with the index, and back. Hot hosts are one row each before,
    and Spark splits the URLs of a hot token, as each entry is on the other side.
    """
    spark = split.sparkSession
    index = spark.createDataFrame(list(entries), _ENTRY)
    different = split.select("host", "path").distinct()
    tokens = different.select("*", F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
    fits = tokens.join(index, "token").filter(F.rlike(_subject(), F.col("regex")))
    names = [field.split(" ")[0] for field in _ENTRY.split(", ")]
    best = fits.groupBy("host", "path").agg(F.max(F.struct(*names)).alias("_best"))
    return split.join(best, ["host", "path"], "left").select(*split.columns, "_best")

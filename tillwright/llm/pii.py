"""Personal data in texts (operator 2).

Regular expressions propose spans, checksum validators confirm them, and words near a span move its
score. Four base kinds (email, ip, card, phone) count wherever their pattern and validator agree;
further kinds need a valid checksum or a telling word close by, so that plain numbers stay alone.
All scans are linear in the text: expressions start only where a run of their characters starts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwright.llm.common import text_or_empty

# Kinds in the order in which spans that start together are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "short_card", "local_phone", "id_number", "mac", "ip6")
SPAN_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)

# Words that make a span of a kind likelier when they stand within CONTEXT characters before it.
CONTEXT = 40
CONTEXT_WORDS = {
    "email": ("mail", "contact", "correo", "kontakt"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "short_card": ("card", "visa", "amex", "credit", "karte", "carte", "tarjeta"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "id_number": ("ssn", "social security", "tax id", "passport", "national id", "dni", "steuer"),
    "mac": ("mac",),
    "ip6": ("ip", "ipv6", "host", "server", "address"),
}
# Score of a span that its pattern and validator confirm, without any word of context.
START_SCORE = {
    "email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.7, "iban": 0.9,
    "short_card": 0.3, "local_phone": 0.3, "id_number": 0.5, "mac": 0.6, "ip6": 0.6,
}
CONTEXT_GAIN = 0.3
THRESHOLD = 0.5

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")
_LOCAL_PHONE = re.compile(r"(?<![\w+.-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,5}(?![\w-])")
_ID_NUMBER = re.compile(r"(?<![\w.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_MAC = re.compile(r"(?<![\w:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![\w:-])")
_IP6 = re.compile(r"(?<![\w:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![\w:])")
_DIGIT = re.compile(r"[0-9]")
_TWO_DIGITS = re.compile(r"[0-9][ -]?[0-9]")


def luhn(number: str) -> bool:
    digits = [int(c) for c in number if "0" <= c <= "9"]
    doubled = [d * 2 - 9 if d > 4 else d * 2 for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _count_digits(part: str) -> int:
    return sum("0" <= c <= "9" for c in part)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain, found from each @ outwards."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def _matches(
    pattern: re.Pattern, valid: Callable[[str], bool], needs: Callable[[str], object]
) -> Callable[[str], Iterator[tuple[int, int]]]:
    def find(text: str) -> Iterator[tuple[int, int]]:
        if needs(text):
            yield from (m.span() for m in pattern.finditer(text) if valid(m[0]))

    return find


FINDERS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": _emails,
    "ip": _matches(_IP, lambda s: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split(".")), lambda t: "." in t and _DIGIT.search(t)),
    "card": _matches(_CARD, lambda s: 14 <= _count_digits(s) <= 19 and luhn(s), _TWO_DIGITS.search),
    "phone": _matches(_PHONE, lambda s: 10 <= _count_digits(s) <= 15, lambda t: "+" in t),
    "iban": _matches(_IBAN, mod97, _TWO_DIGITS.search),
    "short_card": _matches(_CARD, lambda s: 12 <= _count_digits(s) <= 13 and luhn(s), _TWO_DIGITS.search),
    "local_phone": _matches(_LOCAL_PHONE, lambda s: 9 <= _count_digits(s) <= 12, _TWO_DIGITS.search),
    "id_number": _matches(_ID_NUMBER, lambda s: s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000", _TWO_DIGITS.search),
    "mac": _matches(_MAC, lambda s: len(set(s)) > 2, lambda t: _DIGIT.search(t) and (":" in t or "-" in t)),
    "ip6": _matches(_IP6, lambda s: True, lambda t: _DIGIT.search(t) and ":" in t),
}

_CONTEXT_PATTERNS = {
    kind: re.compile(r"(?<![^\W_])(?:" + "|".join(map(re.escape, words)) + r")", re.IGNORECASE)
    for kind, words in CONTEXT_WORDS.items()
}


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) by start, then kind; code points, end exclusive.

    Further kinds yield to base spans they overlap, and to the THRESHOLD.
    """
    found: list[tuple[str, int, int, float]] = []
    if "@" not in text and not _DIGIT.search(text):
        return found
    taken: list[tuple[int, int]] = []
    for kind in KINDS:
        for start, end in FINDERS[kind](text):
            near = _CONTEXT_PATTERNS[kind].search(text, max(0, start - CONTEXT), start)
            score = min(1.0, START_SCORE[kind] + (CONTEXT_GAIN if near else 0))
            if kind not in BASE_KINDS and (
                score < THRESHOLD or any(start < e and s < end for s, e in taken)
            ):
                continue
            found.append((kind, start, end, round(score, 2)))
        taken = [span[1:3] for span in found]
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


@F.pandas_udf(SPAN_TYPE)
def spans(texts: pd.Series) -> pd.Series:
    """The spans of whole texts; a null text counts as empty."""
    names = ("kind", "start", "end", "score")
    return pd.Series(
        [[dict(zip(names, span, strict=True)) for span in find_spans(t or "")] for t in texts],
        dtype="object",
    )


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series, found: pd.Series) -> pd.Series:
    def mask(text: str, marks) -> str:
        parts, at = [], 0
        for span in marks:
            if span["start"] >= at:
                parts += [text[at : span["start"]], f"<{span['kind']}>"]
            at = max(at, span["end"])
        return "".join(parts) + text[at:]

    return pd.Series([mask(t or "", s) for t, s in zip(texts, found, strict=True)], dtype="object")


def joined(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """doc_id and ``pii``, the array of spans, for each row of ``docs``.

    Null and empty texts have no spans; repeated rows and null ids get a row each; other columns are
    not looked at.
    """
    return docs.select("doc_id", spans(text_or_empty()).alias("pii"))


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with each span in ``text`` replaced by its kind in angle brackets; null stays null."""
    masked = F.when(F.col("text").isNull(), None).otherwise(_masked(text_or_empty(), spans(text_or_empty())))
    return docs.withColumn("text", masked)


def digest(found: DataFrame) -> DataFrame:
    """Counts and a fingerprint of the base spans, and all spans as text."""
    base = F.filter("pii", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("pii", lambda s: s["kind"])
    counts = [
        (F.size("pii") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("pii")).alias("spans"),
    )

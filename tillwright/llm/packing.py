"""Best-fit packing of tokenized documents into sequences (operator 7).

Documents are tokenized and cut into pieces of at most ``capacity`` tokens. How full a sequence gets
depends on the pieces' lengths alone, and there are at most ``capacity`` of those. So the bin packing
is solved on the histogram of lengths, whose size does not grow with the data. Best fit gives the
incumbent. Where that is above the lower bound, bin completion looks for a packing with one sequence less, again and
again: it fills sequences around the largest length left, tries undominated fillings only, and turns
back where they waste more than is left to waste. The search has a budget (SEARCH_STEPS); when that is
used up, the incumbent stays, and ``gap`` tells how far it may be from the best. Pieces then take their places by their
number within their length, in parallel.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import numbered, shuffle_partitions, slices, stored, text_or_empty

CAPACITY = 2048
END_ID = 0
# Fixed value: how byte-level tokenizers of this kind cut texts before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words whose ids a worker keeps; more are computed anew.
CACHED_WORDS = 400_000
# Of the search for a better packing: lengths tried in all, and in the fillings of one sequence; fillings tried of each.
SEARCH_STEPS, FILLING_STEPS, FILLINGS = 2_000_000, 1_000, 8


# --- tokens ------------------------------------------------------------------


@cache
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def _word_encoder(path: str) -> Callable[[str], list[int]]:
    """Ids of a word, by the same vocabulary in a library that is faster on short strings.

    Only where the vocabulary is a byte-level BPE whose ids follow its merges, which is what that
    library expects; else by the tokenizer itself.
    """
    import tiktoken

    tokenizer = _tokenizer(path)
    model = json.loads(tokenizer.to_str())["model"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", ())]
    ids = [model["vocab"].get("".join(m), -1) for m in merges]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
    if ids != sorted(ids) or -1 in ids or any(c not in model["vocab"] for c in byte_of):
        return lambda word: tokenizer.encode(word, add_special_tokens=False).ids
    ranks = {
        bytes(byte_of[c] for c in token): number
        for token, number in model["vocab"].items()
        if all(c in byte_of for c in token) and (len(token) == 1 or number >= ids[0]) and number <= ids[-1]
    }
    return tiktoken.Encoding(
        "words", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


class _Words(dict):
    """Ids of words as bytes, computed when first asked for."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(word)).tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids


class _Encoder:
    """Ids of texts as the tokenizer gives them, with the ids of words kept.

    A byte-level tokenizer of this kind cuts at white space before it merges, so where every white
    space is one space or newline between two words, the ids of a text are the ids of its words, each
    with the space before it. Any other text goes to the tokenizer whole: one with other white space, or with
    two of these next to each other or at an end.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        encode = _word_encoder(path)
        self.first, self.spaced = _Words(encode), _Words(lambda word: encode(" " + word))
        self.newline = array("I", encode("\n")).tobytes()

    def __call__(self, text: str) -> bytes:
        words = text.split()
        separators = text.count(" ") + text.count("\n")
        # The lengths agree if no other white space is there, the numbers if each separator is alone.
        if words and "<|" not in text and len(words) == separators + 1 and sum(map(len, words)) + separators == len(text):
            first, spaced, lines = self.first, self.spaced.__getitem__, []
            for line in text.split("\n"):
                word, *words = line.split(" ")
                lines.append(first[word] + b"".join(map(spaced, words)))
            return self.newline.join(lines)
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def tokenize(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32 and, if wanted, ids.

    ``ids`` are little-endian unsigned 32-bit numbers as bytes. A document is its ids and END_ID, so
    null and empty texts are one piece of length 1. Documents longer than ``capacity`` are cut into
    pieces of ``capacity``, the first being the shorter one. Repeated rows and null ids are packed as
    documents of their own.
    """
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long"
    end = np.array([END_ID], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _Encoder(tokenizer_path)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]
        for batch in slices(batches):
            rows: list[tuple] = []
            doc_ids = batch.column(0).to_pylist()
            for doc_id, text in zip(doc_ids, batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                total = len(ids) // 4
                at, piece, length = 0, 0, total % capacity or min(capacity, total)
                while at < total:
                    part = ids[4 * at : 4 * (at + length)]
                    rows.append((doc_id, piece, at, length, zlib.crc32(part), *[part] * with_ids))
                    at, piece, length = at + length, piece + 1, capacity
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return source.mapInArrow(cut, kind + ", ids binary" * with_ids)


# --- the plan ----------------------------------------------------------------


@dataclass(frozen=True)
class Filling:
    """So many sequences, each holding ``counts`` pieces of the given lengths, longest first."""

    repeats: int
    counts: tuple[tuple[int, int], ...]


def _best_fit(left: dict[int, int], capacity: int) -> list[Filling]:
    """Best fit decreasing on the histogram: the longest piece that fits, as often as it does."""
    left = {k: n for k, n in left.items() if n}
    lengths = sorted(left)
    plan = []
    while lengths:
        room, counts = capacity, []
        at = len(lengths)
        while room and (at := bisect_right(lengths, room, 0, at)):
            at -= 1
            length = lengths[at]
            n = min(room // length, left[length])
            counts.append((length, n))
            room -= n * length
        repeats = min(left[length] // n for length, n in counts)
        plan.append(Filling(repeats, tuple(counts)))
        for length, n in counts:
            left[length] -= repeats * n
            if not left[length]:
                lengths.remove(length)
    return plan


class _Search:
    """Bin completion on a histogram: a packing into so many sequences, by depth-first branch and bound."""

    def __init__(self, histogram: dict[int, int], capacity: int, steps: int):
        self.histogram, self.capacity, self.steps = histogram, capacity, steps
        # Bit s of sums[length]: whether s is a sum of lengths up to this one, in any number. More sums than
        # the pieces left can make, so what it rules out cannot be.
        whole = (1 << capacity + 1) - 1
        self.sums, reach = {0: 1}, 1
        for length in sorted(histogram):
            step = length
            while step <= capacity and (more := (reach | reach << step) & whole) != reach:
                reach, step = more, step * 2
            self.sums[length] = reach

    def _fillings(self, left: dict[int, int], least_waste: int, most_waste: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
        """(waste, filling as (length, number)) around the largest length left with a waste in bounds, best first.

        A filling is left out if another dominates it: one that has
        a further piece in its waste, or a longer piece in place of one or two of its own, is never worse.
        """
        first = max(length for length, n in left.items() if n)
        own = dict(left)
        own[first] -= 1
        free = sum(1 << length for length, n in own.items() if n)  # bit by length
        found, tried = [], 0
        stack: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(first, self.capacity - first, ())]
        while stack and tried < FILLING_STEPS:
            limit, room, chosen = stack.pop()
            tried += 1
            if least_waste <= room <= most_waste and not self._dominated(own, free, room, chosen):
                found.append((room, chosen))
            length = (free & (1 << min(limit, room) + 1) - 1).bit_length() - 1
            if length <= 0:
                continue
            low = max(0, room - most_waste)
            # No sum of these lengths closes the gap so far that the waste is allowed.
            if not self.sums[length] >> low & (1 << room - low + 1) - 1:
                continue
            # Pushed so that most of the longest comes first.
            for n in range(min(room // length, own[length]) + 1):
                stack.append((length - 1, room - n * length, (*chosen, (length, n)) if n else chosen))
        self.steps -= tried + len(left) // 8  # a look at all lengths costs too
        # Of equal waste the one with the longest pieces: short ones are easier to place later.
        found.sort(key=lambda f: (f[0], [-length for length, n in f[1] for _ in range(n)]))
        out = []
        for waste, chosen in found[:FILLINGS]:
            counts = {first: 1}
            for length, n in chosen:
                counts[length] = counts.get(length, 0) + n
            out.append((waste, tuple(sorted(counts.items(), reverse=True))))
        return out

    @staticmethod
    def _dominated(own: dict[int, int], free: int, waste: int, chosen: tuple[tuple[int, int], ...]) -> bool:
        for length, n in chosen:
            if n == own[length]:
                free &= ~(1 << length)

        def fits(low: int, high: int) -> bool:
            """Whether a piece of a length from low to high is free."""
            return low <= high and bool(free >> low & (1 << high - low + 1) - 1)

        if fits(1, waste):
            return True
        others = [length for length, n in chosen for _ in range(min(n, 2))]
        if any(fits(x + 1, x + waste) for x in set(others)):
            return True
        return any(fits(both, both + waste) for both in {x + y for i, x in enumerate(others) for y in others[i + 1 :]})

    def packed_into(self, sequences: int) -> list[Filling] | None:
        """A plan of at most so many sequences; None if there is none, or none was found within the steps."""
        left = dict(self.histogram)
        spare = sequences * self.capacity - sum(length * n for length, n in left.items())
        if spare < 0:
            return None
        path: list[tuple[int, int, tuple[tuple[int, int], ...]]] = []
        seen: set[int] = set()

        def choices(spare: int) -> Iterator[tuple[int, int, tuple[tuple[int, int], ...]]]:
            low, high, largest = 0, 0, min(spare, self.capacity)
            while low <= largest:
                # Small wastes first, where the sums rule out most; larger ones only when these lead nowhere.
                for waste, filling in self._fillings(left, low, min(high, largest)):
                    most = min(left[i] // n for i, n in filling)
                    if waste:
                        most = min(most, spare // waste)
                    # As often as it goes, or once, after which it may be chosen again or not.
                    for repeats in (most, 1)[: 1 + (most > 1)]:
                        yield repeats, waste, filling
                low, high = high + 1, 2 * high + 1

        stack = [choices(spare)]
        while stack and self.steps > 0:
            choice = next(stack[-1], None)
            if choice is None:
                stack.pop()
                if path:
                    repeats, waste, filling = path.pop()
                    spare += repeats * waste
                    for i, n in filling:
                        left[i] += repeats * n
                continue
            repeats, waste, filling = choice
            path.append(choice)
            spare -= repeats * waste
            for i, n in filling:
                left[i] -= repeats * n
            if not any(left.values()):
                return [Filling(repeats, filling) for repeats, _, filling in path]
            state = hash((spare, *left.values()))
            if state in seen:
                stack.append(iter(()))  # turned back at once
                continue
            seen.add(state)
            stack.append(choices(spare))
        return None


def sequences(plan: list[Filling]) -> int:
    return sum(filling.repeats for filling in plan)


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """No packing has fewer: by the sum of lengths, and with pieces over a half counted (L2)."""
    total = sum(k * n for k, n in histogram.items())
    best = -(-total // capacity)
    for small in (0, *sorted(k for k in histogram if 2 * k <= capacity)):
        large = sum(n for k, n in histogram.items() if k > capacity - small)
        middle = {k: n for k, n in histogram.items() if small <= k <= capacity - small}
        over = {k: n for k, n in middle.items() if 2 * k > capacity}
        free = sum((capacity - k) * n for k, n in over.items())
        rest = sum(k * n for k, n in middle.items() if 2 * k <= capacity) - free
        best = max(best, large + sum(over.values()) + max(0, -(-rest // capacity)))
    return best


def plan_packing(histogram: dict[int, int], capacity: int = CAPACITY, steps: int = SEARCH_STEPS) -> list[Filling]:
    """Best fit, improved by bin completion until the lower bound is met, nothing better exists, or the steps are used up."""
    histogram = {length: n for length, n in histogram.items() if n}
    plan = _best_fit(dict(histogram), capacity)
    least = lower_bound(histogram, capacity)
    if sequences(plan) > least:
        search = _Search(histogram, capacity, steps)
        while sequences(plan) > least and (better := search.packed_into(sequences(plan) - 1)):
            plan = better
    return plan


def gap(histogram: dict[int, int], plan: list[Filling], capacity: int = CAPACITY) -> int:
    """By how many sequences a plan is above the lower bound; a better one need not exist."""
    return sequences(plan) - lower_bound(histogram, capacity)


# --- places ------------------------------------------------------------------


def _places(plan: list[Filling]):
    """For each length, intervals of piece numbers: keys to search, and (base, sequence, offset, n)."""
    seen: dict[int, int] = {}
    rows, sequence = [], 0
    for filling in plan:
        offset = 0
        for length, n in filling.counts:
            start = seen.get(length, 0)
            rows.append(((length << 44) + start, start, sequence, offset, n))
            seen[length] = start + filling.repeats * n
            offset += length * n
        sequence += filling.repeats
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5).T


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (columns length, doc_id, piece, start, ids_crc32 and others).

    Sequences are filled from offset 0 without gaps. Each piece is placed once; an empty table gives
    an empty table. Only the histogram of lengths, ``capacity`` rows at most, reaches the driver.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces, "pieces")
    histogram = {
        row["length"]: row["n"]
        for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    }
    plan = spark.sparkContext.broadcast(_places(plan_packing(histogram, capacity)))
    order = ["doc_id", "piece", "ids_crc32"]
    ranked = numbered(pieces, ["length"], order, F.lit(1), "_number", shuffle_partitions(spark))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        keys, starts, sequence, offsets, each = plan.value
        length, number = lengths.to_numpy(np.int64), numbers.to_numpy(np.int64)
        at = np.searchsorted(keys, (length << 44) + number, side="right") - 1
        turn, slot = np.divmod(number - starts[at], each[at])
        return pd.DataFrame(
            {"sequence_id": sequence[at] + turn, "offset": offsets[at] + slot * length}
        )

    placed = ranked.withColumn("_place", place("length", "_number"))
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    return placed.select(*kept, "_place.sequence_id", "_place.offset")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = True
) -> DataFrame:
    """Tokenize and pack documents: one row per piece with its ids, sequence and offset."""
    return pack(tokenize(docs, tokenizer_path, capacity, with_ids), capacity)

"""Phrases whose words stand together more often than apart, per language (operator 11).

Phrases are counted in HAT-tries: a shallow trie over word ids, whose leaves are hash containers that
burst into a trie node with containers of their own once they hold many entries. Where a task's tries
hold more than a bounded number of entries, whole subtrees, the largest first, leave it as sorted runs.
Runs are cut by prefix partition, and each partition's runs are merged in one place.

Three passes over the texts: words, pairs of frequent words, and longer phrases all of whose pairs are
frequent; a phrase is never more frequent than a part of it, so nothing that could be a candidate is
left out. Which words and pairs are frequent is told to tasks by Bloom filters of bounded size, which
let every frequent one through, and at times another, whose count then falls short. Word ids are
64-bit hashes; that they tell all words apart is checked, and others are taken if they do not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import discard, shuffle_partitions, slices, stored, text_or_empty

MIN_COUNT = 30
MOST_WORDS = 4
FIRST = 2000
CONTAINED_PERCENT = 80
NO_LANGUAGE = "und"

CONTAINER_ENTRIES = 65_536  # more burst it
HELD_ENTRIES = 1_000_000  # of a task's tries; more are spilled
HELD_WORDS = 400_000
RUN_ENTRIES = 32_768
CHUNK_BYTES = 6 << 20
PARTS_A_PARTITION = 2
FILTER_BITS = (1 << 20, 1 << 28)  # least and most

_LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_BREAKS = b".,;:!?\n\x0b\x0c\r"
_CLEAN = bytes.maketrans(_LOWER[0] + _BREAKS + b"\t", _LOWER[1] + b"\n" * len(_BREAKS) + b" ")


# --- words -------------------------------------------------------------------


@dataclass(frozen=True)
class Words:
    """Words in order, as places in a dictionary, and whether each follows the one before in its piece."""

    dictionary: pa.Array
    codes: np.ndarray
    follows: np.ndarray


def _encoded(chunk: bytes, follows: bool) -> tuple[Words, bool]:
    """The words of clean text, whose first may follow a word before it; and whether one behind it may follow its last."""
    data = np.frombuffer(chunk, np.uint8)
    ends_piece = data == 10
    inside = ~(ends_piece | (data == 32))
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside]))]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), buffers).dictionary_encode()
    # Breaks before each word: a word follows if there is none since the word before.
    breaks = np.flatnonzero(ends_piece)
    before = np.searchsorted(breaks, starts)
    same = before == np.concatenate([[0 if follows else -1], before[:-1]])
    open_end = follows and not len(breaks) if not len(starts) else not len(breaks) or bool(breaks[-1] < starts[-1])
    return Words(words.dictionary, words.indices.to_numpy(zero_copy_only=False), same[: len(starts)]), open_end


def _words(texts: list[str]) -> Iterator[Words]:
    """The words of texts, each of which ends a piece, in chunks of bounded bytes cut between words."""
    clean = b"\n".join(text.encode() for text in texts).translate(_CLEAN) + b"\n"
    at, follows = 0, False
    while at < len(clean):
        end = at + CHUNK_BYTES
        if end < len(clean):
            cut = max(clean.rfind(b" ", at, end), clean.rfind(b"\n", at, end))
            # A word longer than a chunk is kept whole.
            ends = [e for e in (clean.find(b" ", end), clean.find(b"\n", end)) if e >= 0]
            end = cut + 1 if cut >= at else min(ends) + 1
        words, follows = _encoded(clean[at:end], follows)
        yield words
        at = end


def word_ids(lang: str, words: pa.Array, seed: int) -> np.ndarray:
    prefix, number = lang.encode() + b"\0", xxhash.xxh3_64_intdigest
    return np.fromiter((number(prefix + word, seed) for word in words.to_pylist()), np.uint64, len(words))


def _keys(ids: np.ndarray) -> pa.Array:
    """Rows of ids as binary, 8 bytes each, which sort as the numbers do."""
    flat, width = ids.astype(">u8").tobytes(), 8 * (ids.shape[1] if ids.ndim > 1 else 1)
    return pa.array([flat[i : i + width] for i in range(0, len(flat), width)], pa.binary())


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), text_or_empty().alias("text"))


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    for batch in slices(batches, CHUNK_BYTES):
        texts: dict[str, list[str]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            texts.setdefault(lang, []).append(text)
        for lang, own in texts.items():
            for words in _words(own):
                yield lang, words


def word_counts(docs: DataFrame, seed: int = 0) -> DataFrame:
    """lang, word (binary), key (its id, 8 bytes), f: how often each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Table]] = {}

        def summed(lang: str) -> pa.Table:
            held[lang] = [pa.concat_tables(held[lang]).group_by("word", use_threads=False).aggregate([("f", "sum")]).rename_columns(["word", "f"])]
            return held[lang][0]

        def spilled() -> Iterator[pa.RecordBatch]:
            for lang in held:
                rows = summed(lang)
                words = rows["word"].combine_chunks().cast(pa.binary())
                columns = [pa.array([lang] * len(words), pa.string()), words, _keys(word_ids(lang, words, seed)), rows["f"].combine_chunks()]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "key", "f"])
            held.clear()

        for lang, words in _by_lang(batches):
            counts = np.bincount(words.codes, minlength=len(words.dictionary))
            held.setdefault(lang, []).append(pa.table({"word": words.dictionary, "f": pa.array(counts, pa.int64())}))
            if sum(len(t) for tables in held.values() for t in tables) > 2 * HELD_WORDS and sum(len(summed(each)) for each in held) > HELD_WORDS:
                yield from spilled()
        yield from spilled()

    each = _source(docs).mapInArrow(run, "lang string, word binary, key binary, f long")
    return each.groupBy("lang", "word", "key").agg(F.sum("f").alias("f"))


def told_apart(words: DataFrame) -> bool:
    """Whether no two words have the same id."""
    return words.groupBy("key").count().filter("count > 1").isEmpty()


# --- filters -----------------------------------------------------------------


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _pair_marks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(a) * np.uint64(3) + b)


@dataclass(frozen=True)
class Filter:
    """A Bloom filter of 64-bit marks with two bits a mark; at most 2**28 bits, whatever it holds."""

    bits: np.ndarray

    @staticmethod
    def _positions(size: int) -> tuple[tuple[int, int], ...]:
        return (0, size - 1), (32, size - 1)

    @staticmethod
    def of(marks: DataFrame) -> Filter:
        """Of a table's ``mark`` column (long)."""
        size = FILTER_BITS[0]
        rows = marks.count()
        while size < min(16 * rows, FILTER_BITS[1]):
            size *= 2
        places = F.array(*[F.shiftrightunsigned("mark", shift).bitwiseAND(F.lit(mask).cast("long")) + 1 for shift, mask in Filter._positions(size)])
        at = marks.select(F.explode(places).alias("_at"))
        parts = at.groupBy(F.bitmap_bucket_number("_at").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("bits"))
        out = np.zeros(size // 8, np.uint8)
        for row in parts.collect():  # 8192 rows of 4 KB at most
            start = (row["part"] - 1) * 4096
            out[start : start + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)[: size // 8 - start]
        return Filter(out)

    def has(self, marks: np.ndarray) -> np.ndarray:
        found = np.ones(len(marks), bool)
        for shift, mask in self._positions(len(self.bits) * 8):
            at = (marks >> np.uint64(shift)) & np.uint64(mask)
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


# --- tries -------------------------------------------------------------------


class _Container:
    """A hash table of phrases (rows of word ids) with counts, open addressing, at most half full."""

    def __init__(self, n: int, size: int = 64):
        self.ids, self.counts, self.entries = np.zeros((size, n), np.uint64), np.zeros(size, np.uint64), 0

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        used = np.flatnonzero(self.counts)
        return self.ids[used], self.counts[used]

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Count phrases that differ from each other."""
        size = len(self.counts)
        while size < 2 * (self.entries + len(ids)):
            size *= 2
        if size > len(self.counts):
            held = self.items()
            self.ids, self.counts, self.entries = np.zeros((size, ids.shape[1]), np.uint64), np.zeros(size, np.uint64), 0
            self._insert(*held)
        self._insert(ids, counts)

    def _insert(self, ids: np.ndarray, counts: np.ndarray) -> None:
        mark, mask = ids[:, 0], np.uint64(len(self.counts) - 1)
        for i in range(1, ids.shape[1]):
            mark = _pair_marks(mark, ids[:, i])
        at, left = (mark & mask).astype(np.int64), np.arange(len(ids))
        while len(left):
            slot = at[left]
            free = self.counts[slot] == 0
            # Where several want the same free slot, the last one gets it.
            self.ids[slot[free]] = ids[left[free]]
            mine = (self.ids[slot] == ids[left]).all(1)
            self.entries += int((mine & free).sum())
            self.counts[slot[mine]] += counts[left[mine]]
            left = left[~mine]
            at[left] = (at[left] + 1) & int(mask)


class _Node:
    """A container, or, once that held many entries, sixteen nodes by the leading digit of the next word's id."""

    def __init__(self, n: int, depth: int):
        self.n, self.depth, self.entries = n, depth, 0
        self.held: _Container | None = _Container(n)
        self.children: dict[int, _Node] = {}

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        if self.held is None:
            digit = (ids[:, self.depth] >> np.uint64(60)).astype(np.uint8)
            for d in np.unique(digit).tolist():
                own = digit == d
                self.children.setdefault(d, _Node(self.n, self.depth + 1)).add(ids[own], counts[own])
            self.entries = sum(child.entries for child in self.children.values())
            return
        self.held.add(ids, counts)
        self.entries = self.held.entries
        if self.entries > CONTAINER_ENTRIES and self.depth < self.n:
            held, self.held = self.held.items(), None
            self.add(*held)

    def items(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.held is not None:
            yield self.held.items()
        for child in self.children.values():
            yield from child.items()


class PhraseTrie:
    """Counts of phrases of n words by their ids; each level of the trie takes the leading digit of one word's id."""

    def __init__(self, n: int):
        self.n, self.root = n, _Node(n, 0)

    @property
    def entries(self) -> int:
        return self.root.entries

    def add(self, ids: np.ndarray, counts: np.ndarray) -> None:
        """Count rows of ``ids`` that differ from each other."""
        if len(ids):
            self.root.add(ids, counts)

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until at most ``keep`` entries are held."""
        root = self.root
        if root.held is not None:
            if root.entries > keep:
                yield root.held.items()
                self.root = _Node(self.n, 0)
            return
        for digit in sorted(root.children, key=lambda d: -root.children[d].entries):
            if root.entries <= keep:
                return
            subtree = root.children.pop(digit)
            root.entries -= subtree.entries
            yield from subtree.items()


def _part_of(ids: np.ndarray, parts: int) -> np.ndarray:
    """The prefix partition of phrases: by their first two words, of four words the first three."""
    mark = _pair_marks(ids[:, 0], ids[:, 1])
    if ids.shape[1] == MOST_WORDS:
        mark = _pair_marks(mark, ids[:, 2])
    return (mark % np.uint64(parts)).astype(np.int32)


_RUN = "n int, part int, ids binary, counts binary"


def _runs(subtrees: Iterator[tuple[np.ndarray, np.ndarray]], n: int, parts: int) -> Iterator[pa.RecordBatch]:
    """The entries of subtrees as sorted runs, each of one prefix partition."""
    taken = list(subtrees)
    ids = np.concatenate([np.zeros((0, n), np.uint64), *[i for i, _ in taken]])
    if not len(ids):
        return
    numbers = np.concatenate([c for _, c in taken])
    part = _part_of(ids, parts)
    order = np.lexsort([*ids.T[::-1], part])
    ids, part, numbers = ids[order], part[order], numbers[order]
    cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    rows = [(a, min(a + RUN_ENTRIES, end)) for start, end in zip(cuts, [*cuts[1:], len(part)], strict=True) for a in range(start, end, RUN_ENTRIES)]
    for at in range(0, len(rows), 1024):
        some = rows[at : at + 1024]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n] * len(some), pa.int32()),
                pa.array([part[a] for a, _ in some], pa.int32()),
                pa.array([np.ascontiguousarray(ids[a:b].T).tobytes() for a, b in some], pa.binary()),
                pa.array([numbers[a:b].tobytes() for a, b in some], pa.binary()),
            ],
            ["n", "part", "ids", "counts"],
        )


def _distinct(codes: np.ndarray, known: int, start: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the phrases of n codes from each of ``start`` on: where each distinct one is first, and how often it is there."""
    code, most = codes[start].astype(np.int64), known
    for i in range(1, n):
        if most * known >= 1 << 62:
            _, code = np.unique(code, return_inverse=True)
            most = len(start)
        code, most = code * known + codes[start + i], most * known
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return start[first], counts


def counted(
    chunks: Iterator[tuple[str, Words]], lengths: tuple[int, ...], seed: int, words: Filter, pairs: Filter | None, parts: int
) -> Iterator[pa.RecordBatch]:
    """Runs of the phrases of some lengths, of words and pairs that the filters let through, in chunks of texts."""
    tries = [PhraseTrie(n) for n in lengths]
    behind = np.zeros(0, np.uint64), np.zeros(0, bool)  # the last words of a text that goes on, and what they follow
    for lang, chunk in chunks:
        own = word_ids(lang, chunk.dictionary, seed)
        may = words.has(own)[chunk.codes]
        codes, known, ids, follows = chunk.codes, len(own), own[chunk.codes], chunk.follows & may
        follows[1:] &= may[:-1]
        old = len(behind[0]) if len(follows) and follows[0] else 0
        if old:
            ids, follows = np.concatenate([behind[0], ids]), np.concatenate([behind[1], follows])
            distinct, codes = np.unique(ids, return_inverse=True)
            follows[old] &= bool(words.has(ids[old - 1 : old])[0])
            known = len(distinct)
        if pairs is not None:
            at = np.flatnonzero(follows[1:])
            follows[at + 1] = pairs.has(_pair_marks(ids[at], ids[at + 1]))
        for trie in tries:
            whole = np.ones(max(0, len(ids) - trie.n + 1), bool)
            for i in range(1, trie.n):
                whole &= follows[i : len(whole) + i]
            start = np.flatnonzero(whole)
            first, counts = _distinct(codes, known, start[start + trie.n > old], trie.n)
            trie.add(np.stack([ids[first + i] for i in range(trie.n)], axis=1), counts.astype(np.uint64))
            if trie.entries > HELD_ENTRIES // len(tries):
                yield from _runs(trie.spill(HELD_ENTRIES // len(tries) // 2), trie.n, parts)
        behind = (ids[1 - MOST_WORDS :], follows[1 - MOST_WORDS :].copy()) if len(chunk.codes) else behind
        if len(behind[1]):
            behind[1][0] = False
    for trie in tries:
        yield from _runs(trie.spill(0), trie.n, parts)


def _phrase_counts(docs: DataFrame, lengths: tuple[int, ...], seed: int, words, pairs, min_count: int) -> DataFrame:
    """n, key (ids, 8 bytes each), mark, f of the phrases that occur ``min_count`` times at least.

    ``words`` and ``pairs`` are broadcast filters of what a phrase may be made of.
    """
    parts = PARTS_A_PARTITION * shuffle_partitions(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted(_by_lang(batches), lengths, seed, words.value, pairs.value if pairs else None, parts)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        at: tuple[int, int] | None = None

        def merged() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            ids = np.concatenate([i for i, _ in held])
            counts = np.concatenate([c for _, c in held])
            held.clear()
            order = np.lexsort(ids.T[::-1])
            ids, counts = ids[order], counts[order]
            starts = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(1)]))
            sums = np.add.reduceat(counts, starts)
            kept = sums >= min_count
            ids, sums = ids[starts[kept]], sums[kept]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), ids.shape[1], np.int32)),
                    _keys(ids),
                    pa.array(_pair_marks(ids[:, 0], ids[:, 1]).view(np.int64)),
                    pa.array(sums.astype(np.int64)),
                ],
                ["n", "key", "mark", "f"],
            )

        for batch in batches:
            for n, part, ids, counts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (n, part) != at:
                    yield from merged()
                    at = n, part
                held.append((np.frombuffer(ids, np.uint64).reshape(n, -1).T, np.frombuffer(counts, np.uint64)))
        yield from merged()

    runs = _source(docs).mapInArrow(count, _RUN)
    tasks = shuffle_partitions(docs.sparkSession)
    dealt = runs.repartitionById(tasks, F.col("part") % tasks).sortWithinPartitions("n", "part")
    return dealt.mapInArrow(merge, "n int, key binary, mark long, f long")


# --- scores ------------------------------------------------------------------


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(38,0)")


def scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """key, n, a, l, r, score of each phrase, at its lowest-scoring cut; ties to the smallest first part."""
    cuts = phrases.select("key", "n", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("n") - 1)).alias("k"))
    left = F.substring(F.col("key"), F.lit(1), 8 * F.col("k"))
    right = F.substring(F.col("key"), 8 * F.col("k") + 1, 8 * (F.col("n") - F.col("k")))
    cuts = cuts.withColumns({"left": left, "right": right})
    of_left = counts.select(F.col("key").alias("left"), F.col("f").alias("l"))
    of_right = counts.select(F.col("key").alias("right"), F.col("f").alias("r"))
    both = cuts.join(of_left, "left").join(of_right, "right").withColumns({"_a": _wide("a"), "_b": _wide("l") + _wide("r")})
    each = both.withColumn("score", F.expr("(cast(2000000 AS decimal(38,0)) * _a) div _b"))
    lowest = each.groupBy("key", "n", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.select("key", "n", "a", "cut.l", "cut.r", "cut.score")


def not_contained(phrases: DataFrame, percent: int = CONTAINED_PERCENT) -> DataFrame:
    """The keys of phrases that stand inside no longer one nearly as often as alone."""
    longer = phrases.filter("n > 2").select("key", "n", "f")
    sized = longer.select("key", "n", "f", F.explode(F.sequence(F.lit(2), F.col("n") - 1)).alias("m"))
    at = sized.select("key", "f", "m", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("m"))).alias("i"))
    inside = at.select(F.substring(F.col("key"), 8 * F.col("i") + 1, 8 * F.col("m")).alias("key"), F.col("f").alias("most"))
    most = inside.groupBy("key").agg(F.max("most").alias("most"))
    gone = phrases.join(most, "key").filter(_wide("most") * 100 >= _wide("f") * percent)
    return phrases.join(gone.select("key"), "key", "left_anti").select("key")


def spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Add lang and phrase (words joined by spaces) to phrases by ``key``."""
    each = phrases.select("key", F.posexplode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i", "_i"))
    each = each.select("key", "i", F.substring(F.col("key"), 8 * F.col("i") + 1, F.lit(8)).alias("word_key"))
    named = each.join(words.select(F.col("key").alias("word_key"), "lang", F.col("word").cast("string").alias("word")), "word_key")
    together = named.groupBy("key").agg(
        F.min("lang").alias("lang"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"),
    )
    return phrases.join(together, "key")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``first`` phrases of 2 to 4 words.

    Null texts are empty, a null language is ``und``. Repeated rows count each time, and doc_id and other columns
    decide nothing. Words are compared by their bytes. Ties of score and count go by the phrase's bytes. A language without a
    phrase has no row.
    """
    spark = docs.sparkSession
    seed, words = 0, stored(word_counts(docs, 0), "words")
    while not told_apart(words):
        discard(words)
        seed += 1
        words = stored(word_counts(docs, seed), "words")
    frequent = stored(words.filter(F.col("f") >= min_count), "frequent")
    totals = stored(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    discard(words)
    number = F.conv(F.hex("key"), 16, -10).cast("long").alias("mark")
    of_words = spark.sparkContext.broadcast(Filter.of(frequent.select(number)))
    pairs = stored(_phrase_counts(docs, (2,), seed, of_words, None, min_count), "pairs")
    of_pairs = spark.sparkContext.broadcast(Filter.of(pairs.select("mark")))
    longer = stored(_phrase_counts(docs, tuple(range(3, MOST_WORDS + 1)), seed, of_words, of_pairs, min_count), "longer")
    phrases = pairs.union(longer)
    counts = frequent.select("key", "f").union(phrases.select("key", "f"))
    best = scored(phrases, counts).join(not_contained(phrases), "key", "left_semi")
    named = spelled(best, frequent).withColumn("_salt", F.pmod(F.xxhash64("key"), F.lit(shuffle_partitions(spark))))
    order = F.desc("score"), F.desc("a"), F.asc("phrase")

    def best_of(rows: DataFrame, *group: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("rank") <= first)

    # A language's phrases are ranked in many parts first, so that the last ranking sees ``first`` of each.
    ranked = best_of(best_of(named, "lang", "_salt"), "lang")
    numbers = [F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    return ranked.drop("n").join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *numbers)

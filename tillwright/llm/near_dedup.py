"""Near duplicates by an LSH forest over MinHash signatures (operator 3).

Documents with the same shingle set form a class first, whatever their number. Each class has a MinHash
signature, and the forest sorts all signatures in several orders. Classes whose signatures share a
prefix in an order stand next to each other there, those with the longest common prefix closest; they are a
region. Candidates are confirmed on their full shingle sets, and confirmed ones get one label.

Each class is first compared with its longest-common-prefix neighbours that have another label, and the best of
all orders is confirmed (NEAR_ROUNDS). So most of a group has few labels before pairs are looked at, and pairs
within a label are never formed. Then all pairs of different labels in regions of up to CROWDED classes are
candidates.

Classes of larger regions with several labels are compared exactly, on their full sets: regions that share a class make a
crowd, whose classes are dealt into blocks of about BLOCK, a large label in blocks of its own. A task takes two
blocks, and gives the links that join labels only, so what is made grows with the blocks, not with the pairs.
Blocks of one label are not compared with each other.

No group is ever gathered: a task holds two blocks, or regions that are bounded.

Which links are found. Two sets of similarity s share the least prefix in one order with probability
s**DEPTH, so at least one of 20 orders shows them with 1 - (1 - s**4)**20: at s = 0.8 that is 0.99997. The
sketch that both must share is the same in all orders; it turns down 8.8e-7 of such pairs. In a
crowd every pair of different labels is compared, so no link is lost there; tests measure the share of links found.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tillwright.llm.common import WORD, discard, shuffle_partitions, slices, stored, text_or_empty
from tillwright.llm.components import components

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80

HASHES = 128
# Depth (least common prefix, in signature values) and number of orders.
LEVELS = ((4, 20),)
KEY_VALUES = 12  # how far orders are sorted
CROWDED = 64
BLOCK = 512  # classes; two blocks are in memory at once
# One bit per signature value; of two sets of similarity 0.8 at least, 0.9 of them agree on average. Fewer
# than this many of 128 do with 8.8e-7, a thirtieth of what the orders miss.
SKETCH_AGREE = 97
NEAR_ROUNDS = 1
FILTER_BITS = 1 << 25
# Sets travel as so many leading bytes of each 64-bit hash.
SET_BYTES = 6
_SEED = 7


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    factor = rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
    return factor, rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _sort_orders(depth: int, orders: int) -> np.ndarray:
    """For each order the signature values that it sorts by, in turn.

    Leading values of different orders are disjoint as long as there are enough of them.
    """
    rng = np.random.default_rng((_SEED, depth))
    out = []
    while len(out) < orders:
        lead = rng.permutation(HASHES)[: HASHES // depth * depth].reshape(-1, depth)
        out += [np.concatenate([row, rng.permutation(np.setdiff1d(np.arange(HASHES), row))[: KEY_VALUES - depth]]) for row in lead]
    return np.array(out[:orders])


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh3_64_intdigest(word)
        if len(self) < 300_000:
            self[word] = number
        return number


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, size: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``size`` words; fewer words make one shingle."""
    words = text.encode().lower().split()  # bytes: only A-Z and ASCII white space count
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(size, len(words))
    mixed = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        mixed = _mixed(mixed * np.uint64(3) + each[i : len(words) - n + 1 + i])
    return np.unique(mixed)


def _set_key(shingles: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None


def _signature(shingles: np.ndarray, factor: np.ndarray, shift: np.ndarray) -> bytes:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 4096):
        part = shingles[start : start + 4096, None] * factor + shift
        least = np.minimum(least, part.min(0))
    return _mixed(least).astype(">u2").tobytes()


def signatures(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the set; null if empty), signature, for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = _constants()
        hashes = _WordHashes()
        for batch in slices(batches):
            sizes, keys, marks = [], [], []
            for text in batch.column(1).to_pylist():
                found = shingle_set(text, shingle_words, hashes)
                sizes.append(len(found))
                keys.append(_set_key(found))
                marks.append(_signature(found, factor, shift) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary())],
                ["doc_id", "n_shingles", "set_key", "signature"],
            )

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return source.mapInArrow(run, "doc_id long, n_shingles long, set_key binary, signature binary")


def _orders(classes: DataFrame, level: int = 0) -> DataFrame:
    """A row per class and order: tree, key (the signature in that order), node, n, label and 128 bits of sketch.

    ``prefix``, the least common prefix, is the region together with ``tree``.
    """
    depth, count = LEVELS[level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = _sort_orders(depth, count)
        for whole in batches:
            # Some thousand classes at a time, as each makes many rows.
            for batch in (whole.slice(at, 2000) for at in range(0, whole.num_rows, 2000)):
                m = batch.num_rows
                marks = np.frombuffer(b"".join(batch.column(3).to_pylist()), ">u2").reshape(m, HASHES)
                bits = np.packbits((marks & 1).astype(np.uint8), axis=1).view(np.int64)
                flat = np.ascontiguousarray(np.stack([marks[:, o] for o in orders])).tobytes()
                width = 2 * KEY_VALUES
                repeated = [np.tile(column, count) for column in (*(batch.column(i).to_numpy() for i in range(3)), bits[:, 0], bits[:, 1])]
                keys = [flat[i * width : (i + 1) * width] for i in range(m * count)]
                trees = pa.array(np.repeat(np.arange(count, dtype=np.int32), m))
                columns = [trees, pa.array(keys, pa.binary()), *map(pa.array, repeated)]
                yield pa.RecordBatch.from_arrays(columns, ["tree", "key", "node", "n", "label", "sketch_0", "sketch_1"])

    rows = classes.select("node", "n_shingles", "label", "signature").mapInArrow(
        run, "tree int, key binary, node long, n long, label long, sketch_0 long, sketch_1 long"
    )
    return rows.withColumn("prefix", F.substring("key", 1, 2 * depth))


class _Sorted:
    """Rows of an order as arrays, with the region of each."""

    def __init__(self, tree, keys, node, n, label, sketch, depth: int):
        self.columns = tree, keys, node, n, label, sketch
        self.tree, self.keys, self.node, self.n, self.label, self.sketch = self.columns
        alike = (tree[1:] == tree[:-1]) & (keys[1:, :depth] == keys[:-1, :depth]).all(1)
        self.region = np.cumsum(np.concatenate([[True], ~alike])) - 1

    def agreement(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many sketch bits of the rows agree; 0 where the sets' sizes rule the pair out."""
        x, y = self.n[i], self.n[j]
        bits = HASHES - np.bitwise_count((self.sketch[i] ^ self.sketch[j]).view(np.uint64)).sum(1).astype(np.int64)
        return np.where((100 * np.minimum(x, y) >= SIMILAR_PERCENT * np.maximum(x, y)) & (bits >= SKETCH_AGREE), bits, 0)

    def others(self) -> tuple[np.ndarray, np.ndarray]:
        """For each row, the last before and the first after it in its region with another label; -1 if there is none."""
        m = len(self.node)
        new_run = np.concatenate([[True], (self.region[1:] != self.region[:-1]) | (self.label[1:] != self.label[:-1])])
        run = np.cumsum(new_run) - 1
        first = np.flatnonzero(new_run)
        last = np.concatenate([first[1:], [m]]) - 1
        before = np.where(run > 0, last[run - 1], -1)
        after = np.where(run < run[-1], first[np.minimum(run + 1, run[-1])], -1)
        before[(before >= 0) & (self.region[before] != self.region)] = -1
        after[(after >= 0) & (self.region[after] != self.region)] = -1
        return before, after

    def nearest(self, fresh: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Pairs (row, other, agreement) of each row with its longest-common-prefix neighbour of another label."""
        best = np.full(len(self.node), -1)
        best_score = np.zeros(len(self.node), np.int64)
        for other in self.others():
            at = np.flatnonzero((other >= 0) & (np.maximum(np.arange(len(other)), other) >= fresh))
            agree = self.agreement(at, other[at])
            at, agree = at[agree > 0], agree[agree > 0]
            common = np.cumprod(self.keys[at] == self.keys[other[at]], axis=1).sum(1)
            score = common * 1000 + agree
            better = score > best_score[at]
            best[at[better]], best_score[at[better]] = other[at[better]], score[better]
        at = np.flatnonzero(best >= 0)
        return [(at, best[at], best_score[at] % 1000)] if len(at) else []

    def within(self, width: int, fresh: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """All pairs of different labels up to ``width`` places apart in a region."""
        found = []
        for step in range(1, min(width, np.bincount(self.region).max() - 1) + 1):
            i = np.flatnonzero((self.region[step:] == self.region[:-step]) & (self.label[step:] != self.label[:-step]))
            i = i[i + step >= fresh]
            agree = self.agreement(i, i + step)
            kept = agree > 0
            if kept.any():
                found.append((i[kept], i[kept] + step, agree[kept]))
        return found

    def tail(self, depth: int) -> _Sorted:
        """What the rows that come next may still have to be compared with."""
        m = len(self.node)
        kept = np.arange(max(0, m - 2 * CROWDED), m)
        before = self.others()[0][m - 1]
        if 0 <= before < kept[0]:
            kept = np.concatenate([[before], kept])
        return _Sorted(*(c[kept] for c in self.columns), depth)


def _met(batches: Iterator[pa.RecordBatch], depth: int, near: bool, width: int) -> Iterator[pa.RecordBatch]:
    """Candidates among sorted rows: with the nearest of another label, or within ``width`` places, or both."""
    tail: _Sorted | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u2").reshape(-1, KEY_VALUES)
        sketch = np.stack([batch.column(5).to_numpy(), batch.column(6).to_numpy()], axis=1)
        columns = (batch.column(0).to_numpy(), keys, *(batch.column(i).to_numpy() for i in (2, 3, 4)), sketch)
        fresh = 0
        if tail is not None:
            fresh = len(tail.node)
            columns = tuple(np.concatenate([old, new]) for old, new in zip(tail.columns, columns, strict=True))
        rows = _Sorted(*columns, depth)
        tail = rows.tail(depth)
        found = (rows.nearest(fresh) if near else []) + (rows.within(width, fresh) if width else [])
        if found:
            i, j, agree = (np.concatenate(c) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(rows.node[i]), pa.array(rows.node[j]), pa.array(agree)], ["node", "other", "agree"])


_PAIR = "node long, other long, agree long"


def _ordered(column: str) -> list[Column]:
    return [F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), F.col(column)]


def nearest_pairs(classes: DataFrame, level: int = 0) -> DataFrame:
    """a, b: of each class the pair with a neighbour of another label that agrees best, over all orders."""
    depth, order = LEVELS[level][0], ["tree", "key", "node"]
    rows = _orders(classes, level).drop("prefix").repartitionByRange(shuffle_partitions(classes.sparkSession), *order)
    met = rows.sortWithinPartitions(*order).mapInArrow(lambda batches: _met(batches, depth, True, 0), _PAIR)
    best = met.filter("node <> other").groupBy("node").agg(F.max(F.struct("agree", "other")).alias("best"))
    return best.select("node", "best.*").select(*_ordered("agree")).select("a", "b").distinct()


def crowded_regions(classes: DataFrame, level: int = 0) -> DataFrame:
    """tree, prefix, mixed of the regions with more than CROWDED classes: whether they have several labels."""
    sizes = _orders(classes, level).groupBy("tree", "prefix").agg(
        F.count("*").alias("size"), (F.min("label") != F.max("label")).alias("mixed")
    )
    return stored(sizes.filter(F.col("size") > CROWDED).select("tree", "prefix", "mixed"), "regions")


def with_crowds(classes: DataFrame, crowded: DataFrame, level: int = 0) -> DataFrame:
    """The rows of the orders with ``mixed``, which is null where the region is not crowded."""
    return _orders(classes, level).join(crowded, ["tree", "prefix"], "left")


def region_pairs(rows: DataFrame, level: int = 0) -> DataFrame:
    """a, b: all pairs of different labels in a region that is not crowded; such a region lies in one task.

    ``rows`` are those of ``with_crowds``.
    """
    partitions, depth = shuffle_partitions(rows.sparkSession), LEVELS[level][0]
    rows = rows.filter("mixed IS NULL").select("tree", "key", "node", "n", "label", "sketch_0", "sketch_1", "prefix")
    dealt = rows.repartition(partitions, "tree", "prefix").sortWithinPartitions("tree", "key", "node").drop("prefix")
    pairs = dealt.mapInArrow(lambda batches: _met(batches, depth, False, CROWDED - 1), _PAIR).filter("node <> other")
    return pairs.select(*_ordered("agree")).select("a", "b").distinct()


def crowds(classes: DataFrame, crowded: DataFrame) -> DataFrame:
    """node, label, crowd of the classes in crowded regions with several labels; regions that share a class are one crowd."""
    inside = _orders(classes).join(crowded.filter("mixed").select("tree", "prefix"), ["tree", "prefix"])
    inside = stored(inside.select("node", "label", F.xxhash64("tree", "prefix").alias("region")), "inside")
    # A region goes by its least class.
    first = inside.groupBy("region").agg(F.min("node").alias("first"))
    found = components(inside.join(first, "region").filter("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b")).distinct())
    members = inside.select("node", "label").distinct().join(found, "node")
    made = stored(members.select("node", "label", F.col("component").alias("crowd")), "crowds")
    discard(inside, found)
    return made


def _blocks(members: DataFrame) -> DataFrame:
    """``crowds`` with ``of`` (a large label, or null for the others) and ``part``, which together are a block."""
    sizes = members.groupBy("crowd", "label").agg(F.count("*").alias("size"))
    large = F.col("size") > BLOCK // 2
    rest = sizes.filter(~large).groupBy("crowd").agg(F.sum("size").alias("others"))
    joined = members.join(sizes, ["crowd", "label"]).join(rest, "crowd", "left")
    parts = F.ceil(F.when(large, F.col("size")).otherwise(F.col("others")) / BLOCK)
    # Small labels lie whole in one block, so that their own pairs are never formed.
    dealt = F.when(large, F.xxhash64("node")).otherwise(F.xxhash64("label"))
    return joined.select("crowd", "node", "label", F.when(large, F.col("label")).alias("of"), F.pmod(dealt, parts).alias("part"))


def _crowd_links(table: pa.Table) -> pa.Table:
    """Links (a, b) of similar sets among two blocks that join their labels: at most one less than there are labels."""
    table = table.sort_by("node")
    nodes, labels, right = (table[name].to_numpy() for name in ("node", "label", "right"))
    sets = [_unpacked(packed) for packed in table["shingles"].to_pylist()]
    sizes = np.array([len(one) for one in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(ids, kind="stable")
    posted, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(ids))])
    at = np.concatenate([[0], np.cumsum(sizes)])
    label_ids = np.unique(labels, return_inverse=True)[1]
    found_a, found_b = [], []
    two = right.any()
    for i in range(len(sets)):
        if two and right[i]:
            continue
        mine = ids[at[i] : at[i + 1]]
        common = np.zeros(len(sets), np.int64)
        for start, end in zip(starts[mine], starts[mine + 1], strict=True):
            common[posted[start:end]] += 1
        similar = 100 * common >= SIMILAR_PERCENT * (sizes[i] + sizes - common)
        for j in np.flatnonzero(similar & (label_ids != label_ids[i]) & (right == two)):
            if label_ids[j] != label_ids[i]:
                found_a.append(nodes[i])
                found_b.append(nodes[j])
                label_ids[label_ids == label_ids[j]] = label_ids[i]
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def crowd_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links that join the labels of ``crowds``, found by comparing all classes of different labels."""
    rows = stored(_blocks(members), "blocks")
    blocks = rows.select("crowd", "of", "part").distinct()
    ends = [blocks.select("crowd", *[F.col(name).alias(f"{name}_{end}") for name in ("of", "part")]) for end in "xy"]
    block = [F.struct(F.col(f"of_{end}"), F.col(f"part_{end}")) for end in "xy"]
    # A block of small labels is compared with itself too, and no two blocks of one large label are.
    apart = F.col("of_x").isNull() | ~F.col("of_x").eqNullSafe(F.col("of_y"))
    both = ends[0].join(ends[1], "crowd").filter((block[0] <= block[1]) & apart).withColumn("pair", F.struct(*block))
    same = block[0] == block[1]
    sides = both.select("crowd", "pair", F.col("of_x").alias("of"), F.col("part_x").alias("part"), F.lit(False).alias("right")).union(
        both.filter(~same).select("crowd", "pair", "of_y", "part_y", F.lit(True))
    )
    sides = sides.select(F.col("crowd").alias("_crowd"), "pair", F.col("of").alias("_of"), F.col("part").alias("_part"), "right")
    alike = (F.col("crowd") == F.col("_crowd")) & F.col("of").eqNullSafe(F.col("_of")) & (F.col("part") == F.col("_part"))
    placed = rows.join(sides, alike).select("_crowd", "pair", "right", "node", "label")
    filled = placed.join(sets, "node").select("_crowd", "pair", "right", "node", "label", "shingles")
    links = filled.groupBy("_crowd", "pair").applyInArrow(_crowd_links, "a long, b long")
    made = stored(links.distinct(), "links")
    discard(rows)
    return made


def _in_filter(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows whose node is in a Bloom filter of ``nodes``, so that few other texts are shuffled.

    The filter has FILTER_BITS bits, whatever the number of nodes: FILTER_BITS / 32768 rows of 4 KB, which
    bounds what is broadcast. It lets every node through, and others the more, the fuller it is.
    """
    at = F.pmod(F.xxhash64("node"), F.lit(FILTER_BITS)) + 1
    bits = nodes.select(at.alias("_at")).groupBy(F.bitmap_bucket_number("_at").alias("_part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_at")).alias("_bits")
    )
    marked = rows.withColumn("_at", at)
    joined = marked.join(F.broadcast(bits), F.bitmap_bucket_number("_at") == F.col("_part"))
    place = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(byte / F.pow(F.lit(2), place % 8)) % 2 == 1
    return joined.filter(is_set).select(*rows.columns)


def _packed(shingles: np.ndarray) -> bytes:
    return shingles.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :SET_BYTES].tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    whole = np.zeros((len(packed) // SET_BYTES, 8), np.uint8)
    whole[:, :SET_BYTES] = np.frombuffer(packed, np.uint8).reshape(-1, SET_BYTES)
    return whole.view(">u8").ravel().astype(np.uint64)


def _sets(docs: DataFrame, nodes: DataFrame, shingle_words: int) -> DataFrame:
    """node, shingles (sorted hashes, SET_BYTES each) of the documents that stand for classes in ``nodes``.

    It may hold other documents too, which the joins that follow leave out. So no text is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in slices(batches):
            sets = [_packed(shingle_set(t, shingle_words, hashes)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    source = docs.select(F.col("doc_id").cast("long").alias("node"), text_or_empty().alias("text"))
    return _in_filter(source, nodes).mapInArrow(run, "node long, shingles binary")


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = _unpacked(x), _unpacked(y)
                small, large = (x, y) if len(x) <= len(y) else (y, x)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                both = int((large[at] == small).sum()) if len(small) else 0
                keep.append(both > 0 and 100 * both >= SIMILAR_PERCENT * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    # Both joins shuffle the sets alike, so the second takes the exchange of the first again.
    with_a = pairs.join(sets, F.col("a") == F.col("node")).select("a", "b", F.col("shingles").alias("x"))
    with_b = with_a.join(sets, F.col("b") == F.col("node")).select("a", "b", "x", F.col("shingles").alias("y"))
    return with_b.mapInArrow(run, "a long, b long")


class _Links:
    """Confirmed links between classes, and the labels that they give."""

    def __init__(self, docs: DataFrame, classes: DataFrame, shingle_words: int):
        self.docs, self.shingle_words = docs, shingle_words
        self.labels = stored(classes.select("node", F.col("node").alias("label")).distinct(), "labels")
        self.sets: list[DataFrame] = []
        self.known: list[DataFrame] = []
        self.tried: list[DataFrame] = []

    def _with_sets(self, nodes: DataFrame) -> DataFrame:
        """Sets of at least the given classes; made for those that had none."""
        if self.known:
            nodes = nodes.join(reduce(DataFrame.union, self.known), "node", "left_anti")
        nodes = stored(nodes, "nodes")
        if not nodes.isEmpty():
            self.sets.append(stored(_sets(self.docs, nodes, self.shingle_words), "sets"))
        self.known.append(nodes)
        return reduce(DataFrame.union, self.sets)

    def add(self, pairs: DataFrame) -> None:
        """Confirm pairs that were not looked at before, and give linked classes one label, the smallest."""
        if self.tried:
            pairs = pairs.join(reduce(DataFrame.union, self.tried), ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        self.tried.append(pairs)
        if pairs.isEmpty():
            return
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        self._label(_confirm(pairs, self._with_sets(nodes)))

    def add_crowds(self, members: DataFrame) -> None:
        """Compare the classes of ``crowds``, and give linked ones one label."""
        if members.isEmpty():
            return
        found = crowd_links(members, self._with_sets(members.select("node")))
        self._label(found)
        discard(found)

    def _label(self, fresh: DataFrame) -> None:
        of = [self.labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}")) for end in "ab"]
        joined = fresh.join(of[0], "a").join(of[1], "b").select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
        found = components(joined)
        renamed = found.select(F.col("node").alias("label"), "component")
        relabelled = self.labels.join(renamed, "label", "left").select("node", F.coalesce("component", "label").alias("label"))
        old, self.labels = self.labels, stored(relabelled, "labels")
        discard(old, found)

    def done(self) -> DataFrame:
        """node, label; what was stored on the way is deleted."""
        discard(*self.sets, *self.known, *self.tried)
        return self.labels


def class_labels(docs: DataFrame, classes: DataFrame, shingle_words: int) -> DataFrame:
    """node, label (the smallest node linked to it) of classes (node, n_shingles, signature)."""
    links, members = _Links(docs, classes, shingle_words), classes.select("node", "n_shingles", "signature")
    for _ in range(NEAR_ROUNDS):
        links.add(nearest_pairs(members.join(links.labels, "node")))
    crowded = crowded_regions(members.join(links.labels, "node"))
    if not crowded.filter("mixed").isEmpty():
        inside = crowds(members.join(links.labels, "node"), crowded)
        links.add_crowds(inside)
        discard(inside)
    links.add(region_pairs(with_crowds(members.join(links.labels, "node"), crowded)))
    discard(crowded)
    return links.done()


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest doc_id reachable), kept.

    Null and empty texts, and texts of white space, have no shingle and are linked with nothing. A class
    of equal sets is one node under its smallest doc_id. Rows that repeat a doc_id are one document: if
    their texts differ, whatever is linked to one is linked to all; all are kept or none. A row without
    an id is linked to the class of its set only, and is kept if no row with an id has that set.
    """
    return _judged(docs, shingle_words).drop("set_key")


def _judged(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``near_duplicates`` with the ``set_key`` of each row."""
    marked = stored(signatures(docs.select("doc_id", "text"), shingle_words), "signatures")
    filled = marked.filter("n_shingles > 0")
    classes = stored(
        filled.groupBy("set_key", "n_shingles", "signature").agg(F.min("doc_id").alias("node")), "classes"
    )
    labels = class_labels(docs, classes.filter("node IS NOT NULL"), shingle_words)
    # Rows of one doc_id with different sets tie their classes together.
    ids = filled.filter("doc_id IS NOT NULL").select("doc_id", "set_key").distinct().groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1")
    several = filled.join(ids, "doc_id", "left_semi").select("doc_id", "set_key").distinct()
    tied = several.join(classes.select("set_key", "node"), "set_key").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    tied = stored(tied.union(labels.select("node", "label").filter("node <> label")), "tied")
    found = components(tied)
    by_set = stored(
        classes.join(found, "node", "left").select("set_key", F.coalesce("component", "node").alias("_class")), "found"
    )
    discard(labels, tied, found, classes)
    rows = marked.join(by_set, "set_key", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("_class")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "set_key"
    )


def drop_near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, with all their columns.

    Rows of one id go or stay together, but for those without a shingle, which stay. Rows without an id
    are judged by their sets, which are made once more for them alone.
    """
    gone = _judged(docs, shingle_words).filter(~F.col("kept"))
    gone = stored(gone.select(F.col("doc_id").alias("_gone"), F.when(F.col("doc_id").isNull(), F.col("set_key")).alias("_gone_set")).distinct(), "dropped")
    same = (F.col("doc_id") == F.col("_gone")) & text_or_empty().rlike(WORD)
    known = docs.filter("doc_id IS NOT NULL").join(gone.filter("_gone IS NOT NULL").select("_gone"), same, "left_anti")
    unknown = docs.filter("doc_id IS NULL").withColumn("_shingled", text_or_empty())
    if unknown.isEmpty():
        return known
    names = [*docs.columns, "_set_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _WordHashes()
        for batch in slices(batches):
            keys = [_set_key(shingle_set(text, shingle_words, hashes)) for text in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(keys, pa.binary())], names)

    keyed = unknown.mapInArrow(run, StructType([*docs.schema.fields, StructField("_set_key", BinaryType())]))
    taken = gone.filter("_gone IS NULL").select("_gone_set")
    return known.unionByName(keyed.join(taken, F.col("_set_key") == F.col("_gone_set"), "left_anti").drop("_set_key"))

"""Mixing sources to target weights (operator 5), with DataFrame functions only.

The words of a source, document after document, are packed into blocks of fixed length. The mix takes
a number of blocks of each source; its slots fall multinomially on the output shards. The i-th slot of
a source takes the block at place i of a pseudorandom permutation of its blocks, a new one for each
time around. Slots and blocks meet in a join on (source, block), whose keys are many however few the
sources are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwright.llm.common import WORD, numbered, shuffle_partitions, stored, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST_EPOCHS = 2
BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
SEED = 17
_ROUNDS = 8


def n_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size, target for a table of (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn. They share ``share`` times all sizes;
    no target passes ``most`` times its source's size, and what is cut goes to the others by weight,
    until none is above. That is the water level: sources whose cap lies lowest against their weight
    fill up first. One row per source is all that is sorted.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("_rank").cast("int") % len(weights) + 1)
    capped = ranked.withColumns({"_weight": weight, "_cap": F.col("source_size") * float(most)})
    by_level = Window.orderBy(F.col("_cap") / F.col("_weight"), "_rank")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = capped.withColumns(
        {
            "_full": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_open": F.sum("_weight").over(by_level.rowsBetween(0, Window.unboundedFollowing)),
            "_total": F.sum("source_size").over(everything) * share,
        }
    )
    levels = levels.withColumn("_level", (F.col("_total") - F.col("_full")) / F.col("_open"))
    # The first source that stays below its cap sets the level for itself and all after it.
    below = F.col("_level") * F.col("_weight") <= F.col("_cap")
    level = F.first(F.when(below, F.col("_level")), ignorenulls=True).over(
        by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.least(F.col("_cap"), F.coalesce(level * F.col("_weight"), F.col("_cap")))
    return levels.select("source", "source_size", target.cast("double").alias("target"))


def permuted(index: Column, size: Column, key: Column) -> Column:
    """A pseudorandom permutation of 0..size-1 per key, by swap-or-not rounds.

    In each round a number and its mirror at a keyed point change places, or not, by a keyed bit. That
    is one to one for every size, so no walk through a larger domain is needed.
    """

    def step(at: Column, turn: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(key, turn), size) - at, size)
        swap = F.xxhash64(key, turn, F.greatest(at, mirror), F.lit(1)).bitwiseAND(F.lit(1).cast("long")) == 1
        return F.when(swap, mirror).otherwise(at)

    return F.aggregate(F.sequence(F.lit(1), F.lit(_ROUNDS)), index, step)


def laid_out(docs: DataFrame, block_words: int = BLOCK_WORDS, more: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Documents with their size and first word's place in their source; and sources with targets.

    Columns of the first: doc_id, source, size, start, and those of ``docs`` in ``more``, which order rows
    of the same doc_id and size. Stored, so that all later steps see the same places.
    """
    source = F.col("source").cast("string").alias("source")
    sized = stored(docs.select("doc_id", source, n_words(text_or_empty()).alias("size"), *more), "sizes")
    totals = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    salts = shuffle_partitions(docs.sparkSession)
    placed = numbered(sized, ["source"], ["doc_id", "size"], F.col("size"), "start", salts, more)
    return stored(placed, "places"), totals


def _blocks(totals: DataFrame, block_words: int) -> DataFrame:
    """Per source: its number of blocks, and how many slots of the mix it fills."""
    n = F.ceil(F.col("source_size") / block_words).cast("long")
    counted = totals.withColumn("blocks", n).filter("blocks > 0")
    slots = F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), F.col("blocks") * MOST_EPOCHS)
    return counted.withColumn("slots", slots.cast("long"))


def mix_slots(totals: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """One row per slot of the mix: source, block, slot, shard.

    Each slot falls on a shard by a hash, so the sources' counts on the shards are multinomial, given
    the totals that the targets fix. Ranges of slots are dealt out first, so a large source is made in
    many tasks.
    """
    run = 4096
    spark = totals.sparkSession
    counted = _blocks(totals, block_words)
    all_slots = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = counted.withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.sum("slots").over(all_slots) / SHARD_SLOTS)))
    runs = counted.filter("slots > 0").withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / run)))
    )
    dealt = runs.repartition(shuffle_partitions(spark), F.xxhash64("source", "_run"))
    last = F.least(F.col("slots"), (F.col("_run") + 1) * run) - 1
    each = dealt.withColumn("slot", F.explode(F.sequence(F.col("_run") * run, last)))
    epoch = F.floor(F.col("slot") / F.col("blocks"))
    key = F.xxhash64(F.lit(seed), F.coalesce("source", F.lit("")), F.col("source").isNull(), epoch)
    keyed = each.withColumns({"_key": key, "_at": F.col("slot") % F.col("blocks")})
    return keyed.select(
        "source",
        permuted(F.col("_at"), F.col("blocks"), F.col("_key")).alias("block"),
        "slot",
        F.pmod(F.xxhash64(F.lit(seed), "source", "slot", F.lit("shard")), F.col("_shards")).alias("shard"),
    )


def mixed_parts(placed: DataFrame, totals: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The part of each document in each block, with how often the mix takes it (0, 1 or 2).

    Columns: those of ``placed``, and from, to (counted from the document's first word), times. Rows of
    size 0 have no part.
    """
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    each = placed.filter("size > 0").withColumn("_block", F.explode(F.sequence(first, last)))
    parts = each.withColumns(
        {
            "from": F.greatest(F.lit(0), F.col("_block") * block_words - F.col("start")),
            "to": F.least(F.col("size"), (F.col("_block") + 1) * block_words - F.col("start")),
        }
    )
    drawn = mix_slots(totals, block_words, seed).groupBy("source", "block").agg(F.count("*").alias("_n"))
    drawn = drawn.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "_n")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b"))
    times = F.coalesce("_n", F.lit(0)).cast("long").alias("times")
    # Spark cannot see that a few sources make many slots, and would send them all to every task.
    return parts.join(drawn.hint("merge"), same, "left").select(*placed.columns, "from", "to", times)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken (words the mix takes).

    No document is taken more than twice, for no block is. A source's words come within about one block
    of its target. Null and empty texts have size 0 and are not taken; a null source is a source of its
    own, behind all others. Repeated rows are laid out as documents of their own, and so are rows
    without an id. Reruns agree, as places depend on ids and sizes alone.
    """
    placed, totals = laid_out(docs, block_words)
    row = ["doc_id", "source", "size", "start"]
    words = (F.col("to") - F.col("from")) * F.col("times")
    taken = mixed_parts(placed, totals, block_words, seed).groupBy(*row).agg(F.sum(words).alias("taken"))
    none = placed.filter("size = 0").select(*row, F.lit(0).cast("long").alias("taken"))
    bounds = totals.select(F.col("source").alias("_s"), "source_size", "target")
    found = taken.unionByName(none).join(bounds, F.col("source").eqNullSafe(F.col("_s")))
    return found.select("doc_id", "size", "source_size", "target", "taken")


_ROW = ("doc_id", "_source", "_sha", "_turn")


def _with_turns(docs: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both with ``_turn``, so that _ROW is the same for a row of ``docs`` and its place, and for no other.

    It is 0 but where several rows have the same id, source and text, which are numbered on either side;
    as their texts are the same, any of them may take any of the places. Only such rows are stored.
    """
    same = list(_ROW[:-1])
    several = placed.groupBy(same).agg(F.count("*").alias("_n")).filter("_n > 1")
    several = stored(several.select(*[F.col(c).alias(f"{c}_2") for c in same]), "repeats")
    first = F.lit(0).cast("long").alias("_turn")
    if several.isEmpty():
        return docs.select("*", first), placed.select("*", first)
    met = F.lit(True)
    for c in same:
        met = met & F.col(c).eqNullSafe(F.col(f"{c}_2"))

    def turned(rows: DataFrame) -> DataFrame:
        again = stored(rows.join(several, met, "left_semi").withColumn("_nth", F.monotonically_increasing_id()), "again")
        numbers = numbered(again, same, ["_nth"], F.lit(1), "_turn", shuffle_partitions(rows.sparkSession)).drop("_nth")
        return rows.join(several, met, "left_anti").select("*", first).unionByName(numbers)

    return turned(docs), turned(placed)


def mix_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = SEED) -> DataFrame:
    """The mix as documents with the columns of ``docs``: ``text`` is what the mix takes of each.

    Parts follow each other as in the document, with the white space before each word; parts taken
    twice follow once more, on a new line. Documents of which nothing is taken are left out, as the
    weights ask. ``n_chars``, if there, is counted anew. Each row has draws of its own, also where rows
    share an id, a text or have no id.
    """
    # 16 bytes tell texts apart.
    sha = F.unhex(F.substring(F.sha2(text_or_empty().cast("binary"), 256), 1, 32))
    keyed = docs.withColumns({"_source": F.col("source").cast("string"), "_sha": sha})
    stored_places, totals = laid_out(keyed, block_words, ("_sha",))
    rows, placed = _with_turns(keyed, stored_places.filter("size > 0").withColumn("_source", F.col("source")))
    # Parts are many, so they carry no more than their row's place, which no other row of the source has; what tells
    # rows apart comes back once a row.
    taken = mixed_parts(placed.select("source", "start", "size"), totals, block_words, seed).filter("times > 0")
    part = F.struct(*[F.col(c).cast("int").alias(c) for c in ("from", "to", "times")])
    of_place = taken.groupBy("source", "start").agg(
        F.array_sort(F.collect_list(part)).alias("_parts"),
        F.sum(F.col("to") - F.col("from")).alias("_covered"),
        F.max("times").alias("_most"),
        F.max("size").alias("_size"),
    )
    of_place = of_place.withColumnsRenamed({"source": "_s", "start": "_at"})
    here = F.col("source").eqNullSafe(F.col("_s")) & (F.col("start") == F.col("_at"))
    draws = placed.select("source", "start", *_ROW).join(of_place.hint("merge"), here)
    draws = draws.select(*[F.col(c).alias(f"{c}_d") for c in _ROW], "_parts", "_covered", "_most", "_size")
    same = F.lit(True)
    for c in _ROW:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_d"))
    joined = rows.join(draws, same)
    pieces = joined.withColumn("_pieces", F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0)))

    def copy(turn: int) -> Column:
        part = F.transform(
            F.filter("_parts", lambda p: p["times"] >= turn),
            lambda p: F.array_join(F.slice("_pieces", (p["from"] + 1).cast("int"), (p["to"] - p["from"]).cast("int")), ""),
        )
        return F.array_join(part, "")

    whole = (F.col("_covered") == F.col("_size")) & (F.col("_most") == 1)
    text = F.when(whole, F.col("text")).when(F.col("_most") == 1, copy(1)).otherwise(F.concat(copy(1), F.lit("\n"), copy(2)))
    mixed = pieces.withColumn("text", text)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*docs.columns)

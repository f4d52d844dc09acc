"""Exact duplicates by content-defined chunk recipes (operator 9).

A text, its white space made even, is cut where its own content says so. Each chunk gets an identifier
that is verified: chunks with the same identifier have been compared by content, in one shuffle of the
distinct chunks. A text is then its recipe, the ordered list of identifiers, and from there on only
recipes move, which are about a hundredth of a long text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import stored, text_or_empty

SPACE_RUN = r"[\x20\x09-\x0D]+"
# A chunk ends after the first space that follows punctuation and has at least MIN_CHUNK characters
# before it; where content gives no such place, after MAX_CHUNK.
MIN_CHUNK, MAX_CHUNK = 512, 8192
_CHUNK = rf"(?s).{{{MIN_CHUNK},{MAX_CHUNK}}}?(?<=[.,;:!?] )|.{{1,{MAX_CHUNK}}}"

# Identifiers, in the order in which they are tried. The last is the content, which needs no check.
DIGESTS: tuple[Callable[[Column], Column], ...] = (
    lambda chunk: F.md5(chunk.cast("binary")),
    lambda chunk: F.sha2(chunk.cast("binary"), 256),
    lambda chunk: F.base64(chunk.cast("binary")),
)


def normalized(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, SPACE_RUN, " ")


def _chunks(docs: DataFrame) -> DataFrame:
    known = docs.withColumn("_normal", normalized(text_or_empty()))
    return known.withColumn("_chunks", F.regexp_extract_all("_normal", F.lit(_CHUNK), F.lit(0)))


def collisions(docs: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    """Identifiers that stand for chunks of different content. Copies of a chunk meet before the shuffle."""
    each = _chunks(docs.select("text")).select(F.explode(F.array_distinct("_chunks")).alias("chunk"))
    contents = each.select(digest(F.col("chunk")).alias("id"), "chunk").groupBy("id", "chunk").count()
    return contents.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")


def verified_digest(docs: DataFrame) -> Callable[[Column], Column]:
    """The first kind of identifier that no two different chunks of these documents share."""
    for digest in DIGESTS[:-1]:
        if collisions(docs, digest).isEmpty():
            return digest
    return DIGESTS[-1]


def with_recipe(docs: DataFrame) -> DataFrame:
    """Add ``_recipe`` (identifiers joined by commas) and ``_normal`` to ``docs``."""
    digest = verified_digest(docs)
    return _chunks(docs).withColumn("_recipe", F.array_join(F.transform("_chunks", digest), ",")).drop("_chunks")


def groups(recipes: DataFrame) -> DataFrame:
    """Recipes that several rows have, with their number and smallest doc_id. Pre-aggregated."""
    counted = recipes.groupBy("_recipe").agg(F.count("*").alias("_size"), F.min("doc_id").alias("_keep"))
    return counted.filter(F.col("_size") > 1)


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and all empty texts are equal. Rows that repeat the smallest doc_id of
    their group all stay, as they are one document. Null ids are larger than any other: a group without
    an id has a null keep_id and stays. Other columns are not looked at.
    """
    known = with_recipe(docs.select("doc_id", "text"))
    recipes = stored(
        known.select("doc_id", "_recipe", F.sha2(F.col("_normal").cast("binary"), 256).alias("text_sha256")),
        "recipes",
    )
    several = stored(groups(recipes), "copies")
    found = recipes.join(several, "_recipe", "left")
    keep = F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_keep"))
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that ``exact_duplicates`` keeps, with all their columns; one of each doc_id and text.

    The verdict is of a doc_id and a text, so another text of the same id, or another row without an
    id, is not touched. Only keys are joined with the documents. Of rows that repeat both, one stays,
    also where they have no id.
    """
    found = exact_duplicates(docs).withColumnsRenamed({"doc_id": "_id", "text_sha256": "_sha"})
    counted = found.groupBy("_id", "_sha").agg(F.first("kept").alias("_kept"), F.count("*").alias("_n"))
    marked = stored(counted.filter("NOT _kept OR _n > 1"), "marked")
    sha = F.sha2(normalized(text_or_empty()).cast("binary"), 256)
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (sha == F.col("_sha"))
    left = docs.join(marked, same, "left_anti")
    several = marked.filter("_kept")
    if several.isEmpty():
        return left
    row = F.struct(*docs.columns)
    repeated = docs.join(several, same).groupBy("_id", "_sha").agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return left.unionByName(repeated.select("_row.*"))

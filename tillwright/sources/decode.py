"""From raw records to typed transactions; the same steps for tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.functions.measures import line_value, parsed_time
from tillwright.schema import EVENT_TIME_FORMAT, RECORD_DDL


def decode_value(raw: DataFrame) -> DataFrame:
    """The record bytes as text, one column ``json``."""
    return raw.select(F.col("value").cast("string").alias("json"))


# Where the text of a damaged record goes.
DAMAGED = "damaged_record"


def parse_json(texts: DataFrame, damaged: bool = False) -> DataFrame:
    """The fixed record schema as struct ``data``. Text that is no record becomes nulls, not an error.

    With ``damaged``, the struct also has the raw text of each record that is no JSON object or has a
    field of a wrong type, as ``damaged_record``; the fields that could be read are kept beside it. It comes from the same
    parse. Columns other than ``json`` are carried along then.
    """
    if not damaged:
        return texts.select(F.from_json("json", RECORD_DDL).alias("data"))
    data = F.from_json("json", f"{RECORD_DDL}, `{DAMAGED}` string", {"columnNameOfCorruptRecord": DAMAGED})
    return texts.withColumn("data", data)


def flatten_payload(parsed: DataFrame) -> DataFrame:
    """The record fields as columns. Every input row is kept.

    With ``damaged_record`` if it was asked for: an empty text, which parses to nothing, is damaged too.
    """
    if DAMAGED not in parsed.schema["data"].dataType.names:
        return parsed.select("data.*")
    text = F.coalesce(f"data.{DAMAGED}", F.when(F.col("data").isNull(), F.col("json")))
    carried = [name for name in parsed.columns if name not in ("data", "json")]
    return parsed.select("data.*", text.alias("_text"), *carried).drop(DAMAGED).withColumnRenamed("_text", DAMAGED)


def derive(records: DataFrame, event_time_format: str = EVENT_TIME_FORMAT) -> DataFrame:
    """Add ``event_time`` and ``transaction_value``; each is null where its inputs do not allow one."""
    return records.withColumns(
        {
            "event_time": parsed_time("timestamp", event_time_format),
            "transaction_value": line_value(),
        }
    )


# Where a record was read, for the ledger.
PLACE = ("_source", "_partition", "_offset")


def with_place(raw: DataFrame) -> DataFrame:
    """Add where each record was read: topic, partition and offset, or the file.

    The records of a file have no offset; they are counted.
    """
    if "offset" in raw.columns:
        place = [F.col(name) for name in ("topic", "partition", "offset")]
    else:
        place = [F.col("_metadata.file_path"), F.lit(0), F.lit(None)]
    types = ("string", "int", "long")
    return raw.withColumns({name: c.cast(kind) for name, c, kind in zip(PLACE, place, types, strict=True)})


def decode_transactions(
    raw: DataFrame, event_time_format: str = EVENT_TIME_FORMAT, damaged: bool = False
) -> DataFrame:
    """Raw ``value`` records to transactions, stamped with the time they were processed.

    With ``damaged``, the text of damaged records is kept in ``damaged_record``. The columns of
    ``with_place`` are kept if they are there.
    """
    place = [name for name in PLACE if name in raw.columns]
    if damaged or place:
        texts = raw.select(F.col("value").cast("string").alias("json"), *place)
        records = flatten_payload(parse_json(texts, damaged=True))
        records = records if damaged else records.drop(DAMAGED)
    else:
        records = flatten_payload(parse_json(decode_value(raw)))
    return derive(records, event_time_format).withColumn("processed_at", F.current_timestamp())

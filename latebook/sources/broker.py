"""Messages of a broker: connection options, payload decoding, dead letters, gaps in offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Offsets that are counted together when gaps are looked for.
BLOCK = 1 << 20
_PLACE = ("topic", "partition", "offset")
_CORRUPT = "_corrupt"


def kafka_options(servers: str, topic: str, *, starting_offsets: str, fail_on_data_loss: bool,
                  max_offsets: int = 10000) -> dict[str, str]:
    """Where to start, and whether lost messages stop the stream, must be said: ``latest`` leaves
    out what is there already, and going on after a loss hides it."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def read_topic(spark: SparkSession, servers: str, topic: str, *, starting_offsets: str,
               fail_on_data_loss: bool, max_offsets: int = 10000) -> DataFrame:
    """A topic as a stream; needs Spark's Kafka connector on the class path."""
    options = kafka_options(servers, topic, starting_offsets=starting_offsets,
                            fail_on_data_loss=fail_on_data_loss, max_offsets=max_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def parsed_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages with ``data``, their payload's fields, and ``readable``: the payload is one
    JSON object whose fields fit the schema."""
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    text = F.col("value").cast("string")
    data = F.from_json(text, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    held = messages.withColumn("data", data)
    return held.withColumn("readable", F.coalesce(
        F.col(f"data.{_CORRUPT}").isNull() & F.col("data").isNotNull()
        & F.startswith(F.ltrim(text), F.lit("{")), F.lit(False)))


def decode_messages(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Payload fields of readable messages next to the broker's time."""
    return (parsed_messages(messages, schema).filter("readable")
            .select(*[F.col(f"data.{c}").alias(c) for c in schema.names],
                    F.col("timestamp").alias("kafka_timestamp")))


def dead_letters(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """The messages that ``decode_messages`` leaves out: where they stood, when, and their bytes.

    Together the two hold every message once. Messages without a place have a null one.
    """
    place: list[Column] = [F.col(c) if c in messages.columns else F.lit(None).alias(c)
                           for c in _PLACE]
    return parsed_messages(messages, schema).filter(~F.col("readable")).select(
        *place, F.col("timestamp").alias("kafka_timestamp"), "value",
        F.when(F.col("value").isNull(), "Mensagem vazia").otherwise("Mensagem ilegível")
        .alias("error_message"))


def offset_gaps(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """``topic, partition, first_missing, last_missing`` of the offsets between a partition's first
    and last message that no message has.

    Each block of offsets is counted first, which shows where any are missing; only the messages of
    such blocks are put in order, so that a partition of any length is no task's burden. Messages
    read twice count once.
    """
    places = messages.select(*_PLACE).withColumn("block", F.floor(F.col("offset") / block))
    counted = places.distinct().groupBy("topic", "partition", "block").agg(
        F.min("offset").alias("low"), F.max("offset").alias("high"), F.count("*").alias("n"))
    of_partition = Window.partitionBy("topic", "partition").orderBy("block")  # one row a block
    between = counted.withColumn("after", F.lead("low").over(of_partition)).filter(
        F.col("after") > F.col("high") + 1).select(
        "topic", "partition", (F.col("high") + 1).alias("first_missing"),
        (F.col("after") - 1).alias("last_missing"))
    holes = counted.filter(F.col("high") - F.col("low") + 1 > F.col("n")).select(
        "topic", "partition", "block")
    in_block = Window.partitionBy("topic", "partition", "block").orderBy("offset")
    inside = (places.distinct().join(holes, ["topic", "partition", "block"], "left_semi")
              .withColumn("next", F.lead("offset").over(in_block))
              .filter(F.col("next") > F.col("offset") + 1)
              .select("topic", "partition", (F.col("offset") + 1).alias("first_missing"),
                      (F.col("next") - 1).alias("last_missing")))
    return between.union(inside)

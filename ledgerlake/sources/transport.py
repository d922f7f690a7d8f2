"""Message transports and payload decoding.

A transport yields ``key string, value string`` rows. ``kafka`` is the
production transport (needs the spark-sql-kafka package on the classpath);
``file`` reads JSON-lines folders of the same two columns and is what the
tests drive. Decoding is identical for both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.config import PAYMENT_SCHEMA, RAW_MESSAGE_SCHEMA, RAW_TOPIC


def read_raw_stream(
    spark: SparkSession,
    transport: str = "kafka",
    *,
    path: str | None = None,
    bootstrap: str | None = None,
    topic: str = RAW_TOPIC,
    starting_offsets: str = "earliest",
    max_files_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    options: dict | None = None,
) -> DataFrame:
    """Streaming source of raw payment messages.

    ``fail_on_data_loss=False`` skips offsets that have expired; by default
    the query fails, so that no message is lost unseen.
    """
    if transport == "kafka":
        chosen = kafka_options(bootstrap, topic, starting_offsets, fail_on_data_loss) | (options or {})
        reader = spark.readStream.format("kafka").options(**chosen)
        return reader.load().selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
    if transport == "file":
        reader = spark.readStream.schema(RAW_MESSAGE_SCHEMA)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.json(path)
    raise ValueError(f"unknown transport {transport!r}")


def kafka_options(
    bootstrap: str | None, topic: str, starting_offsets: str = "earliest", fail_on_data_loss: bool = True
) -> dict[str, str]:
    """Options of the Kafka stream source."""
    # The connector's option names.
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }


def read_raw_batch(
    spark: SparkSession,
    transport: str = "kafka",
    *,
    path: str | None = None,
    bootstrap: str | None = None,
    topic: str = RAW_TOPIC,
) -> DataFrame:
    """Batch read of a whole topic / message folder (from the earliest offset)."""
    if transport == "kafka":
        return (
            spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .load()
            .selectExpr("topic", "CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value")
        )
    if transport == "file":
        return spark.read.schema(RAW_MESSAGE_SCHEMA).json(path).withColumn("topic", F.lit(topic))
    raise ValueError(f"unknown transport {transport!r}")


#: Column of the faults of a message: (field, the value it came with); field "message": no JSON object at all.
FAULTS = "decode_faults"
FAULTS_TYPE = "array<struct<field: string, value: string>>"
WHOLE_MESSAGE = "message"


def decode_payload(raw: DataFrame, keep_raw: bool = True, faults: bool = False) -> DataFrame:
    """JSON value -> payment columns (PERMISSIVE).

    Malformed JSON gives an all-null payment, a wrongly typed field gives a
    null field, unknown fields are ignored. ``raw_value`` keeps the payload so
    that a structurally bad message is not lost in the dead letter.

    ``faults`` adds ``decode_faults``: a message that is not a JSON object
    (or null), and every field that came with a value which its type cannot
    hold. A field that is absent or null has no fault.
    """
    permissive = {"mode": "PERMISSIVE"}
    # Columns of their own, so that each message is parsed once whatever is read of it later.
    parsed = {"_typed": F.from_json("value", PAYMENT_SCHEMA, permissive)}
    if faults:
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in PAYMENT_SCHEMA.fields])
        texts = texts.add(CORRUPT, T.StringType())
        parsed["_texts"] = F.from_json("value", texts, permissive | {"columnNameOfCorruptRecord": CORRUPT})
    cols = [F.col(f"_typed.{f.name}").alias(f.name) for f in PAYMENT_SCHEMA.fields]
    if keep_raw:
        cols.append(F.col("value").alias("raw_value"))
    if faults:
        cols.append(_faults(F.col("value"), F.col("_typed"), F.col("_texts")).alias(FAULTS))
    return raw.withColumns(parsed).select(*cols)


CORRUPT = "_corrupt"


def _faults(value: Column, typed: Column, texts: Column) -> Column:
    """Every field read as text beside its own type: text without a typed value is a fault."""

    def fault(field: str, text: Column) -> Column:
        return F.struct(F.lit(field).alias("field"), text.alias("value"))

    whole = texts.isNull() | texts[CORRUPT].isNotNull()
    found = [
        F.when(~whole & texts[f.name].isNotNull() & typed[f.name].isNull(), fault(f.name, texts[f.name]))
        for f in PAYMENT_SCHEMA.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return F.array_compact(F.array(F.when(whole, fault(WHOLE_MESSAGE, value)), *found)).cast(FAULTS_TYPE)

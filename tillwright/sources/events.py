"""Shop events as a stream with a ``value`` column, the message text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# How the broker is reached.
SECURITY = {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"}
LOGIN_MODULE = "org.apache.kafka.common.security.plain.PlainLoginModule"


def kafka_options(
    servers: str,
    topic: str,
    user: str | None = None,
    secret: str | None = None,
    starting: str = "earliest",
    most_per_trigger: int | None = None,
) -> dict[str, str]:
    """Reader options for one topic; with ``user``, over SASL.

    ``most_per_trigger`` bounds the first batches when a query starts on a long log.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if user is not None:
        login = f'{LOGIN_MODULE} required username="{user}" password="{secret}";'
        options |= {**SECURITY, "kafka.sasl.jaas.config": login}
    if most_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(most_per_trigger)
    return options


def event_source(spark: SparkSession, kind: str, **options: str) -> DataFrame:
    """Stream of messages: ``kafka`` from a topic, ``parquet`` or ``text`` from files in ``path``."""
    reader = spark.readStream.format(kind)
    if kind != "kafka":
        path = options.pop("path")
        return reader.schema("value string").options(**options).load(path)
    return reader.options(**options).load().select("value")

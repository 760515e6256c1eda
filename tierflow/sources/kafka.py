"""Options of Kafka and Event Hubs scans. The connector itself comes with the cluster's jars."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Secrets = Callable[[str, str], str]

# Reader options that steer decoding and must not reach the connector.
PRIVATE_OPTIONS = ("custom_decode_fo", "custom_decode_pmu", "custom_decode_trasaction_type", "decode_headers")
_BASE = ("kafka.bootstrap.servers", "subscribe", "kafka.security.protocol")
_STORES = ("truststore", "keystore")

RECORD_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, "
    "headers array<struct<key: string, value: binary>>"
)


def kafka_options(details: dict[str, str], reader: dict[str, str] | None, secrets: Secrets | None = None) -> dict:
    """Connector options of a Kafka source; reader options win over the source's own."""
    options = {k: details.get(k) for k in _BASE}
    places = {s: details.get(f"kafka.ssl.{s}.location") for s in _STORES}
    if all(places.values()):
        needed = [f"kafka.ssl.{s}.secrets.{part}" for s in _STORES for part in ("scope", "key")]
        missing = [n for n in needed if not details.get(n)]
        if missing or secrets is None:
            raise ValueError(f"a TLS source needs {needed} and a secret resolver; missing: {missing}")
        for s in _STORES:
            scope, key = details[f"kafka.ssl.{s}.secrets.scope"], details[f"kafka.ssl.{s}.secrets.key"]
            options[f"kafka.ssl.{s}.location"] = places[s]
            options[f"kafka.ssl.{s}.password"] = secrets(scope, key)
    merged = {**options, **(reader or {})}
    return {k: v for k, v in merged.items() if v is not None}


def eventhub_options(details: dict[str, str], reader: dict[str, str] | None, secrets: Secrets) -> dict:
    """Event Hubs through its Kafka endpoint; the secret's name defaults to the access key's name."""
    namespace, key_name = details["eventhub.namespace"], details["eventhub.accessKeyName"]
    host = f"{namespace}.servicebus.windows.net"
    secret = secrets(details["eventhub.secretsScopeName"], details.get("eventhub.accessKeySecretName") or key_name)
    connection = f"Endpoint=sb://{host}/;SharedAccessKeyName={key_name};SharedAccessKey={secret}"
    login = "org.apache.kafka.common.security.plain.PlainLoginModule"
    options = {
        "kafka.bootstrap.servers": f"{host}:{details['eventhub.port']}",
        "subscribe": details["eventhub.name"],
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.jaas.config": f'{login} required username="$ConnectionString" password="{connection}";',
    }
    return {**options, **(reader or {})}


def connector_options(options: dict[str, str]) -> dict[str, str]:
    return {k: v for k, v in options.items() if k not in PRIVATE_OPTIONS}


def message_kind(options: dict[str, str]) -> str | None:
    """Which known message kind the reader options ask to decode, if any."""
    flags = (options.get("custom_decode_fo"), options.get("custom_decode_pmu"))
    return options.get("custom_decode_trasaction_type") if "true" in flags else None


def read_kafka(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**{"includeHeaders": "true", **connector_options(options)}).load()

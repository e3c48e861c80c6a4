"""Record transforms: names of records, fields and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidefeed.functions import columns as fn


def lower_case_all(records: DataFrame, schema_name: str | None) -> tuple[DataFrame, str | None]:
    """The records with lower-case top-level field names, and the lower-case schema name.

    Nothing changes if the records have no schema name or its letters are small already, even if
    fields' aren't. Names that fall together are an error.
    """
    if schema_name is None or schema_name == schema_name.lower():
        return records, schema_name
    names = [c.lower() for c in records.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"fields of {schema_name} fall together")
    return records.toDF(*names), schema_name.lower()


class TopicRePrefix:
    """Topics by the last part of their name, under a prefix that has to be given."""

    def __init__(self, prefix: str | None):
        if not prefix:
            raise ValueError("a prefix is required")
        self.prefix = prefix

    def __call__(self, records: DataFrame, topic: str = "topic") -> DataFrame:
        return records.withColumn(topic, fn.topic_of_table(records[topic], self.prefix))

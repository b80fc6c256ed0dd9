"""Sources: raw record schema, decode, the fixture feed and Kafka/file readers."""

from labwire.sources.records import RAW_SCHEMA, RAW_COLUMNS, ARRIVAL, decode
from labwire.sources.fixtures import lab_order_records, records_from_dir, read_tables

__all__ = ["RAW_SCHEMA", "RAW_COLUMNS", "ARRIVAL", "decode", "lab_order_records",
           "records_from_dir", "read_tables"]

"""daybridge: daily ingestion of nested JSON and next-event analytics on Spark.

Every operator takes and returns a DataFrame and is built from Spark's own
expressions, joins, windows and writers.
"""

from daybridge.operators.flatten import flatten
from daybridge.operators.next_event import add_next_event
from daybridge.operators.project import ColumnSpec, project_typed
from daybridge.operators.utc import add_utc_time
from daybridge.plans.daily import BridgeSpec, bridge_next_event, bulk_bridge, bulk_load, load_day
from daybridge.plans.flight_load import IngestConfig, UtcSpec, prepare_batch, process_file
from daybridge.sources.json_source import ingest_json, read_json
from daybridge.sources.tables import column_comments, overwrite_partitions, table_exists
from daybridge.sources.zones import read_zones

__version__ = "0.1.0"

__all__ = [
    "BridgeSpec",
    "ColumnSpec",
    "IngestConfig",
    "UtcSpec",
    "add_next_event",
    "add_utc_time",
    "bridge_next_event",
    "bulk_bridge",
    "bulk_load",
    "column_comments",
    "flatten",
    "ingest_json",
    "load_day",
    "overwrite_partitions",
    "prepare_batch",
    "process_file",
    "project_typed",
    "read_json",
    "read_zones",
    "table_exists",
]

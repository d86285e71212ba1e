"""Sources (event tables, adapter) and sinks (fact table, TSV, report rows)."""

from cohortia.sources.events import feed_actions, load_events, message_actions, orders_activity
from cohortia.sources.tables import preview, read_jdbc, read_parquet, read_table

__all__ = ["feed_actions", "message_actions", "load_events", "orders_activity",
           "read_parquet", "read_table", "read_jdbc", "preview"]

"""Sources and sinks."""

from .event_csv import read_event_csv
from .raw_csv import read_crm_csv, read_whatsapp_csv
from .tables import (
    append_daily,
    append_table,
    drop_expired_partitions,
    partition_dates,
    replace_dates,
    replace_mart,
    replace_table,
)

__all__ = [
    "append_daily",
    "append_table",
    "drop_expired_partitions",
    "partition_dates",
    "read_crm_csv",
    "read_event_csv",
    "read_whatsapp_csv",
    "replace_dates",
    "replace_mart",
    "replace_table",
]

from goldweave.sources.lookup import LookupFailed, job_frequency, lookup_one, property_is_on
from goldweave.sources.snapshot import (
    AlreadyCommitted,
    Layout,
    Store,
    append_rejects,
    publish,
    publish_touched,
)
from goldweave.sources.tables import (
    deleted_rows,
    flag_rows,
    of_source,
    read_changes,
    read_feed,
    read_table,
    source_count,
)

__all__ = [
    "AlreadyCommitted",
    "Layout",
    "LookupFailed",
    "Store",
    "append_rejects",
    "deleted_rows",
    "flag_rows",
    "job_frequency",
    "lookup_one",
    "of_source",
    "property_is_on",
    "publish",
    "publish_touched",
    "read_changes",
    "read_feed",
    "read_table",
    "source_count",
]

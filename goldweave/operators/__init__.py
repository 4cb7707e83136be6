from goldweave.operators.collapse import MergeSource, collapse, collapse_many
from goldweave.operators.counts import counted, merge_counts
from goldweave.operators.distinct import distinct_rows
from goldweave.operators.filters import key_filter
from goldweave.operators.latest import catch_up, late_messages, latest_in_window, window_maxima
from goldweave.operators.load import insert_new
from goldweave.operators.normalize import message_insert_defaults, normalize_feed, project_messages
from goldweave.operators.quarantine import Rule, castable, max_length, not_null, split_rejects
from goldweave.operators.update import expand_to_keys, soft_delete, update_by_key
from goldweave.operators.upsert import merge, upsert
from goldweave.operators.windows import Windows, advance, due_windows

__all__ = [
    "MergeSource",
    "Rule",
    "Windows",
    "advance",
    "castable",
    "catch_up",
    "collapse",
    "collapse_many",
    "counted",
    "distinct_rows",
    "due_windows",
    "expand_to_keys",
    "insert_new",
    "key_filter",
    "late_messages",
    "latest_in_window",
    "max_length",
    "merge",
    "merge_counts",
    "message_insert_defaults",
    "normalize_feed",
    "not_null",
    "project_messages",
    "soft_delete",
    "split_rejects",
    "update_by_key",
    "upsert",
    "window_maxima",
]

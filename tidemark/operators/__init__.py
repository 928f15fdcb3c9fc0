from tidemark.operators.dedupe import keep_first
from tidemark.operators.paging import (
    attach_parent_key,
    attach_whole,
    merge_child_pages,
    merge_pages,
    page_states,
    require_whole,
    source_filter,
    with_stop,
)
from tidemark.operators.shaping import (
    flatten,
    item_fields,
    json_items,
    record_field,
    rename,
    require_values,
    select_columns,
    unwrap_items,
    unwrap_json,
)

__all__ = [
    "attach_parent_key",
    "attach_whole",
    "flatten",
    "item_fields",
    "json_items",
    "keep_first",
    "merge_child_pages",
    "merge_pages",
    "page_states",
    "record_field",
    "rename",
    "require_values",
    "require_whole",
    "select_columns",
    "source_filter",
    "unwrap_items",
    "unwrap_json",
    "with_stop",
]

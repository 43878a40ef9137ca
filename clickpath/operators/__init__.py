"""DataFrame → DataFrame operators of the four analyses."""

from clickpath.operators.active import (
    category_session_clicks,
    item_session_clicks,
    top_item_sessions,
    top_session_details,
    top_sessions,
)
from clickpath.operators.categories import (
    COUNT_COLUMNS,
    category_actions,
    category_counts,
    category_counts_by_joins,
    category_ids,
    click_counts,
    item_category_ids,
    item_counts,
    item_counts_by_joins,
    order_counts,
    pay_counts,
    rank_categories,
    session_category_counts,
    session_kind_counts,
    top_categories,
    weighted_items,
)
from clickpath.operators.filters import (
    DEFAULT_FILTER,
    SessionFilter,
    action_range,
    apply_filter,
    apply_filter_by_actions,
    apply_filter_by_flags,
    hit_flags,
    non_null,
    params_range,
)
from clickpath.operators.sampling import hour_counts, hour_quotas, sample_details, sample_sessions
from clickpath.operators.sessions import (
    aggregate_sessions,
    attach_lists,
    attach_users,
    dedupe_users,
    detail_record,
    expand_copies,
    full_sessions,
    render_sessions,
    session_details,
    weighted_details,
)
from clickpath.operators.stats import (
    aggr_stat,
    length_histogram,
    merge_counters,
    session_counters,
    stat_from_counters,
    step_bucket,
    visit_bucket,
)
from clickpath.operators.topn import ranked_top

__all__ = [
    "COUNT_COLUMNS",
    "DEFAULT_FILTER",
    "SessionFilter",
    "action_range",
    "aggr_stat",
    "aggregate_sessions",
    "apply_filter",
    "apply_filter_by_actions",
    "apply_filter_by_flags",
    "attach_lists",
    "attach_users",
    "category_actions",
    "category_counts",
    "category_counts_by_joins",
    "category_ids",
    "category_session_clicks",
    "click_counts",
    "dedupe_users",
    "detail_record",
    "expand_copies",
    "full_sessions",
    "hour_counts",
    "hit_flags",
    "hour_quotas",
    "item_category_ids",
    "item_counts",
    "item_counts_by_joins",
    "item_session_clicks",
    "length_histogram",
    "merge_counters",
    "non_null",
    "order_counts",
    "params_range",
    "pay_counts",
    "rank_categories",
    "ranked_top",
    "render_sessions",
    "sample_details",
    "sample_sessions",
    "session_category_counts",
    "session_counters",
    "session_details",
    "session_kind_counts",
    "stat_from_counters",
    "step_bucket",
    "top_categories",
    "top_item_sessions",
    "top_session_details",
    "top_sessions",
    "visit_bucket",
    "weighted_details",
    "weighted_items",
]

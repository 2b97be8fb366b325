from .alerts import (
    classify_outcome,
    date_window,
    enrich_alerts,
    load_dim_lookup,
    outcome_stats,
    recent,
    to_alert,
    top_n,
    valid_event,
)
from .conform import apply_defaults, conform, rejects
from .dedup import dedup, dedup_either, distinct_names, keep_latest
from .joins import fits_broadcast, hot_keys, join_dim, lookup_key, skew_join
from .lexicon_join import match_patterns, match_substrings, match_terms
from .quality import (
    assert_or_remove,
    drop_any_blank,
    drop_any_null,
    min_bound,
    null_profile,
    quality_funnel,
    require,
)
from .rollups import alerts_against_history, build_rollup, geo_totals, merge_rollup, trend_by_year
from .scd import current, expire, open_versions, scd2_merge
from .standardize import (
    fallback,
    fill_from_groups,
    project,
    rename,
    repair_like,
    standardize,
    with_measure,
    with_stamp,
)
from .star import DimSpec, FactSpec, build_dim, build_fact, star_join

__all__ = [
    "DimSpec",
    "FactSpec",
    "alerts_against_history",
    "apply_defaults",
    "assert_or_remove",
    "build_dim",
    "build_fact",
    "build_rollup",
    "classify_outcome",
    "conform",
    "current",
    "date_window",
    "dedup",
    "dedup_either",
    "distinct_names",
    "drop_any_blank",
    "drop_any_null",
    "enrich_alerts",
    "expire",
    "fallback",
    "fill_from_groups",
    "fits_broadcast",
    "geo_totals",
    "hot_keys",
    "join_dim",
    "keep_latest",
    "load_dim_lookup",
    "lookup_key",
    "match_patterns",
    "match_substrings",
    "match_terms",
    "merge_rollup",
    "min_bound",
    "null_profile",
    "open_versions",
    "outcome_stats",
    "project",
    "quality_funnel",
    "recent",
    "rejects",
    "rename",
    "repair_like",
    "require",
    "scd2_merge",
    "skew_join",
    "standardize",
    "star_join",
    "to_alert",
    "top_n",
    "trend_by_year",
    "valid_event",
    "with_measure",
    "with_stamp",
]

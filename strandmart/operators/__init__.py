"""Reusable relational operators on DataFrames."""

from strandmart.operators.aggregates import (  # noqa: F401
    collect_parallel,
    concat_distinct,
    concat_sorted,
    count_by,
    flag_counts,
    flagged_keys,
    group_totals,
    pivot_first,
    pivot_latest,
)
from strandmart.operators.joins import (  # noqa: F401
    anti_null_safe,
    anti_on,
    coalesce_sources,
    left_on,
    lookup,
    map_latest,
    or_join,
    override,
    pairs_with_default,
    prefix_join,
    semi_on,
)
from strandmart.operators.merge import insert_absent, last_per_key, upsert  # noqa: F401
from strandmart.operators.ranking import (  # noqa: F401
    best_by,
    dense_rank_by,
    first_flag,
    latest_by,
    richest_by,
    top_n_by,
)
from strandmart.operators.shape import melt, union_by_name, union_padded  # noqa: F401

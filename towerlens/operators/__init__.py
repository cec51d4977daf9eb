"""Generic DataFrame -> DataFrame operators; column names are parameters."""

from towerlens.operators.constraints import (  # noqa: F401
    DataQualityError,
    constraint_violations,
    enforce,
)
from towerlens.operators.dedup import dedup_counts, dedup_keep_first  # noqa: F401
from towerlens.operators.filters import drop_null_keys, outlier_filter  # noqa: F401
from towerlens.operators.joins import heavy_keys, join_dim, join_skewed, key_census, match_rates, orphans  # noqa: F401
from towerlens.operators.profile import (  # noqa: F401
    audit_record,
    null_counts,
    table_fingerprint,
    value_counts,
)
from towerlens.operators.ranking import pct_rank_average, pct_rank_table  # noqa: F401

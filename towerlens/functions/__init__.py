"""Column expressions (all built-in Spark functions, codegen friendly)."""

from towerlens.functions.exprs import (  # noqa: F401
    avg_exact,
    bucketize,
    eq_flag,
    final_sum,
    lenient_number,
    lenient_timestamp,
    merged_sums,
    partial_sums,
    pct,
    round_half_even,
    round_half_up,
    safe_ratio,
    sum_exact,
)

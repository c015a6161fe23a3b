"""Column-expression helpers (all JVM-side built-ins, no Python UDF)."""
from airnet.functions.columns import (  # noqa: F401
    EDGE_PALETTE, NO_SCORE_COLOR, UNKNOWN_LINE_COLOR, calendar_parts, euclidean, guarded_zscore,
    hash_bucket, hex_gradient, line_color, minmax_clamped, ordinal_expr, zscore,
)
from airnet.functions.names import unique_names  # noqa: F401

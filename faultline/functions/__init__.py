"""Column-level helpers: every function returns a Column or a list of names."""

from faultline.functions.names import (  # noqa: F401
    normalize_table_name,
    resolve_column,
    standardize_column_name,
    standardize_columns,
)
from faultline.functions.numeric import (  # noqa: F401
    above_to_null,
    clip_keep_null,
    half_even,
    lenient_number,
    nan_to_null,
    negative_to_null,
)

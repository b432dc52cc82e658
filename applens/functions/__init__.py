"""Column expressions; all built-in Spark functions, no Python UDFs."""

from applens.functions.text import (  # noqa: F401
    alnum, category_label, literal_split, parse_count, parse_price, parse_size_mb,
    prefix, remove_newlines, short_name, strip, to_double, to_long,
)
from applens.functions.numeric import (  # noqa: F401
    ceil1, nan_to_null, safe_corr, sign_label,
)

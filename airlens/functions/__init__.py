"""Column-expression functions (scalar, JVM-side, codegen friendly)."""

from airlens.functions.aqi import (  # noqa: F401
    BREAKPOINTS,
    CATEGORIES,
    DANGEROUS_AQI,
    POLLUTANTS,
    category,
    concentration,
    is_dangerous,
    normalize_unit,
    round_half_even,
    sub_index,
    truncate,
)
from airlens.functions.common import (  # noqa: F401
    first_truthy,
    iso_utc_string,
    parse_iso_timestamp,
    record_key,
)

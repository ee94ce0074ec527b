"""Column expressions used by the rules (all JVM-side built-ins)."""

from fraudmart.functions.exprs import (  # noqa: F401
    EVENT_TYPES,
    as_interval,
    date_lit,
    expired,
    fio,
    file_date_from_name,
    source_name,
    ts_lit,
    within_interval,
)

"""Column helpers (scalar functions). Every helper takes and returns Columns,
so rules stay inside whole-stage codegen; none is a Python UDF."""

from creditpulse.functions.text import (  # noqa: F401
    area_parts,
    first_non_blank,
    first_part,
    is_blank,
    java_trim,
    strip_token,
)
from creditpulse.functions.numbers import opt_double, opt_float, opt_int, opt_long, strict_long  # noqa: F401
from creditpulse.functions.timefn import (  # noqa: F401
    bucket_end,
    date_prefix,
    day_of,
    drop_fraction,
    ms_of_ntz,
    ms_to_ntz,
    ms_to_text,
    prev_day,
    text_to_ms,
)

"""Column -> Column building blocks; everything stays inside JVM codegen."""

from carelake.functions.ages import (
    age_band,
    age_band8,
    age_from_dates,
    decode_admission_age,
    decode_packed_age,
)
from carelake.functions.casting import br_number, decimal_comma, money_avg, money_sum, to_double, to_int, to_long
from carelake.functions.codes import (
    bed_category,
    code_chapter,
    code_group,
    chapter_label,
    is_external_cause,
    is_sensitive,
    outcome_label,
    recode_sex_to_admissions,
    reference_month,
)
from carelake.functions.dates import (
    dow_sunday0,
    epi_week,
    epi_year,
    parse_dmy,
    parse_ymd,
    period_date,
    period_month,
    period_year,
    stay_days,
)
from carelake.functions.rates import flag, guarded_ratio, percent, stored_percent
from carelake.functions.text import (
    accent_key,
    alias_name,
    composite_key,
    id_or_fallback,
    null_coordinates,
    postcode_prefix,
    pseudonym,
    truncate_code,
    zero_pad,
)

__all__ = [name for name in dir() if not name.startswith("_")]

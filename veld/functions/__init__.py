"""Column expressions: text (X1-X5), numeric (X6, X10, A10, A12), geographic."""

from veld.functions.text import (capitalize, title_case, strip_code, normalize_address,
                                 address_candidates, collapse_blanks, nan_text)
from veld.functions.numeric import (parse_int, parse_double, range_bucket, safe_corr,
                                    skewness_adjusted, POSTCODE_PROVINCES)
from veld.functions.geo import mercator_distance, haversine_distance, distance

__all__ = [
    "capitalize", "title_case", "strip_code", "normalize_address", "address_candidates",
    "collapse_blanks", "nan_text", "parse_int", "parse_double", "range_bucket", "safe_corr",
    "skewness_adjusted", "POSTCODE_PROVINCES", "mercator_distance", "haversine_distance",
    "distance",
]

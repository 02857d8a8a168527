"""``Column`` expressions, and order statistics over ranges (``ranges``)."""

from pixelframe.functions.exprs import (
    safe_ratio, percent_string, fixed_string,
    key_hash, hash_bucket, round_doubles,
)
from pixelframe.functions.albers import (
    AlbersParams, CONUS_ALBERS, albers_forward, albers_inverse,
)

__all__ = [
    "safe_ratio", "percent_string", "fixed_string",
    "key_hash", "hash_bucket", "round_doubles",
    "AlbersParams", "CONUS_ALBERS", "albers_forward", "albers_inverse",
]

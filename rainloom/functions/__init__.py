from rainloom.functions.scalars import (
    blank_to_null, compass_degrees, digest, digest_fraction, nan_to_null, to_double, yes_no_flag,
)

__all__ = [
    "blank_to_null", "compass_degrees", "digest", "digest_fraction", "nan_to_null", "to_double",
    "yes_no_flag",
]

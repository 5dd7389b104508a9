from .clean import (
    WHITESPACE, clean_str, equals_flag, first_truthy, has_value, join_nonempty, map_tokens,
    null_safe_sum, strip, to_bool2, to_bool3, truthy,
)
from .convert import to_date_safe, to_double, to_int, to_ts_ntz, to_ts_utc, typed_value
from .geo import ewkb_to_wkb
from .keys import (
    composite_key, hash_key, household_number, is_digits, is_external_id, key_slice, prefixed_key,
    replace_chain, stable_id, strip_suffix, title_case, title_key,
)
from .labels import attendance, gender, kind_by_substring, status_label
from .names import fabricated_login, norm_email, split_name, split_name_last, username

__all__ = [
    "WHITESPACE", "attendance", "clean_str", "composite_key", "equals_flag", "ewkb_to_wkb",
    "fabricated_login", "first_truthy", "gender", "has_value", "hash_key", "household_number",
    "is_digits", "is_external_id", "join_nonempty", "key_slice", "kind_by_substring", "map_tokens",
    "norm_email", "null_safe_sum", "prefixed_key", "replace_chain", "split_name", "split_name_last",
    "stable_id", "status_label", "strip", "strip_suffix", "title_case", "title_key", "to_bool2",
    "to_bool3", "to_date_safe", "to_double", "to_int", "to_ts_ntz", "to_ts_utc", "truthy",
    "typed_value", "username",
]

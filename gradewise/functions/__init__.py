from gradewise.functions.columns import (
    column,
    grade_label,
    hash_bucket,
    is_missing,
    majority,
    md5_of,
    normalize_text,
    row_key,
    to_number,
)

__all__ = [
    "column",
    "grade_label",
    "hash_bucket",
    "is_missing",
    "majority",
    "md5_of",
    "normalize_text",
    "row_key",
    "to_number",
]

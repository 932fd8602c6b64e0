from shopledger.functions.columns import (
    date_key,
    hash_email,
    mask_phone,
    money,
    normalise_text,
    percent,
    ratio,
    surrogate_key,
    utc_timestamps,
)

__all__ = [
    "date_key",
    "hash_email",
    "mask_phone",
    "money",
    "normalise_text",
    "percent",
    "ratio",
    "surrogate_key",
    "utc_timestamps",
]

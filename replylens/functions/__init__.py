from replylens.functions.columns import (
    bucket_start,
    field,
    hash_key,
    latency_ms,
    mask_pan,
    once,
    outcome,
    prefer_response,
    round_half_up,
    safe_ratio,
    strict_instant,
)

__all__ = [
    "bucket_start",
    "field",
    "hash_key",
    "latency_ms",
    "mask_pan",
    "once",
    "outcome",
    "prefer_response",
    "round_half_up",
    "safe_ratio",
    "strict_instant",
]

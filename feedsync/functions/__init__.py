from feedsync.functions.columns import (
    canonical_code,
    full_match,
    guarded_int,
    is_true,
    null_concat,
)

__all__ = ["canonical_code", "full_match", "guarded_int", "is_true", "null_concat"]

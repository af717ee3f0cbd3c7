"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from shoplens.functions.numeric import clip, days_between, exact_mean, exact_sum, np_round, safe_div
from shoplens.functions.text import (
    emotion_score,
    keyword_flag,
    stable_binary,
    stable_bucket,
    stable_hash32,
    translate_category,
)

__all__ = [
    "clip", "days_between", "exact_mean", "exact_sum", "np_round", "safe_div", "emotion_score", "keyword_flag",
    "stable_binary", "stable_bucket", "stable_hash32", "translate_category",
]

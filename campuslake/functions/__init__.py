"""Column helpers shared by the operators."""

from .labels import absence_band, mention, performance_category
from .measures import merged_stddev, pass_rate, round_dec, weighted_mean
from .parsing import as_number, iso_date

__all__ = [
    "absence_band",
    "as_number",
    "iso_date",
    "mention",
    "merged_stddev",
    "pass_rate",
    "performance_category",
    "round_dec",
    "weighted_mean",
]

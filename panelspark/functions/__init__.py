"""Scalar functions over columns: numbers and ranks in prose, ages, calendar days, box-score formulas."""

from .calendar import age, marked_sunday, placeholder_date
from .formulas import game_score, true_shooting, usage
from .prose import dictionary_hits, infobox, smallest_pick, tier_number

__all__ = ["age", "dictionary_hits", "game_score", "infobox", "marked_sunday", "placeholder_date", "smallest_pick", "tier_number", "true_shooting", "usage"]

"""Box-score formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published weights of the game score.
GAME_SCORE = {"points": 1.0, "field_goals": 0.4, "field_goal_attempts": -0.7, "missed_free_throws": -0.4, "offensive_rebounds": 0.7, "defensive_rebounds": 0.3, "steals": 1.0, "assists": 0.7, "blocks": 0.7, "fouls": -0.4, "turnovers": -1.0}


def game_score(**counts: Column) -> Column:
    """The weighted sum of a line's counts; null if any is. Counts that are not given are not part of it."""
    if unknown := set(counts) - set(GAME_SCORE):
        raise ValueError(f"unknown counts: {sorted(unknown)}")
    return sum((F.lit(GAME_SCORE[k]) * c for k, c in sorted(counts.items())), F.lit(0.0))


def true_shooting(points: Column, attempts: Column, free_throws: Column) -> Column:
    """Points over twice the shots and 0.44 of the free throws; null without a try."""
    tries = 2 * (attempts + 0.44 * free_throws)
    return F.when(tries > 0, points / F.nullif(tries, F.lit(0.0)))


def usage(own: Column, minutes: Column, team: Column, team_minutes: Column, players: int = 5) -> Column:
    """Share of the team's plays that one ends while on the floor."""
    base = F.nullif(minutes * team, F.lit(0.0))
    return own * (team_minutes / players) / base

"""Pitch geometry: coordinates are percent of a 105 x 68 m field."""

from pyspark.sql import functions as F

from .numeric import _col, round_even

FIELD_LENGTH, FIELD_WIDTH = 105.0, 68.0
ZONES = ["Back", "Center", "Left", "Right"]
SHOT_TYPES = ["Saved Shot", "Goal", "Miss", "Post"]
DIRECTIONS = ["Backward", "Backward Left", "Backward Right", "Forward", "Forward Left",
              "Forward Right", "Left", "Right"]


def pass_direction(dx, dy, threshold=5.0):
    """One of eight directions, or ``no clear direction``."""
    dx, dy, t = _col(dx), _col(dy), float(threshold)
    side = F.when(dy > t, F.lit(" Right")).when(dy < -t, F.lit(" Left")).when(
        F.abs(dy) <= t, F.lit(""))
    along = F.when(dx > t, F.lit("Forward")).when(dx < -t, F.lit("Backward")).when(
        F.abs(dx) <= t, F.lit(""))
    name = F.trim(F.concat(along, side))
    return F.when(F.length(name) > 0, name).otherwise(F.lit("no clear direction"))


def pitch_length(x0, y0, x1, y1):
    """Distance in metres, two decimals."""
    dx = (_col(x1) - _col(x0)) * FIELD_LENGTH / 100.0
    dy = (_col(y1) - _col(y0)) * FIELD_WIDTH / 100.0
    return round_even(F.sqrt(dx * dx + dy * dy), 2)


def shot_length(x, y, goal_y):
    """Distance of a shot to the goal line at the crossing point, or the middle if unknown."""
    return pitch_length(x, y, F.lit(100.0), F.coalesce(_col(goal_y), F.lit(50.0)))

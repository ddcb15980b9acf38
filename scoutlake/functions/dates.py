"""Dates as dd/MM/yyyy text and epoch seconds."""

from pyspark.sql import functions as F

from .numeric import _col


def parse_dmy(c):
    """dd/MM/yyyy text to date, null if invalid."""
    return F.try_to_timestamp(_col(c), F.lit("dd/MM/yyyy")).cast("date")


def format_dmy(c):
    return F.date_format(_col(c), "dd/MM/yyyy")


def format_hm(c):
    return F.date_format(_col(c), "HH:mm")


def epoch_date(c):
    """Epoch seconds to date, null-safe."""
    return F.timestamp_seconds(_col(c)).cast("date")

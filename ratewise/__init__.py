"""Ratings analytics and recommendations as plain Spark DataFrame operators."""

from ratewise.settings import DEFAULTS, Settings

__all__ = ["DEFAULTS", "Settings"]

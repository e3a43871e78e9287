"""Behaviour-analytics operators for (user, item, category, brand, time, action) logs on Spark."""

from cartwise.schema import ActionType
from cartwise.windows import Suffixes, WindowSpec

__all__ = ["ActionType", "Suffixes", "WindowSpec"]

"""Whole runs."""

from .weekly import WeeklyRun, weekly_run

__all__ = ["WeeklyRun", "weekly_run"]

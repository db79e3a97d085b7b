"""The expected answers, in SQL for another engine."""

from oracle.answers import ANSWERS

__all__ = ["ANSWERS"]

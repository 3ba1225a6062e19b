"""Registered queries and their SQL."""

from . import contamination, dedup, evaluation, privacy, release, training  # noqa: F401

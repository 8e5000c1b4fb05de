"""Registered queries, by group, with the SQL that each is held against."""

from __future__ import annotations

from prismcube.queries import cubes, data_jobs, insights, people, patterns, shapes, stored, texts  # noqa: F401  registers them
from prismcube.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

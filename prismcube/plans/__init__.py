"""Specifications of jobs as plain dataclasses."""

"""Registered queries of the library's own operators."""

from . import catalogue, library, validators
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "catalogue", "library", "validators"]

"""Registered queries over the test tables, each beside its independent SQL form."""

from . import answers, cleaning, counts, places, series  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401

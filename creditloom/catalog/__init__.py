"""Registered queries, each with an independent SQL form where SQL can express it."""

from creditloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "load"]


def load() -> None:
    """Import every module that registers queries."""
    from creditloom.catalog import (  # noqa: F401
        cleaning, evaluation, explanation, features, modelling, population, storage, streams, trees)

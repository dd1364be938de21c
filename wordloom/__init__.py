"""Corpus indexing and ranked keyword search, expressed as Spark DataFrame jobs."""

from wordloom.plans.session import IndexSession

__all__ = ["IndexSession"]

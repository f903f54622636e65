"""Named queries over one scale folder: ``name -> callable(spark, folder)``."""

from granary.catalogue import analyses, checks, layers, loads  # noqa: F401
from granary.catalogue.base import QUERIES

__all__ = ["QUERIES"]

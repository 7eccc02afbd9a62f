"""Corpus preparation as Spark jobs: many bilingual sources in, one split table out."""

from corpusmix.session import build_session
from corpusmix.sources.recipe import Recipe, SourceEntry, load_recipe, parse_recipe

__all__ = ["Recipe", "SourceEntry", "build_session", "load_recipe", "parse_recipe"]

"""Operators for preparing training text at corpus scale (quality, toxicity, duplicates,
packing, search, scoring, tokenizing, URL and HTML work). Nothing else in the library
imports this subpackage."""

"""Lexicons kept as tables: (term, priority, canonical, label)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.matching import Lexicon, Pattern, Term

# more terms than this are not put into one expression; EntityRules.of_table then joins the table instead
MAX_TERMS = 2_000


def load_lexicon(
    *tables: DataFrame, label: str | None = None, longest_first: bool = False, max_terms: int = MAX_TERMS
) -> Lexicon:
    """Read one or more lexicon tables, concatenated in the order given, into an expression-sized lexicon.

    Columns ``canonical`` and ``label`` may be missing. ``longest_first`` puts the longer of two terms of
    equal priority first.
    """
    lexicons = []
    for table in tables:
        optional = {c: F.lit(None).cast("string") for c in ("canonical", "label") if c not in table.columns}
        rows = table.withColumns(optional) if optional else table
        if label is not None:
            rows = rows.filter(F.col("label") == label)
        taken = rows.select("term", "priority", "canonical", "label").limit(max_terms + 1).collect()
        if len(taken) > max_terms:
            raise ValueError(f"lexicon has more than {max_terms} terms; match it as a table instead")
        lexicons.append(Lexicon([Term(*r) for r in taken if r["term"] is not None], longest_first))
    return reduce(Lexicon.__add__, lexicons)


def load_patterns(*tables: DataFrame, max_terms: int = 20_000) -> tuple[Pattern, ...]:
    """Read (term, label) tables as token patterns; tokens are separated by spaces."""
    patterns: list[Pattern] = []
    for table in tables:
        taken = table.select("term", "label").limit(max_terms + 1).collect()
        if len(taken) > max_terms:
            raise ValueError(f"more than {max_terms} patterns")
        patterns += [Pattern(tuple(term.lower().split()), label) for term, label in taken if term and term.strip()]
    return tuple(patterns)

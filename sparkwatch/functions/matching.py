"""Lexicon and pattern matching as Column expressions.

A lexicon becomes one regular expression with shared beginnings folded together, so a text is read once
however many terms there are. Two ways to match a term:

* ``word``: no letter or digit may touch the term on either side;
* ``substring``: anywhere, also inside other words.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws

WORD_CHAR = r"[\p{L}\p{N}]"
MODES = ("word", "substring")

# Up to this many terms a plain substring scan per term beats one regular expression (measured on 25 MB of text).
SCAN_TERMS = 256
# The same for word matching, where a term that is found still has to be tested for its boundaries.
SCAN_WORDS = 32


@dataclass(frozen=True)
class Term:
    term: str
    priority: int
    canonical: str | None = None
    label: str | None = None


@dataclass(frozen=True)
class Pattern:
    """A sequence of lower-cased tokens carrying a label."""

    tokens: tuple[str, ...]
    label: str


class Lexicon:
    """Terms by priority, then by name; lower-cased, and a repeated term counts at its best place only."""

    def __init__(self, terms: Iterable[Term], longest_first: bool = False):
        def order(t: Term):
            text = t.term.strip().lower()
            return (t.priority, -len(text) if longest_first else 0, text)

        kept: dict[str, Term] = {}
        for t in sorted(terms, key=order):
            text = t.term.strip().lower()
            if text and text not in kept:
                kept[text] = Term(text, t.priority, t.canonical, t.label)
        self.terms = tuple(kept.values())

    @classmethod
    def of(cls, *terms: str, label: str | None = None, canonical: Mapping[str, str] | None = None) -> "Lexicon":
        """Lexicon from bare terms; their order is the priority."""
        names = canonical or {}
        return cls(Term(t, i, names.get(t), label) for i, t in enumerate(terms))

    @property
    def words(self) -> list[str]:
        return [t.term for t in self.terms]

    @property
    def mapping(self) -> dict[str, str]:
        return {t.term: t.canonical for t in self.terms if t.canonical}

    def __len__(self) -> int:
        return len(self.terms)

    def __add__(self, other: "Lexicon") -> "Lexicon":
        """Concatenation: the terms of ``other`` rank after all of this one's."""
        shift = max((t.priority for t in self.terms), default=-1) + 1 - min((t.priority for t in other.terms), default=0)
        moved = [Term(t.term, t.priority + shift, t.canonical, t.label) for t in other.terms]
        return Lexicon([*self.terms, *moved])


def _terms(lexicon: Lexicon | Sequence[str]) -> list[str]:
    if isinstance(lexicon, Lexicon):
        return lexicon.words
    return list(dict.fromkeys(t.strip().lower() for t in lexicon if t.strip()))


def _check_mode(match: str) -> None:
    if match not in MODES:
        raise ValueError(f"match must be one of {MODES}, got {match!r}")


def _alternation(terms: Iterable[str]) -> str:
    """One pattern for all terms, shared beginnings folded; it prefers the longest term at a place."""
    terms = list(terms)
    if len(shared := os.path.commonprefix(terms)) > 1:  # a beginning of all terms needs no level of its own
        return re.escape(shared) + _alternation([t[len(shared) :] for t in terms])
    branches: dict[str, list[str]] = {}
    ends_here = False
    for t in terms:
        if t:
            branches.setdefault(t[0], []).append(t[1:])
        else:
            ends_here = True
    if not branches:
        return ""
    body = "|".join(re.escape(head) + _alternation(tails) for head, tails in sorted(branches.items()))
    if len(branches) > 1 or ends_here:
        body = f"(?:{body})"
    return body + "?" if ends_here else body


def _starts(terms: Iterable[str]) -> str:
    """Look-ahead for a first letter of any term: it rules most places out before costlier tests."""
    return "(?=[" + "".join(re.escape(c) for c in sorted({t[0] for t in terms})) + "])"


def _bounded(pattern: str, terms: Iterable[str], match: str) -> str:
    """The pattern with its boundaries; ``terms`` are what it can match, by their beginnings."""
    if match == "substring":
        return pattern
    return f"{_starts(terms)}(?<!{WORD_CHAR}){pattern}(?!{WORD_CHAR})"


def _scans(terms: Sequence[str], match: str) -> bool:
    return len(terms) <= (SCAN_TERMS if match == "substring" else SCAN_WORDS)


def _occurs(lowered: Column, term: str, match: str) -> Column:
    """One term by a plain substring scan; its boundaries are looked at only where it was found."""
    found = F.contains(lowered, F.lit(term))
    if match == "substring":
        return found
    # the literal comes first, so the expression does not look behind at every place
    literal = re.escape(term)
    return found & lowered.rlike(f"{literal}(?<!{WORD_CHAR}{literal})(?!{WORD_CHAR})")


def any_term(
    text: Column, lexicon: Lexicon | Sequence[str], match: str = "word", lowered: bool = False
) -> Column:
    """Does at least one term occur in the text? ``lowered`` says that the text is in lower case already."""
    _check_mode(match)
    terms = _terms(lexicon)
    if not terms:
        return F.lit(False)
    low = text if lowered else F.lower(text)
    if _scans(terms, match):
        return reduce(or_, [_occurs(low, t, match) for t in terms])
    return low.rlike(_bounded(_alternation(terms), terms, match))


def _winner_at(terms: Sequence[str], match: str) -> list[int]:
    """For each term: the best rank among the terms that also match wherever it does.

    Terms that match at one place are beginnings of the longest of them, so the longest match alone
    tells which others match there too.
    """
    rank = {t: i for i, t in enumerate(terms)}
    best = []
    for t in terms:
        ranks = [rank[t]]
        for end in range(1, len(t)):
            inner = rank.get(t[:end])
            if inner is not None and (match == "substring" or not t[end].isalnum()):
                ranks.append(inner)
        best.append(min(ranks))
    return best


def first_term(
    text: Column, lexicon: Lexicon | Sequence[str], match: str = "word", lowered: bool = False
) -> Column:
    """The term that comes first in the lexicon among those found; its place in the text does not count."""
    _check_mode(match)
    terms = _terms(lexicon)
    if not terms:
        return F.lit(None).cast("string")
    low = text if lowered else F.lower(text)
    if _scans(terms, match):
        return F.coalesce(*[F.when(_occurs(low, t, match), F.lit(t)) for t in terms])
    # a look-ahead finds the longest term at every place, overlaps included
    trie = _alternation(terms)
    if match == "substring":
        finder = f"(?=({trie}))"
    else:
        finder = f"{_starts(terms)}(?<!{WORD_CHAR})(?=({trie})(?!{WORD_CHAR}))"
    found = F.array_distinct(F.regexp_extract_all(low, F.lit(finder), F.lit(1)))
    # one literal each, however many terms there are
    all_terms = F.split(F.lit("\x00".join(terms)), "\x00")
    winners = F.expr(f"array({','.join(str(b + 1) for b in _winner_at(terms, match))})")
    ranks = F.transform(found, lambda t: F.get(winners, (F.array_position(all_terms, t) - 1).cast("int")))
    return F.get(all_terms, F.array_min(ranks) - 1)


def first_pattern(
    text: Column,
    patterns: Sequence[Pattern],
    label: str | None = None,
    limit: int | None = None,
    lowered: bool = False,
) -> Column:
    """The earliest match of a token sequence, the longest one where two start together.

    ``limit`` looks at the first so many characters only; by default the whole text is searched.
    """
    wanted = {p.tokens for p in patterns if any(t.strip() for t in p.tokens) and (label is None or p.label == label)}
    if not wanted:
        return F.lit(None).cast("string")
    ordered = sorted(wanted, key=lambda tokens: (-len(" ".join(tokens)), tokens))
    alternatives = "|".join(r"\s+".join(re.escape(t) for t in tokens) for tokens in ordered)
    searched = text if limit is None else F.substring(text, 1, limit)
    searched = searched if lowered else F.lower(searched)
    found = F.regexp_extract(searched, _bounded(f"({alternatives})", (t[0] for t in ordered), "word"), 1)
    return F.nullif(F.regexp_replace(found, r"\s+", " "), F.lit(""))


def canonicalize(term: Column, mapping: Mapping[str, str]) -> Column:
    """Case-blind synonym lookup; a miss gives the stripped upper-case term."""
    stripped = strip_ws(term)
    if not mapping:
        return F.upper(stripped)
    pairs: list[Column] = []
    for name, canonical in {k.strip().lower(): v for k, v in mapping.items()}.items():
        pairs += [F.lit(name), F.lit(canonical)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(stripped)), F.upper(stripped))


def override_members(
    term: Column, members: Iterable[str], value: str, otherwise: Column | None = None
) -> Column:
    """``value`` for members of a closed list (case-blind), else ``otherwise`` (by default the term itself)."""
    names = sorted({m.strip().upper() for m in members})
    rest = term if otherwise is None else otherwise
    if not names:
        return rest
    return F.when(F.upper(strip_ws(term)).isin(names), F.lit(value)).otherwise(rest)


def cascade(*matchers: Column) -> Column:
    """The first matcher that finds something."""
    return F.coalesce(*matchers)


def keyword_query(
    text: Column, groups: Sequence[Sequence[str]], match: str = "substring", lowered: bool = False
) -> Column:
    """(a OR b ...) AND (c OR d ...): at least one term of every group."""
    return reduce(and_, [any_term(text, group, match, lowered) for group in groups], F.lit(True))


def relevance(
    text: Column,
    exclude: Lexicon | Sequence[str],
    all_of: Sequence[Lexicon | Sequence[str]],
    match: str = "word",
    lowered: bool = False,
) -> Column:
    """False where an excluded term occurs; else true if every group has a term in the text.

    A filter works out what it tests anew for every term: lower long texts first and say ``lowered``.
    """
    return ~any_term(text, exclude, match, lowered) & keyword_query(text, all_of, match, lowered)

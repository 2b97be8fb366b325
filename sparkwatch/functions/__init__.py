from .keys import hash_key
from .matching import (
    Lexicon,
    Pattern,
    Term,
    any_term,
    canonicalize,
    cascade,
    first_pattern,
    first_term,
    keyword_query,
    override_members,
    relevance,
)
from .text import fold_accents, is_blank, normalize_name, prefix, strip_ws, text_of
from .times import as_timestamp, parse_ts, today, ts_was_imputed, year_month

__all__ = [
    "Lexicon",
    "Pattern",
    "Term",
    "any_term",
    "as_timestamp",
    "canonicalize",
    "cascade",
    "first_pattern",
    "first_term",
    "fold_accents",
    "hash_key",
    "is_blank",
    "keyword_query",
    "normalize_name",
    "override_members",
    "parse_ts",
    "prefix",
    "relevance",
    "strip_ws",
    "text_of",
    "today",
    "ts_was_imputed",
    "year_month",
]

"""From live text events to resolved alerts. Everything here is a pure frame-to-frame function."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..functions.matching import Lexicon, Pattern, canonicalize, cascade, first_pattern, first_term, override_members
from ..functions.text import strip_ws, text_of
from ..functions.times import AsOf, as_timestamp, parse_ts, today, ts_was_imputed
from ..sources.lexicons import MAX_TERMS, load_lexicon
from .columns import computed_once
from .dedup import dedup
from .joins import join_dim, lookup_key
from .lexicon_join import match_patterns, match_substrings, match_terms
from .scd import current

OUTCOMES = ("no_disease", "no_country", "no_keys", "inserted")
Matcher = Callable[[Column], Column]


@dataclass(frozen=True)
class EntityRules:
    """How one kind of entity is found and named.

    Terms are tried first, then token patterns, then the caller's own ``matchers`` (Column -> Column, for
    instance a pandas UDF). A lexicon too large for one expression is given as a ``table`` (term, priority,
    canonical) and matched by a join; its terms come before those of ``lexicon``. In the same way ``pattern_table``
    (term, label) holds patterns, tried after ``patterns``. What was found goes through ``members`` (a closed list
    mapped to one value), then the synonym ``mapping``; a name in neither is upper-cased.
    """

    lexicon: Lexicon
    patterns: tuple[Pattern, ...] = ()
    label: str | None = None
    mapping: Mapping[str, str] = field(default_factory=dict)
    members: tuple[str, ...] = ()
    member_value: str = ""
    match: str = "word"
    pattern_limit: int | None = None
    matchers: tuple[Matcher, ...] = ()
    table: DataFrame | None = None
    max_words: int = 3
    pattern_table: DataFrame | None = None

    @classmethod
    def of_table(cls, table: DataFrame, max_terms: int = MAX_TERMS, **options) -> EntityRules:
        """Rules over a lexicon table of any size: one expression up to ``max_terms``, a join beyond."""
        if len(table.limit(max_terms + 1).select("term").collect()) <= max_terms:
            return cls(lexicon=load_lexicon(table, label=None), **options)
        return cls(lexicon=Lexicon([]), table=table, **options)

    def extract(self, text: Column, lowered: Column, term: Column | None = None, pattern: Column | None = None) -> Column:
        """The term found in a text, given with its lower-case form; own matchers see the text as it is.

        ``term`` and ``pattern`` are what the tables have for it.
        """
        return cascade(
            *([] if term is None else [term]),
            first_term(lowered, self.lexicon, self.match, lowered=True),
            first_pattern(lowered, self.patterns, self.label, self.pattern_limit, lowered=True),
            *([] if pattern is None else [pattern]),
            *[m(text) for m in self.matchers],
        )

    def name(self, term: Column) -> Column:
        named = canonicalize(term, {**self.lexicon.mapping, **self.mapping})
        return override_members(term, self.members, self.member_value, otherwise=named) if self.members else named


def valid_event(df: DataFrame, title: str = "title", url: str = "url") -> DataFrame:
    """Rows with a title that is more than whitespace and a non-empty url."""
    return df.filter((strip_ws(F.col(title)) != "") & (F.col(url) != ""))


def date_window(df: DataFrame, col: str, as_of: AsOf = None, days: int = 1) -> DataFrame:
    """Rows dated from ``days`` before ``as_of`` up to its end, both days included.

    The bounds are put on the column itself, so the test reaches the file scan.
    """
    day = today(as_of)
    lower = F.date_sub(day, days).cast("timestamp")
    upper = F.date_add(day, 1).cast("timestamp")
    return df.filter((F.col(col) >= lower) & (F.col(col) < upper))


def recent(df: DataFrame, ts: str, *tiebreak: str | Column) -> DataFrame:
    """Newest first, ties in the order given; rows without a time come last."""
    return df.orderBy(F.col(ts).desc_nulls_last(), *tiebreak)


def top_n(df: DataFrame, order: Sequence[Column], n: int = 100) -> DataFrame:
    """The first n rows of an order; every task keeps only its own n best."""
    return df.orderBy(*order).limit(n)


def load_dim_lookup(dim: DataFrame, name_col: str, key_col: str, current_only: bool = False) -> DataFrame:
    """(name, key) of a dimension, of its current versions only if asked."""
    rows = current(dim) if current_only else dim
    return rows.select(name_col, key_col)


def extract_entities(df: DataFrame, text: Column, rules: Mapping[str, EntityRules]) -> DataFrame:
    """Add one column per kind of entity with its canonical name, null where none was found."""
    df = computed_once(df, {"__text": text, "__lower": F.lower(text)})
    added = []
    for name, r in rules.items():
        if r.table is not None:
            df = _joined_terms(df, name, r)
            added += [f"__{name}_term", f"__{name}_canonical"]
        if r.pattern_table is not None:
            df = _joined_pattern(df, name, r)
            added.append(f"__{name}_pattern")

    def of(column: str) -> Column | None:
        return F.col(column) if column in added else None

    terms = {f"__{name}": r.extract(F.col("__text"), F.col("__lower"), of(f"__{name}_term"), of(f"__{name}_pattern")) for name, r in rules.items()}
    named = {name: r.name(F.col(f"__{name}")) for name, r in rules.items()}
    for name, r in rules.items():
        if r.table is not None:
            named[name] = F.coalesce(F.col(f"__{name}_canonical"), named[name])
    df = computed_once(df, terms).withColumns(named)
    return df.drop("__text", "__lower", *terms, *added)


def _by_digest(df: DataFrame, match: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Add what ``match`` finds in the texts, given as (__digest, __lower).

    Texts are matched where they lie; hits are joined by the digest, broadcast where their measured size allows.
    """
    keyed = df.withColumn("__digest", F.md5("__lower"))
    found = match(keyed.select("__digest", "__lower"))
    return join_dim(keyed, found, ["__digest"], "left", derived=True, costly=True).drop("__digest")


def _joined_terms(df: DataFrame, name: str, rules: EntityRules) -> DataFrame:
    """Add the term that a lexicon table has for each text, and its canonical name."""
    lexicon = rules.table
    if rules.label is not None and "label" in lexicon.columns:
        lexicon = lexicon.filter(F.col("label") == rules.label)
    if "canonical" not in lexicon.columns:
        lexicon = lexicon.withColumn("canonical", F.lit(None).cast("string"))

    def match(texts: DataFrame) -> DataFrame:
        if rules.match == "substring":
            found = match_substrings(texts, "__digest", "__lower", lexicon, keep=["canonical"])
        else:
            found = match_terms(texts, "__digest", "__lower", lexicon, rules.max_words, keep=["canonical"])
        return found.select("__digest", F.col("term").alias(f"__{name}_term"), F.col("canonical").alias(f"__{name}_canonical"))

    return _by_digest(df, match)


def _joined_pattern(df: DataFrame, name: str, rules: EntityRules) -> DataFrame:
    """Add the pattern that a table has for each text."""

    def match(texts: DataFrame) -> DataFrame:
        found = match_patterns(texts, "__digest", "__lower", rules.pattern_table, rules.label, rules.pattern_limit)
        return found.select("__digest", F.col("pattern").alias(f"__{name}_pattern"))

    return _by_digest(df, match)


def classify_outcome(
    df: DataFrame,
    disease: str = "disease",
    country: str = "country",
    disease_key: str = "disease_key",
    location_key: str = "location_key",
) -> DataFrame:
    """Add ``outcome``: the first thing an event lacks, in the order disease, country, keys."""

    def absent(c: str) -> Column:
        return F.col(c).isNull() | (F.col(c) == "")

    return df.withColumn(
        "outcome",
        F.when(absent(disease), "no_disease")
        .when(absent(country), "no_country")
        .when(absent(disease_key) | absent(location_key), "no_keys")
        .otherwise("inserted"),
    )


def outcome_stats(df: DataFrame) -> DataFrame:
    """One row: total and the count of every outcome."""
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    return df.agg(F.count(F.lit(1)).alias("total"), *counts)


def to_alert(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Assemble the alert row; the id is a hash of what identifies the alert, so a replay gives the same id."""
    return df.select(
        hash_key(
            [F.coalesce(F.col(c), F.lit("")) for c in ("source", "url", "title", "disease_key", "location_key")],
            sep="|",
        ).alias("alert_id"),
        "disease_key",
        "location_key",
        parse_ts("published_at", as_of).alias("published_at"),
        as_timestamp(as_of).alias("ingestion_time"),
        "title",
        "source",
        "url",
        ts_was_imputed("published_at").alias("published_at_imputed"),
    )


def resolve_events(
    events: DataFrame,
    diseases: DataFrame,
    locations: DataFrame,
    disease_rules: EntityRules,
    country_rules: EntityRules,
    dedup_first: bool = True,
    fold: bool = False,
) -> DataFrame:
    """Events with entities, keys and outcome; none is lost, whatever its outcome.

    ``diseases`` holds (disease_name, disease_key), ``locations`` (country, location_key). Leave the
    deduplication out to run this on a streaming frame.
    """
    rows = dedup(events, ["title", "source"], ["published_at", "url"]) if dedup_first else events
    rows = extract_entities(
        rows, text_of("title", "description"), {"disease": disease_rules, "country": country_rules}
    )
    rows = lookup_key(rows, "disease", diseases, "disease_name", "disease_key", "disease_key", fold=fold)
    rows = lookup_key(rows, "country", locations, "country", "location_key", "location_key", fold=fold)
    return classify_outcome(rows)


def enrich_alerts(
    events: DataFrame,
    diseases: DataFrame,
    locations: DataFrame,
    disease_rules: EntityRules,
    country_rules: EntityRules,
    as_of: AsOf = None,
    dedup_first: bool = True,
    fold: bool = False,
) -> DataFrame:
    """Decoded events to alert rows: deduplicate, extract, resolve, keep what resolved."""
    rows = resolve_events(events, diseases, locations, disease_rules, country_rules, dedup_first, fold)
    return to_alert(rows.filter(F.col("outcome") == "inserted"), as_of)

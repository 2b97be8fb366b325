"""Lexicon and pattern matching over whole texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkwatch.functions import (
    Lexicon,
    Pattern,
    canonicalize,
    cascade,
    first_pattern,
    first_term,
    keyword_query,
    override_members,
    relevance,
    text_of,
)
from sparkwatch.functions.text import prefix
from sparkwatch.operators import match_patterns, match_substrings, match_terms
from sparkwatch.sources import load_lexicon

from .registry import query, table

# Terms chosen from the invented vocabulary of the documents, in priority order. Some contain others
# ("the" in "from the"), some occur only inside words ("tb"), and one never occurs.
TERMS = ("tb", "from that", "inoran", "hehely", "orre", "rewh", "thatin", "von", "the", "plague")
WORD_TERMS = ("orantion", "from that", "hehely", "ononst", "inoran", "of the", "rewh", "von", "the", "plague")

WORD = r"(^|[^\p{{L}}\p{{N}}]){}([^\p{{L}}\p{{N}}]|$)"


def sql_contains(text: str, term: str) -> str:
    return f"contains(lower({text}), '{term}')"


def sql_word(text: str, term: str) -> str:
    return f"regexp_matches(lower({text}), '{WORD.format(term)}')"


def sql_any(text: str, terms, test) -> str:
    return "(" + " OR ".join(test(text, t) for t in terms) + ")"


def sql_first(text: str, terms, test) -> str:
    cases = " ".join(f"WHEN {test(text, t)} THEN '{t}'" for t in terms)
    return f"CASE {cases} END"


@query(f"SELECT doc_id, {sql_first('text', TERMS, sql_contains)} AS term FROM documents")
def lexicon_first(spark, sf):
    """Substring matching, first by priority."""
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", first_term(F.col("text"), Lexicon.of(*TERMS), "substring").alias("term"))


@query(f"SELECT doc_id, {sql_first('text', WORD_TERMS, sql_word)} AS term FROM documents")
def lexicon_first_word(spark, sf):
    """Word matching, first by priority."""
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", first_term(F.col("text"), Lexicon.of(*WORD_TERMS), "word").alias("term"))


def _first_words(spark, sf):
    """A lexicon that grows with the data: the first word of every benchmark text, ranked by its first item."""
    first = F.regexp_extract(F.lower("text"), r"^[^\p{L}\p{N}]*([\p{L}\p{N}]+)", 1)
    words = table(spark, sf, "benchmark").select(first.alias("term"), F.col("item_id").alias("priority"))
    return words.filter("term <> ''")


@query(
    r"""WITH lex AS (
         SELECT term, min(item_id) AS priority FROM (
           SELECT regexp_extract(lower(text), '^[^\p{L}\p{N}]*([\p{L}\p{N}]+)', 1) AS term, item_id FROM benchmark)
         WHERE term <> '' GROUP BY term),
       words AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents)
       SELECT doc_id, arg_min(term, priority) AS term, min(priority) AS priority
       FROM words JOIN lex USING (term) GROUP BY doc_id"""
)
def lexicon_table(spark, sf):
    """Word matching against a lexicon table by joining word n-grams."""
    return match_terms(table(spark, sf, "documents"), "doc_id", "text", _first_words(spark, sf), max_words=1)


@query(
    r"""WITH lex AS (
         SELECT regexp_extract(lower(text), '[\p{L}\p{N}]+ [\p{L}\p{N}]+ [\p{L}\p{N}]+') AS term, min(item_id) AS priority
         FROM benchmark GROUP BY 1 HAVING term <> ''),
       cut AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w,
                      regexp_split_to_array(lower(text), '[\p{L}\p{N}]+') AS gap FROM documents),
       grams AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 1),
                   lambda i: w[i] || gap[i + 1] || w[i + 1] || gap[i + 2] || w[i + 2])) AS term FROM cut)
       SELECT doc_id, arg_min(term, priority) AS term, min(priority) AS priority FROM grams JOIN lex USING (term) GROUP BY doc_id"""
)
def lexicon_table_phrases(spark, sf):
    """Phrases of three words, the first ones of the benchmark texts, anchored by their first words."""
    phrase = F.regexp_extract(F.lower("text"), r"[\p{L}\p{N}]+ [\p{L}\p{N}]+ [\p{L}\p{N}]+", 0)
    phrases = table(spark, sf, "benchmark").select(phrase.alias("term"), F.col("item_id").alias("priority"))
    return match_terms(table(spark, sf, "documents"), "doc_id", "text", phrases, max_words=3)


@query(
    r"""WITH lex AS (
         SELECT term, min(priority) AS priority FROM (
           SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]{9,}')) AS term, conv_id * 100 + turn AS priority FROM conversations)
         GROUP BY term),
       words AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS word FROM documents),
       inner_terms AS (SELECT word, term, priority FROM (SELECT DISTINCT word FROM words WHERE length(word) >= 9) JOIN lex ON contains(word, term))
       SELECT doc_id, min(struct_pack(p := priority, t := term)).t AS term, min(priority) AS priority
       FROM words JOIN inner_terms USING (word) GROUP BY doc_id"""
)
def lexicon_table_substring(spark, sf):
    """The longer words of all conversations as a lexicon table, in order of their first turn, searched for also inside words."""
    turns = table(spark, sf, "conversations")
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]{9,})"), F.lit(1)))
    lexicon = turns.select(words.alias("term"), (F.col("conv_id") * 100 + F.col("turn")).alias("priority"))
    return match_substrings(table(spark, sf, "documents"), "doc_id", "text", lexicon)


@query(
    r"""WITH patterns AS (
         SELECT DISTINCT unnest(list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
                                            list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS pattern
         FROM (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}]{3,}') AS w FROM benchmark)),
       cut AS (SELECT doc_id, regexp_extract_all(low, '[\p{L}\p{N}]+') AS w, regexp_split_to_array(low, '[\p{L}\p{N}]+') AS gap
               FROM (SELECT doc_id, regexp_replace(lower(text), '\s+', ' ', 'g') AS low FROM documents)),
       grams AS (
         SELECT doc_id, i - 1 AS start, w[i] || gap[i + 1] || w[i + 1] AS pattern FROM (SELECT *, unnest(range(1, len(w))) AS i FROM cut)
         UNION ALL
         SELECT doc_id, i - 1, w[i] || gap[i + 1] || w[i + 1] || gap[i + 2] || w[i + 2] FROM (SELECT *, unnest(range(1, len(w) - 1)) AS i FROM cut))
       SELECT doc_id, pattern FROM grams JOIN patterns USING (pattern)
       QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY start, length(pattern) DESC) = 1"""
)
def pattern_table(spark, sf):
    """All runs of two and three longer words of the benchmark texts as a table of token patterns: earliest, then longest."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}]{3,})"), F.lit(1))
    items = table(spark, sf, "benchmark").select(w.alias("w")).filter("size(w) > 1")
    runs = F.flatten(
        F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.array(*[F.array_join(F.slice("w", i, F.lit(n)), " ") for n in (2, 3)]))
    )
    # runs cut short by the end of a text are one word, or pairs again
    patterns = items.select(F.explode(runs).alias("term")).filter("contains(term, ' ')")
    return match_patterns(table(spark, sf, "documents"), "doc_id", "text", patterns)


@query(
    """WITH lex AS (SELECT DISTINCT lang AS term, ascii(lang) * 1000 + ascii(substr(lang, 2)) AS priority FROM documents),
       words AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS term FROM documents),
       hits AS (SELECT doc_id, arg_min(term, priority) AS term FROM words JOIN lex USING (term) GROUP BY doc_id)
       SELECT doc_id, term FROM documents LEFT JOIN hits USING (doc_id)"""
)
def lexicon_loaded(spark, sf):
    """A lexicon table read into one expression: the language codes, some of which are words as well."""
    docs = table(spark, sf, "documents")
    codes = docs.select(
        F.col("lang").alias("term"), (F.ascii("lang") * 1000 + F.ascii(F.substring("lang", 2, 1))).alias("priority")
    )
    return docs.select("doc_id", first_term(F.col("text"), load_lexicon(codes.distinct())).alias("term"))


PATTERNS = (
    Pattern(("of", "the"), "PHRASE"),
    Pattern(("the",), "WORD"),
    Pattern(("of",), "WORD"),
    Pattern(("in", "the"), "PHRASE"),
    Pattern(("from", "that"), "PHRASE"),
    Pattern(("to", "be"), "PHRASE"),
    Pattern(("und",), "WORD"),
)


def sql_pattern(text: str, label: str) -> str:
    tokens = sorted((p.tokens for p in PATTERNS if p.label == label), key=lambda t: (-len(" ".join(t)), t))
    alternatives = "|".join(r"\s+".join(t) for t in tokens)
    found = rf"regexp_extract(lower({text}), '(?:^|[^\p{{L}}\p{{N}}])({alternatives})(?:[^\p{{L}}\p{{N}}]|$)', 1)"
    return rf"nullif(regexp_replace({found}, '\s+', ' ', 'g'), '')"


@query(
    f"SELECT doc_id, {sql_pattern('text', 'PHRASE')} AS phrase, {sql_pattern('text', 'WORD')} AS word FROM documents",
    name="pattern_first",
)
def earliest_pattern(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        first_pattern(text, PATTERNS, "PHRASE").alias("phrase"),
        first_pattern(text, PATTERNS, "WORD").alias("word"),
    )


@query(f"SELECT doc_id, md5(substr(text, 1, 500)) AS prefix_md5, {sql_pattern('substr(text, 1, 500)', 'WORD')} AS word FROM documents")
def text_prefix(spark, sf):
    """The first 500 characters, and the earliest pattern in them, as a matcher with a bounded window sees a text."""
    text = F.col("text")
    found = first_pattern(text, PATTERNS, "WORD", limit=500)
    return table(spark, sf, "documents").select("doc_id", F.md5(prefix(text, 500)).alias("prefix_md5"), found.alias("word"))


CASCADE_TERMS = ("orantion", "hehely", "rewh", "von")


@query(
    f"""SELECT doc_id, coalesce({sql_first('text', CASCADE_TERMS, sql_word)}, {sql_pattern('text', 'PHRASE')},
                                {sql_first('text', ('und', 'que', 'zz'), sql_contains)}) AS entity
        FROM documents"""
)
def entity_cascade(spark, sf):
    """Terms, else patterns, else a matcher of the caller's own."""
    text = F.col("text")
    found = cascade(
        first_term(text, Lexicon.of("orantion", "hehely") + Lexicon.of("rewh", "von")),
        first_pattern(text, PATTERNS, "PHRASE"),
        first_term(text, ("und", "que", "zz"), "substring"),
    )
    return table(spark, sf, "documents").select("doc_id", found.alias("entity"))


MAPPING = {"small ring": "RING, SMALL", "Red Widget": "WIDGET, RED", "hot bolt": "BOLT, HOT"}
MEMBERS = ("OLD GEAR", "NEW GEAR", "BLUE GEAR")


@query(
    """SELECT p_partkey, CASE WHEN upper(p_name) IN ('OLD GEAR', 'NEW GEAR', 'BLUE GEAR') THEN 'GEARS'
                              WHEN p_name = 'small ring' THEN 'RING, SMALL'
                              WHEN p_name = 'red widget' THEN 'WIDGET, RED'
                              WHEN p_name = 'hot bolt' THEN 'BOLT, HOT'
                              ELSE upper(p_name) END AS canonical
       FROM part""",
    name="canonicalize",
)
def canonical_names(spark, sf):
    name = F.concat(F.lit("\t"), F.initcap("p_name"), F.lit(" \n"))
    named = override_members(name, MEMBERS, "GEARS", otherwise=canonicalize(name, MAPPING))
    return table(spark, sf, "part").select("p_partkey", named.alias("canonical"))


EXCLUDED = ("inoran", "orre", "que")
GROUPS = (("the", "von", "und"), ("of the", "tion", "der"))


def _relevance_sql(test) -> str:
    groups = " AND ".join(sql_any("text", g, test) for g in GROUPS)
    return f"NOT {sql_any('text', EXCLUDED, test)} AND {groups}"


@query(
    f"SELECT doc_id, {_relevance_sql(sql_word)} AS by_word, {_relevance_sql(sql_contains)} AS by_substring FROM documents",
    name="relevance",
)
def relevant_texts(spark, sf):
    text = text_of("text")
    return table(spark, sf, "documents").select(
        "doc_id",
        relevance(text, EXCLUDED, GROUPS, "word").alias("by_word"),
        relevance(text, EXCLUDED, GROUPS, "substring").alias("by_substring"),
    )


QUERY = (("the", "und", "des"), ("ing", "ment", "lich"))


@query(
    f"""SELECT conv_id, turn, role FROM conversations
        WHERE {sql_any('text', QUERY[0], sql_contains)} AND {sql_any('text', QUERY[1], sql_contains)}""",
    name="keyword_query",
)
def keyword_filter(spark, sf):
    talks = table(spark, sf, "conversations")
    return talks.filter(keyword_query(F.col("text"), QUERY)).select("conv_id", "turn", "role")

"""Term and pattern matching against lexicons held as tables, for lexicons too large for one expression.

Texts never move. What a lexicon anchors its terms by is looked for where a text lies, only places with an anchor are
extended or verified there, and only hits are shuffled:

* words (``match_terms``) and token patterns (``match_patterns``): a term is anchored by its first word. From a
  place whose word begins a term, the n-grams with the lengths of such terms are cut, and no others;
* substrings (``match_substrings``): a term is anchored by the one of its character q-grams that the fewest words (or texts)
  hold. A term with a q-gram that none holds is left out beforehand; the others are verified where their anchor is.

Lexicons are broadcast in parts of a measured size, or joined by ``join_dim``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.matching import WORD_CHAR
from ..functions.text import strip_ws
from ..session import ensure_checkpoint_dir
from .columns import computed_once
from .joins import BROADCAST_BYTES, BROADCAST_ROWS, auto_broadcast_bytes, estimated_bytes, fits_broadcast, join_dim, measured_size

# up to this many first words are put into the expression that looks for them; beyond that every word is joined with them
INLINE_HEADS = 10_000
PARTS = r"[\p{L}\p{N}]++|[^\p{L}\p{N}]++"
GRAM = 3  # characters of an anchor; shorter terms are anchored by themselves
# the same for terms within one word, the longest that fits: there are so few grams of three letters that words and terms
# which share one grow with the square of the data
WORD_GRAMS = (8, 5)


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD_CHAR}+)"), F.lit(1))


def lexicon_terms(lexicon: DataFrame, keep: Sequence[str], text: Column | None = None) -> DataFrame:
    """(gram, priority, *keep): stripped and lower-cased terms, a repeated term at its best row only."""
    named = F.lower(strip_ws("term")) if text is None else text
    best_row = F.min(F.struct("priority", *[F.col(c) for c in keep])).alias("best")
    rows = lexicon.select(named.alias("gram"), "priority", *keep).filter("gram <> ''")
    return rows.groupBy("gram").agg(best_row).select("gram", "best.*")


def shaped(terms: DataFrame) -> DataFrame:
    """Add the first word of each term and its number of words; terms without a word can't be anchored and go."""
    words = word_list(F.col("gram"))
    return terms.withColumns({"head": F.get(words, F.lit(0)), "n": F.size(words)}).filter("head IS NOT NULL")


def anchored_grams(df: DataFrame, id_col: str, text: Column, terms: DataFrame, inline: int = INLINE_HEADS) -> DataFrame:
    """(id, start, gram): runs of words, with what stands between them, that begin and are as long as some term does.

    ``terms`` has head and n. ``start`` grows with the place in the text.
    """
    heads = terms.groupBy("head").agg(F.collect_set("n").alias("lengths"))
    known = heads.limit(inline + 1).collect()
    # words and what stands between them, by turns
    cut = computed_once(df.select(id_col, text.alias("__t")), {"__parts": F.regexp_extract_all("__t", F.lit(PARTS), F.lit(0))}).drop("__t")
    if not known:
        return cut.select(id_col, F.lit(0).alias("start"), F.lit("").alias("gram")).filter(F.lit(False))

    def gram(parts: Column, start: Column | int, n: int) -> Column:
        return F.array_join(F.slice(parts, start + 1 if isinstance(start, Column) else start, 2 * n - 1), "")

    if len(known) <= inline:
        by_length: dict[int, list[str]] = {}
        for head, lengths in known:
            for n in lengths:
                by_length.setdefault(n, []).append(head)

        def runs(n: int, heads: list[str]) -> Column:
            # words are letters and digits, so they need no quoting
            among = ", ".join(f"'{h}'" for h in sorted(heads))
            last = 2 * n - 1
            places = F.expr(f"CASE WHEN size(__parts) >= {last} THEN filter(sequence(0, size(__parts) - {last}), i -> get(__parts, i) IN ({among})) END")
            return F.transform(places, lambda i: F.struct(i.alias("start"), gram(F.col("__parts"), i, n).alias("gram")))

        none = F.array().cast("array<struct<start:int,gram:string>>")
        found = F.concat(*[F.coalesce(runs(n, heads), none) for n, heads in sorted(by_length.items())])
        return cut.select(id_col, F.inline(found))
    longest = max(n for n, in terms.select("n").distinct().collect())
    tail = F.transform("__parts", lambda w, i: F.struct(i.alias("start"), w.alias("head"), F.slice("__parts", i + 1, 2 * longest - 1).alias("tail")))
    places = cut.select(id_col, F.inline(tail)).filter(F.col("head").rlike(f"^{WORD_CHAR}"))
    begun = join_dim(places, heads, ["head"], derived=True, costly=True)
    cuts = [F.when(F.array_contains("lengths", n) & (F.size("tail") >= 2 * n - 1), gram(F.col("tail"), 1, n)) for n in range(1, longest + 1)]
    return begun.select(id_col, "start", F.explode(F.array_compact(F.array(*cuts))).alias("gram"))


def match_terms(
    df: DataFrame, id_col: str, text_col: str, lexicon: DataFrame, max_words: int, keep: Sequence[str] = ()
) -> DataFrame:
    """(id, term, priority, *keep): for each document with a hit, the term that comes first in the lexicon.

    ``lexicon`` has ``term`` and ``priority``; terms start and end with a letter or digit and have at most
    ``max_words`` words. Whole words only (``match_substrings`` has the other mode). The winner is the same as that
    of ``first_term`` in word mode. ``keep`` names further columns of the lexicon, taken from the term's best row.
    """
    terms = lexicon_terms(lexicon, keep)
    lowered = F.lower(F.col(text_col))
    if max_words == 1:
        grams = df.select(id_col, F.explode(F.array_distinct(word_list(lowered))).alias("gram"))
        if estimated_bytes(terms) <= auto_broadcast_bytes(terms):
            return first_hits(grams.join(terms, "gram"), id_col, keep)
        ensure_checkpoint_dir(df.sparkSession)
        terms = terms.checkpoint()
    else:
        ensure_checkpoint_dir(df.sparkSession)
        terms = shaped(terms).filter(F.col("n") <= max_words).checkpoint()
        grams = anchored_grams(df, id_col, lowered, terms).drop("start")
        terms = terms.drop("head", "n")
    if fits_broadcast(terms):
        return first_hits(grams.join(F.broadcast(terms), "gram"), id_col, keep)
    # the vocabulary of the texts meets the lexicon first, once per distinct n-gram; most terms occur nowhere
    terms = grams.select("gram").distinct().join(terms, "gram").checkpoint()
    return first_hits(join_dim(grams, terms, ["gram"], costly=True), id_col, keep)


def first_hits(hits: DataFrame, id_col: str, keep: Sequence[str]) -> DataFrame:
    """Of the hits (id, gram, priority, *keep) the one that comes first in the lexicon, per document."""
    best = hits.groupBy(id_col).agg(F.min(F.struct("priority", "gram", *keep)).alias("b"))
    return best.select(id_col, F.col("b.gram").alias("term"), F.col("b.priority").alias("priority"), *[F.col(f"b.{c}") for c in keep])


def char_grams(text: Column, q: int) -> Column:
    """The distinct runs of q characters; one pass over the text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{q}}}))"), F.lit(1)))


def match_substrings(
    df: DataFrame,
    id_col: str,
    text_col: str,
    lexicon: DataFrame,
    keep: Sequence[str] = (),
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, term, priority, *keep) like ``match_terms``, but a term may stand anywhere, also inside words.

    Any characters may be in a term. The winner is that of ``first_term`` in substring mode. A term of letters and digits
    stands inside one word, so each distinct word of the texts is searched once and the texts are joined with what was
    found in their words; other terms are searched for in the texts. Anchors are broadcast in parts of at most
    ``max_rows`` and ``max_bytes``, with one pass over words or texts for each part.
    """
    ensure_checkpoint_dir(df.sparkSession)
    inner, length = F.col("gram").rlike(f"^{WORD_CHAR}+$"), F.char_length("gram")
    longer = [F.when(inner & (length >= q), q) for q in WORD_GRAMS]
    shape = {"q": F.coalesce(*longer, F.least(length, F.lit(GRAM))), "inner": inner}
    terms = lexicon_terms(lexicon, keep).withColumns(shape).checkpoint()
    kinds = terms.select("inner", "q").distinct().collect()
    found = []
    if sizes := [q for inner, q in kinds if inner]:
        words = df.select(id_col, F.explode(F.array_distinct(word_list(F.lower(F.col(text_col))))).alias("__word"))
        vocabulary = words.select(F.col("__word").alias("__id"), F.col("__word").alias("__low")).distinct().checkpoint()
        hits = _anchored_hits(vocabulary, terms.filter("inner"), sizes, keep, max_rows, max_bytes)
        best = first_hits(hits, "__id", keep).withColumnsRenamed({"__id": "__word", "term": "gram"})
        found.append(join_dim(words, best, ["__word"], derived=True, costly=True).drop("__word"))
    if sizes := [q for inner, q in kinds if not inner]:
        texts = df.select(F.col(id_col).alias("__id"), F.lower(F.col(text_col)).alias("__low"))
        hits = _anchored_hits(texts, terms.filter("NOT inner"), sizes, keep, max_rows, max_bytes)
        found.append(hits.withColumnRenamed("__id", id_col))
    if not found:  # an empty lexicon
        columns = [F.lit(None).cast(terms.schema[c].dataType).alias(c) for c in ("gram", "priority", *keep)]
        found = [df.select(id_col, *columns).filter(F.lit(False))]
    return first_hits(reduce(DataFrame.unionByName, found), id_col, keep)


def _anchored_hits(
    texts: DataFrame, terms: DataFrame, sizes: Sequence[int], keep: Sequence[str], max_rows: int, max_bytes: int
) -> DataFrame:
    """(__id, gram, priority, *keep): every term in every text, given as (__id, __low)."""
    held = computed_once(texts, {"__grams": F.concat(F.array().cast("array<string>"), *[char_grams(F.col("__low"), q) for q in sizes])})
    probes = held.select("__id", "__low", F.explode("__grams").alias("anchor"))

    # how many texts hold each q-gram; a term is anchored by its rarest one, and can't occur if one of them is nowhere
    counts = probes.groupBy("anchor").agg(F.count(F.lit(1)).alias("texts"))
    own = F.when(F.lit(False), F.array().cast("array<string>"))
    for q in sizes:
        own = own.when(F.col("q") == q, char_grams(F.col("gram"), q))
    parts = terms.select("gram", "priority", *keep, F.explode(own).alias("anchor"))
    rarest = (
        parts.join(counts, "anchor", "left")
        .groupBy("gram")
        .agg(
            F.min(F.struct("texts", "anchor"))["anchor"].alias("anchor"),
            F.bool_and(F.col("texts").isNotNull()).alias("possible"),
            F.first(F.struct("priority", *keep)).alias("row"),
        )
    )
    anchored = rarest.filter("possible").select("gram", "anchor", "row.*").checkpoint()
    n, volume = measured_size(anchored)
    slices = max(1, -(-n // max_rows), -(-volume // max_bytes))
    hits = []
    for s in range(slices):
        part = anchored if slices == 1 else anchored.filter(F.pmod(F.xxhash64("gram"), F.lit(slices)) == s)
        # the term is verified where the text lies
        hits.append(probes.join(F.broadcast(part), "anchor").filter(F.contains("__low", "gram")).drop("__low", "anchor"))
    return reduce(DataFrame.unionByName, hits)


def match_patterns(
    df: DataFrame,
    id_col: str,
    text_col: str,
    patterns: DataFrame,
    label: str | None = None,
    limit: int | None = None,
    inline: int = INLINE_HEADS,
) -> DataFrame:
    """(id, pattern): the earliest token pattern in each text, the longest where two start together.

    ``patterns`` has ``term``, tokens separated by spaces that start and end with a letter or digit, and ``label`` if one is asked for.
    Between tokens any whitespace may stand. The winner is that of ``first_pattern``.
    """
    chosen = patterns if label is None else patterns.filter(F.col("label") == label)
    spaced = F.btrim(F.regexp_replace(F.lower("term"), r"\s+", " "))
    ensure_checkpoint_dir(df.sparkSession)
    terms = shaped(lexicon_terms(chosen.withColumn("priority", F.lit(0)), [], spaced)).checkpoint()
    searched = F.col(text_col) if limit is None else F.substring(text_col, 1, limit)
    text = F.regexp_replace(F.lower(searched), r"\s+", " ")
    grams = anchored_grams(df, id_col, text, terms, inline)
    hits = join_dim(grams, terms.select("gram"), ["gram"], costly=True)
    best = hits.groupBy(id_col).agg(F.min(F.struct("start", F.negative(F.char_length("gram")).alias("n"), "gram")).alias("b"))
    return best.select(id_col, F.col("b.gram").alias("pattern"))

import datetime as dt
import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkwatch.functions import (
    Lexicon,
    Pattern,
    Term,
    any_term,
    canonicalize,
    cascade,
    first_pattern,
    first_term,
    fold_accents,
    hash_key,
    keyword_query,
    normalize_name,
    override_members,
    parse_ts,
    prefix,
    relevance,
    strip_ws,
    text_of,
    ts_was_imputed,
    year_month,
)
from sparkwatch.functions import matching
from sparkwatch.functions.text import WHITESPACE


def values(spark, texts, *exprs):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    out = [tuple(r)[1:] for r in df.select("i", *exprs).orderBy("i").collect()]
    return [r[0] for r in out] if len(exprs) == 1 else out


def test_strip_ws_removes_all_whitespace_and_trim_only_spaces(spark):
    got = values(spark, [" \t a b\n ", " x ", None], strip_ws("t"), F.trim("t"))
    assert got == [("a b", "\t a b\n"), ("x", " x "), (None, None)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(alphabet="a é\t\n\x1f\x85\xa0\u2003\u3000\u200b", max_size=8), min_size=1, max_size=30))
def test_strip_ws_strips_what_python_strips(spark, texts):
    assert values(spark, texts, strip_ws("t")) == [t.strip() for t in texts]


def test_whitespace_is_complete():
    import sys

    assert set(WHITESPACE) == {chr(c) for c in range(sys.maxunicode) if chr(c).isspace()}


def test_text_of_keeps_the_separator(spark):
    df = spark.createDataFrame([("a", None), (None, "b"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(text_of("x", "y")).collect()] == ["a ", " b", " "]


def test_prefix_counts_characters(spark):
    assert values(spark, ["é" * 600], F.length(prefix("t"))) == [500]


def test_normalize_name(spark):
    names = ["Côte  d'Ivoire (x)-y", None, "  Guinea-Bissau\t", "NATION_3"]
    assert values(spark, names, normalize_name("t")) == ["C TE D'IVOIRE X -Y", "", "GUINEA-BISSAU", "NATION 3"]
    assert values(spark, names[:1], normalize_name("t", fold=True)) == ["COTE D'IVOIRE X -Y"]
    assert values(spark, ["çé"], fold_accents("t")) == ["CE"]


def test_hash_key_formulas(spark):
    df = spark.createDataFrame([("YEM", " Cholera ", None, 2026)], "a string, b string, c string, d int")
    got = df.select(
        hash_key("a"), hash_key("b", normalize=True), hash_key(["a", "b", "c", "d"])
    ).first()
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    assert tuple(got) == (md5("YEM"), md5("cholera"), md5("YEM_ Cholera _2026"))


@pytest.mark.parametrize(
    "text, expected, imputed",
    [
        ("2024-01-05T10:00:00Z", dt.datetime(2024, 1, 5, 10), False),
        ("2024-01-05 10:00:00", dt.datetime(2024, 1, 5, 10), False),
        ("2024-01-05T10:00:00+02:00", dt.datetime(2024, 1, 5, 8), False),
        ("2024-01-05T10:00:00.250Z", dt.datetime(2024, 1, 5, 10, 0, 0, 250000), False),
        ("2024-01-05", dt.datetime(2024, 1, 5), False),
        ("zz", dt.datetime(2030, 1, 1), True),
        ("2024-13-45T10:00:00Z", dt.datetime(2030, 1, 1), True),
        ("2024", dt.datetime(2030, 1, 1), True),
        (None, dt.datetime(2030, 1, 1), True),
    ],
)
def test_parse_ts(spark, text, expected, imputed):
    got = values(spark, [text], parse_ts("t", "2030-01-01 00:00:00"), ts_was_imputed("t"))[0]
    assert (got[0].replace(tzinfo=None), got[1]) == (expected, imputed)


def test_year_month(spark):
    df = spark.sql("select timestamp'2024-03-09 00:00:00' as t")
    assert df.select(year_month("t")).first()[0] == 202403


# --- matching -----------------------------------------------------------------------------------------


def test_substring_mode_hits_inside_words_and_word_mode_does_not(spark):
    lex = Lexicon.of("tb", "ukraine")
    assert values(spark, ["outbreak reported"], first_term(F.col("t"), lex, "substring")) == ["tb"]
    assert values(spark, ["outbreak reported"], first_term(F.col("t"), lex, "word")) == [None]


def test_list_order_decides_in_substring_mode(spark):
    lex = Lexicon.of("uk", "ukraine")
    both = values(
        spark, ["War in Ukraine"], first_term(F.col("t"), lex, "substring"), first_term(F.col("t"), lex, "word")
    )
    assert both == [("uk", "ukraine")]


def test_word_mode_finds_a_low_ranked_longer_term_and_a_high_ranked_beginning(spark):
    lex = Lexicon.of("ebola disease", "ebola", "polio", "poliomyelitis")
    texts = ["Ebola disease", "ebola diseases", "poliomyelitis", "polio and poliomyelitis", "covid"]
    assert values(spark, texts, first_term(F.col("t"), lex)) == [
        "ebola disease", "ebola", "poliomyelitis", "polio", None,
    ]


def test_word_boundaries_are_unicode(spark):
    assert values(spark, ["étb", "tb.", "tb1", "(TB)"], first_term(F.col("t"), ["tb"])) == [None, "tb", None, "tb"]


def test_lexicon_lowers_dedups_and_concatenates():
    lex = Lexicon([Term("WHO", 1), Term("who", 0), Term("Flu", 2, "INFLUENZA")])
    assert lex.words == ["who", "flu"] and lex.mapping == {"flu": "INFLUENZA"}
    joined = Lexicon.of("a", "b") + Lexicon.of("c", "a")
    assert joined.words == ["a", "b", "c"]
    same = [Term("virus", 0), Term("nipah virus", 0)]
    assert Lexicon(same, longest_first=True).words == ["nipah virus", "virus"]


def brute_first(text, terms, match):
    for t in terms:
        start = 0
        while (at := text.find(t, start)) >= 0:
            before = text[at - 1] if at else " "
            after = text[at + len(t)] if at + len(t) < len(text) else " "
            if match == "substring" or not (before.isalnum() or after.isalnum()):
                return t
            start = at + 1
    return None


alphabet = st.text(alphabet="ab .", min_size=0, max_size=12)
term = st.text(alphabet="ab. ", min_size=1, max_size=4).map(str.strip).filter(bool)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(alphabet, min_size=1, max_size=25), terms=st.lists(term, min_size=1, max_size=8, unique=True))
def test_matching_equals_brute_force(spark, texts, terms):
    for match in ("word", "substring"):
        got = values(spark, texts, first_term(F.col("t"), terms, match), any_term(F.col("t"), terms, match))
        expected = [brute_first(t, terms, match) for t in texts]
        assert [g[0] for g in got] == expected
        assert [g[1] for g in got] == [e is not None for e in expected]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(alphabet, min_size=1, max_size=25), terms=st.lists(term, min_size=1, max_size=8, unique=True))
def test_large_lexicons_take_the_expression_path_with_the_same_result(spark, texts, terms):
    limit, matching.SCAN_TERMS = matching.SCAN_TERMS, 0
    try:
        got = values(spark, texts, first_term(F.col("t"), terms, "substring"), any_term(F.col("t"), terms, "substring"))
    finally:
        matching.SCAN_TERMS = limit
    expected = [brute_first(t, terms, "substring") for t in texts]
    assert got == [(e, e is not None) for e in expected]


def test_first_pattern_by_position_then_length(spark):
    patterns = [
        Pattern(("fever",), "D"), Pattern(("dengue", "fever"), "D"), Pattern(("dengue",), "D"),
        Pattern(("south", "sudan"), "C"), Pattern(("e.", "coli"), "D"),
    ]
    texts = ["fever, then dengue", "Dengue \n FEVER", "dengues", "South  Sudan", "E. coli found", None]
    assert values(spark, texts, first_pattern(F.col("t"), patterns, "D")) == [
        "fever", "dengue fever", None, None, "e. coli", None,
    ]
    assert values(spark, texts[3:4], first_pattern(F.col("t"), patterns, "C")) == ["south sudan"]


def test_first_pattern_limit_and_whole_text(spark):
    late = "x" * 500 + " dengue"
    patterns = [Pattern(("dengue",), "D")]
    both = values(spark, [late], first_pattern(F.col("t"), patterns), first_pattern(F.col("t"), patterns, limit=500))
    assert both == [("dengue", None)]


def test_canonicalize_and_members(spark):
    mapping = {"DRC": "DEMOCRATIC REPUBLIC OF CONGO", "uk": "UNITED KINGDOM"}
    term = F.col("t")
    named = override_members(term, ["Texas", "OHIO"], "UNITED STATES", otherwise=canonicalize(term, mapping))
    texts = [" drc ", "UK", "Lagos\n", "texas", None]
    assert values(spark, texts, named) == ["DEMOCRATIC REPUBLIC OF CONGO", "UNITED KINGDOM", "LAGOS", "UNITED STATES", None]
    assert values(spark, ["x"], override_members(term, ["Y"], "Z")) == ["x"]


def test_cascade_takes_any_column_matcher(spark):
    import pandas as pd

    @F.pandas_udf("string")
    def last_word(s: pd.Series) -> pd.Series:
        return s.str.split().str[-1]

    found = cascade(first_term(F.col("t"), ["flu"]), last_word(F.col("t")))
    assert values(spark, ["the flu here", "some where"], found) == ["flu", "where"]


def test_keyword_query_and_relevance(spark):
    texts = ["outbreak of virus", "outbreak", "early warning outbreak virus", None]
    assert values(spark, texts[:3], keyword_query(F.col("t"), [["outbreak", "epidemic"], ["virus"]])) == [True, False, True]
    text = text_of("t")
    by_word = relevance(text, ["war"], [["virus"], ["outbreak"]], "word")
    by_substring = relevance(text, ["war"], [["virus"], ["outbreak"]], "substring")
    assert values(spark, texts, by_word, by_substring) == [(True, True), (False, False), (True, False), (False, False)]


def test_capital_terms_match_lower_text(spark):
    assert values(spark, ["who says"], any_term(F.col("t"), ["WHO"])) == [True]


def test_unknown_mode_is_rejected(spark):
    with pytest.raises(ValueError):
        first_term(F.col("t"), ["a"], "fuzzy")

"""Lexicons held as tables against the expressions and plain Python, at sizes that no expression takes."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparkwatch.functions import Lexicon, Pattern, first_pattern, first_term
from sparkwatch.operators import lexicon_join, match_patterns, match_substrings, match_terms
from sparkwatch.operators.alerts import EntityRules, extract_entities

from helpers import rows

SYLLABLES = ("ka", "lo", "mi", "tu", "re", "so", "na", "pe", "zü", "qi")


def word(rng):
    return "".join(rng.choices(SYLLABLES, k=rng.randint(1, 4)))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    out = [rng.choice((" ", "  ", "\n", ", ")).join(word(rng) for _ in range(rng.randint(0, 40))) for _ in range(120)]
    return [*out, "", None, "KALO-mi. Re so", "a", "...", "ka\tlo ka  lo", "x" * 5_000 + "kalo"]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "i int, t string, priority int, q int").repartition(3)


def test_substring_table_equals_the_expression(spark, docs, texts):
    """20,001 terms, some of one or two characters, with spaces, hyphens or inside words; most occur nowhere."""
    rng = random.Random(6)
    terms = [f"{word(rng)}{rng.choice(('', '', ' ', '-'))}{word(rng)}{rng.choice('xyz')}" for _ in range(60_000)]
    terms = list(dict.fromkeys([*terms, "kalom", "qiqire", "lo-mi", "a", "so na", "pe", ". re", "zün", "x" * 40]))[-20_001:]
    rng.shuffle(terms)
    lexicon = spark.createDataFrame(list(zip(terms, range(len(terms)))), "term string, priority int")
    expected = {(i, next((t for t in terms if t in (x or "").lower()), None)) for i, x in enumerate(texts)}
    expected = {e for e in expected if e[1]}
    assert {(r["i"], r["term"]) for r in match_substrings(docs, "i", "t", lexicon).collect()} == expected
    assert len(expected) > 60
    # in parts that are broadcast one after the other
    assert {(r["i"], r["term"]) for r in match_substrings(docs, "i", "t", lexicon.filter("priority < 300"), max_rows=7).collect()} == {
        (i, t) for i, x in enumerate(texts) if (t := next((t for t in terms[:300] if t in (x or "").lower()), None))
    }


def test_longer_terms_in_words_are_anchored_by_longer_grams(spark, monkeypatch):
    """Words and terms that share short grams only are not brought together."""
    sizes = set()
    cut = lexicon_join.char_grams
    monkeypatch.setattr(lexicon_join, "char_grams", lambda text, q: (sizes.add(q), cut(text, q))[1])
    found = spark.createDataFrame([(0, "xabcdefghiy abcdefgh"), (1, "zabcdefz abcdxefgh"), (2, "vabcdv")], "i int, t string")
    lexicon = spark.createDataFrame([("abcdefghi", 0), ("abcdef", 1), ("abc", 2)], "term string, priority int")
    hits = {(r["i"], r["term"]) for r in match_substrings(found, "i", "t", lexicon).collect()}
    assert hits == {(0, "abcdefghi"), (1, "abcdef"), (2, "abc")}
    assert sizes == {8, 5, 3}


def test_substring_table_equals_first_term(spark, docs):
    terms = ["miso", "o ka", "qi", "TUre ", "nana", "lo", "kalo"]
    lexicon = spark.createDataFrame(list(zip([*terms, " "], [3, 1, 2, 2, 0, 9, 9, 0])), "term string, priority int")
    order = [t for _, t in sorted(zip([3, 1, 2, 2, 0, 9, 9], [t.strip().lower() for t in terms]))]
    expected = docs.select("i", first_term(F.col("t"), Lexicon.of(*order), "substring").alias("term")).filter("term IS NOT NULL")
    assert rows(match_substrings(docs, "i", "t", lexicon).select("i", "term")) == rows(expected)
    assert match_substrings(docs, "i", "t", lexicon.limit(0)).collect() == []


@pytest.mark.parametrize("inline", [10_000, 0])
def test_pattern_table_equals_first_pattern(spark, docs, inline):
    """5,000 patterns of one to four tokens; ``inline`` 0 joins the first words instead."""
    rng = random.Random(9)
    patterns = {" ".join(word(rng) for _ in range(rng.randint(1, 4))) for _ in range(5_000)}
    chosen = sorted(p for p in patterns if " " in p)
    table = spark.createDataFrame([(p.title().replace(" ", "  "), "A") for p in chosen] + [("ka", "B")], "term string, label string")
    got = match_patterns(docs, "i", "t", table, "A", inline=inline)
    few = [p for p in chosen if all(len(w) == 2 for w in p.split()[:2])][:400]
    expected = docs.select("i", first_pattern(F.col("t"), [Pattern(tuple(p.split()), "A") for p in chosen]).alias("p")).filter("p IS NOT NULL")
    assert rows(got) == rows(expected) and few


def test_pattern_table_with_a_limit(spark, docs):
    table = spark.createDataFrame([("ka lo", "A"), ("re so", "A"), ("lo", "A"), ("kalo", "A")], "term string, label string")
    patterns = [Pattern(tuple(t.split()), "A") for t in ("ka lo", "re so", "lo", "kalo")]
    expected = docs.select("i", first_pattern(F.col("t"), patterns, limit=20).alias("p")).filter("p IS NOT NULL")
    assert rows(match_patterns(docs, "i", "t", table, limit=20)) == rows(expected)


def test_phrases_anchored_by_joined_heads(spark, docs, monkeypatch):
    from sparkwatch.operators import lexicon_join

    terms = [" ".join(p) for p in (("ka", "lo"), ("so", "na"), ("re",), ("mi", "tu", "re"), ("pe",))]
    lexicon = spark.createDataFrame(list(zip(terms, range(5))), "term string, priority int")
    expected = rows(match_terms(docs, "i", "t", lexicon, 3))
    anchored = lexicon_join.anchored_grams
    monkeypatch.setattr(lexicon_join, "anchored_grams", lambda *a: anchored(*a, inline=0))
    assert rows(match_terms(docs, "i", "t", lexicon, 3)) == expected and expected


def test_texts_are_not_shuffled(spark, docs):
    """Only hits, q-gram counts and terms cross an exchange."""
    lexicon = spark.createDataFrame([("so na", 0), ("ka", 1)], "term string, priority int")
    for found in (match_substrings(docs, "i", "t", lexicon), match_terms(docs, "i", "t", lexicon, 3)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        for line in plan.splitlines():
            if "Exchange hash" in line:
                assert "__low" not in line and "t#" not in line.split("hashpartitioning")[1]
        assert "BroadcastHashJoin" in plan


def test_entities_from_tables(spark, texts):
    """A lexicon matched inside words and a pattern table, instead of expressions, give the same entities."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    terms = ["nana", "miso", "lo ka", "qiqi"]
    lexicon = spark.createDataFrame([(t, i, t.upper()) for i, t in enumerate(terms)], "term string, priority int, canonical string")
    patterns = spark.createDataFrame([("ka lo", "A"), ("re so", "A")], "term string, label string")
    as_table = EntityRules.of_table(lexicon, max_terms=1, match="substring", label="A", pattern_table=patterns)
    as_expression = EntityRules(
        Lexicon.of(*terms), patterns=(Pattern(("ka", "lo"), "A"), Pattern(("re", "so"), "A")), label="A", match="substring"
    )
    text = F.coalesce("t", F.lit(""))
    got, expected = (rows(extract_entities(docs, text, {"e": r}).select("i", "e")) for r in (as_table, as_expression))
    assert got == expected and any(e for _, e in expected)

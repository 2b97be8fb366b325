"""License scans against a word-by-word search of every phrase and template, without an index."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from sparkwatch.llm import licenses

DOCS = "doc_id long, text string, id long, file string, hits int, looked string, places int, score string, t0 int"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(licenses.UPPER, licenses.LOWER)))


def brute(texts, templates=licenses.TEMPLATES, phrases=licenses.PHRASES, share=licenses.SHARE):
    files = [words(t) for t in texts]
    df = Counter(w for f in files for w in set(f))
    weight = {w: max(1, math.floor(1000 * math.log((2 * len(files) + 2) / (2 * df[w] + 1)))) for t in templates for w in t.words}
    out = []
    for f in files:
        places = sorted((label, i) for p, label in phrases.items() for i in range(len(f)) if f[i : i + len(words(p))] == words(p))
        best = {}
        for t in templates:
            total = sum(weight[w] for w in t.words)
            for o in range(-len(t.words), len(f)):
                if all(o + p >= 0 and f[o + p : o + p + len(x)] == x for p, x in t.placed):
                    got = sum(weight[w] for i, w in enumerate(t.words) if 0 <= o + i < len(f) and f[o + i] == w) / total
                    best[t] = max(best.get(t, 0), got)
        labels = sorted((t.label, round(s, 9)) for t, s in best.items() if s >= share)
        out.append((len(f), places, labels, round(max(best.values(), default=0.0), 9)))
    return out


def scanned(spark, texts, **options):
    frame = spark.createDataFrame([(i, t, 1, "f", 2, "l", 3, "s", 4) for i, t in enumerate(texts)], DOCS)
    rows = licenses.scan_licenses(frame, **options).orderBy("id").collect()
    return [
        (r["n_words"], sorted((p["label"], p["at"]) for p in r["places"]), sorted((t["label"], round(t["share"], 9)) for t in r["templates"]), round(r["score"], 9))
        for r in rows
    ]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    common = "the of a software license version public general under terms by cc and in mit apache gnu 2 0 3 copy is".split()
    out = [" ".join(rng.choices(common, k=rng.randint(1, 60))) for _ in range(120)]
    notices = [t.text for t in licenses.TEMPLATES]
    for i in range(60):  # notices whole, cut off at either side, and with one word changed
        cut = rng.choice(notices).split()
        kind = rng.randrange(3)
        cut = cut if kind == 0 else cut[rng.randint(0, 3) :] if kind == 1 else [*cut[:-2], "other", cut[-1]]
        out.append(" ".join([*rng.choices(common, k=rng.randint(0, 9)), *cut, *rng.choices(common, k=rng.randint(0, 9))]))
    out += [None, "", " ;- ", "MIT License", "mit license mit license", "CC BY CC BY-NC 4.0", "Ünder thE ÉCC BY", "cc by" * 3, "GNU\x00General (Public) LICENSE"]
    out += ["mit license " * 8_000, "x" * 60_000, " ".join(notices), "mit license", "mit license"]
    return out


def test_scan_agrees_with_brute_force(spark, texts):
    got, expected = scanned(spark, texts), brute(texts)
    assert got == expected
    assert sum(bool(e[2]) for e in expected) > 30 and any(e[3] and not e[2] for e in expected)


def test_own_templates_with_repeated_words(spark):
    """A template whose phrase repeats its words, and one that is a single word."""
    own = (licenses.Template("twice", "no no warranty of any kind no no", ("no no warranty",)), licenses.Template("one", "Zlib", ("zlib",)), licenses.Template("same", "ha ha", ("ha ha",)))
    texts = ["no no no warranty of any kind", "no warranty", "zlib zlib", "Zlib", "ha", "ha ha ha", "no no warranty of no kind no no", None]
    options = {"templates": own, "phrases": {"any kind": "kind"}}
    assert scanned(spark, texts, **options) == brute(texts, **options)


def test_empty_table(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).collect() == []


def test_no_python_and_no_shuffle_of_texts(spark, texts):
    frame = spark.createDataFrame([(i, t, 1, "f", 2, "l", 3, "s", 4) for i, t in enumerate(texts)], DOCS).select("doc_id", "text")
    plan = licenses.scan_licenses(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_phrase_has_to_stand_in_its_template():
    with pytest.raises(ValueError):
        licenses.Template("x", "some notice", ("other notice",)).placed

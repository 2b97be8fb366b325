"""Secret scans: candidates found by pattern, false positives removed by a random forest.

DataFrame and Spark ML operations only. A candidate is a run of at least ``MIN_LENGTH`` letters, digits and ``_+/=-`` with a digit
in it. Its features are the length, how often the kind of character changes, the shares of kinds, how much of it is
covered by words of the corpus' dictionary, whether it looks like a path, and the words next to it, hashed. The forest is
trained on labelled findings: a table of (candidate, before, after, label), or by default those findings of the corpus that a fixed
format confirms or rules out. It is fitted on at most ``sample`` of them, those with the smallest hash.

Defined results: null and empty texts have no candidates; repeated rows are scanned each; where the labelled findings are of one
class or none, a finding is scored by its fixed format (0.5 if that tells nothing); further columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

MIN_LENGTH = 16
NEAR = 3  # words on either side
DICTIONARY = 400  # most frequent words of four letters or more
SAMPLE = 20_000  # labelled findings a forest is fitted on at most
RUN = r"[A-Za-z0-9_+/=-]{16,}"
# Public formats of keys, names that keys are assigned to, and what looks alike but is no secret.
FORMATS = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36,}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_(live|test)_[A-Za-z0-9]{16,}$|^AIza[0-9A-Za-z_-]{35}$|^eyJ[A-Za-z0-9_-]{10,}$"
NAMES = r"(?i)(api[_-]?key|secret|token|password|passwd|credential|auth)"
HARMLESS = r"^[0-9_+/=-]+$|^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$|^[a-z]+[0-9]{1,3}$"
DIGESTS = r"(?i)\b(commit|sha1|sha256|md5|checksum|digest|etag)\b"


def candidates(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, word_index, piece, candidate, word, before, after) of every candidate."""
    words = F.split(F.col(text_col), r"\s+")
    hit = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1),
        lambda i: (F.length(F.get("words", i)) >= MIN_LENGTH) & F.get("words", i).rlike(RUN) & F.get("words", i).rlike("[0-9]"),
    )
    docs = df.filter(F.col(text_col).rlike(RUN)).select(F.col(id_col).alias("id"), words.alias("words"))
    found = docs.select("id", "words", F.explode(hit).alias("word_index"))
    near = found.select(
        "id",
        "word_index",
        F.get("words", F.col("word_index")).alias("word"),
        F.slice("words", F.greatest(F.col("word_index") - NEAR, F.lit(0)) + 1, F.least(F.col("word_index"), F.lit(NEAR))).alias("before"),
        F.slice("words", F.col("word_index") + 2, NEAR).alias("after"),
    )
    runs = near.select("id", "word_index", "word", "before", "after", F.posexplode(F.regexp_extract_all("word", F.lit(RUN), F.lit(0))).alias("piece", "candidate"))
    return runs.filter(F.col("candidate").rlike("[0-9]"))


def dictionary(df: DataFrame, text_col: str, size: int = DICTIONARY) -> list[str]:
    """The most frequent words of the corpus with four letters or more; counts are summed per task before the shuffle."""
    words = df.select(F.explode(F.split(F.lower(F.col(text_col)), r"[^a-z]+")).alias("w")).filter(F.length("w") >= 4)
    top = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").limit(size)
    return [r["w"] for r in top.collect()]


def features(found: DataFrame, words: list[str]) -> DataFrame:
    """``found`` with a feature column per property."""
    c = F.col("candidate")
    n = F.length(c)
    kinds = F.translate(c, "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "a" * 26 + "A" * 26 + "0" * 10)
    runs = F.length(F.regexp_replace(kinds, r"(.)\1+", "$1"))
    covering = "|".join(sorted(words, key=lambda w: (-len(w), w))) or r"(?!)"
    without = F.length(F.regexp_replace(F.lower(c), covering, ""))
    around = F.concat_ws(" ", "before", "word", "after")

    def share(pattern: str) -> F.Column:
        return (n - F.length(F.regexp_replace(c, pattern, ""))) / n

    measured = {
        "f_length": F.least(n, F.lit(200)).cast("double"),
        "f_changes": (runs - 1) / n,
        "f_distinct": F.size(F.array_distinct(F.split(c, ""))) / F.least(n, F.lit(64)),
        "f_digits": share("[0-9]"),
        "f_upper": share("[A-Z]"),
        "f_hex": share("[0-9a-f]"),
        "f_vowels": share("[aeiouAEIOU]"),
        "f_signs": share("[^A-Za-z0-9]"),
        "f_covered": (n - without) / n,
        "f_path": (c.contains("/") | F.col("word").rlike(r"^[./~]|://|\.[a-z]{2,4}$")).cast("double"),
        "f_quoted": F.col("word").rlike("[\"'`]").cast("double"),
        "f_assigned": (F.col("word").rlike("[=:]") | F.try_element_at("before", F.lit(-1)).rlike("[=:]$")).cast("double"),
        "f_named": around.rlike(NAMES).cast("double"),
        "f_digest": around.rlike(DIGESTS).cast("double"),
    }
    near = F.transform(F.concat(F.transform("before", lambda w: F.concat(F.lit("<"), F.lower(w))), F.transform("after", lambda w: F.concat(F.lit(">"), F.lower(w)))), lambda w: F.substring(w, 1, 24))
    return found.withColumns({k: F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in measured.items()}).withColumn("near", near)


def assembled(df: DataFrame) -> DataFrame:
    hashed = HashingTF(numFeatures=32, inputCol="near", outputCol="near_counts").transform(df)
    inputs = [c for c in df.columns if c.startswith("f_")]
    return VectorAssembler(inputCols=[*inputs, "near_counts"], outputCol="features").transform(hashed)


def label_by_format() -> F.Column:
    """1 for a public key format or a random-looking value assigned to a telling name, 0 for what is known to be harmless, else null."""
    assigned = (F.col("f_assigned") == 1) & (F.col("f_named") == 1) & (F.col("f_quoted") == 1) & (F.col("f_covered") < 0.5)
    return (
        F.when(F.col("candidate").rlike(FORMATS), 1.0)
        .when(F.col("candidate").rlike(HARMLESS) | (F.col("f_digest") == 1) | (F.col("f_path") == 1), 0.0)
        .when(assigned, 1.0)
        .when(F.col("f_covered") >= 0.6, 0.0)
    )


def scan_secrets(
    df: DataFrame,
    findings: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.5,
    sample: int = SAMPLE,
    trees: int = 40,
    depth: int = 7,
) -> DataFrame:
    """Every candidate as (id, word_index, piece, candidate, score, is_secret)."""
    words = dictionary(df, text_col)
    found = stored(features(candidates(df, id_col, text_col), words), "secret-candidates")
    if findings is None:
        labelled = found.withColumn("label", label_by_format())
    else:
        need = {"word": F.col("candidate"), "before": F.array().cast("array<string>"), "after": F.array().cast("array<string>")}
        labelled = features(findings.withColumns({k: v for k, v in need.items() if k not in findings.columns}), words)
    # copies of a finding teach nothing new
    labelled = labelled.filter("label IS NOT NULL").withColumn("label", F.col("label").cast("double"))
    once = labelled.withColumn("turn", F.row_number().over(Window.partitionBy("candidate").orderBy("label"))).filter("turn = 1")
    learned = stored(once.orderBy(F.xxhash64("candidate"), "candidate").limit(sample).drop("turn"), "secret-labels")
    if len(learned.select("label").distinct().take(2)) < 2:
        scored = found.withColumn("score", F.coalesce(label_by_format(), F.lit(0.5)))
    else:
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="sqrt", subsamplingRate=0.8)
        model = forest.fit(assembled(learned))
        scored = model.transform(assembled(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("id", "word_index", "piece", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))

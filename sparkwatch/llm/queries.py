"""The registered queries of the corpus operators, with the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip
from .brown import score_texts
from .common import read_table
from .conversations import damaged, repair_conversations, summary
from .exact import exact_duplicates
from .knn import top_k
from .lexical import LOWER, UPPER, rank_documents
from .licenses import PHRASES, SHARE, TEMPLATES, scan_licenses, words_of
from .packing import pack_tokens
from .pii import find_personal_data
from .quality import score_quality
from .secrets import scan_secrets
from .simhash import near_duplicates
from .substring import repeated_passages

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op3_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(read_table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


ORACLES["op4_exact_dedup"] = """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
    FROM t WINDOW same AS (PARTITION BY text)
"""


@query
def op6_batched_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), TOKENIZER).withColumnRenamed("id", "doc_id")


def id_remainder(by: int) -> F.Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % by


@query
def op7_nb_svm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").filter(id_remainder(5) != 0)
    scored = score_quality(docs, labels)
    return scored.select(
        "doc_id", (id_remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op10_disclosure_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op8_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_texts(docs, id_remainder(7) != 2)
    return scored.select(
        F.col("id").alias("doc_id"), (~F.col("in_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op9_voronoi_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


ORACLES["op9_voronoi_top_k"] = """
    WITH v AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
        SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
        FROM v AS q JOIN v AS d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id
    )
    SELECT query_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id, score FROM scored
    WINDOW best AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 10
"""


@query
def op2_compact_window_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op5_forest_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op13_auction_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is reported, those without a row left as well."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    found = summary(repair_conversations(damaged(rows)))
    all_ids = rows.select("conv_id").distinct()
    joined = all_ids.join(found.withColumnRenamed("conv_id", "found_id"), F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
    zero = F.lit(0).cast("long")
    counts = [F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_k2_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


ORACLES["op12_k2_treap_search"] = f"""
    WITH pairs AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
    ), words AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM documents
    ), postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY ALL),
    totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
    dampened AS (SELECT doc_id, 10 + (90 * n * n_docs) // n_terms AS m FROM lengths, totals),
    weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM postings, totals GROUP BY term, n_docs),
    scored AS (
        SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
        FROM pairs JOIN postings USING (term) JOIN weights USING (term) JOIN dampened USING (doc_id) GROUP BY ALL
    )
    SELECT item_id, row_number() OVER best AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
    QUALIFY row_number() OVER best <= 10
"""


@query
def op11_rare_token_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents"))
    at = F.col("places.at")
    every = F.array_sort(F.array_distinct(F.concat("base_labels", "templates.label")))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        "score",
    )


def sql_list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def license_sql() -> str:
    """Every place of every phrase and template by comparing slices of the word lists, without an index."""
    phrases = ", ".join(f"('{label}', {sql_list(words_of(p))})" for p, label in PHRASES.items())
    templates = ", ".join(
        f"({i}, '{t.label}', {sql_list(t.words)}, [{', '.join(str(p) for p, _ in t.placed)}], [{', '.join(sql_list(p) for _, p in t.placed)}])"
        for i, t in enumerate(TEMPLATES)
    )
    return f"""
    WITH files AS (
        SELECT row_number() OVER () AS file, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
    ), phrases(label, p) AS (VALUES {phrases}),
    templates(template, label, t, places, mandatory) AS (VALUES {templates}),
    held AS (SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct(w)) AS word FROM files) GROUP BY word),
    vocabulary AS (SELECT DISTINCT unnest(t) AS word FROM templates),
    weights AS (
        SELECT v.word, greatest(1, floor(1000 * ln((2 * (SELECT count(*) FROM files) + 2)::DOUBLE / (2 * coalesce(df, 0) + 1)))::BIGINT) AS n
        FROM vocabulary AS v LEFT JOIN held USING (word)
    ), placed AS (SELECT file, unnest(w) AS word, unnest(range(len(w))) AS place FROM files),
    starts AS (
        SELECT file, label, place FROM placed JOIN phrases ON word = p[1] JOIN files USING (file)
        WHERE w[place + 1 : place + len(p)] = p
    ), base AS (
        SELECT file, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list(DISTINCT label) AS labels FROM starts GROUP BY file
    ), offsets AS (
        SELECT file, template, place - places[1] AS o FROM placed JOIN templates ON word = mandatory[1][1]
    ), verified AS (
        SELECT file, template, label, t, w, o FROM offsets JOIN files USING (file) JOIN templates USING (template)
        WHERE o + places[1] >= 0 AND len(list_filter(range(1, len(places) + 1), lambda k: o + places[k] >= 0 AND w[o + places[k] + 1 : o + places[k] + len(mandatory[k])] = mandatory[k])) = len(places)
    ), words AS (SELECT template, unnest(t) AS word, unnest(range(len(t))) AS i FROM templates),
    totals AS (SELECT template, sum(n) AS total FROM words JOIN weights USING (word) GROUP BY template),
    shares AS (
        SELECT file, label, max(part / total) AS share FROM (
            SELECT file, v.label, v.template, v.o, sum(n)::DOUBLE AS part
            FROM verified AS v JOIN words USING (template) JOIN weights USING (word) WHERE v.o + i >= 0 AND v.w[v.o + i + 1] = word GROUP BY ALL
        ) JOIN totals USING (template) GROUP BY file, label
    ), best AS (
        SELECT file, max(share) AS score, coalesce(list(DISTINCT label) FILTER (WHERE share >= {SHARE}), []) AS labels FROM shares GROUP BY file
    )
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word, last_word,
           coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(s.labels, [])))), ','), '') AS labels,
           coalesce(score, 0)::DOUBLE AS score
    FROM files LEFT JOIN base AS b USING (file) LEFT JOIN best AS s USING (file)
"""


ORACLES["op11_rare_token_licenses"] = license_sql()


def repair_sql() -> str:
    """The damage, the faults, and the cheapest edits by a search over suffixes: a list of rows, last first, is folded to the best per state.

    The best of a state is (cost, audit, lines); structs and lists compare in that order.
    """
    follow = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # states: nothing kept, after s, u, a
    made = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))
    far = 1_000_000_000
    fits = lambda s: "CASE x.r[1:1] " + " ".join(f"WHEN '{i}' THEN acc.b[{to + 1}].c + x.e" for i, to in follow[s].items()) + f" ELSE {far} END"
    kept = lambda s, what: "CASE x.r[1:1] " + " ".join(f"WHEN '{i}' THEN acc.b[{to + 1}].{what}" for i, to in follow[s].items()) + f" ELSE acc.b[1].{what} END"

    def passed(s: int) -> str:
        """Edits that pass the row."""
        role, to = made[s]
        return f"""list_min([
            {{'c': acc.b[{s + 1}].c + 2, 'a': 'D' || acc.b[{s + 1}].a, 'l': acc.b[{s + 1}].l}},
            {{'c': CASE WHEN x.g THEN {far} ELSE {fits(s)} END, 'a': 'K' || {kept(s, 'a')}, 'l': list_prepend(x.r || ':' || x.t, {kept(s, 'l')})}},
            {{'c': CASE WHEN x.g THEN {far} ELSE acc.b[{to + 1}].c + 1 + x.e END, 'a': 'R' || acc.b[{to + 1}].a, 'l': list_prepend('{role}:' || x.t, acc.b[{to + 1}].l)}}])"""

    def inserted(s: int, source: str) -> str:
        """The best of a state after up to three turns inserted before the row."""
        options, at, cost, audit, lines = [], s, 0, "", []
        for _ in range(4):
            front = f"list_concat([{', '.join(lines)}], {source}[{at + 1}].l)" if lines else f"{source}[{at + 1}].l"
            options.append(f"{{'c': {source}[{at + 1}].c + {cost}, 'a': '{audit}' || {source}[{at + 1}].a, 'l': {front}}}")
            role, to = made[at]
            at, cost, audit, lines = to, cost + 5, audit + "I", [*lines, f"'{role}:'"]
        return f"list_min([{', '.join(options)}])"

    end = "[{'c': 0, 'a': '', 'l': []::VARCHAR[]}, {'c': 10, 'a': 'II', 'l': ['user:', 'assistant:']}, {'c': 5, 'a': 'I', 'l': ['assistant:']}, {'c': 0, 'a': '', 'l': []::VARCHAR[]}]"
    row = f"{{'g': false, 'r': '', 't': '', 'e': 0, 'b': {end}}}"
    step = (
        f"{{'g': x.g, 'r': x.r, 't': x.t, 'e': x.e, "
        f"'b': list_transform([[{', '.join(passed(p) for p in range(4))}]], lambda n: [{', '.join(inserted(s, 'n') for s in range(4))}])[1]}}"
    )
    return f"""
    WITH bits AS (
        SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
        FROM range(256) AS r(i)
    ), named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS bytes
        FROM conversations
    ), marked AS (
        SELECT n.*, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[1 + xor(c & 255, b)])), 4294967295) % 20 AS fault FROM named AS n, bits
    ), damaged AS (
        SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
               CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
        FROM marked, range(CASE WHEN fault = 3 THEN 2 ELSE 1 END) AS r(copy) WHERE fault <> 0
    ), placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
               regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last FROM damaged
    ), faults AS (
        SELECT *, CASE WHEN last = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                       WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE 'o' END AS kind,
               lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS pair FROM placed
    ), folded AS (
        SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (kind = 'b') AS blank,
               count(*) FILTER (kind = 'd') AS duplicate, count(*) FILTER (kind = 't') AS truncated,
               count(*) FILTER (i > 1 AND pair NOT IN ('su', 'ua', 'au')) AS illegal,
               list({{'g': kind IN ('b', 'd'), 'r': role, 't': text, 'e': CASE WHEN kind = 't' THEN 5 ELSE 0 END, 'b': {end}}} ORDER BY i DESC) AS rows
        FROM faults GROUP BY conv_id
    ), best AS (
        SELECT *, list_reduce(list_prepend({row}, rows), lambda acc, x: {step}).b[1] AS best FROM folded
    )
    SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
           sha256(coalesce(array_to_string(best.l, chr(10)), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) AS a LEFT JOIN best AS r ON a.conv_id IS NOT DISTINCT FROM r.conv_id
"""


ORACLES["op13_auction_conversation_repair"] = repair_sql()

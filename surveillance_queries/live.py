"""Events, entities, alerts and their outcomes."""

from dataclasses import replace

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkwatch.functions import Lexicon, Pattern, hash_key
from sparkwatch.operators import date_window, enrich_alerts, open_versions, outcome_stats, top_n
from sparkwatch.operators.alerts import EntityRules, extract_entities, resolve_events
from sparkwatch.operators.scd import current
from sparkwatch.plans import feed_page as page_of
from sparkwatch.plans import feed_to_events
from sparkwatch.sinks import publish, to_events
from sparkwatch.sources import EventSource, decode_json, read_events, stream_article_feed
from sparkwatch.sources.feed import ARTICLE_SCHEMA, articles_of, read_article_feed
from sparkwatch.sinks import read_snapshot
from sparkwatch.streaming import AlertSink, compact_alerts, dedup_stream, read_alerts, read_compacted_rollup, read_stats, start_alerts, start_feed

from .registry import query, table, work_dir
from .text import sql_contains, sql_first, sql_word

AS_OF = "2024-02-01 06:00:00"

PROPS = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("missing", T.StringType())])


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                             ELSE CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) END AS k,
              CAST(NULL AS VARCHAR) AS missing
       FROM events"""
)
def json_decode(spark, sf):
    """Errors carry broken JSON and decode to nulls; the event id rides along in the payload's envelope."""
    broken = F.concat(F.lit("{"), "props")
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_type") == "error", broken).otherwise(F.col("props")).cast("binary").alias("value")
    )
    data = F.from_json(F.col("value").cast("string"), PROPS)
    return events.select("event_id", data["k"].alias("k"), data["missing"].alias("missing"))


@query(
    """SELECT event_type AS title, props AS description, CAST(event_id AS VARCHAR) AS url,
              CASE WHEN value > 50 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS source,
              strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at
       FROM events"""
)
def event_encode(spark, sf):
    """Encode nine-field events and decode the five fields a consumer reads."""
    articles = table(spark, sf, "events").select(
        F.col("event_type").alias("title"),
        F.col("props").alias("description"),
        F.lit(None).cast("string").alias("content"),
        F.lit("desk").alias("author"),
        F.when(F.col("value") <= 50, F.col("user_id").cast("string")).alias("source"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"),
        F.col("event_id").cast("string").alias("url"),
    )
    return decode_json(to_events(articles, as_of=AS_OF))


# Documents as live articles: the text is split between title and description by language, publish times
# are bad for French, carry an offset for German, and sources repeat.
def articles(spark, sf):
    docs = table(spark, sf, "documents")
    day = F.lpad((F.col("n_chars") % 28 + 1).cast("string"), 2, "0")
    stamp = F.concat(F.lit("2024-01-"), day, F.lit("T10:00:00"))
    return docs.select(
        F.when(F.col("lang") == "es", F.col("source")).otherwise(F.col("text")).alias("title"),
        F.when(F.col("lang") == "es", F.col("text")).alias("description"),
        F.col("source"),
        F.when(F.col("lang") == "fr", "zz")
        .when(F.col("lang") == "de", F.concat(stamp, F.lit("+02:00")))
        .otherwise(F.concat(stamp, F.lit("Z")))
        .alias("published_at"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("doc_id"),
    )


ARTICLES = """SELECT CASE WHEN lang = 'es' THEN source ELSE text END AS title,
       CASE WHEN lang = 'es' THEN text END AS description, source,
       CASE lang WHEN 'fr' THEN 'zz' ELSE '2024-01-' || lpad(CAST(n_chars % 28 + 1 AS VARCHAR), 2, '0') || 'T10:00:00' ||
         CASE lang WHEN 'de' THEN '+02:00' ELSE 'Z' END END AS published_at,
       'https://example.org/' || CAST(doc_id AS VARCHAR) AS url, doc_id
FROM documents"""

DISEASE_TERMS = ("hehely", "rewh", "von", "orre", "of the")
DISEASE_NAMES = {
    "hehely": "RED WIDGET", "rewh": "BLUE BOLT", "von": "SMALL RING", "orre": "UNLISTED THING", "of the": "HOT ROD",
}
PLACE_TERMS = ("inoran", "thatin", "und", "the", "que")
PLACE_NAMES = {
    "inoran": "NATION_3", "thatin": "NATION_7", "und": "NATION_11", "the": "NATION_19", "que": "ATLANTIS",
}

DISEASE_RULES = EntityRules(
    Lexicon.of(*DISEASE_TERMS, canonical=DISEASE_NAMES),
    patterns=(Pattern(("in", "the"), "DISEASE"),),
    label="DISEASE",
    mapping={"in the": "NEW GEAR"},
)
PLACE_RULES = EntityRules(
    Lexicon.of(*PLACE_TERMS), mapping=PLACE_NAMES, match="substring", members=("THATIN",), member_value="NATION_8"
)


def diseases(spark, sf):
    part = table(spark, sf, "part").select(F.upper("p_name").alias("disease_name")).distinct()
    dim = open_versions(part.withColumn("disease_key", hash_key("disease_name", normalize=True)), "2024-01-01")
    return current(dim).select("disease_name", "disease_key")


def locations(spark, sf):
    nation = table(spark, sf, "nation")
    return nation.select(F.col("n_name").alias("country"), hash_key("n_name").alias("location_key"))


def _sql_names(term: str, names: dict[str, str]) -> str:
    return f"CASE {term} " + " ".join(f"WHEN '{t}' THEN '{n}'" for t, n in names.items()) + " END"


_TEXT = "coalesce(title, '') || ' ' || coalesce(description, '')"
_PHRASE = r"""CASE WHEN regexp_matches(lower(body), '(^|[^\p{L}\p{N}])in\s+the([^\p{L}\p{N}]|$)') THEN 'in the' END"""

RESOLVED = f"""articles AS ({ARTICLES}),
unique_articles AS (SELECT *, {_TEXT} AS body FROM (
  SELECT *, row_number() OVER (PARTITION BY title, source ORDER BY published_at, url) AS rn FROM articles) WHERE rn = 1),
terms AS (SELECT *, coalesce({sql_first('body', DISEASE_TERMS, sql_word)}, {_PHRASE}) AS d,
                 {sql_first('body', PLACE_TERMS, sql_contains)} AS p FROM unique_articles),
named AS (SELECT *, {_sql_names('d', {**DISEASE_NAMES, 'in the': 'NEW GEAR'})} AS disease,
                 {_sql_names('p', {**PLACE_NAMES, 'thatin': 'NATION_8'})} AS country FROM terms),
keyed AS (SELECT named.*, dk.disease_key, lk.location_key FROM named
  LEFT JOIN (SELECT DISTINCT upper(p_name) AS name, md5(lower(p_name)) AS disease_key FROM part) dk ON disease = dk.name
  LEFT JOIN (SELECT n_name AS name, md5(n_name) AS location_key FROM nation) lk ON country = lk.name),
resolved AS (SELECT *, CASE WHEN disease IS NULL THEN 'no_disease' WHEN country IS NULL THEN 'no_country'
  WHEN disease_key IS NULL OR location_key IS NULL THEN 'no_keys' ELSE 'inserted' END AS outcome FROM keyed)"""

PUBLISHED = f"""CASE WHEN published_at = 'zz' THEN TIMESTAMP '{AS_OF}'
     ELSE CAST(substr(published_at, 1, 10) AS TIMESTAMP) + INTERVAL 10 HOUR
          - CASE WHEN published_at LIKE '%+02:00' THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END END"""

ALERTS = f"""SELECT md5(concat_ws('|', coalesce(source, ''), coalesce(url, ''), coalesce(title, ''), disease_key, location_key)) AS alert_id,
       disease_key, location_key, {PUBLISHED} AS published_at, TIMESTAMP '{AS_OF}' AS ingestion_time,
       md5(title) AS title_md5, source, url, published_at = 'zz' AS published_at_imputed
FROM resolved WHERE outcome = 'inserted'"""


def alerts(spark, sf):
    return enrich_alerts(
        articles(spark, sf).drop("doc_id"), diseases(spark, sf), locations(spark, sf), DISEASE_RULES, PLACE_RULES, AS_OF
    )


def _with_title_digest(df):
    return df.withColumn("title_md5", F.md5("title")).drop("title")


@query(f"WITH {RESOLVED} {ALERTS}")
def alert_enrich(spark, sf):
    return _with_title_digest(alerts(spark, sf))


@query(f"WITH {RESOLVED} {ALERTS}")
def alert_enrich_table(spark, sf):
    """The same alerts with the disease lexicon as a table, matched by a join."""
    terms = [(t.term, t.priority, t.canonical) for t in DISEASE_RULES.lexicon.terms]
    lexicon = spark.createDataFrame(terms, "term string, priority int, canonical string")
    rules = replace(DISEASE_RULES, lexicon=Lexicon([]), table=lexicon)
    rows = articles(spark, sf).drop("doc_id")
    return _with_title_digest(enrich_alerts(rows, diseases(spark, sf), locations(spark, sf), rules, PLACE_RULES, AS_OF))


@query(
    f"""WITH {RESOLVED}
        SELECT count(*) AS total, count(*) FILTER (outcome = 'no_disease') AS no_disease,
               count(*) FILTER (outcome = 'no_country') AS no_country, count(*) FILTER (outcome = 'no_keys') AS no_keys,
               count(*) FILTER (outcome = 'inserted') AS inserted
        FROM resolved"""
)
def alert_outcomes(spark, sf):
    events = articles(spark, sf).drop("doc_id")
    return outcome_stats(
        resolve_events(events, diseases(spark, sf), locations(spark, sf), DISEASE_RULES, PLACE_RULES)
    )


def streamed(spark, sf, checkpoints: int = 1, between=None) -> str:
    """Alerts of the articles through streams: events as keyed JSON files, decoded, resolved, written per batch."""
    root = work_dir(spark, "alerts")
    rows = articles(spark, sf).drop("doc_id")
    to_events(rows, fields=("title", "description", "source", "published_at", "url")).write.mode("overwrite").json(
        f"{root}/topic"
    )
    sink = AlertSink(
        f"{root}/out",
        f"{root}/stats",
        lambda: diseases(spark, sf),
        lambda: locations(spark, sf),
        DISEASE_RULES,
        PLACE_RULES,
        as_of=AS_OF,
    )
    source = EventSource("json", path=f"{root}/topic")
    for i in range(checkpoints):
        start_alerts(spark, source, sink, f"{root}/ck{i}", trigger=None).awaitTermination()
        if between:
            between(root)
    return root


@query(f"WITH {RESOLVED} SELECT alert_id, disease_key, location_key, published_at, url FROM ({ALERTS})")
def alert_stream(spark, sf):
    """The same alerts through the stream."""
    alerts = read_alerts(spark, f"{streamed(spark, sf)}/out")
    return alerts.select("alert_id", "disease_key", "location_key", "published_at", "url")


@query(f"WITH {RESOLVED} SELECT alert_id, CAST(2 * count(*) AS BIGINT) AS stored FROM ({ALERTS}) GROUP BY alert_id")
def alert_stream_new_checkpoint(spark, sf):
    """Two streams with checkpoints of their own on one root: neither takes anything of the other away."""
    alerts = read_alerts(spark, f"{streamed(spark, sf, 2)}/out")
    return alerts.groupBy("alert_id").agg(F.count(F.lit(1)).alias("stored"))


@query(
    f"""WITH {RESOLVED}, alerts AS ({ALERTS})
        SELECT alert_id, source, published_at, url FROM (
          SELECT *, row_number() OVER (PARTITION BY source, location_key, published_at, disease_key
                                       ORDER BY ingestion_time DESC, alert_id) AS rn FROM alerts) WHERE rn = 1"""
)
def alerts_compacted(spark, sf):
    """The compacted table after three streams with a compaction, and retired batches, after each."""

    def between(root: str) -> None:
        compact_alerts(spark, f"{root}/out", f"{root}/latest", retire=True)

    root = streamed(spark, sf, 3, between)
    return read_snapshot(spark, f"{root}/latest").select("alert_id", "source", "published_at", "url")


# Three batches of the articles that overlap, taken in on three days.
DAYS = ("2024-02-01 06:00:00", "2024-02-02 06:00:00", "2024-02-03 06:00:00")
BATCHES = ("published_at < '2024-01-15'", "published_at >= '2024-01-10' AND published_at <> 'zz'", "true")
# A second month for some sources, and a batch that touches only this month.
FEBRUARY = "source IN ('src1', 'src2', 'src5')"


def sql_batch(where: str, as_of: str, resolved: str = RESOLVED, rows: str = ARTICLES) -> str:
    """The alerts of one batch."""
    return f"(WITH {resolved.replace(rows, f'SELECT * FROM ({rows}) WHERE {where}')} {ALERTS.replace(AS_OF, as_of)})"


def latest_sql(batches: list[str]) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, location_key, published_at, disease_key
                                                 ORDER BY ingestion_time DESC, alert_id) AS rn
                              FROM ({' UNION ALL '.join('SELECT * FROM ' + b for b in batches)})) WHERE rn = 1"""


def in_batches(spark, sf, rows, batches) -> str:
    """Alerts written batch by batch, (condition, time of intake) each, with a compaction after every one."""
    root = work_dir(spark, "alerts")
    dims = diseases(spark, sf), locations(spark, sf)
    sink = AlertSink(f"{root}/out", f"{root}/stats", lambda: dims[0], lambda: dims[1], DISEASE_RULES, PLACE_RULES, stream="desk")
    for i, (where, as_of) in enumerate(batches):
        replace(sink, as_of=as_of)(rows.filter(where), i)
        compact_alerts(spark, f"{root}/out", f"{root}/latest", rollup=f"{root}/rollup")
    return root


@query(
    f"""SELECT location_key, disease_key, count(*) AS alert_count
        FROM ({latest_sql([sql_batch(w, d) for w, d in zip(BATCHES, DAYS)])}) GROUP BY ALL"""
)
def rollup_after_compaction(spark, sf):
    """The rollup that is kept in step with the compacted table: rows that a later batch replaces are subtracted."""
    root = in_batches(spark, sf, articles(spark, sf).drop("doc_id"), list(zip(BATCHES, DAYS)))
    return read_compacted_rollup(spark, f"{root}/latest", f"{root}/rollup")


TWO_MONTHS = ARTICLES.replace("ELSE '2024-01-'", f"ELSE CASE WHEN {FEBRUARY} THEN '2024-02-' ELSE '2024-01-' END")
_TWO_MONTHS_RESOLVED = RESOLVED.replace(ARTICLES, TWO_MONTHS)
_FEBRUARY_ONLY = "published_at LIKE '2024-02%'"


@query(
    f"""SELECT alert_id, source, published_at, ingestion_time, CAST(year(published_at) * 100 + month(published_at) AS INTEGER) AS published_month
        FROM ({latest_sql([sql_batch(w, d, _TWO_MONTHS_RESOLVED, TWO_MONTHS) for w, d in (("true", DAYS[0]), (_FEBRUARY_ONLY, DAYS[1]))])})"""
)
def compaction_two_months(spark, sf):
    """The compacted table after a second batch that touches one of its two months; the other one is carried over."""
    shifted = F.when(F.expr(FEBRUARY), F.regexp_replace("published_at", "^2024-01", "2024-02")).otherwise(F.col("published_at"))
    rows = articles(spark, sf).drop("doc_id").withColumn("published_at", shifted)
    root = in_batches(spark, sf, rows, [("true", DAYS[0]), (_FEBRUARY_ONLY, DAYS[1])])
    latest = read_snapshot(spark, f"{root}/latest")
    return latest.select("alert_id", "source", "published_at", "ingestion_time", "published_month")


@query(
    f"""WITH {RESOLVED}
        SELECT count(*) AS total, count(*) FILTER (outcome = 'no_disease') AS no_disease,
               count(*) FILTER (outcome = 'no_country') AS no_country, count(*) FILTER (outcome = 'no_keys') AS no_keys,
               count(*) FILTER (outcome = 'inserted') AS inserted
        FROM resolved"""
)
def alert_stats(spark, sf):
    """The statistics that the stream writes per batch."""
    return read_stats(spark, f"{streamed(spark, sf)}/stats").drop("stream", "batch_id")


@query(
    """SELECT event_id, ts, event_type FROM events
       WHERE ts >= TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'""",
    name="date_window",
)
def two_days(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    return date_window(events, "ts", "2024-01-15 12:00:00", days=1)


@query(
    """SELECT doc_id, source, DATE '2024-01-01' + CAST(n_chars % 28 AS INTEGER) AS published_on
       FROM documents WHERE lang = 'en' ORDER BY published_on DESC, doc_id LIMIT 100"""
)
def recent_top(spark, sf):
    """The newest hundred articles in one language, the page size being the feature."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 28).cast("int"))
    docs = table(spark, sf, "documents").filter("lang = 'en'")
    return top_n(docs.select("doc_id", "source", day.alias("published_on")), [F.desc("published_on"), F.asc("doc_id")], 100)


ASKED = (("the", "von", "und"), ("ing", "ment", "lich"))


@query(
    f"""WITH articles AS ({ARTICLES}), bodies AS (SELECT *, {_TEXT} AS body FROM articles WHERE published_at <> 'zz'),
        dated AS (SELECT *, {PUBLISHED} AS shown_at FROM bodies
                  WHERE {" AND ".join("(" + " OR ".join(sql_contains("body", t) for t in g) + ")" for g in ASKED)})
        SELECT md5(title) AS title_md5, source, published_at, url FROM dated
        WHERE shown_at >= TIMESTAMP '2024-01-14 00:00:00' AND shown_at < TIMESTAMP '2024-01-16 00:00:00'
        ORDER BY shown_at DESC, url LIMIT 100"""
)
def feed_page(spark, sf):
    """The newest hundred of two days that satisfy the keyword query, the page size being the feature."""
    page = page_of(articles(spark, sf), ASKED, "2024-01-15 12:00:00")
    return page.select(F.md5("title").alias("title_md5"), "source", "published_at", "url")


def payloads(spark, sf):
    """Article payloads, one per document: the article and a second one under its source's name.

    Payloads of src3 report an error.
    """

    def article(title, description):
        return F.struct(
            title.alias("title"),
            description.alias("description"),
            F.lit(None).cast("string").alias("content"),
            F.lit(None).cast("string").alias("author"),
            F.struct(F.col("source").alias("name")).alias("source"),
            F.col("published_at").alias("publishedAt"),
            F.col("url").alias("url"),
        )

    return articles(spark, sf).select(
        F.when(F.col("source") == "src3", "error").otherwise("ok").alias("status"),
        F.array(
            article(F.col("title"), F.col("description")), article(F.col("source"), F.lit(None).cast("string"))
        ).alias("articles"),
    )


@query(
    f"""WITH articles AS ({ARTICLES})
        SELECT 0 AS feed_position, md5(title) AS title_md5, source, published_at, url
        FROM articles WHERE source <> 'src3'
        UNION ALL SELECT 1, md5(source), source, published_at, url FROM articles WHERE source <> 'src3'"""
)
def article_feed(spark, sf):
    """Payloads as JSON text, parsed under the feed schema and taken apart."""
    text = payloads(spark, sf).select(F.to_json(F.struct("status", "articles")).alias("value"))
    rows = articles_of(decode_json(text, ARTICLE_SCHEMA))
    return rows.select("feed_position", F.md5("title").alias("title_md5"), "source", "published_at", "url")


@query(
    f"""WITH articles AS ({ARTICLES})
        SELECT 0 AS feed_position, md5(title) AS title_md5, source, published_at, url
        FROM articles WHERE source <> 'src3'
        UNION ALL SELECT 1, md5(source), source, published_at, url FROM articles WHERE source <> 'src3'"""
)
def feed_files(spark, sf):
    """The same articles from landed files: some with a payload per line, some with one payload over many lines."""
    root = work_dir(spark, "feed")
    lined, single = payloads(spark, sf).filter("hash(articles) % 50 <> 0"), payloads(spark, sf).filter("hash(articles) % 50 = 0")
    lined.write.json(f"{root}/lines")
    # one pretty-printed document per file
    text = single.select(F.to_json(F.struct("status", "articles"), {"pretty": "true"}).alias("value"))
    text.repartition(max(1, text.count()), F.monotonically_increasing_id()).write.option("maxRecordsPerFile", 1).text(f"{root}/files")
    rows = read_article_feed(spark, f"{root}/lines").unionByName(read_article_feed(spark, f"{root}/files", multi_line=True))
    return rows.select("feed_position", F.md5("title").alias("title_md5"), "source", "published_at", "url")


@query(
    f"""WITH articles AS ({ARTICLES})
        SELECT url, CASE WHEN lower(title) LIKE '%the%' THEN 'THE' WHEN len(title) % 2 = 0 THEN 'EVEN' END AS entity FROM articles"""
)
def own_matcher(spark, sf):
    """A matcher of the user's own, a pandas UDF, at the end of the cascade."""

    @F.pandas_udf("string")
    def even(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: "even" if len(t) % 2 == 0 else None)

    rules = EntityRules(Lexicon.of("the"), match="substring", matchers=(even,))
    found = extract_entities(articles(spark, sf).drop("doc_id"), F.coalesce("title", F.lit("")), {"entity": rules})
    return found.select("url", "entity")


EXCLUDED = ("inoran", "orre")
GROUPS = (("the", "von", "und"), ("of", "tion", "der"))


def _any(terms) -> str:
    return "(" + " OR ".join(sql_word("body", t) for t in terms) + ")"


@query(
    f"""WITH articles AS ({ARTICLES}), bodies AS (SELECT *, {_TEXT} AS body FROM articles),
        kept AS (SELECT * FROM bodies WHERE trim(title) <> '' AND NOT {_any(EXCLUDED)} AND {_any(GROUPS[0])} AND {_any(GROUPS[1])})
        SELECT md5(key) AS key_md5, source, published_at, url, 'en' AS language FROM (
          SELECT *, regexp_replace(title, '^\\s+|\\s+$', '', 'g') AS key,
                 row_number() OVER (PARTITION BY lower(regexp_replace(title, '^\\s+|\\s+$', '', 'g')) ORDER BY doc_id) AS rn
          FROM kept) WHERE rn = 1"""
)
def feed_events(spark, sf):
    """Validity, relevance, first of each url or title, published as events. Urls are unique here."""
    # the id is part of the url; the feed order is that of the documents
    rows = articles(spark, sf).withColumns(
        {"content": F.lit(None).cast("string"), "author": F.lit(None).cast("string"), "feed_position": F.col("doc_id")}
    )
    events = feed_to_events(rows, EXCLUDED, GROUPS, ["feed_position"], as_of=AS_OF)
    fields = T.StructType(
        [T.StructField(n, T.StringType()) for n in ("source", "published_at", "url", "language")]
    )
    return events.select(F.md5("key").alias("key_md5"), F.from_json("value", fields).alias("d")).select("key_md5", "d.*")


@query(
    f"""WITH articles AS ({ARTICLES}), bodies AS (SELECT *, {_TEXT} AS body FROM articles WHERE source <> 'src3'),
        kept AS (SELECT * FROM bodies WHERE trim(title) <> '' AND NOT {_any(EXCLUDED)} AND {_any(GROUPS[0])} AND {_any(GROUPS[1])})
        SELECT url, source FROM kept
        QUALIFY row_number() OVER (PARTITION BY lower(regexp_replace(title, '^\\s+|\\s+$', '', 'g')) ORDER BY published_at, url) = 1"""
)
def feed_stream(spark, sf):
    """Landed payloads through the stream that filters, drops repeats of a url or title, and publishes events."""
    root = work_dir(spark, "feed")
    payloads(spark, sf).write.json(f"{root}/in")
    start_feed(stream_article_feed(spark, f"{root}/in"), EXCLUDED, GROUPS, f"{root}/ck", path=f"{root}/topic", as_of=AS_OF).awaitTermination()
    events = decode_json(read_events(spark, EventSource("json", path=f"{root}/topic/*")))
    return events.select("url", "source")


@query("SELECT count(*) AS sent, count(*) AS stored FROM documents")
def events_sent(spark, sf):
    """How many events a publish reports, beside how many lie there."""
    path = work_dir(spark, "topic")
    sent = publish(to_events(articles(spark, sf), fields=("title", "source", "url"), as_of=AS_OF), "json", path)
    return read_events(spark, EventSource("json", path=path)).agg(F.lit(sent).alias("sent"), F.count(F.lit(1)).alias("stored"))


_TITLE = "lower(regexp_replace(title, '^\\s+|\\s+$', '', 'g'))"


@query(
    f"""WITH articles AS ({ARTICLES}), bodies AS (SELECT *, {_TEXT} AS body, CASE WHEN {FEBRUARY} THEN 1 ELSE 0 END AS run FROM articles),
        kept AS (SELECT * FROM bodies WHERE trim(title) <> '' AND NOT {_any(EXCLUDED)} AND {_any(GROUPS[0])} AND {_any(GROUPS[1])})
        SELECT url, run FROM kept QUALIFY row_number() OVER (PARTITION BY {_TITLE} ORDER BY run, doc_id) = 1"""
)
def feed_two_runs(spark, sf):
    """Two runs of the feed, the second one repeated: what the first published isn't published again. Urls are unique here."""
    rows = articles(spark, sf).withColumns(
        {"content": F.lit(None).cast("string"), "author": F.lit(None).cast("string"), "feed_position": F.col("doc_id")}
    )
    accepted = work_dir(spark, "accepted")
    url = T.StructType([T.StructField("url", T.StringType())])

    def run(where: str, name: str):
        events = feed_to_events(rows.filter(where), EXCLUDED, GROUPS, ["feed_position"], as_of=AS_OF, accepted=accepted, run=name)
        return events.select(F.from_json("value", url)["url"].alias("url"))

    first = run(f"NOT ({FEBRUARY})", "2024-02-01")
    run(FEBRUARY, "2024-02-02")
    second = run(FEBRUARY, "2024-02-02")
    return first.withColumn("run", F.lit(0)).unionByName(second.withColumn("run", F.lit(1)))


@query("SELECT user_id, event_type, min(ts) >= TIMESTAMP '2023-01-01 00:00:00' AS in_time, 1::BIGINT AS rows FROM events GROUP BY ALL")
def stream_dedup(spark, sf):
    """A stream of three batches with bounded state: all events, all of them again, and late ones of two years before.

    The stream is stopped and started again from its checkpoint between the batches.
    """
    root = work_dir(spark, "dedup")
    events = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    late = events.withColumn("ts", F.col("ts") - F.expr("INTERVAL 730 DAYS"))
    for batch in (events, events, late):
        batch.write.mode("append").parquet(f"{root}/in")
        rows = dedup_stream(spark.readStream.schema(events.schema).parquet(f"{root}/in"), ["user_id", "event_type"], "ts", "400 days")
        writer = rows.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ck")
        writer.trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.schema(events.schema).parquet(f"{root}/out")
    return kept.groupBy("user_id", "event_type").agg((F.min("ts") >= "2023-01-01").alias("in_time"), F.count(F.lit(1)).alias("rows"))

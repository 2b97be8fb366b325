"""The feed job: landed articles -> relevant, unique articles -> keyed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.matching import Lexicon, keyword_query
from ..functions.text import text_of
from ..functions.times import AsOf
from ..operators.alerts import date_window, top_n
from ..operators.columns import computed_once
from ..operators.dedup import dedup_either
from ..session import ensure_checkpoint_dir
from ..sinks.accepted import dedup_across_runs
from ..sinks.events import to_events
from ..streaming.feed import filter_feed


def feed_page(
    articles: DataFrame,
    query: Sequence[Sequence[str]],
    as_of: AsOf = None,
    days: int = 1,
    n: int = 100,
    tiebreak: Sequence[str] = ("url",),
) -> DataFrame:
    """One page as a feed would answer: articles of the last days that satisfy the keyword query, newest n.

    Articles without a readable publish time are left out.
    """
    dated = date_window(articles.withColumn("__at", F.try_to_timestamp("published_at")), "__at", as_of, days)
    lowered = computed_once(dated, {"__lower": F.lower(text_of("title", "description"))})
    asked = lowered.filter(keyword_query(F.col("__lower"), query, lowered=True)).drop("__lower")
    newest = [F.col("__at").desc(), *[F.col(t).asc() for t in tiebreak]]
    return top_n(asked, newest, n).drop("__at")


def feed_to_events(
    articles: DataFrame,
    exclude: Lexicon | Sequence[str],
    all_of: Sequence[Lexicon | Sequence[str]],
    order_by: Sequence[str] = ("feed_position",),
    match: str = "word",
    as_of: AsOf = None,
    accepted: str | None = None,
    run: str | None = None,
) -> DataFrame:
    """Valid and relevant articles, first of each url and title in feed order, as (key, value) events.

    ``accepted`` is a folder that keeps what earlier runs published: urls and titles in it are not published again.
    ``run`` then names this run; ids grow from run to run, and a run that is repeated publishes the same events.
    """
    ensure_checkpoint_dir(articles.sparkSession)
    # what is relevant is a small part of a feed, and it is read more than once
    kept = filter_feed(articles, exclude, all_of, match).checkpoint()
    keys = ["url", F.lower("title")]
    if accepted:
        if not run:
            raise ValueError("a run that remembers what it accepts needs an id")
        return to_events(dedup_across_runs(kept, keys, order_by, accepted, run), as_of=as_of)
    return to_events(dedup_either(kept, keys, order_by), as_of=as_of)

"""All trend analyses in dependency order, each written to its own table."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from threadloom.operators import trends as A
from threadloom.sizing import cut_lineage

log = logging.getLogger(__name__)


@dataclass
class Run:
    """Which analyses wrote a table, and the errors of those that did not."""

    tables: dict[str, str] = field(default_factory=dict)
    errors: dict[str, Exception] = field(default_factory=dict)


def analyses(
    posts: DataFrame,
    analysis: DataFrame,
    subreddits: DataFrame,
    stored: Callable[[str], DataFrame],
    as_of: str | datetime.date,
    correlations: DataFrame | None = None,
    analysed: DataFrame | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Name to plan, in order; plans that need an earlier result ask for stored(its name).

    Given analysed, the stored analysed_posts of both, the plans read it instead of joining posts and analysis each. With the stored correlation table, emerging_saved is that table with the emerging report merged in.
    """
    def stored_trends() -> DataFrame:
        return stored("weekly_tech_trends")

    both = (posts, analysis) if analysed is None else (analysed, None)
    plans = {
        "weekly_tech_trends": lambda: A.weekly_tech_trends(*both),
        "tech_growth": lambda: A.tech_growth(stored_trends()),
        "emerging_tech": lambda: A.emerging_tech(stored_trends()),
        "tech_correlation": lambda: A.tech_correlation(stored_trends(), analysis, as_of),
        "skill_demand": lambda: A.skill_demand(*both),
        "subreddit_tech_trends": lambda: A.subreddit_tech_trends(*both, subreddits),
        "sentiment_popularity": lambda: A.sentiment_popularity_corr(A.sentiment_popularity_monthly(*both)),
        "tech_trends_weekly": lambda: A.tech_trends_by_time(*both, "week"),
        "tech_trends_monthly": lambda: A.tech_trends_by_time(*both, "month"),
    }
    if correlations is not None:
        plans["emerging_saved"] = lambda: A.save_emerging(correlations, stored("emerging_tech"), as_of)
    return plans


# Analyses that read the stored result of another one; all others start at once.
AFTER = {"tech_growth": "weekly_tech_trends", "emerging_tech": "weekly_tech_trends", "tech_correlation": "weekly_tech_trends", "emerging_saved": "emerging_tech"}


def run_all_analyses(
    posts: DataFrame, analysis: DataFrame, subreddits: DataFrame, out: str, as_of: str | datetime.date,
    correlations: DataFrame | None = None, workers: int = 4,
) -> Run:
    """Write every analysis below `out`, a new folder, up to `workers` of them at a time, each as soon as what it reads is there.

    The posts are joined with their analysis once, for all of them; if that fails, each joins for itself. An error in
    one is kept and does not stop the others, but those that read its result fail too.
    """
    spark = posts.sparkSession
    run = Run()

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(run.tables[name])

    analysed = None
    try:
        analysed = cut_lineage(A.analysed_posts(posts, analysis), "analysed-posts")
    except Exception:  # perhaps of a column that only some analyses read
        log.exception("the analysed posts could not be stored")
    plans = analyses(posts, analysis, subreddits, stored, as_of, correlations, analysed)

    def write(name: str) -> None:
        path = f"{out.rstrip('/')}/{name}"
        try:
            plans[name]().write.parquet(path)
            run.tables[name] = path
        except Exception as error:  # one failed analysis must not take the others with it
            log.exception("analysis %s failed", name)
            run.errors[name] = error

    waiting = {name: AFTER.get(name) for name in plans}
    with ThreadPoolExecutor(workers) as pool:
        running: dict[Future, str] = {}
        while waiting or running:
            done = {*run.tables, *run.errors}
            for name in [n for n, before in waiting.items() if before is None or before in done]:
                del waiting[name]
                running[pool.submit(inheritable_thread_target(spark)(write), name)] = name
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                del running[future]
                future.result()
    return run

"""All eight jobs in order over lake files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import jobs, terms
from ..session import shared_dir
from ..sources.readers import read_json_lines, results_summary
from ..sources.writers import write_results


@dataclass(frozen=True)
class Job:
    name: str
    source: str
    run: Callable[[DataFrame], DataFrame]
    key: str
    values: Sequence[str]


JOBS = (
    Job("rating_by_area", "restaurants", jobs.rating_by_area, "area", ("avg_rating", "restaurant_count")),
    Job("tag_count", "meals", jobs.tag_count, "tag", ("n",)),
    Job("rating_bucket", "restaurants", jobs.rating_bucket, "bucket", ("n",)),
    Job("lexicon_sentiment", "restaurants", jobs.lexicon_sentiment, "name",
        ("avg_sentiment_score", "reviews_analyzed")),
    Job("term_match_count", "restaurants", terms.nested_term_match_count, "term", ("n",)),
    Job("top_reviewed", "restaurants", jobs.top_reviewed, "name", ("review_count",)),
    Job("review_star_distribution", "restaurants", jobs.review_star_distribution, "stars", ("n",)),
    Job("delivery_vs_dinein_venue", "restaurants", jobs.delivery_vs_dinein_venue, "label",
        ("avg_rating", "restaurant_count")),
)


def run_all(
    spark: SparkSession, restaurants: str, meals: str, output: str, job_list: Sequence[Job] = JOBS
) -> dict[str, tuple[int, DataFrame]]:
    """Run the jobs one after the other, stop at the first failure; (record count, first 10) per job.

    The text input is parsed once and kept as Parquet in the shared folder, where
    each job reads only the columns, and of nested reviews only the fields, it uses.
    """
    sources = {}
    for name, path, schema in (
        ("restaurants", restaurants, schemas.RESTAURANTS_RAW), ("meals", meals, schemas.MEALS_RAW)
    ):
        staged = shared_dir(spark, f"lake-{name}")
        read_json_lines(spark, path, schema).write.parquet(staged)
        sources[name] = spark.read.parquet(staged)
    summaries = {}
    for job in job_list:
        folder = f"{output}/{job.name}"
        write_results(job.run(sources[job.source]), folder, job.key, job.values)
        summaries[job.name] = results_summary(spark, folder)
    return summaries

"""Film rating statistics; input columns `movieId` and `rating`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ratings_stats(ratings: DataFrame) -> DataFrame:
    """Number of ratings and average rating (two decimals, half up) per film."""
    return ratings.groupBy("movieId").agg(
        F.count("movieId").alias("cnt"), F.round(F.avg("rating"), 2).alias("avg_rating")
    )


def ratings_top(
    ratings: DataFrame, *, more_than: int = 2000, n: int = 10, best_average: bool = False
) -> DataFrame:
    """The n films with more than `more_than` ratings.

    Most rated first, then best average; `best_average` swaps the two.
    """
    order = ["avg_rating", "cnt"] if best_average else ["cnt", "avg_rating"]
    popular = ratings_stats(ratings).where(F.col("cnt") > more_than)
    return popular.orderBy(*[F.desc(name) for name in order], F.asc("movieId")).limit(n)


def ratings_top_sql(ratings: DataFrame, *, more_than: int = 2000, n: int = 10) -> DataFrame:
    """`ratings_top` as SQL text, where HAVING names the count by its alias."""
    statement = """
        SELECT movieId, count(*) AS cnt, round(avg(rating), 2) AS avg_rating
        FROM {rows} GROUP BY movieId HAVING cnt > {least}
        ORDER BY cnt DESC, avg_rating DESC, movieId LIMIT {n}
    """
    return ratings.sparkSession.sql(statement, rows=ratings, least=more_than, n=n)

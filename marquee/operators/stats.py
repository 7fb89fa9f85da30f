"""Rating statistics: counts, averages, monthly trends, tags, search
documents and per-genre top lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.expr import genre_matches, year_month
from marquee.operators.topk import nest_ranked, top_n_per_group

# The default genre list, in its original order (the
# misspelled "Ccrime" of the original list is written "Crime" here).
DEFAULT_GENRES = [
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary",
    "Drama", "Family", "Fantasy", "Foreign", "History", "Horror", "Music",
    "Mystery", "Romance", "Science", "Tv", "Thriller", "War", "Western",
]


def rating_count_by_movie(ratings: DataFrame, ordered: bool = False) -> DataFrame:
    """Number of ratings per movie (partial counts map-side, one shuffle)."""
    out = ratings.groupBy("mid").agg(F.count(F.lit(1)).alias("count"))
    return out.orderBy(F.desc("count"), "mid") if ordered else out


def avg_score_by_movie(ratings: DataFrame) -> DataFrame:
    """Average score per movie (partial sums and counts map-side)."""
    return ratings.groupBy("mid").agg(F.avg("score").alias("avg_score"))


def _with_month(ratings: DataFrame, tz: str) -> DataFrame:
    return ratings.select("mid", "score", year_month("timestamp", tz).alias("ym"))


def avg_score_by_movie_month(ratings: DataFrame, tz: str = "UTC", ordered: bool = False) -> DataFrame:
    """Average score per (movie, yyyyMM month)."""
    out = _with_month(ratings, tz).groupBy("mid", "ym").agg(F.avg("score").alias("avg_score"))
    return out.orderBy(F.desc("avg_score"), "mid", "ym") if ordered else out


def rating_count_by_movie_month(ratings: DataFrame, tz: str = "UTC") -> DataFrame:
    """Number of ratings per (movie, yyyyMM month)."""
    return _with_month(ratings, tz).groupBy("mid", "ym").agg(F.count(F.lit(1)).alias("count"))


def tags_by_movie(tags: DataFrame) -> DataFrame:
    """Distinct tags of each movie, sorted, joined by ``|``. ``collect_set``
    is aggregated partially before the one shuffle on mid, so each map task
    sends at most a movie's distinct tags, not its rows."""
    return tags.where(F.col("tag").isNotNull()).groupBy("mid").agg(
        F.concat_ws("|", F.array_sort(F.collect_set("tag"))).alias("tags")
    )


def movie_search_docs(movies: DataFrame, tags: DataFrame) -> DataFrame:
    """Movie fields plus the ``|``-joined tags; untagged movies keep NULL."""
    return movies.join(tags_by_movie(tags), on="mid", how="left")


def genre_windows(texts: DataFrame, seed: DataFrame) -> DataFrame:
    """(genre, genres) where the lower-cased text ``genres`` contains the
    lower-cased ``genre``, as an equi-join: a text contains a genre if one of
    its windows of the genre's length equals it. The lengths of the seed are
    few (at most that of its longest genre) and come in as a scalar; windows
    are made row by row, so the work is linear in the text for each length. An
    empty genre is the empty window of every text."""
    low = seed.select("genre", F.lower("genre").alias("window"))
    lengths = seed.agg(F.array_sort(F.collect_set(F.length(F.lower("genre")))).alias("lengths"))
    cut = texts.select("genres", F.lower("genres").alias("text"), F.explode(lengths.scalar()).alias("n"))
    cut = cut.where(F.length("text") >= F.col("n")).select(
        "genres", "text", "n", F.explode(F.sequence(F.lit(1), F.length("text") - F.col("n") + 1)).alias("at"))
    windows = cut.select("genres", F.substring("text", F.col("at"), F.col("n")).alias("window"))
    return windows.join(low, "window").select("genre", "genres").distinct()


def genre_match(movies: DataFrame, genres: Sequence[str] | DataFrame = DEFAULT_GENRES) -> DataFrame:
    """(genre, movie) for every genre contained, case-insensitively, in the
    movie's genres text; nulls match nothing, repeated genres count once. A
    list is a parameter: the theta join is a per-row filter over a literal
    array plus an explode, with no join and no shuffle. A relation (its first
    column), of any size, is joined by windows (``genre_windows``)."""
    if isinstance(genres, DataFrame):
        seed = genres.select(F.col(genres.columns[0]).alias("genre")).where("genre is not null").distinct()
        texts = movies.select("genres").where("genres is not null").distinct()
        found = genre_windows(texts, seed)
        return found.join(movies, "genres").select("genre", *movies.columns)
    seed = F.array(*[F.lit(g) for g in dict.fromkeys(g for g in genres if g is not None)])
    # explode + filter (both in whole-stage codegen; a lambda would not be)
    pairs = movies.select(F.explode(seed).alias("genre"), "*")
    return pairs.where(genre_matches("genres", "genre"))


def genre_top_n(
    movies: DataFrame,
    ratings: DataFrame,
    genres: Sequence[str] = DEFAULT_GENRES,
    n: int = 10,
    nested: bool = False,
) -> DataFrame:
    """Top ``n`` movies per genre by average score (ties: lower mid first).
    Unrated movies drop out (inner join); a genre without a match gives no
    row. Flat: genre, rank, mid, avg_score. Nested: genre, recoms."""
    avg = avg_score_by_movie(ratings)
    scored = genre_match(movies.select("mid", "genres"), genres).join(avg, "mid")
    top = top_n_per_group(scored, ["genre"], [F.desc("avg_score"), F.asc("mid")], n)
    top = top.select("genre", "rank", "mid", "avg_score")
    if not nested:
        return top
    return nest_ranked(top.withColumnRenamed("avg_score", "score"), ["genre"], "rank",
                       ["mid", "score"], "recoms")


def distinct_users(ratings: DataFrame) -> DataFrame:
    """Every user that has rated (a partial distinct, one shuffle)."""
    return ratings.select("uid").distinct()


def preview(df: DataFrame, n: int = 30) -> DataFrame:
    """The first ``n`` rows, for a look at a result."""
    return df.limit(n)

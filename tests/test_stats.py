from marquee.functions.expr import year_month
from marquee.operators import stats


def movies(spark, rows):
    return spark.createDataFrame(rows, "mid int, genres string")


def ratings(spark, rows):
    return spark.createDataFrame(rows, "uid int, mid int, score double, timestamp int")


def test_movie_without_tags_keeps_null(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "mid int, name string")
    t = spark.createDataFrame([(9, 1, "x", 0), (9, 1, "x", 1), (8, 1, "a", 0)],
                              "uid int, mid int, tag string, timestamp int")
    out = {r.mid: r.tags for r in stats.movie_search_docs(m, t).collect()}
    assert out == {1: "a|x", 2: None}


def test_genre_substring_case_insensitive_and_null_genres(spark):
    m = movies(spark, [(1, "Action|Drama"), (2, "Brand#20"), (3, None), (4, "warrior")])
    got = sorted((r.genre, r.mid) for r in stats.genre_match(m, ["action", "brand#2", "War", "Crime"]).collect())
    assert got == [("War", 4), ("action", 1), ("brand#2", 2)]


def test_genre_top_n_ties_lower_mid_first_and_unrated_drop(spark):
    m = movies(spark, [(1, "Drama"), (2, "Drama"), (3, "Drama"), (4, "Drama")])
    r = ratings(spark, [(1, 2, 4.0, 0), (1, 1, 4.0, 0), (1, 3, 5.0, 0)])
    got = [(x.rank, x.mid) for x in stats.genre_top_n(m, r, ["Drama", "Horror"], 2).orderBy("rank").collect()]
    assert got == [(1, 3), (2, 1)]


def test_genre_top_n_nested(spark):
    m = movies(spark, [(1, "Drama"), (2, "Drama")])
    r = ratings(spark, [(1, 1, 3.0, 0), (1, 2, 4.0, 0)])
    row = stats.genre_top_n(m, r, ["Drama"], 10, nested=True).collect()[0]
    assert row.genre == "Drama" and [(i.mid, i.score) for i in row.recoms] == [(2, 4.0), (1, 3.0)]


def test_year_month_is_session_zone_free(spark):
    df = spark.createDataFrame([(1564412033,), (0,)], "t int")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = [r.ym for r in df.select(year_month("t").alias("ym")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == ["201907", "197001"]
    tokyo = df.select(year_month("t", "Asia/Tokyo").alias("ym")).collect()
    assert tokyo[1].ym == "197001"


def test_counts_and_averages(spark):
    r = ratings(spark, [(1, 1, 4.0, 0), (2, 1, 2.0, 2678400), (1, 2, 5.0, 0)])
    assert {x.mid: x["count"] for x in stats.rating_count_by_movie(r).collect()} == {1: 2, 2: 1}
    assert {x.mid: x.avg_score for x in stats.avg_score_by_movie(r).collect()} == {1: 3.0, 2: 5.0}
    months = {(x.mid, x.ym): x["count"] for x in stats.rating_count_by_movie_month(r).collect()}
    assert months == {(1, "197001"): 1, (1, "197002"): 1, (2, "197001"): 1}
    ordered = stats.avg_score_by_movie_month(r, ordered=True).collect()
    assert ordered[0].avg_score == 5.0
    assert stats.distinct_users(r).count() == 2
    assert stats.rating_count_by_movie(r, ordered=True).first().mid == 1


def test_top_n_plan_limits_before_shuffle(spark):
    r = ratings(spark, [(u, m, float(m % 5), 0) for u in range(5) for m in range(30)])
    m = movies(spark, [(i, "Drama") for i in range(30)])
    plan = stats.genre_top_n(m, r, ["Drama"], 3)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    partial = next(i for i, ln in enumerate(lines) if "WindowGroupLimit" in ln and "Partial" in ln)
    shuffle = next(i for i, ln in enumerate(lines) if "Exchange hashpartitioning(genre" in ln)
    assert shuffle < partial          # the partial limit runs below (before) the genre shuffle


def test_genre_seed_relation_and_preview(spark):
    from marquee.sources.tables import genre_seed
    m = movies(spark, [(1, "Action|Drama"), (2, "Comedy")])
    got = sorted((r.genre, r.mid) for r in stats.genre_match(m, genre_seed(spark, ["Drama", "Comedy"])).collect())
    assert got == [("Comedy", 2), ("Drama", 1)]
    assert stats.preview(m, 1).count() == 1


def test_genre_relation_is_joined_like_the_list(spark):
    from marquee.operators import stats
    from marquee.sources import fixtures as fx

    movies = fx.movies(spark, "/root/testdata/sf0.001")
    names = ["ECONOMY", "promo", None, "promo"]
    a = stats.genre_match(movies, names).select("genre", "mid")
    b = stats.genre_match(movies, spark.createDataFrame([(g,) for g in names], "g string")).select("genre", "mid")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect())) and a.count() > 0

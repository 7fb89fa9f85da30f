"""Column expressions. All are built-in Spark expressions, so they stay in
whole-stage codegen and do not block predicate pushdown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts) -> Column:
    """Whole seconds from 1970-01-01 of a TIMESTAMP_NTZ column; does not
    depend on the session time zone."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH), _col(ts))


def from_epoch_seconds(seconds) -> Column:
    """TIMESTAMP_NTZ at ``seconds`` after 1970-01-01 (wall clock in UTC)."""
    return F.timestamp_add("SECOND", _col(seconds), F.expr(EPOCH))


def year_month(seconds, tz: str = "UTC") -> Column:
    """Epoch seconds -> ``yyyyMM`` text in zone ``tz`` (session-zone free)."""
    ts = from_epoch_seconds(seconds)
    if tz.upper() != "UTC":
        ts = F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)
    return F.date_format(ts, "yyyyMM")


def genre_matches(genres, genre) -> Column:
    """Case-insensitive substring test; a null ``genres`` never matches."""
    return F.coalesce(F.contains(F.lower(_col(genres)), F.lower(_col(genre))), F.lit(False))


def dot(a, b, dim: int | None = None) -> Column:
    """Dot product of two arrays. With a known ``dim`` it is unrolled into
    plain arithmetic (whole-stage codegen; same left-to-right sum);
    otherwise a higher-order expression over any length."""
    if dim:
        terms = [F.get(_col(a), i).cast("double") * F.get(_col(b), i).cast("double") for i in range(dim)]
        out = terms[0]
        for t in terms[1:]:
            out = out + t
        return out
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda acc, v: acc + v,
    )


def norm(a) -> Column:
    """Euclidean length of an array (as double)."""
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a, b) -> Column:
    """dot(a, b) / (|a| |b|); NULL (never NaN, never an error) when either
    vector is all zeros, so a threshold filter drops the pair."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def log2_count(n) -> Column:
    """log2 of a count where a count of 0 contributes 0."""
    return F.log2(F.greatest(_col(n), F.lit(1)))


def fold_vector(vec, parts: int) -> Column:
    """Sum consecutive equal slices of an array into ``parts`` doubles
    (uses every entry; the array length must be a multiple of ``parts``)."""
    v = _col(vec)
    width = F.size(v) / F.lit(parts)
    width = width.cast("int")
    return F.transform(
        F.sequence(F.lit(0), F.lit(parts - 1)),
        lambda k: F.aggregate(F.slice(v, k * width + 1, width), F.lit(0.0),
                              lambda acc, x: acc + x.cast("double")),
    )


def archive_date() -> Column:
    """Calendar date text ``yyyy-MM-dd`` (session zone) of the archive folder;
    calendar year, not week-based year."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def format_item(mid, score, digits: int = 6) -> Column:
    """``mid:score`` text with a fixed number of decimals."""
    return F.format_string(f"%d:%.{digits}f", _col(mid), _col(score))

from marquee.functions.expr import (
    archive_date, cosine, dot, epoch_seconds, fold_vector, format_item,
    from_epoch_seconds, genre_matches, log2_count, norm, year_month,
)

__all__ = [
    "archive_date", "cosine", "dot", "epoch_seconds", "fold_vector", "format_item",
    "from_epoch_seconds", "genre_matches", "log2_count", "norm", "year_month",
]

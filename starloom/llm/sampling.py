"""Bounded, repeatable samples of labelled rows for fitting classifiers on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(rows: DataFrame, key: str, columns: list[str], limit: int, text: str = "text", max_chars: int = 20_000):
    """At most ``limit`` rows as a pandas frame, those with the smallest hash of ``key`` first.

    Only keys are ordered; their rows follow by a join with at most ``limit`` keys.
    Of a text longer than ``max_chars`` a slice at a hashed place is taken. Both bounds hold for fitting only.
    """
    order = F.xxhash64(F.col(key).cast("string"))
    chosen = rows.select(F.col(key).alias("_key")).where("_key is not null").distinct().orderBy(F.xxhash64(F.col("_key").cast("string")), "_key").limit(limit)
    at = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(7)), F.greatest(F.length(text) - max_chars + 1, F.lit(1))) + 1
    picked = (
        rows.join(F.broadcast(chosen), F.col(key) == F.col("_key"), "left_semi")
        .select(key, F.col(text).substr(at.cast("int"), F.lit(max_chars)).alias(text), *columns)
    )
    # copies of a key may exceed the limit; the order is total over what is returned
    return picked.orderBy(order, key, text, *columns).limit(limit).toPandas()


def joined_sample(docs: DataFrame, labels: DataFrame, key: str, columns: list[str], limit: int, text: str = "text", max_chars: int = 20_000):
    """Texts of at most ``limit`` labelled keys, those with the smallest hash first, as a pandas frame.

    The label rows are cut to the limit before they meet the texts, so no text is shuffled to find its label.
    """
    hashed = F.xxhash64(F.col(key).cast("string"))
    chosen = labels.where(F.col(key).isNotNull()).select(F.col(key).alias("_key"), *columns).orderBy(F.xxhash64(F.col("_key").cast("string")), "_key", *columns).limit(limit)
    at = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(7)), F.greatest(F.length(text) - max_chars + 1, F.lit(1))) + 1
    rows = (
        docs.where(F.col(text).isNotNull()).select(key, text)
        .join(F.broadcast(chosen), F.col(key) == F.col("_key"))
        .select(key, F.col(text).substr(at.cast("int"), F.lit(max_chars)).alias(text), *columns)
    )
    return rows.orderBy(hashed, key, text, *columns).limit(limit).toPandas()

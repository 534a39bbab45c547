"""Repeated lines out of documents, decided from hashes in key ranges; the result is a compressed keep bitmap per document.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z in lower case. Keys of at least
``MIN_CHARS`` code points that several documents hold stay in the smallest id only. Keys travel
as two 64-bit hashes with id and position, texts do not. Hashes are uniform, so ranges of equal
width are ranges of equal rows, and no pass is needed to find their bounds. Inside a range rows are
sorted by key, id and position; the first id of a key streams past, what follows under another id is lost.

A key that a sample shows to be frequent is split: each of its documents goes to one of several places, found by a hash.
A row that is not of the first id at its place is lost in any case; the rows of the first id of each place
(a place has one) meet once more. The sample steers the split alone, the result is the same with any.

The keep bitmap is run-length compressed: the runs (start, length) of lines that stay, ascending. Everything is
built-in column functions.

Defined results: a null or empty text is one empty line. Rows that share an id are one document: all of them keep a line that their id
holds first. A null id is an id of its own, the largest. Copies of a row get the same bitmap. Short keys, blank lines among them, always stay. Texts of any
length are read whole. No rows give no rows. Columns of the input keep their values, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.runtime import cut_lineage

MIN_CHARS = 10
#: Share of the rows that is sampled to find frequent keys.
SAMPLE = 0.01
BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LAST = (1 << 63) - 1
_ID, _MARK, _LOST = "_line_id", "_line_mark", "_line_lost"


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n")


def _key(line: Column) -> Column:
    """Only A-Z change; where all is ASCII, lower() does the same faster."""
    bare = F.trim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def _identity(key: str, text: str) -> dict[str, Column]:
    """A row is told by its id and a hash of its text; its bitmap depends on these two alone."""
    return {_ID: F.coalesce(F.col(key).cast("long"), F.lit(_LAST)), _MARK: F.xxhash64(F.coalesce(F.col(text), F.lit("")))}


def key_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, mark, at, h1, h2) of every line that is long enough to be looked for."""
    own = _identity(key, text)
    lines = docs.select(own[_ID].alias("id"), own[_MARK].alias("mark"), F.posexplode(_lines(text)).alias("at", "line"))
    keyed = lines.select("id", "mark", "at", _key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keyed.select("id", "mark", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def frequent_keys(sampled: DataFrame, ranges: int) -> DataFrame:
    """(h1, h2, places) of keys with at least half a range of the sampled rows; two for each range at most."""
    total = sampled.count()
    least = max(10, total // (2 * ranges))
    counts = sampled.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return counts.select("h1", "h2", F.ceil(4 * F.col("n") / least).cast("int").alias("places"))


def lost_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, sample: float = SAMPLE) -> DataFrame:
    """(id, mark, lost) of the rows that lose lines; lost holds their positions from 0, ascending."""
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    often = cut_lineage(frequent_keys(cut_lineage(key_rows(docs.sample(sample, seed=1), key, text, min_chars)), ranges))
    # two rows for each range at most
    dealt = key_rows(docs, key, text, min_chars).join(F.broadcast(often), ["h1", "h2"], "left")
    place = F.coalesce(F.pmod(F.xxhash64("id", "mark"), F.col("places")).cast("int"), F.lit(-1))
    # equal widths of the upper 31 bits of the hash; the places of a frequent key lie in ranges that follow one another
    within = F.shiftright(F.shiftrightunsigned("h1", 33) * ranges, 31)
    dealt = dealt.select("id", "mark", "at", "h1", "h2", place.alias("place"))
    dealt = dealt.withColumn("range", ((within + F.greatest("place", F.lit(0))) % ranges).cast("int"))
    stream = Window.partitionBy("range", "h1", "h2", "place").orderBy("id", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = dealt.repartitionById(ranges, "range").withColumn("first", F.first("id").over(stream))
    late = F.col("id") != F.col("first")
    found = cut_lineage(first.where(late | (F.col("place") >= 0)).select("id", "mark", "at", "h1", "h2", late.alias("late")))
    heads = found.where("not late")
    again = Window.partitionBy("h1", "h2").orderBy("id", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    behind = heads.withColumn("first", F.first("id").over(again)).where("id != first")
    lost = found.where("late").select("id", "mark", "at").union(behind.select("id", "mark", "at"))
    return lost.groupBy("id", "mark").agg(F.sort_array(F.collect_set("at")).alias("lost"))


def _runs(lost: Column, n: Column) -> Column:
    """The runs (start, length) of 0..n-1 without ``lost``."""
    starts = F.concat(F.array(F.lit(0)), F.transform(lost, lambda p: p + 1))
    ends = F.concat(lost, F.array(n))
    runs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
    return F.filter(runs, lambda r: r["length"] > 0)


def _marked(docs: DataFrame, lost: DataFrame, key: str, text: str) -> DataFrame:
    """The rows with the positions that they lose (empty if none)."""
    own = docs.withColumns(_identity(key, text))
    met = own.join(lost.toDF(_ID, _MARK, _LOST), [_ID, _MARK], "left").withColumn(_LOST, F.coalesce(F.col(_LOST), F.array().cast("array<int>")))
    return met.select(*[F.col(f"`{c}`") for c in docs.columns], _LOST)


def keep_bitmaps(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, n_lines, n_dropped, keep) of every row; keep holds the runs of lines that stay. No text travels."""
    lost = lost_lines(docs, key, text, **options)
    own = _identity(key, text)
    narrow = docs.select(F.col(key), own[_ID].alias(_ID), own[_MARK].alias(_MARK), F.size(_lines(text)).alias("_n"))
    met = narrow.join(lost.toDF(_ID, _MARK, _LOST), [_ID, _MARK], "left").withColumn(_LOST, F.coalesce(F.col(_LOST), F.array().cast("array<int>")))
    return met.select(key, F.col("_n").cast("long").alias("n_lines"), F.size(_LOST).cast("long").alias("n_dropped"), _runs(F.col(_LOST), F.col("_n")).alias("keep"))


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with n_lines, n_dropped, keep and kept_text: the lines of the keep bitmap joined by a line feed."""
    met = _marked(docs, lost_lines(docs.select(key, text), key, text, **options), key, text)
    lines, lost = _lines(text), F.col(_LOST)
    keep = _runs(lost, F.size(lines))
    # the outer lambda binds the lines, so a text is split once and not for each run
    parts = F.transform(F.array(lines), lambda own: F.flatten(F.transform(keep, lambda r: F.slice(own, r["start"] + 1, r["length"]))))
    kept = F.array_join(parts[0], "\n")
    added = {
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.size(lost).cast("long"),
        "keep": keep,
        "kept_text": F.when(F.size(lost) == 0, F.coalesce(F.col(text), F.lit(""))).otherwise(kept),
    }
    own = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    return met.select(*own, *[c.alias(name) for name, c in added.items()])

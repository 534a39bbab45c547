"""Words that differ by one code point, found by walking a trie of all words level by level.

The trie is a table of edges. Its nodes are the prefixes of words at which words part or end; a chain
without a branch is one edge with a longer label, so the number of levels is that of branchings on a path, not of letters. A node is its prefix, or
beyond ``PLAIN`` code points two hashes of it. Every word is entered from both ends: an edit in its second half leaves the first half
whole, one in the first half leaves the second half whole for the reversed word. So a walk may start at half the word, where few words are left.

A state is (word, position, node, edits). States without an edit are the nodes of a word's own path from its half on. From each, one
edit is made at one of the node's edges: a code point is replaced by a larger one, or left out; the other two cases are the same pairs
seen from the other word. A state with an edit then follows the one edge that its next code points
spell, level by level, and dies where there is none; an edge knows the first code points below it, so most
states die before they are sent anywhere. A state that ends at the end of a word is a pair. Pairs are
verified on the two words, so no hash decides.

A node has at most one edge for each code point of the alphabet, so what a state meets is bounded. Edge and state
tables are joined on nodes without hints, adaptive execution splits nodes with very many states.

Defined results: a null text has no words. Runs of letters are taken from whole texts; words of any length are
compared. Rows that share an id are counted one by one. A null id counts as an empty one for the hash. No texts give no rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.runtime import cut_lineage

RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Prefixes up to this length name their node themselves.
PLAIN = 32
_M1, _M2 = (1 << 61) - 1, (1 << 89) - 1  # primes
_ROWS = 50_000
FORWARD, BACKWARD = "<", ">"


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", every: int = 97, least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n): runs of letters with A-Z in lower case, and how often each occurs.

    Where ``every`` divides h, the crc32 of "<id>:<run>", the code point h % length is left out. Words shorter or rarer than the bounds go.
    """
    found = F.coalesce(F.col(text), F.lit(""))
    # all-ASCII texts take the faster way to the same result
    lower = F.when(F.octet_length(found) == F.char_length(found), F.lower(found)).otherwise(F.translate(found, _UPPER, _LOWER))
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_length)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    hashed = runs.select("run", h.alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    words = hashed.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    return counts.where((F.char_length("word") >= least_length) & (F.col("n") >= least_count))


def node_names(word: str, start: int):
    """(depth, name) of the word's prefixes from depth ``start`` on; names of long prefixes come from running hashes."""
    for d in range(start, min(len(word), PLAIN) + 1):
        yield d, word[:d]
    if len(word) > PLAIN:
        a = b = 0
        for d, c in enumerate(map(ord, word), 1):
            a, b = (a * 1_000_003 + c) % _M1, (b * 8_388_617 + c) % _M2
            if d > PLAIN and d >= start:
                yield d, f"{d}#{a:x}#{b:x}"


def _name(word: str) -> str:
    return word if len(word) <= PLAIN else list(node_names(word, len(word)))[-1][1]


def _emit(rows, schema: pa.Schema):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def prefixes(entries: DataFrame) -> DataFrame:
    """(node, word, depth, next, half) of the nodes on each word's path, from one before its half to its end.

    A node is the side and the name of a prefix; word is the name of the whole word, so that a long word is not repeated for each of its
    prefixes. next is the code point that follows, empty at the end. half is where edits begin.
    """
    schema = pa.schema([("node", pa.string()), ("word", pa.string()), ("depth", pa.int32()), ("next", pa.string()), ("half", pa.int32())])

    def rows(batches):
        for batch in batches:
            for side, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                half = len(word) // 2 if side == FORWARD else len(word) - len(word) // 2
                whole = _name(word)
                for d, name in node_names(word, half - 1):
                    yield side + name, whole, d, word[d : d + 1], half

    return entries.select("side", "letters").mapInArrow(lambda batches: _emit(rows(batches), schema), "node string, word string, depth int, next string, half int")


def long_words(entries: DataFrame) -> DataFrame:
    """(node, letters) of the words that are longer than a plain name; node is where they end."""
    schema = pa.schema([("node", pa.string()), ("letters", pa.string())])

    def rows(batches):
        for batch in batches:
            for side, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield side + _name(word), word

    long = entries.where(F.char_length("letters") > PLAIN).select("side", "letters")
    return long.mapInArrow(lambda batches: _emit(rows(batches), schema), "node string, letters string")


def _letters(node: Column, long: Column) -> Column:
    """The letters of the word that ends at a node."""
    return F.coalesce(long, node.substr(F.lit(2), F.char_length(node)))


def paths(entries: DataFrame) -> DataFrame:
    """(node, letters, depth, half, chars, ends, child, child_depth, child_chars, child_ends): the nodes of each word, with the edge to the next one.

    Nodes are prefixes at which words part or end, and each word's half. chars are the code points that may follow a
    node; ends tells whether a word ends there.
    """
    found = cut_lineage(prefixes(entries))
    nodes = found.groupBy("node").agg(F.collect_set("next").alias("after"), F.max(F.col("depth") == F.col("half")).alias("halved"))
    nodes = nodes.where((F.size("after") > 1) | F.array_contains("after", "") | F.col("halved"))
    nodes = nodes.select("node", F.array_join("after", "").alias("chars"), F.array_contains("after", "").alias("ends"))
    real = found.select("node", "word", "depth", "half").join(nodes, "node")
    step = Window.partitionBy(F.col("node").substr(1, 1), "word").orderBy("depth")
    edges = {"child": F.lead("node").over(step), **{f"child_{c}": F.lead(c).over(step) for c in ("depth", "chars", "ends")}}
    whole = F.concat(F.col("node").substr(1, 1), F.col("word"))
    path = real.select("*", whole.alias("whole"), *[c.alias(name) for name, c in edges.items()])
    long = long_words(entries).select(F.col("node").alias("whole"), "letters")
    met = path.join(long, "whole", "left").withColumn("letters", _letters(F.col("whole"), F.col("letters")))
    return met.select("node", "letters", "depth", "half", "chars", "ends", *edges)


def _after(letters: str, at: Column) -> Column:
    """The code point at a position, empty at the end."""
    return F.col(letters).substr(at + 1, F.lit(1))


def _alive(at: Column, chars: str, ends: str) -> Column:
    """Whether a word that is read up to ``at`` can go on below a node or ends there."""
    following = _after("letters", at)
    return F.when(following == "", F.col(ends)).otherwise(F.contains(F.col(chars), following))


def first_edits(starts: DataFrame, edges: DataFrame) -> DataFrame:
    """(letters, node, at): states after one edit at an edge of a node on the word's own path.

    A code point is replaced by a larger one, or one is left out; at is how much of the word is read then.
    """
    m, at = F.char_length("label"), F.col("depth")
    part = F.col("letters").substr(at + 1, m)
    longer = F.col("letters").substr(at + 1, m + 1)
    # labels of one code point, the usual case, need no distance
    replaced = (part < F.col("label")) & F.when(m == 1, part != "").otherwise(F.levenshtein(part, F.col("label"), 1) == 1) & (F.char_length(part) == m)
    removed = (part != F.col("label")) & (F.char_length(longer) == m + 1) & F.when(m == 1, F.endswith(longer, F.col("label"))).otherwise(
        F.levenshtein(longer, F.col("label"), 1) == 1
    )
    reads = F.array(
        F.when(replaced & _alive(at + m, "child_chars", "child_ends"), at + m), F.when(removed & _alive(at + m + 1, "child_chars", "child_ends"), at + m + 1)
    )
    met = starts.select("letters", "node", "depth").join(edges, "node")
    inside = met.select("letters", F.col("child").alias("node"), F.explode(reads).alias("at")).where("at is not null")
    last = starts.where(F.col("ends") & (F.char_length("letters") == F.col("depth") + 1))
    return inside.union(last.select("letters", "node", F.char_length("letters").alias("at")))


def follow(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states one level further down: the edge of the node that spells the word's next code points, if there is one."""
    met = states.withColumn("first", _after("letters", F.col("at"))).join(edges, ["node", "first"])
    at = F.col("at") + F.char_length("label")
    spelled = F.col("letters").substr(F.col("at") + 1, F.char_length("label")) == F.col("label")
    return met.where(spelled & _alive(at, "child_chars", "child_ends")).select("letters", F.col("child").alias("node"), at.alias("at"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other), in both orders: the pairs of distinct words that differ by one inserted, deleted or replaced code point."""
    forward = words.select(F.lit(FORWARD).alias("side"), F.col("word").alias("letters"))
    entries = cut_lineage(forward.union(words.select(F.lit(BACKWARD).alias("side"), F.reverse("word").alias("letters"))))
    path = cut_lineage(paths(entries))
    label = F.col("letters").substr(F.col("depth") + 1, F.col("child_depth") - F.col("depth"))
    edges = path.where("child is not null").select("node", "child", label.alias("label"), "child_chars", "child_ends").groupBy("node", "child").agg(
        *[F.first(c).alias(c) for c in ("label", "child_chars", "child_ends")]
    )
    edges = cut_lineage(edges.withColumn("first", F.col("label").substr(1, 1)))
    states = cut_lineage(first_edits(path.where("depth >= half"), edges))
    ended = []
    while True:
        done = F.col("at") == F.char_length("letters")
        ended.append(states.where(done).select("letters", "node"))
        going = states.where(~done)
        if going.isEmpty():
            break
        states = cut_lineage(follow(going, edges))
    met = ended[0]
    for more in ended[1:]:
        met = met.union(more)
    met = met.join(long_words(entries).withColumnRenamed("letters", "long"), "node", "left")
    other = _letters(F.col("node"), F.col("long"))
    back = F.col("node").substr(1, 1) == BACKWARD
    pairs = met.select(*[F.when(back, F.reverse(c)).otherwise(c).alias(name) for name, c in (("word", F.col("letters")), ("other", other))])
    pairs = pairs.where(F.levenshtein("word", "other", 1) == 1)
    return cut_lineage(pairs.union(pairs.select("other", "word")).distinct())


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain word -> form -> its form ends; the way doubles each round. Chains must not close."""
    current = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        jump = current.toDF("root", "further")
        following = cut_lineage(current.join(jump, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if following.where("moved").isEmpty():
            return current
        current = following.select("word", "root")


def variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of ``counts`` (word, n; words are distinct).

    form is the near word of largest n (ties: the smallest in code-point order), if that is at least ``ratio`` (over 1) times the word's own.
    """
    counts = cut_lineage(counts.select("word", F.col("n").cast("long").alias("n")))
    pairs = near_pairs(counts.select("word"))
    near = pairs.join(counts.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), "other")).alias("best"))
    met = counts.join(best, "word", "left")
    strong = -F.col("best.minus") >= ratio * F.col("n")
    formed = cut_lineage(met.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(strong, F.col("best.other")).alias("form"), F.when(strong, -F.col("best.minus")).alias("form_n")))
    roots = last_forms(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

"""The queries of the training-data operators: each runs its operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import conversation_trie, decontaminate, embedding_dedup, html_extract, language_id, line_dedup, mixing, ngram_join, quality, spelling, substring_dedup, token_packing, toxicity
from starloom.llm.words import crc_fold
from starloom.runtime import cut_lineage

#: Shares of the words that the mixture shall have in each language.
LANGUAGE_TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_fold(docs: DataFrame, folds: int, held: int) -> DataFrame:
    """held_out: whether crc32(doc_id as text) modulo ``folds`` is ``held``; a null id is held out."""
    return docs.withColumn("held_out", F.coalesce(crc_fold("doc_id", folds) == held, F.lit(True)))


@query
def op1_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_packing.pack(table(spark, sf_dir, "documents"))


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: Every window of every text, compared by its words.
ORACLE["op2_substring_dedup"] = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS l FROM documents
), w AS (
    SELECT doc_id, unnest(l) AS word, generate_subscripts(l, 1) AS p FROM d
), win AS (
    SELECT doc_id, p, array_to_string(list_slice(l, p, p + 19), ' ') AS words
    FROM (SELECT doc_id, l, unnest(range(1, len(l) - 18)) AS p FROM d WHERE len(l) >= 20)
), late AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY words ORDER BY doc_id, p) AS k FROM win) WHERE k > 1
), cover AS (
    SELECT w.doc_id, w.p, w.word,
           max(CASE WHEN late.p IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY w.doc_id ORDER BY w.p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
    FROM w LEFT JOIN late ON late.doc_id = w.doc_id AND late.p = w.p
)
SELECT d.doc_id, CAST(count(cover.p) AS BIGINT) AS n_words, CAST(coalesce(sum(gone), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY cover.p) FILTER (WHERE gone = 0), '')) AS kept_sha256
FROM d LEFT JOIN cover ON cover.doc_id = d.doc_id GROUP BY d.doc_id
"""


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_fold(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), 3, 1)
    model = language_id.fit(docs.where("not held_out"))
    return language_id.identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame):
    """Ratings are the labels' quality grades, of the folds that are not held out."""
    ratings = with_fold(table(spark, sf_dir, "labels"), 5, 0).where("not held_out").withColumnRenamed("quality", "grade")
    return quality.fit(docs, ratings)


@query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text_hash")


#: All pairs of texts that share a shingle, counted exactly.
ORACLE["op4_ngram_join"] = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(list_slice(l, p, p + 4), ' ') AS g
    FROM (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 4, 1) + 1)) AS p FROM d WHERE len(l) > 0)
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
    SELECT x, y FROM common JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), reach(x, y) AS (
    SELECT doc_id, doc_id FROM d
    UNION
    SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
), low AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, low.component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN low ON low.x = d.doc_id
"""


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_fold(table(spark, sf_dir, "documents").select("doc_id", "text"), 5, 0)
    model = quality_model(spark, sf_dir, docs)
    return quality.score(docs, model).drop("text")


@query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_fold(table(spark, sf_dir, "documents").select("doc_id", "text"), 5, 0)
    labels = with_fold(table(spark, sf_dir, "labels"), 5, 0).where("not held_out")
    return toxicity.score(docs, toxicity.fit(docs, labels))


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.deduplicate(table(spark, sf_dir, "embeddings"))


#: The same over all pairs of a label.
ORACLE["op9_embedding_dedup"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
), ok AS (
    SELECT * FROM v
    WHERE label IS NOT NULL AND e IS NOT NULL AND list_count(e) = len(e) AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0
      AND list_dot_product(e, e) > 0
), link AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(x, y) AS (
    SELECT vec_id, vec_id FROM v
    UNION
    SELECT reach.x, link.y FROM reach JOIN link ON link.x = reach.y
), low AS (
    SELECT x, min(y) AS component_id FROM reach GROUP BY x
), many AS (
    SELECT x, count(*) AS n FROM link GROUP BY x
)
SELECT v.vec_id, coalesce(many.n, 0) AS n_links, low.component_id, v.vec_id = low.component_id AS kept
FROM v JOIN low ON low.x = v.vec_id LEFT JOIN many ON many.x = v.vec_id
"""


def language_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> mixing.DomainModel:
    """Domains are languages, learned from the documents that ``labels`` covers."""
    labelled = docs.select("doc_id", "lang").join(table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id", "left_semi")
    return mixing.fit(docs.select("doc_id", "text"), labelled, "lang")


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_model(spark, sf_dir, docs)
    members = cut_lineage(mixing.memberships(docs, model, keep=["doc_id"]))
    rated, _ = mixing.rates(members, mixing.spread(LANGUAGE_TARGETS, model.domains))
    names = F.array(*[F.lit(d) for d in model.domains])
    best = F.when(F.col("mix_tokens") > 0, names[F.array_position("mix_p", F.array_max("mix_p")).cast("int") - 1])
    return rated.select("doc_id", F.col("mix_tokens").alias("n_tokens"), best.alias("domain"), F.col("mix_p").alias("membership"), F.col("mix_rate").alias("rate"), mixing.copies("mix_rate", "doc_id").alias("copies"))


@query
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE["op12_line_dedup"] = r"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), line AS (
    SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS p FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM line
), judged AS (
    SELECT *, length(key) >= 10 AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _crc_table() -> str:
    """CRC-32 of the 16 values of four bits, as an SQL list."""
    table = []
    for v in range(16):
        for _ in range(4):
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        table.append(v)
    return str(table)


def crc_sql(text: str) -> str:
    """crc32 of the UTF-8 bytes of a text in SQL: four bits a step, the lower ones of each byte first."""
    digits = f"hex(encode({text}))"
    bits = f"list_transform(range(length({digits})), lambda i: instr('0123456789ABCDEF', substr({digits}, 2 * (i // 2) + 2 - i % 2, 1)) - 1)"
    step = f"xor(c >> 4, list_extract({_crc_table()}::BIGINT[], (xor(c, v) & 15) + 1))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, v: {step}), 4294967295)"


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = cut_lineage(conversation_trie.ordered_turns(table(spark, sf_dir, "conversations")))
    return conversation_trie.trie(conversation_trie.rebuilt(turns, block=100, heads=6))


#: Every prefix of every conversation as a list of its turns.
ORACLE["op13_conversation_trie"] = rf"""
WITH turn AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), conv AS (
    SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base, {crc_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM turn GROUP BY conv_id
), part AS (
    SELECT c.conv_id, 0 AS side, t.pos, t.role, t.text FROM conv c JOIN turn t ON t.conv_id = c.base AND t.pos < c.h
    UNION ALL
    SELECT c.conv_id, 1, t.pos, t.role, t.text FROM conv c JOIN turn t ON t.conv_id = c.conv_id AND t.pos >= c.h
), path AS (
    SELECT c.conv_id, coalesce(list({{'role': p.role, 'text': p.text}} ORDER BY p.side, p.pos) FILTER (WHERE p.side IS NOT NULL), []) AS turns
    FROM conv c LEFT JOIN part p ON p.conv_id = c.conv_id GROUP BY c.conv_id
), member AS (
    SELECT conv_id, depth, list_slice(turns, 1, depth) AS prefix, len(turns) = depth AS ending
    FROM (SELECT *, unnest(range(len(turns) + 1)) AS depth FROM path)
), node AS (
    SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ending), '')) AS ends_sha256
    FROM member GROUP BY prefix, depth
), edge AS (
    SELECT p.prefix, p.conv_id AS parent_conv_id, n.prefix AS child FROM node n JOIN node p ON p.depth = n.depth - 1 AND p.prefix = list_slice(n.prefix, 1, n.depth - 1)
), many AS (
    SELECT prefix, count(*) AS n_children FROM edge GROUP BY prefix
), value AS (
    SELECT n.prefix, n.depth, CASE WHEN many.n_children IS NULL THEN 1 ELSE 0 END AS leaf,
           CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * length(n.prefix[n.depth].text) END AS saved
    FROM node n LEFT JOIN many ON many.prefix = n.prefix
), sums AS (
    SELECT list_slice(prefix, 1, d) AS prefix, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS d FROM value) GROUP BY 1
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, edge.parent_conv_id, n.n_convs, coalesce(many.n_children, 0) AS n_children,
       CAST(sums.n_leaves AS BIGINT) AS n_leaves, CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM node n JOIN sums ON sums.prefix = n.prefix LEFT JOIN many ON many.prefix = n.prefix LEFT JOIN edge ON edge.child = n.prefix
"""


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents").select("doc_id", "text")))


#: Near words by the texts that remain when one code point of each is left out.
ORACLE["op11_spelling_variants"] = rf"""
WITH RECURSIVE run AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents
    ) WHERE length(run) >= 5 GROUP BY doc_id, run
), hashed AS (
    SELECT run, n, {crc_sql("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")} AS h FROM run
), counts AS (
    SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
        SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), less AS (
    SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM counts)
), near AS (
    SELECT a.word, b.word AS other FROM less a JOIN less b ON a.rest = b.rest AND a.p = b.p AND a.word <> b.word
    UNION
    SELECT less.word, counts.word FROM less JOIN counts ON counts.word = less.rest
    UNION
    SELECT counts.word, less.word FROM less JOIN counts ON counts.word = less.rest
), best AS (
    SELECT near.word, count(*) AS n_near, first(c.word ORDER BY c.n DESC, c.word) AS other, max(c.n) AS other_n
    FROM near JOIN counts c ON c.word = near.other GROUP BY near.word
), formed AS (
    SELECT c.word, c.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * c.n THEN b.other END AS form, CASE WHEN b.other_n >= 2 * c.n THEN b.other_n END AS form_n
    FROM counts c LEFT JOIN best b ON b.word = c.word
), chain(word, root, form) AS (
    SELECT word, word, form FROM formed
    UNION ALL
    SELECT chain.word, formed.word, formed.form FROM chain JOIN formed ON formed.word = chain.form
)
SELECT f.word, f.form, chain.root, f.n, f.n_near, f.form_n FROM formed f JOIN chain ON chain.word = f.word AND chain.form IS NULL
"""

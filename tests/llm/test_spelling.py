import random
import re
import zlib
from collections import Counter


from starloom.llm import queries, spelling
from tests.conftest import rows as sorted_rows


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def counted(docs, least_count=3):
    out = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= least_count}


def expected(counts):
    near = {w: [v for v in counts if v != w and one_edit(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return sorted(((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()), key=repr)


def check(spark, counts):
    found = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert sorted_rows(found) == expected(counts)


def edited(draw, word):
    k, c = draw.randrange(len(word) + 1), draw.choice("abcéøz")
    return draw.choice([word[:k] + c + word[k:], word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :]])


def test_variants_by_definition(spark):
    draw = random.Random(3)
    words = {"".join(draw.choice("abcdéø") for _ in range(draw.randrange(5, 9))) for _ in range(300)}
    words |= {"a" * k for k in range(5, 12)} | {"ab" * 4, "ba" * 4, "abab" + "baba"}
    words |= {e for w in list(words) for e in (edited(draw, w), edited(draw, w)) if len(e) >= 5}
    check(spark, {w: draw.choice([3, 4, 6, 7, 12, 25, 60, 200]) for w in words})


def test_long_words_and_shared_long_prefixes(spark):
    draw = random.Random(4)
    stem = "".join(draw.choice("abcdef") for _ in range(3_000))
    words = {stem, stem[:-1], stem[1:], stem[:1500] + "z" + stem[1501:], stem[:40], stem[:41], stem[:42] + "q", "x" * 2_000, "x" * 1_999, "x" * 1_997}
    words |= {stem[:64] + "".join(draw.choice("ab") for _ in range(6)) for _ in range(40)}
    words |= {"".join(draw.choice("ab") for _ in range(6)) + stem[:64] for _ in range(40)}
    words |= {edited(draw, w) for w in list(words)}
    check(spark, {w: draw.choice([3, 6, 12, 24]) for w in words})


def test_chain_of_forms_and_ties(spark):
    check(spark, {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96, "cbbbb": 96, "zzzzz": 5, "zzzzy": 5})


def test_levels_follow_branchings_not_letters(spark):
    entries = spark.createDataFrame([("<", "y" * 5_000), ("<", "y" * 2_500 + "n" * 2_500)], "side string, letters string")
    assert spelling.paths(entries).where("child is not null").count() <= 6


def test_words_of_documents(spark, odd_docs, no_docs):
    docs = [(k % 400, text) for k in range(1_200) for text in (f"Straße ÀÉÎÕÜ ßßßßß WORDS words wörter{'x' * (k % 3)}, 12abcdefg34hijkl it's",)]
    docs += [(None, "without an id without an id without an id"), (5, None), (6, ""), (7, "ab cd ef " + "long" * 30_000), (8, "long" * 30_000), (9, "long" * 30_000)]
    found = spelling.word_counts(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.word: r.n for r in found.collect()} == counted(docs)
    odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
    words = spelling.word_counts(odd_docs)
    assert {r.word: r.n for r in words.collect()} == counted(odd)
    assert sorted_rows(spelling.variants(words)) == expected(counted(odd))
    assert spelling.variants(spelling.word_counts(no_docs)).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = queries.QUERIES["op11_spelling_variants"](spark, sf)
    found = con.sql(queries.ORACLE["op11_spelling_variants"])
    assert df.columns == found.columns
    assert sorted_rows(df) == sorted(found.fetchall(), key=repr)

import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.llm import line_dedup

LAST = 1 << 63


def expected(rows):
    """(id, text) -> (number of lines, kept lines with their positions), straight from the definition."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))

    least = defaultdict(lambda: LAST)
    for i, text in rows:
        for line in (text or "").split("\n"):
            least[key(line)] = min(least[key(line)], LAST if i is None else i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [(p, x) for p, x in enumerate(lines) if len(key(x)) < 10 or least[key(x)] == (LAST if i is None else i)]
        out[i, text] = len(lines), kept
    return out


def check(docs, **options):
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    got = line_dedup.without_repeats(docs, **options).collect()
    assert len(got) == docs.count()
    for r in got:
        n, kept = want[r.doc_id, r.text]
        assert (r.n_lines, r.n_dropped, r.kept_text) == (n, n - len(kept), "\n".join(x for _, x in kept))
        assert [p for a, m in r.keep for p in range(a, a + m)] == [p for p, _ in kept]
        assert all(m > 0 for _, m in r.keep) and all(a + m < b for (a, m), (b, _) in zip(r.keep, r.keep[1:]))


@pytest.fixture(scope="module")
def lines(spark):
    rows = [
        (3, "  Shared LINE of text \r\nonly here, nowhere else\n\n\nShared line of text"),
        (2, "shared line of text\nshort\nÄRGER über Zeilen"),
        (5, "short\nshared line of text\t\närger über zeilen\nÄRGER über Zeilen"),
        (7, "SHARED line of text"),
        (7, "shared line of text\nanother row of the same id"),
        (7, "shared line of text\nanother row of the same id"),
        (None, "another row of the same id\n shared line of text"),
        (None, "a line under no id only"),
        (-4, "\n\n"),
        (8, None),
        (9, ""),
        (10, "123456789\n1234567890"),
        (11, "1234567890 \n 123456789"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_small_documents_by_definition(lines):
    check(lines)


def test_frequent_lines_are_split_and_still_right(spark):
    rows = spark.range(3_000).selectExpr(
        "3000 - id AS doc_id",
        "concat_ws('\\n', IF(id % 3 < 2, 'a footer that most documents hold', NULL), concat('line of ', id % 700), IF(id % 2 = 0, 'another frequent line', 'x'), 'A FOOTER that most documents hold') AS text",
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    often = line_dedup.frequent_keys(line_dedup.key_rows(rows), ranges)
    assert 0 < often.count() <= 2 * ranges and often.agg(F.max("places")).first()[0] > 1
    check(rows, sample=1.0)
    check(rows, sample=1e-9)


def test_bitmaps_agree_with_texts(lines):
    bits = {(r.doc_id, r.n_lines, r.n_dropped, str(r.keep)) for r in line_dedup.keep_bitmaps(lines).collect()}
    assert bits == {(r.doc_id, r.n_lines, r.n_dropped, str(r.keep)) for r in line_dedup.without_repeats(lines).collect()}


def test_odd_documents(odd_docs, no_docs):
    check(odd_docs.select("doc_id", "text"))
    out = line_dedup.without_repeats(odd_docs)
    assert out.columns == [c for c in odd_docs.columns if c != "keep"] + ["n_lines", "n_dropped", "keep", "kept_text"]
    others = [c for c in odd_docs.columns if c != "keep"]
    assert sorted(map(repr, out.select(others).collect())) == sorted(map(repr, odd_docs.select(others).collect()))
    assert line_dedup.without_repeats(no_docs).count() == 0 and line_dedup.keep_bitmaps(no_docs).count() == 0


def test_main_path_is_native(lines, capsys):
    line_dedup.without_repeats(lines).explain("formatted")
    line_dedup.key_rows(lines).explain("formatted")
    plan = capsys.readouterr().out
    assert "EvalPython" not in plan and "EvalArrow" not in plan and "MapIn" not in plan


def test_query_equals_its_sql(spark):
    import duckdb

    from starloom.llm import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(queries.ORACLE["op12_line_dedup"]).fetchall()
    got = [tuple(r) for r in queries.QUERIES["op12_line_dedup"](spark, sf).collect()]
    assert sorted(got) == sorted(want)

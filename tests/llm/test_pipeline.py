from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from starloom.llm import mixing, queries
from tests.llm.test_duplicates import sets_by_definition, smallest_reachable
from tests.llm.test_leaks_pages import shingles, tokens

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect_on_what_the_one_before_kept(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    inputs, kept = docs.collect(), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != "token_packing":
            assert docs.columns == COLUMNS
    good = {r.doc_id for r in kept["quality"]}
    labels = {r.doc_id: r.quality for r in queries.table(spark, SF, "labels").collect()}
    right = [(r.doc_id in good) == labels[r.doc_id] for r in inputs if r.doc_id in labels]
    assert sum(right) / len(right) > 0.9
    sets = {r.doc_id: sets_by_definition(r.text) for r in kept["quality"]}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert {r.doc_id for r in kept["near_duplicates"]} == set(smallest_reachable(sets, links).values())
    items = [shingles(tokens(r.text)) for r in queries.table(spark, SF, "benchmark").collect()]
    clean = {r.doc_id for r in kept["near_duplicates"] if not any(len(s & shingles(tokens(r.text))) >= 0.8 * len(s) for s in items)}
    assert {r.doc_id for r in kept["decontamination"]} == clean and len(kept["decontamination"]) == len(clean)
    assert {r.doc_id for r in kept["mixing"]} == clean and len(kept["mixing"]) > len(clean)
    segments = sorted((d, o) for r in kept["token_packing"] for d, o in zip(r.doc_ids, r.doc_offsets))
    assert sorted(d for d, o in segments if o == 0) == sorted(r.doc_id for r in kept["mixing"])
    assert corpus_pipeline.run(spark, SF).agg(F.sum("n_tokens")).first()[0] == sum(r.n_tokens for r in kept["token_packing"])


def held_columns(df):
    """How often each combination of values occurs in the columns that no stage may change, with their types."""
    extra = [c for c in df.columns if c not in ("doc_id", "text", "lang")]
    return [(f.name, f.dataType) for f in df.select(extra).schema], Counter(map(repr, df.select("doc_id", *extra).collect()))


def tokens_wanted(spark, docs):
    """Words of a mixture that meets the targets and cuts no language, worked out from the memberships alone."""
    model = queries.language_model(spark, SF, docs)
    shares = mixing.spread(queries.LANGUAGE_TARGETS, model.domains)
    rows = mixing.memberships(docs, model, keep=["doc_id"]).collect()
    return max(sum(r.mix_tokens * r.mix_p[k] for r in rows) / share for k, share in enumerate(shares) if share > 0)


def test_odd_documents_pass_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        types, before = held_columns(docs)
        words_before = docs.select(F.sum(F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))).first()[0] or 0
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name == "token_packing":
                assert (out.count() > 0) == bool(before)
                continue
            assert out.columns == docs.columns
            after_types, after = held_columns(out)
            assert after_types == types and set(after) <= set(before)
            if name != "mixing":
                assert all(n <= before[row] for row, n in after.items())
                continue
            # every document stays; how often each is repeated follows from the targets, so the total is bounded by theirs
            assert set(after) == set(before)
            words_after = out.select(F.sum(F.size(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))).first()[0] or 0
            wanted = tokens_wanted(spark, docs) if before else 0
            assert words_before <= words_after <= 1.05 * wanted + 2 * words_before

import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from starloom.llm.words import NOT_ALNUM, grams, pieces, words

TEXT = st.one_of(st.none(), st.text(alphabet="ab \t\n\x0bé　Z.", max_size=40))


@given(st.lists(TEXT, max_size=8))
def test_words_are_those_of_the_pattern(texts):
    w = words(pa.array(texts, pa.string()))
    expected = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)] == [x for row in expected for x in row]
    assert w.counts.tolist() == [len(row) for row in expected]
    seen = {}
    for a, b, h in zip(w.starts, w.ends, w.hashes.tolist()):
        assert seen.setdefault(w.data[a:b].tobytes(), h) == h
    assert len(set(seen.values())) == len(seen)


def test_hash_of_a_word_does_not_depend_on_its_place():
    long = "x" * 200_000
    w = words(pa.array(["a " * 70_000 + long, long, None, long[1:]]))
    assert w.hashes[-3] == w.hashes[-2] != w.hashes[-1]


def test_lower_case_and_other_separators():
    w = words(pa.array(["It's A-b, Été"]), NOT_ALNUM, lower=True)
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)] == ["it", "s", "a", "b", "Été"]


def test_grams_and_pieces():
    h = np.array([1, 2, 3, 1, 2, 3], np.uint64)
    g = grams(h, 3)
    assert g[0] == g[3] and len(set(g.tolist())) == 3 and len(grams(h, 7)) == 0
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 25, "", "c"])], ["t"])
    assert [x for p in pieces(batch, "t", 20) for x in p.column(0).to_pylist()] == batch.column(0).to_pylist()

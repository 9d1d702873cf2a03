from collections import Counter

import pytest
from conftest import SPACED

from gaugeline.llm import substring_dedup as op


def brute(texts, window):
    words = [SPACED.findall(t or "") for t in texts]
    count = Counter(tuple(w[k:k + window]) for w in words for k in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def check(df, window):
    rows = df.select("doc_id", "text").collect()
    got = sorted(map(tuple, op.remove_repeated(df, window).collect()), key=repr)
    want = brute([r["text"] for r in rows], window)
    assert got == sorted(((r["doc_id"], *w) for r, w in zip(rows, want)), key=repr)
    return got


@pytest.mark.parametrize("window", [16, 35])
def test_documents_as_brute_force(documents, window):
    assert any(r[2] for r in check(documents, window))


def test_odd_documents(odd_documents):
    got = check(odd_documents, 35)
    assert [r for r in got if r[0] == 5] == [(5, 60, 60, "")] * 2


def test_hot_and_periodic_passages(spark, rows_of, monkeypatch):
    monkeypatch.setattr(op, "HOT", 3)
    shared = rows_of(9, 50)
    rows = [(k, f"{rows_of(100 + k, 40)} {shared} {rows_of(200 + k, 40)}") for k in range(12)]
    rows += [(20, "a " * 200), (21, "b " + "a " * 40), (22, "x y " * 60), (23, shared + " end")]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 35)


def test_empty_table_and_short_windows(spark, documents):
    assert op.remove_repeated(documents.limit(0)).count() == 0
    with pytest.raises(ValueError):
        op.remove_repeated(documents, window=8)


def test_automaton_counts_places():
    automaton = op.SuffixAutomaton()
    for sequence in ([1, 2, 3, 1, 2], [2, 3, 1], [1, 2, 3, 1, 2]):
        automaton.add(sequence, 1)
    automaton.finish()
    assert list(automaton.repeated([2, 3, 1], 3)) == [0]
    assert list(automaton.repeated([9, 1, 2, 3, 1, 4], 4)) == [1]
    assert list(automaton.repeated([3, 1, 2, 3], 4)) == []

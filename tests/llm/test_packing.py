import numpy as np
import pyarrow as pa
import pytest

from cairnflow.llm import packing as P


def packed(spark, docs, caps, **kw):
    d = spark.createDataFrame(docs, "doc_id bigint, text string, size string, window_id string")
    c = spark.createDataFrame(caps, "capacity_id int, n_tokens int, text string")
    return P.pack(d, c, **kw).collect()


def test_every_token_once_and_no_window_overfull(spark):
    rng = np.random.default_rng(1)
    words = ["lamp", "river", "stone", "über", "été"]
    docs = [(i, " ".join(rng.choice(words, rng.integers(0, 60))), "", "") for i in range(300)]
    docs += [(900, None, "", ""), (901, "", "", ""), (902, "x" * 1000, "", ""), (903, "é" * 128, "", ""), (None, "lost", "", "")] + docs[:40]
    rows = packed(spark, docs, [(1, 257, ""), (2, 64, ""), (3, None, ""), (4, 0, "")])
    size = {i: len(t.encode()) + 1 for i, t, *_ in docs if i is not None and t is not None}
    for cap_id, cap in ((1, 257), (2, 64)):
        own = [r for r in rows if r.capacity_id == cap_id]
        by_doc, by_window = {}, {}
        for r in own:
            by_doc.setdefault(r.doc_id, []).append(r)
            by_window[r.window_id] = by_window.get(r.window_id, 0) + r.n_tokens
        assert set(by_doc) == set(size)
        for i, pieces in by_doc.items():
            pieces.sort(key=lambda r: r.piece)
            assert sum(r.n_tokens for r in pieces) == size[i]
            assert [r.first_token for r in pieces] == [k * cap for k in range(len(pieces))]
            assert len(pieces) == max(1, -(-size[i] // cap)) == pieces[0].n_pieces
        assert max(by_window.values()) <= cap
        assert sum(size.values()) / (len(by_window) * cap) > 0.9
    assert {r.capacity_id for r in rows} == {1, 2}


def test_exact_capacity_is_whole(spark):
    rows = packed(spark, [(1, "a" * 9, "", ""), (2, "a" * 10, "", "")], [(7, 10, "")])
    assert sorted((r.doc_id, r.n_pieces, r.n_tokens) for r in rows) == [(1, 1, 10), (2, 2, 1), (2, 2, 10)]


def test_empty(spark):
    assert packed(spark, [], [(1, 10, "")]) == []
    assert packed(spark, [(1, "a", "", "")], []) == []


def test_trigrams_stay_in_their_document():
    texts = ["hello", "", "ab", "hello", "xhello"]
    offsets, data = P.text_buffers(pa.array(texts))
    counts = P.trigram_counts(offsets, data)
    assert counts.sum(axis=1).tolist() == [3, 0, 0, 3, 4]
    assert (counts[0] == counts[3]).all()
    offsets, data = P.text_buffers(pa.array(["skip", *texts]).slice(1))
    assert (P.trigram_counts(offsets, data) == counts).all()


def test_long_text_in_slices(monkeypatch):
    texts = ["abc" * 500, "de", "abc" * 500]
    whole = P.trigram_counts(*P.text_buffers(pa.array(texts)))
    monkeypatch.setattr(P, "_SLICE", 97)
    assert (P.trigram_counts(*P.text_buffers(pa.array(texts))) == whole).all()


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    axes = np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")
    cells = np.stack([a.ravel() for a in axes], axis=1)
    keys = P.hilbert_key(cells, bits)
    order = np.argsort(keys)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_neighbours_share_windows(spark):
    """Documents of one kind lie together far more often than by chance."""
    rng = np.random.default_rng(3)
    kinds = ["abcde", "vwxyz", "01234", "äöüßé"]
    docs = [(i, "".join(rng.choice(list(kinds[i % 4]), 100)), "", "") for i in range(400)]
    rows = packed(spark, docs, [(1, 1024, "")], stretch=50)
    by = {}
    for r in rows:
        by.setdefault(r.window_id, []).append(r.doc_id % 4)
    same = sum(a == b for v in by.values() for a in v for b in v)
    assert same / sum(len(v) ** 2 for v in by.values()) > 0.6

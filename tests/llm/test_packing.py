"""Packing where many pieces are equal or short."""

import public_tokenizers
import pytest

from tezgah.llm import packing


def held(made):
    out = {}
    for filling, m in made:
        for s, n in filling:
            out[s] = out.get(s, 0) + n * m
    return out


@pytest.mark.parametrize(
    "counts, bins",
    [({1: 5000, 10: 3}, 3), ({2: 3000, 1500: 1}, 4), ({1: 1500, 900: 2}, 2), ({1: 1_000_000}, 489), ({7: 10_000}, 35), ({2048: 4}, 4), ({2047: 5, 1: 3}, 5), ({}, 0), ({683: 9, 682: 9}, 6)],
)
def test_plans_of_many_equal_pieces(counts, bins):
    made = packing.plan(counts)
    assert held(made) == counts and sum(m for _, m in made) == bins
    assert all(sum(s * n for s, n in filling) <= 2048 for filling, _ in made)


def test_a_filling_leaves_no_room_for_a_piece_that_is_left():
    left = packing.np.zeros(21, int)
    left[[9, 5, 4, 1]] = 2, 1, 3, 1
    for filling in packing.completions([9, 5, 4, 1], left, 20, 20):
        rest = 20 - sum(s * n for s, n in filling)
        assert not any(s <= rest and left[s] > dict(filling).get(s, 0) for s in (9, 5, 4, 1))
    assert all(sum(s * n for s, n in f) == 20 for f in packing.completions([9, 5, 4, 1], left, 20, 0))


@pytest.mark.parametrize("texts", [[""] * 5000, [None] * 1500 + ["a longer one"], ["same words here"] * 900])
def test_thousands_of_equal_texts_are_packed(spark, texts):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, sequence_id string, length int").repartition(3)
    rows = packing.packed(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    total = sum(r.length for r in rows)
    at = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048 and len(at) == -(-total // 2048)

"""The field is fitted on all tokens of the sampled documents."""

import numpy as np
import pytest

from barsmith.llm import pii


def test_fit_counts_every_token(spark, monkeypatch):
    """One frequent kind of token beyond 50 000, and a rare one: both count as often as they occur."""
    texts = ["7 " * 30_000, "8 " * 30_000, "a.b@c.example.org 10.0.0.1 4539148803436467"]
    seen = {}
    plain = pii.fit_field

    def keep(rows, settings, copies=None):
        seen["n"] = len(rows) if copies is None else sum(copies)
        seen["labels"] = {int(r[1]) for r in rows}
        return plain(rows, settings, copies)

    monkeypatch.setattr(pii, "fit_field", keep)
    pii.fit(spark.createDataFrame([(t,) for t in texts], "text string"), settings=pii.Settings(steps=2))
    graphs = [pii.Graph.of(t, pii.base_spans(t)) for t in texts]
    assert seen["n"] == sum(len(g.spans) for g in graphs) > 60_000
    assert seen["labels"] == {int(v) for g in graphs for v in np.maximum(g.fixed, 0)}


def test_copies_are_weights():
    draw = np.random.default_rng(0)
    width, m = len(pii.shape("0")), len(pii.LABELS)
    rows = [(draw.random(width), i % m, *(draw.random(m) for _ in range(4))) for i in range(6)]
    copies = [1, 2, 3, 1, 4, 2]
    one = pii.fit_field(rows, pii.Settings(), copies)
    two = pii.fit_field([r for r, n in zip(rows, copies) for _ in range(n)], pii.Settings())
    for name in vars(one):
        assert np.allclose(getattr(one, name), getattr(two, name))


def test_a_token_over_many_spans_takes_the_smallest_kind():
    """Nine addresses and an e-mail in one token: all spans over it count."""
    text = "x" * 120
    base = [(1, 10 * i, 10 * i + 8) for i in range(9)] + [(0, 92, 110)]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pii, "tokens", lambda _: [(0, 115), (116, 120)])
        assert list(pii.Graph.of(text, base).fixed) == [1, -1]

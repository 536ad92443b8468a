import numpy as np
import pytest

from ratemill.llm import bilstm


@pytest.mark.parametrize("size", [1.0, 8.0, 1000.0])
def test_reading_takes_gates_from_tables(monkeypatch, size):
    draw = np.random.default_rng(4)
    tagger = bilstm.Tagger.new(6, 4, 5)
    for way in ("forward", "backward"):
        tagger.weights[f"{way}_input"] *= np.float32(size)  # the last lies beyond the tables
    kinds = draw.integers(0, 6, (40, 30)).astype(np.uint8)
    exact = tagger._emitted(*(tagger._states(kinds, way) for way in ("forward", "backward")))

    def computed(*args, **named):
        raise AssertionError("tanh is computed")

    monkeypatch.setattr(np, "tanh", computed)
    assert np.abs(tagger.emissions(kinds) - exact).max() < 0.01
    assert tagger.emissions(kinds[:0]).shape == (0, 4, 30) and tagger.emissions(kinds[:, :0]).shape == (40, 4, 0)


def test_tables_hold_what_they_stand_for():
    x = np.linspace(-12, 12, 5001)
    places = np.clip((x * bilstm.PER_UNIT + bilstm.PLACES / 2).astype(int), 0, bilstm.PLACES - 1)
    assert np.abs(bilstm.TANH[places] - np.tanh(x)).max() < 2e-4
    assert np.abs(bilstm.OPEN[places] - 1 / (1 + np.exp(-2 * x))).max() < 1e-4

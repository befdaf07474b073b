"""A mini-batch goes through the net once, and Adam's steps are those of its formula."""

import numpy as np

from shelfwise.operators import nets


def test_a_gradient_goes_forward_once(monkeypatch):
    calls = []
    monkeypatch.setattr(nets, "_forward", lambda net, x, was=nets._forward: calls.append(len(x)) or was(net, x))
    rng = np.random.default_rng(0)
    layers = [4, 5, 3]
    nets.gradient(nets.unpacked(nets.first_weights(layers, 1), layers), rng.normal(size=(20, 4)), rng.integers(0, 3, 20), 0.3)
    assert calls == [20]


def test_steps_follow_the_formula(monkeypatch):
    monkeypatch.setattr(nets, "STEPS", 3)
    rng = np.random.default_rng(0)
    layers, x, y = [4, 5, 3], rng.normal(size=(20, 4)), rng.integers(0, 3, 20)
    flat = nets.first_weights(layers, 1)
    got = nets.local_steps(flat, layers, x, y, 7, 0.01, 0.1)
    order, want, m, v = np.random.default_rng(7), flat.copy(), 0.0, 0.0
    for t in (1, 2, 3):
        rows = order.permutation(20)
        g = nets.gradient(nets.unpacked(want, layers), x[rows], y[rows], 0.1)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        want = want - 0.01 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    assert (got == want).all() and (flat == nets.first_weights(layers, 1)).all()

"""A training step: the same gradients as group by group, with a softmax over slots that is one for all groups."""

import numpy as np
import pytest

from orderlake.llm import attention


def test_a_step_takes_two_softmaxes_for_any_number_of_groups(monkeypatch):
    groups, slots = 40, 5
    rng = np.random.default_rng(2)
    p = attention.initial(attention.Shape(groups, slots), np.full(groups, -np.log(groups)), np.full((groups, slots), -np.log(slots)))
    p = {name: a.astype(np.float64) for name, a in p.items()}
    x, y = rng.integers(0, groups * slots + 1, (6, 9)), rng.integers(0, groups * slots, (6, 9))
    y[y // slots == 3] = 0  # a group without a target
    valid = rng.random((6, 9)) < 0.8
    calls, soften = [], attention._soften

    def counted(z, target):
        calls.append(len(target))
        return soften(z, target)

    monkeypatch.setattr(attention, "_soften", counted)
    loss, g = attention.gradients(p, x, y, valid, slots)
    assert calls == [valid.sum()] * 2
    h, _ = attention.hidden(p, x)
    h, target = h[valid], y[valid]
    assert loss == pytest.approx(-attention.log_probabilities(p, h, target, slots).mean())
    assert set(g) == set(p) and all(g[name].shape == p[name].shape for name in p)
    for c in range(groups):
        own = target // slots == c
        z = h[own] @ p["slot"][c] + p["slot_bias"][c]
        dz = np.exp(z - attention.log_sum(z)[:, None]) if own.any() else z
        dz[np.arange(own.sum()), target[own] % slots] -= 1
        assert g["slot"][c] == pytest.approx(h[own].T @ dz / len(target))
        assert g["slot_bias"][c] == pytest.approx(dz.sum(axis=0) / len(target))

"""The recurrent network against the formulas written out, one token at a time."""

import numpy as np
import pytest

from hazeline.llm.recurrent import GROUP, HIDDEN, Network, score


@pytest.fixture(scope="module")
def net():
    dice = np.random.default_rng(7)
    made = Network.initial(dice.integers(1, 50, 2 * GROUP).astype(float), dice.integers(1, 9, 3).astype(float), 5)
    for values in made.p.values():
        values += dice.normal(0, 0.3, values.shape).astype(np.float32)
    return made


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def plain_step(p, symbol, state):
    """One gated recurrent unit: update gate z, reset gate r, new state through r."""
    n, x = HIDDEN, p["embed"][symbol].astype(float)
    wx, wh, b = p["wx"].astype(float), p["wh"].astype(float), p["b"].astype(float)
    z = sigmoid(x @ wx[:, :n] + b[:n] + state @ wh[:, :n])
    r = sigmoid(x @ wx[:, n : 2 * n] + b[n : 2 * n] + state @ wh[:, n : 2 * n])
    new = np.tanh(x @ wx[:, 2 * n :] + b[2 * n :] + r * (state @ wh[:, 2 * n :] + p["bn"].astype(float)))
    return (1 - z) * new + z * state


def plain_log(net, state, symbol):
    """ln P(class) + ln P(word in its class); only the classes of frequent words have words."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    classes = state @ p["wc"] + p["bc"]
    of = int(net.class_of(np.array([symbol]))[0])
    log = classes[of] - np.log(np.exp(classes).sum())
    if symbol < net.words:
        own = slice(of * GROUP, (of + 1) * GROUP)
        inside = p["wu"].reshape(-1, HIDDEN)[own] @ state + p["bu"].reshape(-1)[own]
        log += inside[symbol % GROUP] - np.log(np.exp(inside).sum())
    return log


def test_scores_equal_the_plain_formulas(net):
    dice = np.random.default_rng(3)
    lengths = np.array([40, 1, 170])
    symbols = dice.integers(0, net.end, lengths.sum())
    symbols[np.cumsum(lengths) - 1] = net.end
    want, at = [], 0
    for n in lengths:
        state, before, total = np.zeros(HIDDEN), net.end, 0.0
        for symbol in symbols[at : at + n]:
            state = plain_step(net.p, before, state)
            total += plain_log(net, state, symbol)
            before = symbol
        want.append(total)
        at += n
    assert score(net, symbols, lengths) == pytest.approx(want, rel=1e-4)


def test_probabilities_of_all_symbols_sum_to_one(net):
    state = np.random.default_rng(1).uniform(-1, 1, HIDDEN).astype(np.float32)
    every = np.arange(net.end + 1)
    found, _ = net.output(np.repeat(state[None], len(every), axis=0), every, None)
    assert np.exp(found.astype(float)).sum() == pytest.approx(1, abs=1e-5)
    assert found == pytest.approx([plain_log(net, state.astype(float), s) for s in every], abs=1e-4)

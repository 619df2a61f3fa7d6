"""Gated recurrent network over symbols with a class-factored softmax, in numpy.

A symbol is a frequent word, a class of rare words, or the end. Output classes are groups of
frequent words of similar frequency (with a softmax inside each group), the classes of rare words,
and the end. Texts are packed into lanes as streams; the state is carried from window to window
and reset where a text starts, and gradients are cut at window borders.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

EMBED = 16
HIDDEN = 24
GROUP = 32
STEPS = 32
LANES = 256
RATE = 0.004
CLIP = 0.1


class Network:
    """`words` frequent words (a multiple of GROUP), `rare` classes of rare words, one end symbol."""

    def __init__(self, words: int, rare: int, vector: np.ndarray | None = None):
        self.words, self.rare, self.groups = words, rare, words // GROUP
        self.end, self.classes = words + rare, words // GROUP + rare + 1
        shapes = {
            "embed": (words + rare + 1, EMBED), "wx": (EMBED, 3 * HIDDEN), "wh": (HIDDEN, 3 * HIDDEN), "b": (3 * HIDDEN,),
            "bn": (HIDDEN,), "wc": (HIDDEN, self.classes), "bc": (self.classes,), "wu": (words, HIDDEN), "bu": (words,),
        }
        size = sum(int(np.prod(s)) for s in shapes.values())
        self.vector = np.zeros(size, dtype=np.float32) if vector is None else vector.astype(np.float32)
        self.p, at = {}, 0
        for name, shape in shapes.items():
            n = int(np.prod(shape))
            self.p[name], at = self.vector[at : at + n].reshape(shape), at + n

    @classmethod
    def initial(cls, counts: np.ndarray, rare_counts: np.ndarray, ends: int, seed: int = 5) -> Network:
        """Output biases start at the unigram distribution, so an untrained network is one."""
        net, rng = cls(len(counts), len(rare_counts)), np.random.default_rng(seed)
        for name, scale in (("embed", 0.3), ("wx", 0.2), ("wh", 0.15), ("wc", 0.05)):
            net.p[name][:] = rng.normal(0, scale, net.p[name].shape)
        grouped = counts.reshape(net.groups, GROUP) + 1.0
        net.p["bu"][:] = np.log(grouped / grouped.sum(axis=1, keepdims=True)).ravel()
        totals = np.concatenate([grouped.sum(axis=1), rare_counts + 1.0, [ends + 1.0]])
        net.p["bc"][:] = np.log(totals / totals.sum())
        return net

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.words, symbols // GROUP, symbols - self.words + self.groups)

    def run(self, inputs: np.ndarray, starts: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray, tuple]:
        """States after every step (steps, lanes, HIDDEN), the last one, and what backward needs.

        Inside, lanes are the last axis, so that every gate is one contiguous block.
        """
        p, (steps, lanes), n = self.p, inputs.shape, HIDDEN
        # what a symbol adds to the gates, once a window and not once a token
        by_symbol = p["wx"].T @ p["embed"].T
        by_symbol += p["b"][:, None]
        resets, state = starts.any(axis=1), np.ascontiguousarray(state.T)
        wh, bn = np.ascontiguousarray(p["wh"].T), p["bn"][:, None]
        before, gates, news, hidden, out = (np.empty((steps, k, lanes), np.float32) for k in (n, 2 * n, n, n, n))
        for t in range(steps):
            if resets[t]:
                state = state * ~starts[t]
            before[t] = state
            ahead, inner, gate, new = by_symbol.take(inputs[t], axis=1), wh @ state, gates[t], news[t]
            np.add(ahead[: 2 * n], inner[: 2 * n], out=gate)
            np.negative(gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.add(inner[2 * n :], bn, out=hidden[t])
            np.multiply(gate[n:], hidden[t], out=new)
            new += ahead[2 * n :]
            np.tanh(new, out=new)
            state = state - new
            state *= gate[:n]
            state += new
            out[t] = state
        return np.ascontiguousarray(out.transpose(0, 2, 1)), state.T, (before, gates, news, hidden)

    def output(self, out: np.ndarray, targets: np.ndarray, grads: dict | None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of every target, and the gradient of the loss by the states.

        `out` (m, HIDDEN), `targets` (m,). Frequent words are handled group by group.
        """
        p, m = self.p, len(targets)
        classes = self.class_of(targets)
        # states lie in (-1, 1), so logits are bounded by the weights and need no shift
        weights = out @ p["wc"]
        weights += p["bc"]
        found = weights[np.arange(m), classes]
        np.exp(weights, out=weights)
        sums = weights.sum(axis=1)
        found -= np.log(sums)
        back = None
        if grads is not None:
            # the sums divide the narrow factors, not the wide weights
            weights[np.arange(m), classes] -= sums
            part = 1 / sums
            grads["wc"] += (out * part[:, None]).T @ weights
            grads["bc"] += part @ weights
            back = weights @ p["wc"].T
            back *= part[:, None]
        frequent = np.flatnonzero(targets < self.words)
        # rows sorted by group: a group is a slice, and what is alike for all groups is done once
        order = frequent[np.argsort(classes[frequent].astype(np.uint16), kind="stable")]
        own_group = classes[order]
        bounds = np.searchsorted(own_group, np.arange(self.groups + 1))
        slices = [(g, slice(bounds[g], bounds[g + 1])) for g in np.flatnonzero(np.diff(bounds))]
        states, word_weights = out[order], p["wu"].reshape(self.groups, GROUP, HIDDEN)
        spread = np.empty((len(order), GROUP), np.float32)
        for group, rows in slices:
            np.matmul(states[rows], word_weights[group].T, out=spread[rows])
        spread += p["bu"].reshape(self.groups, GROUP)[own_group]
        every, inside = np.arange(len(order)), targets[order] % GROUP
        own = spread[every, inside]
        np.exp(spread, out=spread)
        total = spread.sum(axis=1)
        found[order] += own - np.log(total)
        if grads is not None:
            spread[every, inside] -= total
            part = 1 / total
            states *= part[:, None]
            pushed = np.empty_like(states)
            to_words, to_biases = grads["wu"].reshape(word_weights.shape), grads["bu"].reshape(self.groups, GROUP)
            for group, rows in slices:
                to_words[group] += spread[rows].T @ states[rows]
                to_biases[group] += part[rows] @ spread[rows]
                np.matmul(spread[rows], word_weights[group], out=pushed[rows])
            pushed *= part[:, None]
            back[order] += pushed
        return found, back

    def backward(self, inputs: np.ndarray, starts: np.ndarray, back: np.ndarray, kept: tuple, grads: dict) -> None:
        """Truncated backpropagation through one window."""
        p, (steps, lanes), n = self.p, inputs.shape, HIDDEN
        before, gates, news, hidden = kept
        z, r = gates[:, :n], gates[:, n:]
        by_new = (1 - z) * (1 - news * news)
        by_update = (before - news) * (z * (1 - z))
        by_reset = hidden * (r * (1 - r))
        # gradients by the recurrent part of the new state, the update gate, the reset gate, the new state;
        # the first three come through `wh`, the last three directly
        all_back = np.empty((steps, 4 * n, lanes), np.float32)
        wh = np.concatenate([p["wh"][:, 2 * n :], p["wh"][:, : 2 * n]], axis=1)
        carry, resets = np.zeros((n, lanes), np.float32), starts.any(axis=1)
        back = np.ascontiguousarray(back.transpose(0, 2, 1))
        for t in range(steps - 1, -1, -1):
            carry += back[t]
            row = all_back[t]
            new = row[3 * n :]
            np.multiply(carry, by_new[t], out=new)
            np.multiply(new, r[t], out=row[:n])
            np.multiply(carry, by_update[t], out=row[n : 2 * n])
            np.multiply(new, by_reset[t], out=row[2 * n : 3 * n])
            carry *= z[t]
            carry += wh @ row[: 3 * n]
            if resets[t]:
                carry *= ~starts[t]
        through, direct = all_back[:, : 3 * n], all_back[:, n:]
        by_wh = (before @ through.transpose(0, 2, 1)).sum(axis=0)
        grads["wh"][:, 2 * n :] += by_wh[:, :n]
        grads["wh"][:, : 2 * n] += by_wh[:, n:]
        totals = all_back.sum(axis=2).sum(axis=0)
        grads["bn"] += totals[:n]
        grads["b"] += totals[n:]
        embedded = p["embed"][inputs]
        grads["wx"] += (embedded.transpose(0, 2, 1) @ direct.transpose(0, 2, 1)).sum(axis=0)
        cells = inputs[:, None, :] * EMBED + np.arange(EMBED)[:, None]
        spread = np.bincount(cells.ravel(), weights=(p["wx"] @ direct).ravel(), minlength=grads["embed"].size)
        grads["embed"] += spread.reshape(grads["embed"].shape)


def packed(symbols: np.ndarray, lengths: np.ndarray, end: int, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(inputs, targets, text) as (steps, lanes) arrays; text is -1 where a lane is empty.

    `symbols` holds the texts one after the other, each with its end. Every lane is a stream of
    whole texts; the longest texts are dealt first, to the shortest lane.
    """
    total, longest = int(lengths.sum()), int(lengths.max(initial=1))
    lanes = max(1, min(lanes, max(32, total // longest), len(lengths)))
    heap, places = [(0, lane) for lane in range(lanes)], np.zeros((len(lengths), 2), dtype=np.int64)
    for text in np.argsort(-lengths, kind="stable"):
        held, lane = heapq.heappop(heap)
        places[text] = held, lane
        heapq.heappush(heap, (held + int(lengths[text]), lane))
    steps = max(held for held, _ in heap)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    rows, columns = places[owner, 0] + inside, places[owner, 1]
    inputs, targets, text = (np.full((steps, lanes), fill, dtype=np.int32) for fill in (end, end, -1))
    targets[rows, columns], text[rows, columns] = symbols, owner
    later = inside > 0
    inputs[rows[later], columns[later]] = symbols[np.flatnonzero(later) - 1]
    return inputs, targets, text


def windows(inputs: np.ndarray, targets: np.ndarray, text: np.ndarray, steps: int) -> Iterator[tuple]:
    fresh = np.ones(text.shape, dtype=bool)
    fresh[1:] = text[1:] != text[:-1]
    for at in range(0, len(inputs), steps):
        cut = slice(at, at + steps)
        open_lanes = np.flatnonzero((text[cut] >= 0).any(axis=0))
        if len(open_lanes) < text.shape[1]:
            yield tuple(a[cut][:, open_lanes] for a in (inputs, targets, text, fresh)) + (open_lanes,)
        else:
            yield inputs[cut], targets[cut], text[cut], fresh[cut], open_lanes


def score(net: Network, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural log probability of each whole text."""
    result = np.zeros(len(lengths))
    if not len(lengths):
        return result
    inputs, targets, text = packed(symbols, lengths, net.end, 2 * LANES)
    state = np.zeros((inputs.shape[1], HIDDEN), np.float32)
    for x, y, of, fresh, lanes in windows(inputs, targets, text, STEPS):
        out, state[lanes], _ = net.run(x, fresh, state[lanes])
        real = np.flatnonzero(of.ravel() >= 0)
        found, _ = net.output(out.reshape(-1, HIDDEN)[real], y.ravel()[real], None)
        result += np.bincount(of.ravel()[real], weights=found, minlength=len(lengths))
    return result


class Trainer:
    """Adam on a network's whole vector, one window after the other."""

    def __init__(self, net: Network):
        self.net, self.tokens, self.turns = net, 0, 0
        self.first, self.second = np.zeros_like(net.vector), np.zeros_like(net.vector)
        self.grads = Network(net.words, net.rare)

    def learn(self, symbols: np.ndarray, lengths: np.ndarray) -> None:
        if not len(lengths):
            return
        # learning, unlike scoring, restarts inside texts longer than a lane, so that no lane stands idle
        most = max(8 * STEPS, int(lengths.sum()) // LANES)
        lengths = np.concatenate([np.diff(np.append(np.arange(0, n, most), n)) for n in lengths.tolist()])
        inputs, targets, text = packed(symbols, lengths, self.net.end, LANES)
        state = np.zeros((inputs.shape[1], HIDDEN), np.float32)
        for x, y, of, fresh, lanes in windows(inputs, targets, text, STEPS):
            self.grads.vector[:] = 0
            out, state[lanes], kept = self.net.run(x, fresh, state[lanes])
            real = np.flatnonzero(of.ravel() >= 0)
            back = np.zeros((x.size, HIDDEN), np.float32)
            _, back[real] = self.net.output(out.reshape(-1, HIDDEN)[real], y.ravel()[real], self.grads.p)
            self.net.backward(x, fresh, back.reshape(*x.shape, HIDDEN), kept, self.grads.p)
            self.tokens += len(real)
            self._step(len(real))

    def _step(self, n: int) -> None:
        grad = self.grads.vector
        grad *= np.float32(1 / n)
        np.clip(grad, -CLIP, CLIP, out=grad)
        self.turns += 1
        self.first += np.float32(0.1) * (grad - self.first)
        self.second += np.float32(0.01) * (grad * grad - self.second)
        scale = RATE * np.sqrt(1 - 0.99**self.turns) / (1 - 0.9**self.turns)
        self.net.vector -= np.float32(scale) * self.first / (np.sqrt(self.second) + np.float32(1e-7))

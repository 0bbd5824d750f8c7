"""A bidirectional gated recurrent network over bytes in numpy, trained by backpropagation through time.

Sequences are padded to one length; a mask keeps the state where a sequence has ended. Every
position gets a probability of each class from both directions' states.
"""

import numpy as np

EMBEDDED, HIDDEN = 8, 8


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class BiGru:
    def __init__(self, classes: int, seed: int = 0):
        draw = np.random.default_rng(seed).normal
        w = {"embedding": draw(0, 0.3, (257, EMBEDDED)), "out": draw(0, 0.2, (2 * HIDDEN, classes)), "bias": np.zeros(classes)}
        for side in "fb":
            w[f"{side}_in"] = draw(0, EMBEDDED**-0.5, (EMBEDDED, 3 * HIDDEN))
            w[f"{side}_gates"] = draw(0, HIDDEN**-0.5, (HIDDEN, 2 * HIDDEN))
            w[f"{side}_state"] = draw(0, HIDDEN**-0.5, (HIDDEN, HIDDEN))
            w[f"{side}_bias"] = np.zeros(3 * HIDDEN)
        self.weights = {name: value.astype(np.float32) for name, value in w.items()}

    @classmethod
    def of(cls, weights: dict[str, np.ndarray]) -> "BiGru":
        net = cls(len(weights["bias"]))
        net.weights = weights
        return net

    def _run(self, side, e, mask, keep):
        """States by step of one direction, and what backpropagation needs of each step."""
        w, steps = self.weights, range(e.shape[1])
        given = e @ w[f"{side}_in"] + w[f"{side}_bias"]
        h, states, kept = np.zeros((len(e), HIDDEN), np.float32), np.zeros((e.shape[1], len(e), HIDDEN), np.float32), {}
        for t in steps if side == "f" else reversed(steps):
            gates = _sigmoid(given[:, t, : 2 * HIDDEN] + h @ w[f"{side}_gates"])
            update, reset = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(given[:, t, 2 * HIDDEN :] + (reset * h) @ w[f"{side}_state"])
            m = mask[:, t, None]
            after = h + m * update * (new - h)
            if keep:
                kept[t] = (h, update, reset, new)
            h = states[t] = after
        return states, kept

    def _back(self, side, e, mask, kept, outer, grads):
        """Backpropagation through time; ``outer`` is the gradient by step from the output."""
        w, steps = self.weights, range(e.shape[1])
        carried, given = np.zeros((len(e), HIDDEN), np.float32), np.zeros((len(e), e.shape[1], 3 * HIDDEN), np.float32)
        for t in reversed(steps) if side == "f" else steps:
            h, update, reset, new = kept[t]
            grad, m = carried + outer[t], mask[:, t, None]
            d_new = grad * m * update * (1 - new * new)
            d_update = grad * m * (new - h) * update * (1 - update)
            through = d_new @ w[f"{side}_state"].T
            d_reset = through * h * reset * (1 - reset)
            gates = np.concatenate([d_update, d_reset], axis=1)
            grads[f"{side}_state"] += (reset * h).T @ d_new
            grads[f"{side}_gates"] += h.T @ gates
            given[:, t] = np.concatenate([gates, d_new], axis=1)
            carried = grad * (1 - m * update) + through * reset + gates @ w[f"{side}_gates"].T
        grads[f"{side}_bias"] += given.sum(axis=(0, 1))
        grads[f"{side}_in"] += np.einsum("nte,nth->eh", e, given)
        return given @ w[f"{side}_in"].T

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        e = self.weights["embedding"][x]
        forth, kept_f = self._run("f", e, mask, keep)
        back, kept_b = self._run("b", e, mask, keep)
        both = np.concatenate([forth, back], axis=2)
        logits = both @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        log_p = logits - np.log(np.exp(logits).sum(axis=2, keepdims=True))
        return log_p, (e, both, kept_f, kept_b)

    def gradients(self, x, mask, y):
        """Of the mean cross entropy over all positions; every position has its sequence's label."""
        log_p, (e, both, kept_f, kept_b) = self.forward(x, mask, keep=True)
        grads = {name: np.zeros_like(value) for name, value in self.weights.items()}
        error = np.exp(log_p)
        error[:, np.arange(len(y)), y] -= 1
        error *= mask.T[:, :, None] / mask.sum()
        grads["out"] = np.einsum("tnh,tnc->hc", both, error)
        grads["bias"] = error.sum(axis=(0, 1))
        outer = error @ self.weights["out"].T
        d_e = self._back("f", e, mask, kept_f, outer[:, :, :HIDDEN], grads)
        d_e = d_e + self._back("b", e, mask, kept_b, outer[:, :, HIDDEN:], grads)
        np.add.at(grads["embedding"], x, d_e)
        return grads

    def fit(self, x, mask, y, epochs: int = 3, batch: int = 256, rate: float = 0.01, seed: int = 0) -> None:
        order, step = np.random.default_rng(seed), 0
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        spread = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for _ in range(epochs):
            rows = order.permutation(len(x))
            for start in range(0, len(rows), batch):
                some, step = rows[start : start + batch], step + 1
                longest = int(mask[some].sum(axis=1).max())
                for name, g in self.gradients(x[some, :longest], mask[some, :longest], y[some]).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    spread[name] = 0.999 * spread[name] + 0.001 * g * g
                    change = mean[name] / (1 - 0.9**step) / (np.sqrt(spread[name] / (1 - 0.999**step)) + 1e-8)
                    self.weights[name] = self.weights[name] - np.float32(rate) * change

    def evidence(self, x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Log probabilities of each class, summed over the positions of each sequence.

        ``x`` is (position, sequence), with the longest sequences first, so that a step
        works on those that have not ended and needs no mask.
        """
        w, steps = self.weights, range(len(x))
        there = np.searchsorted(-sizes, -np.arange(len(x)), side="left")  # sequences longer than t
        states = np.zeros((len(x), x.shape[1], 2 * HIDDEN), np.float32)
        for side, order, first in (("f", steps, 0), ("b", reversed(steps), HIDDEN)):
            table = w["embedding"] @ w[f"{side}_in"] + w[f"{side}_bias"]
            table[:, : 2 * HIDDEN] *= -1  # what the sigmoid takes the exponent of
            gates_w, state_w = -w[f"{side}_gates"], w[f"{side}_state"]
            h = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t in order:
                now, n = h[: there[t]], there[t]
                given = table[x[t, :n]]
                gates = given[:, : 2 * HIDDEN] + now @ gates_w
                np.exp(gates, out=gates)
                gates += 1
                np.reciprocal(gates, out=gates)
                new = given[:, 2 * HIDDEN :] + (gates[:, HIDDEN:] * now) @ state_w
                np.tanh(new, out=new)
                new -= now
                new *= gates[:, :HIDDEN]
                now += new
                states[t, :n, first : first + HIDDEN] = now
        logits = states @ w["out"] + w["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        logits -= np.log(np.exp(logits).sum(axis=2, keepdims=True))
        logits *= (np.arange(len(x))[:, None] < sizes)[:, :, None]
        return logits.sum(axis=0)

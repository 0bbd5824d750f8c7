"""A small convolutional network over characters, in numpy: forward, backward, Adam.

Characters -> embedding -> convolution -> ReLU -> maximum over the window -> dense -> one logit,
then a logistic calibration of the logit on labelled rows the fit has not seen.
"""

import numpy as np

WIDTH, EMBEDDED, FILTERS, KERNEL = 96, 8, 24, 5
#: Printable ASCII, one class for other characters, one for padding, and where the candidate lies.
_SYMBOLS = 98


def encode(windows: list[tuple[str, str, str]]) -> np.ndarray:
    """(before, candidate, after) as symbols; candidate symbols are a second alphabet."""
    out = np.zeros((len(windows), WIDTH), np.int16)
    for row, (before, middle, after) in enumerate(windows):
        text = before + middle + after
        codes = np.frombuffer(text[:WIDTH].encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        codes = np.where((codes >= 32) & (codes < 127), codes - 30, 1)
        codes[len(before) : len(before) + len(middle)] += _SYMBOLS
        out[row, : len(codes)] = codes
    return out


class CharNet:
    def __init__(self, seed: int = 0):
        draw = np.random.default_rng(seed).normal
        self.weights = {
            "embedding": draw(0, 0.3, (2 * _SYMBOLS, EMBEDDED)),
            "filters": draw(0, 0.2, (KERNEL * EMBEDDED, FILTERS)),
            "filter_bias": np.zeros(FILTERS),
            "dense": draw(0, 0.2, (FILTERS, 1)),
            "bias": np.zeros(1),
        }
        self.scale, self.shift = 1.0, 0.0
        self.mean, self.spread = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        self.step = 0

    def state(self) -> np.ndarray:
        """The weights and Adam's two means of their gradients, one behind the other."""
        return np.concatenate([part[k].ravel() for part in (self.weights, self.mean, self.spread) for k in self.weights])

    def resume(self, state: np.ndarray, step: int) -> "CharNet":
        """Go on from a ``state`` after ``step`` steps."""
        at = 0
        for part in (self.weights, self.mean, self.spread):
            for name, value in part.items():
                part[name] = state[at : at + value.size].reshape(value.shape)
                at += value.size
        self.step = step
        return self

    def plain(self) -> dict:
        """All that the network knows, as arrays and numbers."""
        return {"weights": self.weights, "scale": float(self.scale), "shift": float(self.shift)}

    @classmethod
    def of(cls, plain: dict) -> "CharNet":
        net = cls()
        net.weights, net.scale, net.shift = plain["weights"], plain["scale"], plain["shift"]
        return net

    def _forward(self, x):
        w = self.weights
        e = w["embedding"][x]
        steps = x.shape[1] - KERNEL + 1
        columns = np.concatenate([e[:, k : k + steps] for k in range(KERNEL)], axis=2)
        z = columns @ w["filters"] + w["filter_bias"]
        at = z.argmax(axis=1)
        top = np.take_along_axis(z, at[:, None], axis=1)[:, 0]
        return columns, at, np.maximum(top, 0), (np.maximum(top, 0) @ w["dense"] + w["bias"])[:, 0]

    def _gradients(self, x, y):
        w, rows = self.weights, np.arange(len(x))
        columns, at, top, logit = self._forward(x)
        error = (1 / (1 + np.exp(-logit)) - y)[:, None] / len(x)
        back = (error @ w["dense"].T) * (top > 0)
        grads = {"dense": top.T @ error, "bias": error.sum(axis=0), "filter_bias": back.sum(axis=0)}
        picked = columns[rows[:, None], at]  # row, filter, kernel * embedding
        grads["filters"] = np.einsum("rfk,rf->kf", picked, back)
        to_columns = back[:, :, None] * w["filters"].T[None]
        embedding = np.zeros_like(w["embedding"])
        for k in range(KERNEL):
            symbols = x[rows[:, None], at + k]
            np.add.at(embedding, symbols, to_columns[:, :, k * EMBEDDED : (k + 1) * EMBEDDED])
        grads["embedding"] = embedding
        return grads

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int, order: np.random.Generator, batch: int = 64, rate: float = 0.01) -> None:
        mean, spread = self.mean, self.spread
        for _ in range(epochs):
            rows = order.permutation(len(x))
            for start in range(0, len(rows), batch):
                some = rows[start : start + batch]
                self.step += 1
                for name, g in self._gradients(x[some], y[some]).items():
                    mean[name] = 0.9 * mean[name] + 0.1 * g
                    spread[name] = 0.999 * spread[name] + 0.001 * g * g
                    change = mean[name] / (1 - 0.9**self.step) / (np.sqrt(spread[name] / (1 - 0.999**self.step)) + 1e-8)
                    self.weights[name] = self.weights[name] - rate * change

    def logits(self, x: np.ndarray, batch: int = 512) -> np.ndarray:
        found = [self._forward(x[k : k + batch])[3] for k in range(0, len(x), batch)]
        return np.concatenate(found) if found else np.empty(0)

    def calibrate(self, logits: np.ndarray, y: np.ndarray, counts: np.ndarray, steps: int = 200) -> None:
        """Fit probability = sigmoid(scale * logit + shift) by Newton's method; rows come as counts of a logit and class."""
        features = np.stack([logits, np.ones(len(logits))], axis=1)
        # Counts as if one more row of each class had been seen, so that no fit runs away.
        yes, no = counts @ y, counts @ (1 - y)
        wanted = np.where(y > 0, (yes + 1) / (yes + 2), 1 / (no + 2))
        both = np.array([1.0, 0.0])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(features @ both, -30, 30)))
            gradient = features.T @ (counts * (p - wanted))
            curve = (features * (counts * p * (1 - p))[:, None]).T @ features + 1e-6 * np.eye(2)
            move = np.linalg.solve(curve, gradient)
            both = both - np.clip(move, -1, 1)
            if np.abs(move).max() < 1e-8:
                break
        self.scale, self.shift = both

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.logits(x))

    def calibrated(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))

"""A small character network in numpy: embedding, one convolution, maxima by region, one hidden layer, a logit.

Windows have a fixed layout: LEFT characters before a candidate, BODY characters of it, RIGHT characters after it,
as bytes (0 where there is none).
"""

from __future__ import annotations

import numpy as np

LEFT, BODY, RIGHT = 16, 32, 16
WINDOW = LEFT + BODY + RIGHT
_SPAN, _WIDE, _FILTERS, _HIDDEN = 5, 12, 24, 16
#: Convolution positions of the three regions: context before, candidate, context after.
_REGIONS = ((0, LEFT), (LEFT, LEFT + BODY - _SPAN + 1), (LEFT + BODY - _SPAN + 1, WINDOW - _SPAN + 1))
#: Steps of training at least, however few windows there are.
LEAST_STEPS = 300
#: Windows scored at once.
_BATCH = 512


def as_codes(windows: bytes) -> np.ndarray:
    """Windows laid end to end as one row of character codes each."""
    return np.frombuffer(windows, dtype=np.uint8).reshape(-1, WINDOW) & 127


class CharNetwork:
    """Logits of windows; ``train`` learns from labelled ones by Adam, the same for the same rows in the same order."""

    def __init__(self, seed: int = 12):
        r = np.random.default_rng(seed)
        self.p = {"e": r.normal(0, 0.3, (128, _WIDE)), "w": r.normal(0, 0.15, (_SPAN * _WIDE, _FILTERS)), "b": np.zeros(_FILTERS),
                  "v": r.normal(0, 0.15, (3 * _FILTERS, _HIDDEN)), "c": np.zeros(_HIDDEN), "u": r.normal(0, 0.3, _HIDDEN), "d": np.zeros(1)}
        self.mean, self.spread = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        self.steps = 0.0

    def _forward(self, x: np.ndarray):
        e = self.p["e"][x]
        cols = np.concatenate([e[:, i:WINDOW - _SPAN + 1 + i] for i in range(_SPAN)], axis=2)
        conv = np.maximum((cols.reshape(-1, _SPAN * _WIDE) @ self.p["w"]).reshape(len(x), -1, _FILTERS) + self.p["b"], 0)
        at = np.stack([conv[:, a:z].argmax(axis=1) + a for a, z in _REGIONS], axis=1)  # rows, regions, filters
        rows = np.arange(len(x))[:, None, None]
        top = conv[rows, at, np.arange(_FILTERS)]
        hidden = np.maximum(top.reshape(len(x), -1) @ self.p["v"] + self.p["c"], 0)
        return cols, at, top, hidden, hidden @ self.p["u"] + self.p["d"][0]

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._forward(x[i:i + _BATCH])[4] for i in range(0, len(x), _BATCH)]) if len(x) else np.zeros(0)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        cols, at, top, hidden, z = self._forward(x)
        dz = (1 / (1 + np.exp(-z)) - y) / len(x)
        dh = np.outer(dz, self.p["u"]) * (hidden > 0)
        dtop = (dh @ self.p["v"].T).reshape(top.shape) * (top > 0)
        rows = np.arange(len(x))[:, None, None]
        picked = cols[rows, at]  # rows, regions, filters, span * wide
        flow = (dtop[..., None] * self.p["w"].T).reshape(*dtop.shape, _SPAN, _WIDE)
        de = np.zeros_like(self.p["e"])
        for i in range(_SPAN):
            codes = x[rows, at + i].ravel()
            for j in range(_WIDE):
                de[:, j] += np.bincount(codes, flow[..., i, j].ravel(), minlength=128)
        dw = np.stack([picked[:, :, f].reshape(-1, _SPAN * _WIDE).T @ dtop[:, :, f].ravel() for f in range(_FILTERS)], axis=1)
        return {"e": de, "w": dw, "b": dtop.sum(axis=(0, 1)),
                "v": top.reshape(len(x), -1).T @ dh, "c": dh.sum(axis=0), "u": hidden.T @ dz, "d": np.array([dz.sum()])}

    def _tables(self) -> list[tuple[dict, str]]:
        return [(d, k) for d in (self.p, self.mean, self.spread) for k in sorted(self.p)]

    def state(self) -> np.ndarray:
        """Parameters, Adam's means and spreads and the steps made, as one row of numbers."""
        return np.concatenate([d[k].ravel() for d, k in self._tables()] + [np.array([self.steps], dtype=float)])

    def restore(self, state: np.ndarray) -> CharNetwork:
        at = 0
        for d, k in self._tables():
            d[k] = state[at:at + d[k].size].reshape(d[k].shape).copy()
            at += d[k].size
        self.spread = {k: np.maximum(v, 0) for k, v in self.spread.items()}
        self.steps = state[at]
        return self

    def train(self, x: np.ndarray, y: np.ndarray, turn: int = 0, passes: int = 1, batch: int = 128, rate: float = 0.004, seed: int = 12) -> CharNetwork:
        """One pass of ``passes``: every window at least once, both labels alike (the rarer one is repeated). Half of the windows of a step lose
        the context before the candidate and a quarter the context after it, so the characters of the candidate count by themselves."""
        r = np.random.default_rng(seed)
        own = [np.flatnonzero(y == k) for k in (1, 0)]
        steps = max(-(-LEAST_STEPS // passes), -(-max(len(o) for o in own) // (batch // 2)))
        turns = [np.concatenate([r.permutation(o) for _ in range(-(-steps * (batch // 2) // len(o)))]) for o in own]
        for t in range(steps):
            at = slice(t * (batch // 2), (t + 1) * (batch // 2))
            picked = np.concatenate([o[at] for o in turns])
            xs = x[picked].copy()
            xs[r.random(batch) < 0.5, :LEFT] = 0
            xs[r.random(batch) < 0.25, LEFT + BODY:] = 0
            self.steps += 1
            for k, g in self._gradients(xs, y[picked].astype(float)).items():
                self.mean[k] += 0.1 * (g - self.mean[k])
                self.spread[k] += 0.001 * (g * g - self.spread[k])
                self.p[k] -= rate * (self.mean[k] / (1 - 0.9 ** self.steps)) / (np.sqrt(self.spread[k] / (1 - 0.999 ** self.steps)) + 1e-8)
        return self

    def fit(self, x: np.ndarray, y: np.ndarray, passes: int = 4) -> CharNetwork:
        for turn in range(passes):
            self.train(x, y, turn, passes, seed=12 + turn)
        return self


def fit_calibration(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """(a, b) of probability 1 / (1 + exp(-(a z + b))) by damped Newton steps on the weighted likelihood, targets drawn in
    a little from 0 and 1 so that separable scores stay finite."""
    up, down = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        grad = np.array([(g * z).sum(), g.sum()])
        curve = np.array([[(h * z * z).sum(), (h * z).sum()], [(h * z).sum(), h.sum()]]) + 1e-6 * np.eye(2) * weight.sum()
        step = np.linalg.solve(curve, grad)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
    return float(a), float(b)

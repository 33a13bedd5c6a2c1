"""A character-level bidirectional LSTM with CRF transitions in numpy: training by gradient, and decoding of windows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Printable ASCII has a class a character; then other white space, letters, digits, all else, and padding.
SPACE, LETTER, DIGIT, OTHER, PAD = range(95, 100)
CLASSES = 100
HIDDEN = 20


def classes_of(text: str) -> np.ndarray:
    """The class of each code point."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = codes - 32
    odd = np.flatnonzero((codes < 32) | (codes > 126))
    if len(odd):
        values, where = np.unique(codes[odd], return_inverse=True)
        kinds = [SPACE if c.isspace() else DIGIT if c.isdigit() else LETTER if c.isalpha() else OTHER for c in map(chr, values.tolist())]
        out[odd] = np.array(kinds)[where]
    return out


@dataclass
class Tagger:
    """Parameters by name. ``x*`` (class, 4 H) and ``h*`` (H, 4 H) feed the gates in, forget, out and new of the direction f or b."""

    params: dict[str, np.ndarray]

    @staticmethod
    def fresh(labels: int, hidden: int = HIDDEN, seed: int = 7, kind=np.float32) -> Tagger:
        rng = np.random.default_rng(seed)
        params = {}
        for d in "fb":
            params[f"x{d}"] = rng.normal(0, 0.3, (CLASSES, 4 * hidden))
            params[f"x{d}"][:, hidden : 2 * hidden] += 1  # begin by remembering
            params[f"h{d}"] = rng.normal(0, hidden**-0.5, (hidden, 4 * hidden))
        params["out"] = rng.normal(0, hidden**-0.5, (2 * hidden, labels))
        params["bias"] = np.zeros(labels)
        params["step"] = np.eye(labels)
        return Tagger({k: v.astype(kind) for k, v in params.items()})

    def _pass(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (B, W, H) of one direction; with ``keep`` what the way back needs."""
        wx, wh = self.params[f"x{d}"], self.params[f"h{d}"]
        n = wh.shape[0]
        half = np.ones(4 * n, wx.dtype)
        half[: 3 * n] = 0.5  # a sigmoid is a tanh of the half
        wx, wh = wx * half, wh * half
        h = c = np.zeros((len(x), n), wx.dtype)
        states, kept = np.empty((x.shape[1], len(x), n), wx.dtype), []
        for t in range(x.shape[1]) if d == "f" else reversed(range(x.shape[1])):
            z = np.tanh(wx[x[:, t]] + h @ wh)
            gates = z[:, : 3 * n] * 0.5 + 0.5
            i, f, o, g = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :], z[:, 3 * n :]
            before, c = c, f * c + i * g
            s = np.tanh(c)
            if keep:
                kept.append((t, h, before, i, f, o, g, s))
            h = states[t] = o * s
        return states.transpose(1, 0, 2), kept

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(B, W, labels) scores of the labels at each place of windows ``x(B, W)`` of classes."""
        both = np.concatenate([self._pass(x, "f", False)[0], self._pass(x, "b", False)[0]], axis=2)
        return both @ self.params["out"] + self.params["bias"]

    def decode(self, x: np.ndarray) -> np.ndarray:
        """The best labels of each window."""
        return viterbi(self.emissions(x), self.params["step"])

    def loss(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of the labels ``y(B, W)`` under the CRF, and its gradients."""
        p, size = self.params, len(x)
        sides = {d: self._pass(x, d, True) for d in "fb"}
        both = np.concatenate([sides["f"][0], sides["b"][0]], axis=2)
        scores = both @ p["out"] + p["bias"]
        value, at, step = crf_gradients(scores, p["step"], y)
        at, grads = at / size, {"step": step / size}
        flat = at.reshape(-1, at.shape[2])
        grads["out"], grads["bias"] = both.reshape(-1, both.shape[2]).T @ flat, flat.sum(0)
        back, n = at @ p["out"].T, both.shape[2] // 2
        for k, d in enumerate("fb"):
            wh = p[f"h{d}"]
            gx, gh = np.zeros_like(p[f"x{d}"]), np.zeros_like(wh)
            dh = dc = np.zeros((size, n), wh.dtype)
            for t, h, before, i, f, o, g, s in reversed(sides[d][1]):
                dh = dh + back[:, t, k * n : (k + 1) * n]
                dc = dc + dh * o * (1 - s * s)
                dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g * g)], axis=1)
                np.add.at(gx, x[:, t], dz)
                gh += h.T @ dz
                dh, dc = dz @ wh.T, dc * f
            grads[f"x{d}"], grads[f"h{d}"] = gx, gh
        return value / size, grads


def _total(a: np.ndarray, axis: int) -> np.ndarray:
    """log of the sum of exponentials."""
    most = a.max(axis, keepdims=True)
    return (most + np.log(np.exp(a - most).sum(axis, keepdims=True))).squeeze(axis)


def crf_gradients(scores: np.ndarray, step: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Negative log likelihood of ``y``, summed over windows, and its gradients by scores and transitions."""
    size, width, labels = scores.shape
    ahead, behind = np.empty_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, width):
        ahead[:, t] = _total(ahead[:, t - 1, :, None] + step, 1) + scores[:, t]
    for t in reversed(range(width - 1)):
        behind[:, t] = _total(step + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    whole = _total(ahead[:, -1], 1)
    rows, places = np.arange(size)[:, None], np.arange(width)[None]
    value = float(whole.sum() - scores[rows, places, y].sum() - step[y[:, :-1], y[:, 1:]].sum())
    at = np.exp(ahead + behind - whole[:, None, None])
    at[rows, places, y] -= 1
    pairs = ahead[:, :-1, :, None] + step + (scores + behind)[:, 1:, None, :] - whole[:, None, None, None]
    over = np.exp(pairs).sum((0, 1))
    np.subtract.at(over, (y[:, :-1], y[:, 1:]), 1)
    return value, at, over


def viterbi(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Labels (B, W) of the best path through ``scores(B, W, labels)``; of equal ones the lowest label."""
    size, width, _ = scores.shape
    came = np.empty(scores.shape, np.int8)
    best = scores[:, 0]
    for t in range(1, width):
        ways = best[:, :, None] + step
        came[:, t] = ways.argmax(1)
        best = ways.max(1) + scores[:, t]
    out = np.empty((size, width), np.int8)
    if width:
        out[:, -1] = best.argmax(1)
    for t in reversed(range(1, width)):
        out[:, t - 1] = came[np.arange(size), t, out[:, t]]
    return out


def train(tagger: Tagger, x: np.ndarray, y: np.ndarray, epochs: int, batch: int = 48, rate: float = 0.01, seed: int = 7) -> float:
    """Adam over shuffled batches, the rate falling to zero; changes ``tagger`` and returns the last epoch's mean loss."""
    rng, params = np.random.default_rng(seed), tagger.params
    first, second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))
    count, steps, mean = 0, max(1, epochs * -(-len(x) // batch)), 0.0
    for _ in range(epochs):
        order, losses = rng.permutation(len(x)), []
        for at in range(0, len(x), batch):
            pick = order[at : at + batch]
            value, grads = tagger.loss(x[pick], y[pick])
            losses.append(value)
            count += 1
            norm = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in grads.values())))
            shrink, now = min(1.0, 5.0 / max(norm, 1e-9)), rate * (1 - (count - 1) / steps)
            for k, g in grads.items():
                g = g * shrink
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.001 * (g * g - second[k])
                params[k] -= (now * (first[k] / (1 - 0.9**count)) / (np.sqrt(second[k] / (1 - 0.999**count)) + 1e-8)).astype(params[k].dtype)
        mean = float(np.mean(losses))
    return mean

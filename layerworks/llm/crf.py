"""A bidirectional LSTM over characters with a linear-chain CRF on top, in numpy.

``Tagger`` maps windows of character classes to one tag a place.  Two LSTMs read a window from
either side; a linear layer turns their states into scores of the tags, and the CRF adds
scores of a tag after another.  ``fit`` follows the exact gradient of the windows' log
likelihood (forward-backward over the chain, then back through time) with Adam; ``decode``
finds the best sequence of tags.
"""

from __future__ import annotations

import numpy as np

BARRED = np.float32(-1e4)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return np.log(np.exp(x - most).sum(axis)) + most.squeeze(axis)


class Tagger:
    """``allowed[a, b]``: tag b may follow tag a; ``first[b]``: b may stand first."""

    def __init__(self, classes: int, allowed: np.ndarray, first: np.ndarray, embedded: int = 12, hidden: int = 16, seed: int = 13):
        rng = np.random.default_rng(seed)
        tags = len(first)
        glorot = lambda a, b: (rng.uniform(-1, 1, (a, b)) * np.sqrt(6 / (a + b))).astype(np.float32)
        bias = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)  # gates: in, keep, out, new
        self.hidden = hidden
        self.barred = np.where(allowed, np.float32(0), BARRED), np.where(first, np.float32(0), BARRED)
        self.p = {
            "embed": (0.3 * rng.standard_normal((classes, embedded))).astype(np.float32),
            "tag": glorot(2 * hidden, tags), "tag_bias": np.zeros(tags, np.float32), "next": np.zeros((tags, tags), np.float32), "start": np.zeros(tags, np.float32),
        }
        for side in ("there", "back"):
            self.p |= {f"{side}_in": glorot(embedded, 4 * hidden), f"{side}_state": glorot(hidden, 4 * hidden), f"{side}_bias": bias.copy()}

    def _lstm(self, x: np.ndarray, side: str) -> tuple[np.ndarray, list]:
        """States (time first) of one direction, and what the way back needs."""
        h_size, state = self.hidden, self.p[f"{side}_state"]
        z_in = x @ self.p[f"{side}_in"] + self.p[f"{side}_bias"]
        steps = range(len(x)) if side == "there" else range(len(x) - 1, -1, -1)
        h, c = (np.zeros((x.shape[1], h_size), np.float32) for _ in range(2))
        out, tape = np.empty((len(x), x.shape[1], h_size), np.float32), []
        for t in steps:
            z = z_in[t] + h @ state
            gate, new = _sigmoid(z[:, : 3 * h_size]), np.tanh(z[:, 3 * h_size :])
            i, f, o = gate[:, :h_size], gate[:, h_size : 2 * h_size], gate[:, 2 * h_size :]
            before_h, before_c = h, c
            c = f * c + i * new
            squashed = np.tanh(c)
            h = o * squashed
            out[t] = h
            tape.append((t, i, f, o, new, before_h, before_c, squashed))
        return out, tape

    def _lstm_back(self, d_out: np.ndarray, x: np.ndarray, side: str, tape: list, grads: dict) -> np.ndarray:
        h_size, state = self.hidden, self.p[f"{side}_state"]
        d_z = np.empty((*x.shape[:2], 4 * h_size), np.float32)
        dh, dc, d_state = np.zeros_like(d_out[0]), np.zeros_like(d_out[0]), np.zeros_like(state)
        for t, i, f, o, new, before_h, before_c, squashed in reversed(tape):
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - squashed**2)
            z = d_z[t]
            z[:, :h_size] = dc * new * i * (1 - i)
            z[:, h_size : 2 * h_size] = dc * before_c * f * (1 - f)
            z[:, 2 * h_size : 3 * h_size] = dh * squashed * o * (1 - o)
            z[:, 3 * h_size :] = dc * i * (1 - new**2)
            d_state += before_h.T @ z
            dh, dc = z @ state.T, dc * f
        flat = d_z.reshape(-1, 4 * h_size)
        grads[f"{side}_in"], grads[f"{side}_state"], grads[f"{side}_bias"] = x.reshape(len(flat), -1).T @ flat, d_state, flat.sum(0)
        return d_z @ self.p[f"{side}_in"].T

    def scores(self, windows: np.ndarray) -> np.ndarray:
        """Scores of the tags at each place (time, window, tag)."""
        x = self.p["embed"][windows.T]
        h = np.concatenate([self._lstm(x, "there")[0], self._lstm(x, "back")[0]], 2)
        return h @ self.p["tag"] + self.p["tag_bias"]

    def decode(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tags of each window (window, time), and the scores (window, time, tag)."""
        scores = self.scores(windows)
        follow, at = self.p["next"] + self.barred[0], self.p["start"] + self.barred[1] + scores[0]
        came = np.empty(scores.shape, np.int8)
        for t in range(1, len(scores)):
            ways = at[:, :, None] + follow[None]
            came[t] = ways.argmax(1)
            at = np.take_along_axis(ways, came[t][:, None].astype(np.int64), 1)[:, 0] + scores[t]
        tags = np.empty(scores.shape[:2], np.int64)
        tags[-1] = at.argmax(1)
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = np.take_along_axis(came[t], tags[t][:, None], 1)[:, 0]
        return tags.T, scores.swapaxes(0, 1)

    def gradients(self, windows: np.ndarray, tags: np.ndarray) -> tuple[float, dict]:
        """Mean negative log likelihood of the windows' tags (window, time), and its gradient."""
        n, many = len(windows), len(self.p["start"])
        x = self.p["embed"][windows.T]
        there, tape_there = self._lstm(x, "there")
        back, tape_back = self._lstm(x, "back")
        h = np.concatenate([there, back], 2)
        scores = h @ self.p["tag"] + self.p["tag_bias"]
        follow, start = self.p["next"] + self.barred[0], self.p["start"] + self.barred[1]
        steps = len(scores)
        ahead, behind = np.empty_like(scores), np.zeros_like(scores)
        ahead[0] = start + scores[0]
        for t in range(1, steps):
            ahead[t] = _logsumexp(ahead[t - 1][:, :, None] + follow[None], 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            behind[t] = _logsumexp(follow[None] + (scores[t + 1] + behind[t + 1])[:, None], 2)
        total = _logsumexp(ahead[-1], 1)
        gold, places = tags.T, np.arange(n)
        d_scores = np.exp(ahead + behind - total[None, :, None])
        one = np.zeros_like(d_scores)
        np.put_along_axis(one, gold[:, :, None], 1, 2)
        d_next = np.zeros((many, many), np.float32)
        path = start[gold[0]] + scores[0, places, gold[0]]
        for t in range(1, steps):
            d_next += np.exp(ahead[t - 1][:, :, None] + follow[None] + (scores[t] + behind[t])[:, None] - total[:, None, None]).sum(0)
            path = path + follow[gold[t - 1], gold[t]] + scores[t, places, gold[t]]
        np.subtract.at(d_next, (gold[:-1].ravel(), gold[1:].ravel()), 1)
        d_scores -= one
        d_scores /= n
        grads = {"next": d_next / n, "start": d_scores[0].sum(0), "tag_bias": d_scores.sum((0, 1)), "tag": h.reshape(-1, 2 * self.hidden).T @ d_scores.reshape(-1, many)}
        d_h = d_scores @ self.p["tag"].T
        d_x = self._lstm_back(d_h[:, :, : self.hidden], x, "there", tape_there, grads) + self._lstm_back(d_h[:, :, self.hidden :], x, "back", tape_back, grads)
        grads["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grads["embed"], windows.T.ravel(), d_x.reshape(-1, d_x.shape[2]))
        return float((total - path).mean()), grads

    def fit(self, windows: np.ndarray, tags: np.ndarray, epochs: int = 7, batch: int = 128, rate: float = 0.02, seed: int = 17) -> list[float]:
        """Adam with a falling rate; mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        steps, step, losses = epochs * -(-len(windows) // batch), 0, []
        for _ in range(epochs):
            order, lost = rng.permutation(len(windows)), 0.0
            for a in range(0, len(order), batch):
                some = order[a : a + batch]
                loss, grads = self.gradients(windows[some], tags[some])
                lost += loss * len(some)
                step += 1
                scale = min(1.0, 5.0 / (np.sqrt(sum(float((g**2).sum()) for g in grads.values())) + 1e-12))
                for k, g in grads.items():
                    mean[k] += 0.1 * (scale * g - mean[k])
                    square[k] += 0.001 * ((scale * g) ** 2 - square[k])
                    now = rate * (1 - 0.9 * step / steps)
                    self.p[k] -= (now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(lost / max(len(order), 1))
        return losses

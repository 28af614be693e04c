"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Windows are arrays (rows, length) of character codes. The network gives a score
per character and tag; the CRF adds a score per pair of tags in a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CODES = 99
EMBED, HIDDEN = 8, 16


def codes_of(text: str) -> np.ndarray:
    """Printable ASCII apart, line breaks, other letters, anything else."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.where((points >= 32) & (points < 127), points - 32, 98)
    codes[points == 10] = 96
    codes[points >= 192] = 97
    return codes


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


@dataclass
class CharCrf:
    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, tags: int, seed: int) -> CharCrf:
        rng = np.random.default_rng(seed)
        w = {"embed": rng.normal(0, 0.3, (CODES, EMBED))}
        for side in ("fore", "back"):
            w[side + "_w"] = rng.normal(0, 0.25, (EMBED + HIDDEN, 4 * HIDDEN))
            bias = np.zeros(4 * HIDDEN)
            bias[HIDDEN : 2 * HIDDEN] = 1  # forget gates begin open
            w[side + "_b"] = bias
        w["out_w"] = rng.normal(0, 0.2, (2 * HIDDEN, tags))
        w["out_b"] = np.zeros(tags)
        w["pairs"] = np.zeros((tags, tags))
        return cls({k: v.astype(np.float32) for k, v in w.items()})

    def _run(self, x: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        """Hidden states (length, rows, HIDDEN) of one direction."""
        w, b = self.weights[side + "_w"], self.weights[side + "_b"]
        length, rows, _ = x.shape
        hidden = np.zeros((length, rows, HIDDEN), np.float32)
        h = np.zeros((rows, HIDDEN), np.float32)
        c = np.zeros((rows, HIDDEN), np.float32)
        steps = range(length) if side == "fore" else range(length - 1, -1, -1)
        for t in steps:
            inputs = np.concatenate((x[t], h), 1)
            gates = inputs @ w + b
            gates[:, : 3 * HIDDEN] = _sigmoid(gates[:, : 3 * HIDDEN])
            gates[:, 3 * HIDDEN :] = np.tanh(gates[:, 3 * HIDDEN :])
            i, f, o, g = np.split(gates, 4, 1)
            before = c
            c = f * c + i * g
            squashed = np.tanh(c)
            h = o * squashed
            hidden[t] = h
            if keep is not None:
                keep.append((t, inputs, gates, before, squashed))
        return hidden

    def scores(self, codes: np.ndarray) -> np.ndarray:
        """Tag scores (rows, length, tags)."""
        x = self.weights["embed"][codes.T]
        both = np.concatenate([self._run(x, side, None) for side in ("fore", "back")], 2)
        return (both @ self.weights["out_w"] + self.weights["out_b"]).transpose(1, 0, 2)

    def gradients(self, codes: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of the tags."""
        w = self.weights
        rows, length = codes.shape
        x = w["embed"][codes.T]
        kept: dict[str, list] = {"fore": [], "back": []}
        both = np.concatenate([self._run(x, side, kept[side]) for side in kept], 2)
        scores = both @ w["out_w"] + w["out_b"]
        d_scores, d_pairs = _crf_gradients(scores, w["pairs"], tags.T)
        d_scores /= rows
        out = {
            "pairs": d_pairs / rows,
            "out_w": np.einsum("trh,trk->hk", both, d_scores),
            "out_b": d_scores.sum((0, 1)),
        }
        d_both = d_scores @ w["out_w"].T
        d_x = np.zeros_like(x)
        for k, side in enumerate(kept):
            d_hidden = d_both[:, :, k * HIDDEN : (k + 1) * HIDDEN]
            weight = w[side + "_w"]
            d_w, d_b = np.zeros_like(weight), np.zeros_like(w[side + "_b"])
            d_h = np.zeros((rows, HIDDEN), np.float32)
            d_c = np.zeros((rows, HIDDEN), np.float32)
            for t, inputs, gates, before, squashed in reversed(kept[side]):
                i, f, o, g = np.split(gates, 4, 1)
                d_h = d_h + d_hidden[t]
                d_c = d_c + d_h * o * (1 - squashed**2)
                d_gates = np.concatenate(
                    (
                        d_c * g * i * (1 - i),
                        d_c * before * f * (1 - f),
                        d_h * squashed * o * (1 - o),
                        d_c * i * (1 - g**2),
                    ),
                    1,
                )
                d_w += inputs.T @ d_gates
                d_b += d_gates.sum(0)
                d_inputs = d_gates @ weight.T
                d_x[t] += d_inputs[:, :EMBED]
                d_h = d_inputs[:, EMBED:]
                d_c = d_c * f
            out[side + "_w"], out[side + "_b"] = d_w, d_b
        d_embed = np.zeros_like(w["embed"])
        np.add.at(d_embed, codes.T, d_x)
        out["embed"] = d_embed
        return out

    def fit(
        self, codes: np.ndarray, tags: np.ndarray, steps: int, batch: int, rate: float, seed: int
    ) -> None:
        """Adam over shuffled batches."""
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = np.empty(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < batch:
                order = np.concatenate((order, rng.permutation(len(codes))))
            take, order = order[:batch], order[batch:]
            for k, g in self.gradients(codes[take], tags[take]).items():
                g = np.clip(g, -1, 1)
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                scale = np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8
                move = rate * mean[k] / (1 - 0.9**step) / scale
                self.weights[k] = (self.weights[k] - move).astype(np.float32)


def _crf_gradients(scores: np.ndarray, pairs: np.ndarray, tags: np.ndarray):
    """Of the summed negative log-likelihood, by scores and by pair scores."""
    length, rows, k = scores.shape
    fore = np.empty_like(scores)
    back = np.zeros_like(scores)
    fore[0] = scores[0]
    for t in range(1, length):
        fore[t] = _logsumexp(fore[t - 1][:, :, None] + pairs, 1) + scores[t]
    for t in range(length - 2, -1, -1):
        back[t] = _logsumexp(pairs + (scores[t + 1] + back[t + 1])[:, None, :], 2)
    total = _logsumexp(fore[-1], 1)
    d_scores = np.exp(fore + back - total[None, :, None])
    between = (
        fore[:-1][:, :, :, None] + pairs + (scores[1:] + back[1:])[:, :, None, :]
    ) - total[None, :, None, None]
    d_pairs = np.exp(between).sum((0, 1))
    np.subtract.at(d_pairs, (tags[:-1].ravel(), tags[1:].ravel()), 1)
    t, r = np.indices(tags.shape)
    d_scores[t, r, tags] -= 1
    return d_scores, d_pairs


def best_tags(scores: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The best tag sequence of every row; scores are (rows, length, tags)."""
    rows, length, k = scores.shape
    origin = np.zeros((length, rows, k), np.int8)
    best = scores[:, 0].copy()
    for t in range(1, length):
        reach = best[:, :, None] + pairs
        origin[t] = reach.argmax(1)
        best = reach.max(1) + scores[:, t]
    tags = np.empty((rows, length), np.int8)
    tags[:, -1] = best.argmax(1)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = origin[t][np.arange(rows), tags[:, t]]
    return tags

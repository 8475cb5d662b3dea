"""A log-bilinear neural language model in numpy, trained with noise-contrastive estimation.

The words before a token predict a vector, linearly; its product with an outcome's vector, and the
outcome's bias, is the outcome's score. Training tells outcomes from noise and needs no normalisation;
scoring normalises over all outcomes by one matrix product a block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SIZE = 16
CONTEXT = 4
NOISE = 64
BATCH = 512
RATE = 0.02
#: Tokens normalised at a time.
BLOCK = 512
#: Sums below this are worked out on logarithms: single precision ends at some 1e-38.
LEAST = 1e-28


@dataclass
class LogBilinear:
    """``context`` has a row per outcome and one for a text's start; ``mix[j]`` is for the word j + 1 back."""

    context: np.ndarray
    mix: np.ndarray
    outcome: np.ndarray
    bias: np.ndarray

    @staticmethod
    def start(unigram: np.ndarray, seed: int = 5) -> LogBilinear:
        """The unigram distribution, with small random vectors."""
        rng, n = np.random.default_rng(seed), len(unigram)
        small = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        mix = np.stack([np.eye(SIZE) / (j + 1) for j in range(CONTEXT)]).astype(np.float32)
        return LogBilinear(small(n + 1, SIZE), mix, small(n, SIZE), np.log(unigram).astype(np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.context, self.mix, self.outcome, self.bias]

    def vector(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()]).astype(float)

    def with_vector(self, values: np.ndarray) -> LogBilinear:
        ends = np.cumsum([w.size for w in self.weights()])
        parts = np.split(values, ends[:-1])
        return LogBilinear(*[p.reshape(w.shape).astype(np.float32) for p, w in zip(parts, self.weights())])

    def gradients(self, before: np.ndarray, token: np.ndarray, noise: np.ndarray, log_noise: np.ndarray, with_loss: bool = True):
        """Mean loss (0 unless ``with_loss``) of telling ``token`` from ``noise`` (shared by the batch), and the gradient of every array of ``weights()``.

        ``before`` has the ``CONTEXT`` outcomes before each token, nearest first; ``log_noise`` is the
        logarithm of (noise samples times noise probability) by outcome.
        """
        n = len(token)
        known = self.context[before]
        known, mix = known.reshape(n, -1), self.mix.reshape(-1, SIZE)
        h = known @ mix
        of_token, of_noise = self.outcome[token], self.outcome[noise]
        true = (h * of_token).sum(1) + self.bias[token] - log_noise[token]
        false = h @ of_noise.T + (self.bias[noise] - log_noise[noise])
        loss = float(np.logaddexp(0, -true).sum() + np.logaddexp(0, false).sum()) / n if with_loss else 0.0
        g_true = (_sigmoid(true) - 1) / n
        g_false = _sigmoid(false)
        g_false /= n
        d_h = g_true[:, None] * of_token + g_false @ of_noise
        d_outcome, d_bias = np.zeros_like(self.outcome), np.zeros_like(self.bias)
        _add_rows(d_outcome, token, g_true[:, None] * h)
        _add_rows(d_outcome, noise, g_false.T @ h)
        np.add.at(d_bias, token, g_true)
        np.add.at(d_bias, noise, g_false.sum(0))
        d_mix = (known.T @ d_h).reshape(self.mix.shape)
        d_context = np.zeros_like(self.context)
        _add_rows(d_context, before.ravel(), (d_h @ mix.T).reshape(-1, SIZE))
        return loss, [d_context, d_mix, d_outcome, d_bias]

    def normalised(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Natural log-probability of each token, normalised over all outcomes.

        A score is a sum of one term for each word back, so its exponential is a product of rows of as many
        tables, each at most 1: nothing is exponentiated a token, unless all its products all but vanish.
        """
        terms = np.einsum("kd,jde->jke", self.context, self.mix, optimize=True) @ self.outcome.T
        terms[0] += self.bias
        terms -= terms.max(2, keepdims=True)
        factors = np.exp(terms)
        found = sum(terms[j][before[:, j], token] for j in range(CONTEXT))
        sums = np.empty(len(token), np.float32)
        product, factor = np.empty((2, BLOCK, len(self.bias)), np.float32)
        for i in range(0, len(token), BLOCK):
            some = before[i : i + BLOCK]
            n = len(some)
            # "clip" looks at no bounds, the outcomes are within them
            np.take(factors[0], some[:, 0], 0, product[:n], "clip")
            for j in range(1, CONTEXT):
                np.take(factors[j], some[:, j], 0, factor[:n], "clip")
                if j < CONTEXT - 1:
                    np.multiply(product[:n], factor[:n], product[:n])
            sums[i : i + n] = np.einsum("ij,ij->i", product[:n], factor[:n])
        few = np.flatnonzero(sums < LEAST)
        sums[few] = 1
        out = found - np.log(sums)
        for at in np.split(few, range(BLOCK, len(few), BLOCK)):
            scores = sum(terms[j][before[at, j]] for j in range(CONTEXT))
            out[at] = scores[np.arange(len(at)), token[at]] - np.logaddexp.reduce(scores, 1)
        return out.astype(float)


def _add_rows(sums: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``np.add.at(sums, at, rows)``, by the much faster path numpy has for one dimension."""
    flat = (at[:, None] * SIZE + np.arange(SIZE)).ravel()
    np.add.at(sums.reshape(-1), flat, rows.ravel())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.clip(x, -30, 30)
    np.exp(np.negative(out, out=out), out=out)
    out += 1
    return np.reciprocal(out, out=out)


class Trainer:
    """Adam over batches of the tokens it is given; the same tokens in the same order give the same weights."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, seed: int):
        self.model = model.with_vector(model.vector())
        self.rng = np.random.default_rng(seed)
        self.log_noise = np.log(NOISE * unigram).astype(np.float32)
        self.cumulative = np.cumsum(unigram)
        self.moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.model.weights()]
        self.steps = self.seen = 0

    def learn(self, before: np.ndarray, token: np.ndarray) -> None:
        order = self.rng.permutation(len(token))
        for i in range(0, len(order), BATCH):
            at = order[i : i + BATCH]
            noise = np.searchsorted(self.cumulative, self.rng.random(NOISE) * self.cumulative[-1], "right")
            noise = np.minimum(noise, len(self.cumulative) - 1)
            _, gradients = self.model.gradients(before[at], token[at], noise, self.log_noise, with_loss=False)
            self.steps += 1
            rate = RATE * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps)
            for w, g, (m, v) in zip(self.model.weights(), gradients, self.moments):
                m += 0.1 * (g - m)
                g *= g
                g -= v
                g *= 0.001
                v += g
                w -= rate * m / (np.sqrt(v) + 1e-8)
        self.seen += len(token)

"""Language identification by a convolutional network over bytes, trained and applied in numpy.

A text is cut into windows of 256 bytes. Each byte has an embedding; filters two, three and four
bytes wide run over the window, each filter's largest response is kept, and a softmax layer turns
those into probabilities. Driver and workers need numpy only.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ebbtide.llm.common import extended, narrow
from ebbtide.llm.worker import kept

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
EMBEDDED = 8
#: Bounds of the labelled sample: documents of a language, of all languages together (one each at least),
#: windows of a document. More labels than the last bound are an error.
SAMPLE_DOCS = 1000
SAMPLE_ALL = 64_000
SAMPLE_WINDOWS = 4
MOST_LABELS = 16_384
#: Windows whose responses are held at a time.
WINDOWS = 4096
#: Passes over the sample, and batches at least: a small sample is passed more often.
EPOCHS = 3
STEPS = 500
BATCH = 64
UNKNOWN = "und"


def windows_of(text: str) -> np.ndarray:
    """The whole text as rows of 256 lower-cased UTF-8 bytes, the last one filled up with zeros."""
    data = text.encode("utf-8", "surrogatepass").lower()
    return np.frombuffer(data + bytes(-len(data) % WINDOW), np.uint8).reshape(-1, WINDOW)


@dataclass
class ByteNet:
    """The network's weights: ``filters[w]`` is (w * EMBEDDED, FILTERS)."""

    languages: list[str]
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    biases: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @staticmethod
    def start(languages: list[str], seed: int = 7) -> ByteNet:
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        return ByteNet(
            languages,
            rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
            {w: normal(w * EMBEDDED, FILTERS) for w in WIDTHS},
            {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
            normal(len(WIDTHS) * FILTERS, len(languages)),
            np.zeros(len(languages), np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters.values(), *self.biases.values(), self.out, self.out_bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss of a batch of windows and the gradient of every array of ``weights()``."""
        n, spans, tops, pooled = len(x), {}, {}, []
        embedded = self.embedding[x]
        for w in WIDTHS:
            spans[w] = np.concatenate([embedded[:, k : WINDOW - w + 1 + k] for k in range(w)], axis=2)
            responses = spans[w] @ self.filters[w] + self.biases[w]
            tops[w] = responses.argmax(1)
            pooled.append(np.take_along_axis(responses, tops[w][:, None], 1)[:, 0])
        hidden = np.maximum(np.concatenate(pooled, 1), 0)
        p = softmax(hidden @ self.out + self.out_bias)
        loss = float(-np.log(p[np.arange(n), y] + 1e-9).mean())
        d = p.copy()
        d[np.arange(n), y] -= 1
        d /= n
        d_hidden = (d @ self.out.T) * (hidden > 0)
        d_embedding = np.zeros_like(self.embedding)
        d_filters, d_biases = [], []
        for i, w in enumerate(WIDTHS):
            g = d_hidden[:, i * FILTERS : (i + 1) * FILTERS]
            at = spans[w][np.arange(n)[:, None], tops[w]]  # window, filter, w * EMBEDDED
            d_filters.append(np.einsum("nf,nfe->ef", g, at))
            d_biases.append(g.sum(0))
            back = (g[:, :, None] * self.filters[w].T[None]).reshape(n, FILTERS, w, EMBEDDED)
            for k in range(w):
                np.add.at(d_embedding, x[np.arange(n)[:, None], tops[w] + k], back[:, :, k])
        return loss, [d_embedding, *d_filters, *d_biases, hidden.T @ d, d.sum(0)]

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.005, seed: int = 11) -> ByteNet:
        """Adam over shuffled batches; the same windows give the same weights."""
        rng, step = np.random.default_rng(seed), 0
        moments = [(np.zeros_like(w), np.zeros_like(w)) for w in self.weights()]
        for _ in range(max(epochs, -(-STEPS * BATCH // len(x)))):
            order = rng.permutation(len(x))
            for i in range(0, len(x), BATCH):
                step += 1
                batch = order[i : i + BATCH]
                for w, g, (m, v) in zip(self.weights(), self.gradients(x[batch], y[batch])[1], moments):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return self

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Applies a network: a filter's response is a sum of table entries by byte or pair of bytes."""

    BLOCK = 32

    def __init__(self, net: ByteNet):
        self.net = net
        single = {
            w: [net.embedding @ net.filters[w][k * EMBEDDED : (k + 1) * EMBEDDED] for k in range(w)] for w in WIDTHS
        }
        pair = lambda a, b: (a[:, None] + b[None]).reshape(1 << 16, FILTERS)
        self.tables = {
            w: [
                (k, pair(t[k], t[k + 1]) if k + 1 < w else t[k]) for k in range(0, w, 2)
            ]
            for w, t in single.items()
        }

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        hidden = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32)
        for i in range(0, len(x), self.BLOCK):
            block = x[i : i + self.BLOCK].astype(np.intp)
            pairs = (block[:, :-1] << 8) + block[:, 1:]
            for j, w in enumerate(WIDTHS):
                size, total = WINDOW - w + 1, None
                for k, entries in self.tables[w]:
                    at = (pairs if len(entries) > 256 else block)[:, k : k + size]
                    part = entries.take(at, axis=0)
                    total = part if total is None else np.add(total, part, out=total)
                top = total.max(1) + self.net.biases[w]
                hidden[i : i + self.BLOCK, j * FILTERS : (j + 1) * FILTERS] = top
        np.maximum(hidden, 0, out=hidden)
        return softmax(hidden @ self.net.out + self.net.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


_LETTERS = np.array([chr(b).isalpha() and b < 128 or b >= 0xC3 for b in range(256)])


def predict(scorer: Scorer, texts: list[str]) -> list[tuple[str, float]]:
    """Language and score of each whole text; windows count by the letters they hold."""
    found = [(UNKNOWN, 0.0)] * len(texts)
    known = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    parts = [windows_of(texts[i]) for i in known]
    if not parts:
        return found
    x = np.concatenate(parts)
    of = np.repeat(np.arange(len(parts)), list(map(len, parts)))
    sums, total = np.zeros((len(parts), len(scorer.net.languages))), np.zeros(len(parts))
    for i in range(0, len(x), WINDOWS):
        some, to = x[i : i + WINDOWS], of[i : i + WINDOWS]
        weights = _LETTERS[some].sum(1) + 1e-3
        starts = np.flatnonzero(np.diff(to, prepend=-1))
        sums[to[starts]] += np.add.reduceat(scorer.probabilities(some) * weights[:, None], starts)
        total[to[starts]] += np.add.reduceat(weights, starts)
    means = sums / total[:, None]
    best = means.argmax(1)
    for i, b, p in zip(known, best.tolist(), means.max(1).tolist()):
        found[i] = (scorer.net.languages[b], min(1.0, p))
    return found


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: the CRC-32 of its key as text is 1 modulo 3. Null keys aren't."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ByteNet | None:
    """A network fitted on a bounded sample of the labelled rows that aren't held out; None without any.

    Every label that occurs is learned: from at most ``SAMPLE_DOCS`` documents each, chosen by a hash
    of their key, fewer where there are so many labels that ``SAMPLE_ALL`` would be passed, and up to
    ``SAMPLE_WINDOWS`` windows spread over each text; so the driver gets some tens of megabytes at most.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.where(
        ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    counts = rows.groupBy("lang").count().limit(MOST_LABELS + 1).collect()
    if not counts:
        return None
    if len(counts) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    each = max(1, min(SAMPLE_DOCS, SAMPLE_ALL // len(counts)))
    # twice the wanted share by hash, so that ranks are only taken among few rows
    shares = F.map_from_arrays(F.lit([r["lang"] for r in counts]), F.lit([(2.0 * each + 8) / r["count"] + 1e-3 for r in counts]))
    share = F.element_at(shares, F.col("lang"))
    mixed = F.xxhash64("doc_id")
    place = F.pmod(mixed, F.lit(1 << 30)) / float(1 << 30)
    length = F.greatest(F.lit(1), F.length("text"))
    cuts = [F.substring(F.col("text"), F.floor(length * i / SAMPLE_WINDOWS).cast("int") + 1, F.lit(WINDOW)) for i in range(SAMPLE_WINDOWS)]
    sample = (
        rows.where(place < share)
        .select("lang", mixed.alias("mixed"), F.array_distinct(F.array(*cuts)).alias("cuts"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("mixed", "cuts")))
        .where(F.col("rank") <= each)
        .select("lang", "cuts")
        .collect()
    )
    languages = sorted({r["lang"] for r in sample})
    index = {name: i for i, name in enumerate(languages)}
    sample = sorted((index[r["lang"]], cut) for r in sample for cut in r["cuts"] if any(map(str.isalpha, cut)))
    if not sample:
        return None
    x = np.concatenate([windows_of(cut)[:1] for _, cut in sample])
    return ByteNet.start(languages).train(x, np.array([y for y, _ in sample]))


def identify(docs: DataFrame, net: ByteNet | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replacing columns of these names), in one pass.

    ``und`` with score 0 for texts that are null or without any letter, and for all if ``net`` is
    None. Repeated rows and other columns pass as they are; an empty table stays empty. Texts are
    scored by bounded blocks of windows, however long they are, and every window of a text counts.
    """
    at = [c for c in docs.columns if c not in ("lang_pred", "score")].index(text_col)

    id_of = uuid.uuid4().hex

    def run(batches):
        scorer = kept(("language", id_of), net.scorer) if net else None
        for batch in batches:
            texts, found = batch.column(at), []
            for i in range(0, len(texts), 256):
                some = [t.as_py() for t in texts.slice(i, 256)]
                found += predict(scorer, some) if scorer else [(UNKNOWN, 0.0)] * len(some)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*batch.schema.names, "+lang_pred", "+score"],
            )

    return extended(docs, run, {"lang_pred": "string", "score": "double"})

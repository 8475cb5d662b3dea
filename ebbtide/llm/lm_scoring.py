"""Log-probabilities of whole texts under a unigram and a log-bilinear model of the corpus.

All words of the training texts are counted. The most frequent ones are outcomes of the neural
model; all others share ``TAILS`` outcomes by their last letters, and within such a class have their smoothed
unigram probability. So every text, whatever its words, has a normalised probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import narrow
from ebbtide.llm.folding import folded
from ebbtide.llm.log_bilinear import CONTEXT, LogBilinear, Trainer
from ebbtide.llm.words import _spans
from ebbtide.llm.worker import kept
from ebbtide.session import written

#: Bounds of what the driver and the workers hold: outcomes of single words, classes of the others (a
#: byte of the key), words whose counts each worker has at hand. All other counts are joined.
WORDS = 256
TAILS = 256
AT_HAND = 1 << 18
#: Passes the training texts are dealt to: each text is learned from in one of them, after each the weights are averaged.
PASSES = 2
BLOCK_WORDS = 1 << 20
BLOCK_TOKENS = 1 << 15
MEMO_WORDS = 400_000

END = b"\xff"  # in no UTF-8 text
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Parts of an octave into which counts are sorted to find the most frequent words.
_FINE = 64


class _Keys(dict):
    """Keys of words: 56 bits of a hash, and the class of the word's end in the lowest byte."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        tail = xxhash.xxh3_64_intdigest(word[-3:]) & 0xFF
        key = xxhash.xxh3_64_intdigest(word) & ~0xFF | tail
        if len(word) < 64:
            self[word] = key
        return key


def _texts(batch: pa.RecordBatch, at: int):
    for text in batch.column(at).cast(pa.binary()):
        yield (text.as_py() or b"").translate(_LOWER)


def _key_parts(text: bytes):
    """Keys of a text's tokens, in parts of about a megabyte of text; the end is the last."""
    known = kept("lm keys", _Keys).__getitem__
    for part in _spans(text + b" " + END):
        words = part.split()
        yield np.fromiter(map(known, words), np.uint64, len(words))


def _counted(texts: DataFrame) -> DataFrame:
    """``key, n`` of all tokens."""

    def run(batches):
        held, n = [], 0

        def taken():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])

        for batch in batches:
            for text in _texts(batch, 0):
                for keys in _key_parts(text):
                    held.append(keys)
                    n += len(keys)
                    if n >= BLOCK_WORDS:
                        yield taken()
                        held, n = [], 0
        if held:
            yield taken()

    return texts.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _rank() -> Column:
    """Counts to about one per cent: at most some 2,800 values, whatever the corpus."""
    return F.floor(F.log2("n") * _FINE)


@dataclass
class Vocabulary:
    """What is known of the training tokens, apart from the counts of rare words."""

    tokens: int
    distinct: int
    words: np.ndarray  # keys of single outcomes, sorted
    keys: np.ndarray  # keys at hand, sorted
    logs: np.ndarray  # log10(count + 0.5) of them
    tail_logs: np.ndarray  # log10 of a tail class's smoothed total
    unigram: np.ndarray  # by outcome
    at_hand_from: int  # rank

    def outcomes(self, keys: np.ndarray) -> np.ndarray:
        tail = len(self.words) + (keys & np.uint64(TAILS - 1)).astype(np.int64)
        if not len(self.words):
            return tail
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, at, tail)

    def known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are at hand, and their logarithms (0 elsewhere)."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys))
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return hit, np.where(hit, self.logs[at], 0.0)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """Of ``key, n`` rows: the driver gets at most ``AT_HAND`` of them, and sums by class."""
    ranks = counts.groupBy(_rank().alias("rank")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    ranks = sorted(ranks.collect(), key=lambda r: -r["rank"])

    def reach(limit: int) -> int:
        """The rank from which on there are no more words than ``limit``."""
        total, least = 0, 1 << 40
        for r in ranks:
            total += r["words"]
            if total > limit:
                break
            least = r["rank"]
        return least

    single, at_hand = reach(WORDS), reach(AT_HAND)
    held = counts.where(_rank() >= at_hand).toArrow()
    keys, n = held.column("key").to_numpy().view(np.uint64), held.column("n").to_numpy()
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    tails = counts.where(_rank() < single).groupBy(F.col("key").bitwiseAND(F.lit(TAILS - 1)).alias("tail"))
    tail_tokens, tail_words = np.zeros(TAILS), np.zeros(TAILS)
    for r in tails.agg(F.sum("n").alias("n"), F.count("*").alias("words")).collect():
        tail_tokens[r["tail"]], tail_words[r["tail"]] = r["n"], r["words"]
    chosen = np.isin(keys, counts.where(_rank() >= single).toArrow().column("key").to_numpy().view(np.uint64))
    mass = np.concatenate([n[chosen], tail_tokens]) + 0.5
    return Vocabulary(
        sum(r["n"] for r in ranks),
        sum(r["words"] for r in ranks),
        keys[chosen],
        keys,
        np.log10(n + 0.5),
        np.log10(tail_tokens + 0.5 * (tail_words + 1)),
        mass / mass.sum(),
        at_hand,
    )


def _contexts(outcomes: list[np.ndarray], start: int) -> tuple[np.ndarray, np.ndarray]:
    """The outcomes before each token of some runs, nearest first, and the tokens themselves.

    Each run begins with the ``CONTEXT`` outcomes before it (``start`` at a text's beginning).
    """
    joined = np.concatenate(outcomes)
    real = np.ones(len(joined), bool)
    at = np.cumsum([0, *map(len, outcomes[:-1])])
    real[at[:, None] + np.arange(CONTEXT)] = False
    i = np.flatnonzero(real)
    return joined[i[:, None] - np.arange(1, CONTEXT + 1)], joined[i]


def _runs(vocabulary: Vocabulary, text: bytes, start: int):
    """A text's keys and outcomes by parts; the outcomes begin with the context of the first."""
    before = np.full(CONTEXT, start, np.int64)
    for keys in _key_parts(text):
        run = np.concatenate([before, vocabulary.outcomes(keys)])
        yield keys, run
        before = run[-CONTEXT:]


def train(texts: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """Trained where the texts lie: in each pass every partition goes on from the common weights, and what
    they come to is averaged by the tokens they learned from. Each pass takes its share of the texts, all of them take all."""
    model, start = LogBilinear.start(vocabulary.unigram), len(vocabulary.unigram)

    def added(a: bytes, b: bytes) -> bytes:
        return (np.frombuffer(a) + np.frombuffer(b)).tobytes()

    for turn in range(PASSES):

        def learned(batches, model=model, turn=turn) -> bytes | None:
            trainer = Trainer(model, vocabulary.unigram, 1000 * TaskContext.get().partitionId() + turn)
            held, n, at = [], 0, TaskContext.get().partitionId()
            for batch in batches:
                column = batch.column(0)
                chosen = pa.array((at + np.arange(len(column))) % PASSES == turn)
                at += len(column)
                for text in _texts(batch.filter(chosen), 0):
                    for _, run in _runs(vocabulary, text, start):
                        held.append(run)
                        n += len(run)
                        if n >= BLOCK_TOKENS:
                            trainer.learn(*_contexts(held, start))
                            held, n = [], 0
            if held:
                trainer.learn(*_contexts(held, start))
            if not trainer.seen:
                return None
            return (np.concatenate([[1.0], trainer.model.vector()]) * trainer.seen).tobytes()

        found = folded(texts, learned, added)
        if found is not None:
            sums = np.frombuffer(found)
            model = model.with_vector(sums[1:] / sums[0])
    return model


def _scored(rows: DataFrame, vocabulary: Vocabulary, model: LogBilinear, kind: str) -> DataFrame:
    """Sums of each text over the words at hand, and the other words with their numbers.

    ``base`` adds ``log10(count + 0.5)``; ``score`` the neural log-probabilities, and for words of a tail
    class the same sum less the class's total. What the other words add is joined later, to both.
    """
    start, ten = len(vocabulary.unigram), np.log(10)

    def block(held):
        """Sums over the (text number, keys, outcomes) in ``held``, and the unknown keys by text."""
        of = np.concatenate([np.full(len(keys), i) for i, keys, _ in held])
        keys = np.concatenate([keys for _, keys, _ in held])
        before, token = _contexts([run for *_, run in held], start)
        hit, logs = vocabulary.known(keys)
        neural = model.normalised(before, token) / ten
        tail = token - len(vocabulary.words)
        neural += np.where(tail >= 0, logs - vocabulary.tail_logs[np.maximum(tail, 0)], 0.0)
        return of, keys, hit, logs, neural

    def run(batches):
        base, count = TaskContext.get().partitionId() << 33, 0
        for batch in batches:
            n = batch.num_rows
            sums = np.zeros((4, n))
            others: list[list[np.ndarray]] = [[] for _ in range(n)]

            def add(held):
                of, keys, hit, logs, neural = block(held)
                for row, values in zip(sums, (np.ones(len(of)), hit, logs, neural)):
                    row += np.bincount(of, values, n)
                rest = ~hit
                of, keys = of[rest], keys[rest]
                cuts = np.flatnonzero(np.diff(of)) + 1
                for i, some in zip(of[np.concatenate([[0], cuts])] if len(of) else [], np.split(keys, cuts)):
                    others[i].append(some)

            held, tokens = [], 0
            for i, text in enumerate(_texts(batch, 2)):
                for keys, outcomes in _runs(vocabulary, text, start):
                    held.append((i, keys, outcomes))
                    tokens += len(keys)
                    if tokens >= BLOCK_TOKENS:
                        add(held)
                        held, tokens = [], 0
            if held:
                add(held)
            lists = [np.unique(np.concatenate(o), return_counts=True) if o else (np.empty(0, np.uint64), np.empty(0, np.int64)) for o in others]
            offsets = pa.array(np.cumsum([0, *[len(k) for k, _ in lists]]), pa.int32())
            keys = np.concatenate([k for k, _ in lists]) if lists else np.empty(0, np.uint64)
            times = np.concatenate([c for _, c in lists]) if lists else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(base + count, base + count + n)),
                    batch.column(0),
                    batch.column(1),
                    pa.array(sums[0].astype(np.int64)),
                    pa.array(sums[1].astype(np.int64)),
                    pa.array(sums[2]),
                    pa.array(sums[3]),
                    pa.ListArray.from_arrays(offsets, pa.array(keys.view(np.int64))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "keys", "times"],
            )
            count += n

    return rows.mapInArrow(
        run,
        f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, "
        "keys array<long>, times array<int>",
    )


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: the CRC-32 of its key as text is 1 modulo 5. Null keys aren't."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``: log10 probabilities of every whole text.

    Tokens are words between white space, lower-cased (A-Z), and one end for each text. Everything is
    learned from the texts that aren't ``held_out``: the counts of all their words, and the neural model,
    which trains on them in place. ``base_score`` sums ``log10((c + 0.5) / (N + 0.5 * (V + 1)))`` over the tokens;
    ``score`` sums the model's ``log10`` probabilities, normalised over all known words and one unseen word
    for each class of word ends. ``n_known`` counts tokens seen in training, ``train_tokens`` is ``N``.

    A null or empty text is its end alone. Null and repeated ids stay, each row is scored and learned
    from; long texts go by parts; other columns don't matter; an empty table gives no rows. Without
    any text to learn from, ``score`` is ``base_score``. Words are told apart by 64 bits.
    """
    rows = narrow(docs, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    texts = rows.where(~F.col("held_out")).select("text")
    counts = written(_counted(texts), "lm-counts")
    known = vocabulary(counts)
    model = train(texts, known)
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = written(_scored(rows, known, model, kind), "lm-scored")

    others = scored.select("row", F.explode(F.arrays_zip("keys", "times")).alias("o")).select("row", "o.keys", "o.times")
    rare = counts.where(_rank() < known.at_hand_from).withColumnRenamed("key", "keys")
    n = F.coalesce("n", F.lit(0))
    sums = (
        others.join(rare, "keys", "left")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.log10(n + 0.5)).alias("logs"), F.sum(F.when(n > 0, F.col("times"))).alias("more"))
    )
    logs = F.coalesce("logs", F.lit(0.0))
    base = F.col("base") + logs - F.col("n_tokens") * float(np.log10(known.tokens + 0.5 * (known.distinct + 1)))
    return (
        scored.drop("keys", "times")
        .join(sums, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(known.tokens).cast("long").alias("train_tokens"),
            base.alias("base_score"),
            (F.col("score") + logs if known.tokens else base).alias("score"),
        )
    )

"""Language-model scores, phrases and whitening; bounds of memory and time of the text operators."""

import math
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import language_id, lm_scoring, nearest, phrases, pretokens, singular, whitening
from ebbtide.llm.log_bilinear import CONTEXT, LogBilinear, Trainer
from ebbtide.llm.queries import ORACLES, QUERIES
from ebbtide.llm.token_counts import count_by_chunks
from tests.oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}

# language-model scores


def tokens_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + [None]


def is_held_out(key):
    return key is not None and zlib.crc32(str(key).encode()) % 5 == 1


def test_base_scores_are_those_of_the_formula(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    counts = Counter(t for r in rows if not is_held_out(r["doc_id"]) for t in tokens_of(r["text"]))
    total = sum(counts.values())
    found = {r["doc_id"]: r for r in QUERIES["op11_lm_scores"](spark, FOLDER).collect()}
    assert len(found) == len(rows)
    for r in rows:
        tokens, got = tokens_of(r["text"]), found[r["doc_id"]]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (len(counts) + 1))) for t in tokens)
        assert got["held_out"] == is_held_out(r["doc_id"]) and got["train_tokens"] == total
        assert (got["n_tokens"], got["n_known"]) == (len(tokens), sum(counts[t] > 0 for t in tokens))
        assert got["base_score"] == pytest.approx(base, abs=1e-6)


def test_the_model_predicts_held_out_texts_better_than_the_base(spark):
    rows = QUERIES["op11_lm_scores"](spark, "/root/testdata/sf0.01").where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum() + 0.1 * rows.n_tokens.sum()
    assert (rows.score > rows.base_score).mean() > 0.9


def test_model_probabilities_sum_to_one_over_all_known_and_unseen_words(spark):
    """Texts of one word: all known words, and one unseen word of each class of word ends."""
    words = [f"w{i % 7}x{i}" for i in range(60)] * 2 + ["the"] * 400
    df = spark.createDataFrame([(None, w) for w in words], "doc_id long, text string")
    texts = df.select("text")
    counts = lm_scoring._counted(texts).cache()
    known = lm_scoring.vocabulary(counts)
    model = lm_scoring.train(texts, known)
    n = len(known.unigram)
    before = np.full((n, CONTEXT), n)
    assert np.exp(model.normalised(before, np.arange(n))).sum() == pytest.approx(1, abs=1e-5)
    by_key = {r["key"]: r["n"] for r in counts.collect()}
    p = np.exp(model.normalised(before, np.arange(n)))
    keys = np.array(list(by_key), np.int64).view(np.uint64)
    outcome, tail = known.outcomes(keys), 0.0
    for k, o in zip(by_key, outcome):
        share = 1 if o < len(known.words) else (by_key[k] + 0.5) / 10 ** known.tail_logs[o - len(known.words)]
        tail += p[o] * share
    unseen = sum(p[len(known.words) + t] * 0.5 / 10 ** known.tail_logs[t] for t in range(lm_scoring.TAILS))
    assert tail + unseen == pytest.approx(1, abs=1e-4)


def test_the_model_learns_from_every_training_text(spark):
    """What only texts outside the first two eighths of a partition show is learned, too."""
    texts = spark.createDataFrame([("b a c " * 30 if i % 8 < 2 else "a b " * 500,) for i in range(96)], "text string").coalesce(1)
    known = lm_scoring.vocabulary(lm_scoring._counted(texts).cache())
    model = lm_scoring.train(texts, known)
    a, b = known.outcomes(np.concatenate(list(lm_scoring._key_parts(b"a b")))[:2])
    after = np.exp(model.normalised(np.array([[a, b, a, b]]), np.array([b])))[0]
    assert after > 0.9 and known.unigram[b] < 0.6


def test_scores_take_odd_rows(spark):
    long = "some words " * 40_000
    rows = [(None, None, 1), (3, "", 2), (3, "", 3), (4, "a\tB\n c", 4), (5, long, 5), (6, "a", 6), (7, "été a", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int").withColumn("keys", F.lit(1))
    found = lm_scoring.score_texts(df.repartition(5)).collect()
    assert sorted(r["n_tokens"] for r in found) == [1, 1, 1, 2, 3, 4, 80_001]
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    same = [r for r in found if r["doc_id"] == 3]
    assert same[0] == same[1]
    assert lm_scoring.score_texts(df.limit(0)).count() == 0
    none = lm_scoring.score_texts(df.where("doc_id = 6").withColumn("doc_id", F.lit(9)).where(lm_scoring.held_out(F.lit(9))))
    assert all(r["score"] == r["base_score"] and r["train_tokens"] == 0 for r in none.collect())


def test_contrastive_gradients_and_learning():
    unigram = np.array([0.4, 0.3, 0.2, 0.1])
    model = LogBilinear.start(unigram)
    model = model.with_vector(model.vector() + 0.1 * np.sin(np.arange(len(model.vector()))))
    rng = np.random.default_rng(1)
    before, token, noise = rng.integers(0, 5, (6, CONTEXT)), rng.integers(0, 4, 6), rng.integers(0, 4, 8)
    log_noise = np.log(8 * unigram).astype(np.float32)
    _, gradients = model.gradients(before, token, noise, log_noise)
    for w, g in zip(model.weights(), gradients):
        direction = rng.normal(size=w.shape).astype(np.float32)
        w += 1e-2 * direction
        up = model.gradients(before, token, noise, log_noise)[0]
        w -= 2e-2 * direction
        down = model.gradients(before, token, noise, log_noise)[0]
        w += 1e-2 * direction
        assert (up - down) / 2e-2 == pytest.approx(float((g * direction).sum()), rel=0.02, abs=2e-3)
    token = rng.integers(0, 4, 20_000)
    before = np.stack([(token + j) % 4 for j in range(CONTEXT)], 1)  # the word before tells the next one
    trained = Trainer(LogBilinear.start(unigram), unigram, 0)
    trained.learn(before, token)
    assert trained.model.normalised(before, token).mean() > -0.1


# phrases


def test_phrases_equal_their_sql(spark):
    assert differences(QUERIES["op12_phrases"](spark, FOLDER), connect(FOLDER), ORACLES["op12_phrases"]) is None


@pytest.mark.parametrize("share", [0.0, 0.4, 1.0])
def test_phrases_do_not_depend_on_the_sample(spark, share):
    """Brute force over rows with ties, odd separators, a language that is its own word, null languages."""
    rng = random.Random(4)
    words = ["a", "B", "c", "de", "été", "x"]
    rows = [
        (i, "".join(rng.choice(words) + rng.choice([" "] * 8 + ["\t", ", ", ".", "\n", "  "]) for _ in range(rng.randint(0, 60))), rng.choice(["de", "x", None]))
        for i in range(300)
    ]
    rows += [(7, None, "de"), (7, "", None), (None, "a b c de " * 200, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("rank", F.lit(1)).repartition(7)
    found = {}
    for _, text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    found[key] = found.get(key := (lang or "und", tuple(w[i : i + n])), 0) + 1
    totals = Counter()
    for (lang, p), a in found.items():
        totals[lang] += a * (len(p) == 1)
    candidates = {k: a for k, a in found.items() if len(k[1]) > 1 and a >= 30}
    around = Counter()
    for (lang, p), a in candidates.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                around[lang, p[i : i + n]] = max(around[lang, p[i : i + n]], a)
    expected = []
    for lang in totals:
        of = []
        for (other, p), a in candidates.items():
            if other == lang and 100 * around[lang, p] < 80 * a:
                score, k = min((2_000_000 * a // (found[lang, p[:k]] + found[lang, p[k:]]), k) for k in range(1, len(p)))
                of.append((-score, -a, " ".join(p).encode(), found[lang, p[:k]], found[lang, p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(of)[:25], 1):
            expected.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    got = [tuple(r) for r in phrases.mine_phrases(df, share=share, top=25).collect()]
    assert sorted(got) == sorted(expected) and len(expected) > 30


def test_phrases_of_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 1000)
    monkeypatch.setattr(phrases, "TEXT_WORDS", 1000)
    df = spark.createDataFrame([(1, "one two three four five " * 60_000, "en")], "doc_id long, text string, lang string")
    rows = phrases.mine_phrases(df).collect()
    assert {r["phrase"] for r in rows} == {"one two three four", "two three four five", "three four five one", "four five one two", "five one two three"}
    assert sorted(r["a"] for r in rows) == [59_999] * 3 + [60_000] * 2 and {r["n"] for r in rows} == {300_000}
    assert phrases.mine_phrases(df.limit(0)).count() == 0
    _, passes = phrases.frequent_phrases(df.selectExpr("lang", "text", "doc_id id"), 30, 4, 0.0)
    assert passes == 3  # nothing proposed: words, then pairs, then three, four


# whitening


def reference(x, n_components=32):
    n = len(x)
    centred = x - x.sum(0) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:n_components]
    return centred @ vectors[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def test_whitening_equals_the_plain_eigenvectors(spark):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in r["embedding"]] for r in rows])
    expected, explained = reference(x.astype(float))
    found = QUERIES["op13_whitening"](spark, FOLDER).orderBy("vec_id", "component").toPandas()
    assert len(found) == len(rows) * 32 and (found.n == len(rows)).all()
    w = found.whitened.to_numpy().reshape(-1, 32)
    signs = np.sign((w * expected).sum(0))
    assert np.abs(w * signs - expected).max() < 1e-6
    assert np.allclose(found.explained.to_numpy().reshape(-1, 32), explained, rtol=1e-9)
    sums = x.sum(0).tolist()
    deviation = [sum((len(x) * a - s) ** 2 for a, s in zip(row.tolist(), sums)) for row in x]
    assert found.deviation.to_numpy().reshape(-1, 32)[:, 0].tolist() == deviation
    assert found.identity_error.nunique() == 1 and found.identity_error[0] < 1e-8


def test_whitening_takes_odd_vectors(spark):
    rng = np.random.default_rng(0)
    good = [(i, rng.normal(size=3).tolist()) for i in range(50)] + [(None, [1.0, 2.0, 3.0]), (3, [0.5, 0.5, 0.5])]
    odd = [(60, None), (61, []), (62, [1.0, None, 2.0]), (63, [math.nan, 1.0, 1.0]), (64, [math.inf, 0.0, 0.0]), (65, [1.0, 2.0]), (66, [1e300, 0.0, 0.0])]
    kind = "vec_id long, embedding array<double>"
    df = spark.createDataFrame(good + odd, kind).withColumn("component", F.lit("x")).repartition(9)
    rows = whitening.whiten(df).collect()
    assert Counter(r["vec_id"] for r in rows) == Counter(i for i, _ in good for _ in range(3))
    assert {r["n"] for r in rows} == {52} and sum({r["component"]: r["explained"] for r in rows}.values()) == pytest.approx(1)
    assert whitening.whiten(df.limit(0)).count() == 0 and whitening.whiten(df.where("vec_id in (60, 61)")).count() == 0
    # constant and repeated entries: only as many components as there is variance
    flat = spark.createDataFrame([(i, [float(i), float(i), 7.0]) for i in range(20)], kind)
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], kind)).count() == 0
    # entries far apart: deviations beyond 64 bits are null, none is wrong
    far = whitening.whiten(spark.createDataFrame([(1, [1e12]), (2, [0.0]), (3, [1.0])], kind)).collect()
    assert all(r["deviation"] is None for r in far)


@pytest.mark.parametrize("kind", ["random", "graded", "equal", "nearly equal", "dependent", "few", "blocks", "one"])
def test_singular_values_and_vectors(kind):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 24))
    m = {
        "random": x,
        "graded": x * np.logspace(0, -9, 24),
        "equal": np.vstack([np.eye(24)] * 4),
        "nearly equal": np.linalg.qr(x)[0],
        "dependent": x[:, :5] @ rng.normal(size=(5, 24)),
        "few": x[:4],
        "blocks": np.block([[x, 0 * x], [0 * x, x]]),
        "one": x[:, :1],
    }[kind]
    size = m.shape[1]
    r = np.linalg.qr(m, mode="r")
    values, vectors = singular.right_singular(np.vstack([r, np.zeros((size - len(r), size))]))
    true = np.zeros(size)
    s = np.linalg.svd(m, compute_uv=False)
    true[: len(s)] = s**2
    assert np.abs(values - true).max() < 1e-13 * true[0]
    assert np.abs(vectors.T @ vectors - np.eye(size)).max() < 1e-10
    assert np.abs(m.T @ (m @ vectors) - vectors * values).max() < 1e-12 * true[0]


# bounds of earlier operators


def test_token_counts_of_mixed_texts_take_time_in_proportion():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(path("byte_bpe_50k.json")), random.Random(3)
    code = "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/") for _ in range(40_000))
    marks = "".join(rng.choice("的一是不了人我在有他，。") for _ in range(40_000))
    text = ("some short words " * 30 + code + " " + marks + " " + "ab" * 20_000 + " ") * 3
    started = time.perf_counter()
    n, _ = count_by_chunks(tokenizer, text)
    assert time.perf_counter() - started < 8
    assert n == len(tokenizer.encode(text, add_special_tokens=False))
    pieces = ["a", "B", "7", "12", "'s", "'", " ", "  ", "\n", "。", "的", "é", "—", "<|endoftext|>", "!", "😀", "٣", "ª"]
    for _ in range(500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 80)))
        assert count_by_chunks(tokenizer, text, 6, 2)[0] == len(tokenizer.encode(text, add_special_tokens=False))


@pytest.mark.parametrize("file", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_memos_stay_within_their_bound(monkeypatch, file):
    from public_tokenizers import path

    monkeypatch.setattr(pretokens, "MEMO_BYTES", 100_000)
    of = (pretokens.ByteCounts if "byte" in file else pretokens.WordIds)(path(file))
    take = of.count if "byte" in file else of.ids
    for i in range(40):
        take(" ".join(f"word{i}x{j}" for j in range(300)))
        take("".join(f"a{i}{j}+" for j in range(3000)))  # no space: words only
        memos = (of.parts, of.words, of.parts.before, of.words.before)
        assert of.parts.before and pretokens.ENTRY_BYTES * sum(map(len, memos)) <= 100_000


def test_every_label_is_learned_and_none_is_no_crash(spark):
    texts = [(i, (chr(97 + i % 20) + chr(97 + i // 20)) * 100 + " ", f"l{i}") for i in range(70)]
    df = spark.createDataFrame(texts * 12, "doc_id long, text string, lang string").withColumn("doc_id", F.monotonically_increasing_id())
    net = language_id.fit(df)
    assert len(net.languages) == 70
    long = language_id.predict(net.scorer(), ["ab " * 1_000_000, "x", None])
    assert [p[0] != "und" for p in long] == [True, True, False]


def test_tiny_and_huge_vectors_do_not_spoil_the_index(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(1000, [1e-170] + [0.0] * 7), (1001, [1e200] * 8), (1050, (np.array(rows[7][1]) * 1e-200).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert np.isfinite(nearest._scaled(np.array([r[1] for r in rows]))).all()
    found = nearest.nearest_vectors(df, F.col("vec_id") % 50 == 0).collect()
    assert all(abs(r["score"]) <= 1 + 1e-12 for r in found)
    first = [r for r in found if r["query_id"] == 1050 and r["rank"] == 1]
    assert first[0]["vec_id"] == 7 and first[0]["score"] == pytest.approx(1)


def test_normalising_exponentiates_tables_not_tokens(monkeypatch):
    rng, n, tokens = np.random.default_rng(3), 40, 3000
    before, token = rng.integers(0, n + 1, (tokens, CONTEXT)), rng.integers(0, n, tokens)
    plain, seen = np.exp, []
    for wide in (1, 15):  # with the wide one all products vanish for many contexts
        model = LogBilinear.start(np.full(n, 1 / n))
        model = model.with_vector(model.vector() * wide)
        h = sum((model.context.astype(float) @ model.mix[j])[before[:, j]] for j in range(CONTEXT))
        scores = h @ model.outcome.T + model.bias
        wanted = scores[np.arange(tokens), token] - np.logaddexp.reduce(scores, 1)
        monkeypatch.setattr(np, "exp", lambda x, *a, **k: seen.append(np.size(x)) or plain(x, *a, **k))
        assert model.normalised(before, token) == pytest.approx(wanted, rel=1e-4, abs=1e-3)
        monkeypatch.setattr(np, "exp", plain)
    assert sum(seen) <= 2 * CONTEXT * (n + 1) * n


def test_stored_words_of_phrases_are_small_rows_that_hold_each_word_once(spark):
    long = " ".join(f"w{i}" for i in range(5000))
    docs = spark.createDataFrame([(long, "en", True), ("a b. c", None, False), (None, "de", False)], "text string, lang string, sampled boolean")
    rows = phrases._cut(docs, 3).collect()
    assert max(len(r["hashes"]) for r in rows) <= 8 * (phrases.STORED_WORDS + 4)
    # each text ends with a break of its own
    assert sum(r["starts"] for r in rows) == 5001 + 5 + 1


def test_codebooks_are_fitted_in_little_memory():
    """The sample against the largest codebook, at the driver: a block of products at a time."""
    x, c = np.random.default_rng(1).normal(size=(nearest.SAMPLE, 32)), np.random.default_rng(2).normal(size=(nearest.MAX_CENTROIDS, 32))
    want = ((c * c).sum(1) - 2 * x[:50] @ c.T).argmin(1)
    index = nearest.MultiIndex(c[:64, :16], c[:64, 16:])
    tracemalloc.start()
    got, deep = nearest.nearest_centroid(x, c), index.depth(x, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (got[:50] == want).all() and 0 < deep <= 1
    assert peak < 25e6

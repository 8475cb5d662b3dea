"""Phrases whose words keep together, mined by Toivonen's sampling method.

A sample of the documents proposes phrases. One pass over all documents counts these exactly, with
their negative border: phrases not proposed whose parts all are. Where a phrase of the border turns
out to be frequent, longer ones may have been overlooked; further passes count what became possible,
until nothing new is frequent. So the result is exact, whatever the sample proposed.

Texts are cut into words once and stored as blocks of word hashes, which all passes read. Sets of
phrases stay tables. For the passes each length's set becomes a bitmap of bounded size; where two
phrases share a bit, a pass counts more than it has to, never less. Scores and containment are worked
out on hashes; only the phrases of the result are looked up in the texts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ebbtide.llm.common import in_bitmap, narrow
from ebbtide.llm.words import _spans, gram_hashes, hashed, mixed
from ebbtide.llm.worker import kept
from ebbtide.session import written

#: What a share of the documents has to show of the wanted count for a phrase to be proposed.
CAUTION = 0.6
#: Words a pass looks at together; words cut at a time; words of a stored block, few as Spark hands on 10,000 rows at a
#: time (10 MB), of which it holds several copies.
BLOCK_WORDS = 1 << 18
CUT_WORDS = 1 << 13
STORED_WORDS = 1 << 7
#: Words of a block in the pass that also holds the words themselves.
TEXT_WORDS = 1 << 17
#: Phrases a task remembers as emitted (8 MB).
REMEMBERED = 1 << 20
#: Bits for each phrase of a bitmap, and its largest size as a power of two (16 MB).
BITS_EACH = 32
MOST_BITS = 27
#: First ranks within so many groups of a language, then among the first of all groups.
GROUPS = 256

UNKNOWN = "und"
BREAK = b"\xff"  # in no UTF-8 text
_BREAK_HASH = np.uint64(xxhash.xxh3_64_intdigest(BREAK))
_ENDS = b".,;:!?\n\v\f\r"
_TABLE = bytes(
    0xFF if c in _ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
#: The lowest bits of a phrase's key say how many words it has, less one.
_LENGTH, _SHIFT = np.uint64(7), np.uint64(3)


def _keys(words: np.ndarray, n: int) -> np.ndarray:
    return gram_hashes(words, n) & ~_LENGTH | np.uint64(n - 1)


def _salt(lang: str | None) -> np.uint64:
    # seeded, or a word that is a language's name would cancel out
    return np.uint64(xxhash.xxh3_64_intdigest((UNKNOWN if lang is None else lang).encode(), 1))


def _salted(words: list[bytes], salt: np.uint64) -> np.ndarray:
    """A language's own hashes of words; 0 for the break between pieces."""
    plain = hashed(words)
    own = mixed(plain ^ salt)
    own[own == 0] = 1
    own[plain == _BREAK_HASH] = 0
    return own


def blocks(batches, size: int, reach: int, named: bool = False) -> Iterator[tuple]:
    """The words of ``lang, text`` batches: (hashes, how many starts to look at, words, languages).

    Words themselves are held if ``named``; languages are (first word, language) of runs of words.

    Blocks hold about ``size`` words. The last ``reach`` words of one are the first of the next, so
    that runs over the border are met once; a text of any length goes through in such blocks.
    """
    words, hashes, names, n = [], [], [], 0

    def taken(starts):
        return np.concatenate(hashes), starts, words, names

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            salt, lang = _salt(lang), UNKNOWN if lang is None else lang
            text = (text.as_py() or b"").translate(_TABLE).replace(BREAK, b" \xff ") + b" \xff"
            for part in _spans(text):
                found = part.split()
                hashes.append(_salted(found, salt))
                if named:
                    words += found
                if not names or names[-1][1] != lang:
                    names.append((n, lang))
                n += len(found)
                if n >= size:
                    block = taken(n - reach)
                    yield block
                    cut, ends = n - reach, [start for start, _ in names[1:]] + [n]
                    names = [(max(start - cut, 0), name) for (start, name), end in zip(names, ends) if end > cut]
                    hashes, words, n = [block[0][cut:].copy()], words[-reach:], reach
    if n:
        yield taken(n)


_STORED = "sampled boolean, hashes binary, starts long, salt long"


def _cut(docs: DataFrame, reach: int) -> DataFrame:
    """``lang, text, sampled`` rows as blocks of word hashes of one language, each ended by a break."""

    def run(batches):
        for batch in batches:
            drawn = batch.column(2)
            for sampled, part in ((True, batch.filter(drawn)), (False, batch.filter(pc.invert(drawn)))):
                for hashes, starts, _, names in blocks([part], CUT_WORDS, reach):
                    runs = np.array([at for at, _ in names])
                    salts = np.array([_salt(name) for _, name in names], np.uint64).view(np.int64)
                    at = np.unique(np.concatenate([np.arange(0, starts, STORED_WORDS), runs[runs < starts]]))
                    ends = np.append(at[1:], starts)
                    held = [hashes[i:j].tobytes() + bytes(8) for i, j in zip(at, ends + reach)]
                    columns = [pa.array(np.full(len(at), sampled)), pa.array(held, pa.binary()), pa.array(ends - at)]
                    columns.append(pa.array(salts[np.searchsorted(runs, at, "right") - 1]))
                    yield pa.RecordBatch.from_arrays(columns, ["sampled", "hashes", "starts", "salt"])

    return docs.select("lang", "text", "sampled").mapInArrow(run, _STORED)


@dataclass
class _Words:
    """Stored blocks put together: no run goes over from one to the next, each start is looked at once."""

    hashes: np.ndarray
    own: np.ndarray
    at: np.ndarray
    salts: np.ndarray

    def salt_of(self, places: np.ndarray) -> np.ndarray:
        return self.salts[np.searchsorted(self.at, places, "right") - 1]

    def totals(self) -> tuple[np.ndarray, np.ndarray]:
        """Salts of the languages with the numbers of their words."""
        salts, index = np.unique(self.salts, return_inverse=True)
        each = np.add.reduceat((self.own & (self.hashes != 0)).astype(np.int64), self.at)
        sums = np.zeros(len(salts), np.int64)
        np.add.at(sums, index, each)
        return salts, sums


def _read(batches, size: int) -> Iterator[_Words]:
    kept("word blocks", dict)  # the memo of words isn't needed here
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(1).cast(pa.binary())
        bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 8
        hashes = np.frombuffer(column.buffers()[2], np.uint64)
        starts, salts = batch.column(2).to_numpy(), batch.column(3).to_numpy().view(np.uint64)
        first = 0
        while first < len(starts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size)))
            at = bounds[first : last + 1] - bounds[first]
            last = first + len(at) - 1
            inside = np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))
            own = inside < np.repeat(starts[first:last], np.diff(at))
            yield _Words(hashes[bounds[first] : bounds[last]], own, at[:-1], salts[first:last])
            first = last


def _valid(hashes: np.ndarray, n: int) -> np.ndarray:
    """Where a run of ``n`` words within one piece starts."""
    size = len(hashes) - n + 1
    good = hashes != 0
    out = good[: max(size, 0)].copy()
    for i in range(1, n):
        out &= good[i : i + size]
    return out


def _held(keys: np.ndarray, sets: list[bytes]) -> np.ndarray:
    """Which keys are in one of the bitmaps at least."""
    found = np.zeros(len(keys), bool)
    for bits in sets:
        found |= in_bitmap(keys >> _SHIFT, bits)
    return found


def _possible(hashes: np.ndarray, n: int, known: dict[int, list[bytes]]) -> np.ndarray:
    """Where runs of ``n`` words start whose first and last ``n - 1`` words are both in ``known``."""
    ok = _valid(hashes, n)
    if n > 1 and len(ok):
        if n - 1 not in known:
            return np.zeros(len(ok), bool)
        inside = _held(_keys(hashes, n - 1), known[n - 1])
        ok &= inside[:-1] & inside[1:]
    return ok


def _count(stored: DataFrame, lengths, known: dict[int, list[bytes]], before: dict[int, list[bytes]] | None) -> DataFrame:
    """``key, n`` of the phrases of these lengths that ``known`` allows and ``before`` did not.

    A pass that counts words among others also counts all words of each language, under a key of the
    longest length there is, which no phrase has.
    """

    def run(batches):
        def counted(keys, counts):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])

        for words in _read(batches, BLOCK_WORDS):
            for n in lengths:
                ok = _possible(words.hashes, n, known)
                if before is not None:
                    ok &= ~_possible(words.hashes, n, before)
                ok &= words.own[: len(ok)]
                keys, counts = np.unique(_keys(words.hashes, n)[ok], return_counts=True)
                if len(keys):
                    yield counted(keys, counts)
            if 1 in lengths and len(lengths) > 1:
                salts, sums = words.totals()
                yield counted(salts | _LENGTH, sums)

    return stored.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _length(key: str = "key") -> Column:
    return F.col(key).bitwiseAND(F.lit(int(_LENGTH))) + 1


def _overlooked(frequent: DataFrame, known: dict[int, list[bytes]], longest: int) -> DataFrame:
    """Frequent phrases that may be part of a longer one but that ``known`` lacks."""

    def run(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            length = (keys & _LENGTH).astype(int) + 1
            new = length < longest
            for n, sets in known.items():
                new &= ~((length == n) & _held(keys, sets))
            yield batch.filter(pa.array(new)).select(["key"])

    return frequent.select("key").mapInArrow(run, "key long")


def _bitmaps(keys: DataFrame, lengths, least: int = 15) -> dict[int, list[bytes]]:
    """A bitmap of the phrases of each length, of a size that fits their number up to a bound.

    Brought to the driver in 4 KB parts, all lengths in one job.
    """
    numbers = {r["m"]: r["n"] for r in keys.groupBy(_length().alias("m")).agg(F.count("*").alias("n")).collect()}
    bits = {n: min(MOST_BITS, max(least, (BITS_EACH * numbers[n]).bit_length())) for n in lengths if numbers.get(n)}
    if not bits:
        return {n: [] for n in lengths}
    size = F.coalesce(*[F.when(_length() == n, F.lit(1 << b)) for n, b in bits.items()])
    at = F.pmod(F.shiftright("key", int(_SHIFT)), size) + 1
    parts = (
        keys.where(_length().isin(list(bits)))
        .select(_length().alias("m"), F.bitmap_bucket_number(at).alias("part"), F.bitmap_bit_position(at).alias("bit"))
        .groupBy("m", "part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    whole = {n: bytearray(1 << b >> 3) for n, b in bits.items()}
    for row in parts.collect():
        whole[row["m"]][(row["part"] - 1) * 4096 : row["part"] * 4096] = row["bits"]
    return {n: [bytes(whole[n])] if n in whole else [] for n in lengths}


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of the values are in the ordered array."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _words_of(stored: DataFrame, known: dict[int, list[bytes]], longest: int) -> DataFrame:
    """``key, lang_key, w1, w2, ...``: the language's key and the words' hashes of each phrase ``known`` holds."""
    names = [f"w{i + 1}" for i in range(longest)]

    def run(batches):
        seen = np.empty(0, np.uint64)
        for words in _read(batches, BLOCK_WORDS):
            met = []
            for n, sets in known.items():
                keys = _keys(words.hashes, n)
                ok = _valid(words.hashes, n) & words.own[: len(keys)]
                at = np.flatnonzero(ok)
                at = at[_held(keys[at], sets)]
                new, first = np.unique(keys[at], return_index=True)
                fresh = ~_among(new, seen)
                new, at = new[fresh], at[first[fresh]]
                if len(new):
                    met.append(new)
                    parts = [words.hashes[at + i] if i < n else np.zeros(len(at), np.uint64) for i in range(longest)]
                    columns = [new, words.salt_of(at) | _LENGTH, *parts]
                    yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in columns], ["key", "lang_key", *names])
            if len(seen) + sum(map(len, met)) > REMEMBERED:
                seen = np.empty(0, np.uint64)
            seen = np.sort(np.concatenate([seen, *met]))

    columns = ["lang_key", *names]
    found = stored.mapInArrow(run, ", ".join(f"{c} long" for c in ["key", *columns]))
    # equal keys are equal words
    return found.groupBy("key").agg(*[F.max(c).alias(c) for c in columns])


def _with_parts(phrases: DataFrame, longest: int) -> DataFrame:
    """``phrases`` with ``parts`` instead of their words: the keys of all shorter runs, as (from, words, key)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64()), ("key", pa.int64())]))
    spots = [(i, n) for n in range(1, longest) for i in range(longest - n + 1)]

    def run(batches):
        for batch in batches:
            key, lang_key, *words = (c.to_numpy().view(np.uint64) for c in batch.columns)
            size = len(key)
            # the words of all phrases one after another: a run of each phrase starts every so many words
            flat = np.stack(words, 1).ravel()
            keys = np.empty((size, len(spots)), np.uint64)
            for j, (i, n) in enumerate(spots):
                keys[:, j] = _keys(flat, n)[i::longest][:size]
            starts, lengths = (np.array(x, np.int64) for x in zip(*spots))
            inside = (starts + lengths)[None, :] <= ((key & _LENGTH).astype(np.int64) + 1)[:, None]
            inside &= lengths[None, :] <= (key & _LENGTH).astype(np.int64)[:, None]
            _, j = np.nonzero(inside)
            parts = pa.StructArray.from_arrays(
                [pa.array(starts[j]), pa.array(lengths[j]), pa.array(keys[inside].view(np.int64))], ["start", "words", "key"]
            )
            ends = np.concatenate([[0], np.cumsum(inside.sum(1))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts).cast(kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["key", "lang_key", "parts"])

    return phrases.mapInArrow(run, "key long, lang_key long, parts array<struct<start: long, words: long, key: long>>")


def _first(run: tuple[int, str]) -> int:
    return run[0]


def _texts(docs: DataFrame, known: dict[int, list[bytes]], reach: int) -> DataFrame:
    """``key, lang, phrase`` of each phrase that ``known`` holds."""

    def run(batches):
        seen: set[int] = set()
        for hashes, starts, words, langs in blocks(batches, TEXT_WORDS, reach, named=True):
            out = []
            for n, sets in known.items():
                keys = _keys(hashes, n)
                ok = _valid(hashes, n) & _held(keys, sets)
                ok[starts:] = False
                at = np.flatnonzero(ok)
                new, first = np.unique(keys[at], return_index=True)
                for key, i in zip(new.view(np.int64).tolist(), at[first].tolist()):
                    if key not in seen:
                        if len(seen) >= REMEMBERED >> 2:
                            seen.clear()
                        seen.add(key)
                        out.append((key, langs[bisect_right(langs, i, key=_first) - 1][1], b" ".join(words[i : i + n]).decode()))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string())],
                    ["key", "lang", "phrase"],
                )

    found = docs.select("lang", "text").mapInArrow(run, "key long, lang string, phrase string")
    return found.groupBy("key").agg(F.min(F.struct("lang", "phrase")).alias("named")).select("key", "named.*")


def _mined(docs: DataFrame, min_count: int, longest: int, share: float, seed: int) -> tuple[DataFrame, int, DataFrame]:
    """The frequent phrases, the passes after the first, and the stored blocks of all documents."""
    reach, buckets = longest - 1, 1 << 20
    drawn = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(buckets)) < share * buckets
    stored = written(_cut(docs.withColumn("sampled", drawn), reach), "words")
    sample = stored.where("sampled")
    least = max(1, int(CAUTION * share * min_count))
    known: dict[int, list[bytes]] = {}
    for n in range(1, longest):
        proposed = _count(sample, [n], known, None).where(F.col("n") >= least)
        known |= _bitmaps(written(proposed.select("key"), "proposed"), [n])
    frequent = written(_count(stored, range(1, longest + 1), known, None).where(F.col("n") >= min_count), "phrases")
    passes, found = 0, frequent
    while True:
        more = _bitmaps(written(_overlooked(found, known, longest), "overlooked"), range(1, longest))
        if not any(more.values()):
            return frequent, passes, stored
        before, passes = known, passes + 1
        known = {n: known[n] + more[n] for n in known}
        counted = _count(stored, range(2, longest + 1), known, before).where(F.col("n") >= min_count)
        found = written(counted, "phrases-more")
        frequent = frequent.union(found)


def frequent_phrases(
    docs: DataFrame, min_count: int, longest: int, share: float, seed: int = 0
) -> tuple[DataFrame, int]:
    """``key, n`` of every phrase of ``lang, text, id`` rows that occurs ``min_count`` times, and the passes after the first."""
    return _mined(docs, min_count, longest, share, seed)[:2]


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    min_count: int = 30,
    longest: int = 4,
    contained: int = 80,
    top: int = 2000,
    share: float = 0.25,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language, of 2 to ``longest`` words.

    Words are lower-cased (A-Z) and stand between spaces or tabs; no phrase runs over one of
    ``. , ; : ! ?``, a line's end or a text's. ``a`` counts all occurrences of a phrase, ``l`` and ``r`` those of
    its two parts at the weakest cut, ``n`` all words of the language; the score is
    ``floor(2000000 * a / (l + r))``, exact for any size. Phrases that occur ``min_count`` times are
    candidates, unless a longer candidate that contains them occurs at least ``contained`` percent as often.

    A null language is ``und``, null and empty texts hold no words; repeated rows count each; ties go
    by ``a`` and the phrase's bytes; other columns don't matter; an empty table gives no rows. Long
    texts go through in blocks. The rows in ``share``, chosen by a hash of ``id_col``, propose
    phrases; the result doesn't depend on them. Phrases are told apart by 61 bits of a hash.
    """
    if not 2 <= longest < int(_LENGTH):
        raise ValueError("phrases have 2 to 6 words")
    texts = narrow(docs, lang=lang_col, text=text_col, id=id_col)
    frequent, _, stored = _mined(texts, min_count, longest, share, 0)
    long = frequent.where(_length().between(2, longest))
    words = _words_of(stored, _bitmaps(long, range(2, longest + 1)), longest)
    phrases = written(_with_parts(words.join(long, "key", "left_semi"), longest), "phrase-parts")
    candidates = phrases.join(long.withColumnRenamed("n", "a"), "key")

    count = _length()
    cuts = (
        candidates.select("key", "a", F.posexplode(F.sequence(F.lit(1).cast("long"), count - 1)).alias("_", "k"), "parts", count.alias("m"))
        .select(
            "key",
            "a",
            "k",
            F.filter("parts", lambda p: (p["start"] == 0) & (p["words"] == F.col("k")))[0]["key"].alias("left"),
            F.filter("parts", lambda p: (p["start"] == F.col("k")) & (p["words"] == F.col("m") - F.col("k")))[0]["key"].alias("right"),
        )
    )
    cuts = cuts.join(frequent.select(F.col("key").alias("left"), F.col("n").alias("l")), "left")
    cuts = cuts.join(frequent.select(F.col("key").alias("right"), F.col("n").alias("r")), "right")
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    weakest = cuts.groupBy("key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    runs = candidates.select("a", F.explode(F.filter("parts", lambda p: p["words"] > 1)["key"]).alias("key"))
    around = runs.groupBy("key").agg(F.max("a").alias("around"))
    wide = lambda c: F.col(c).cast("decimal(20, 0)")
    kept = (
        candidates.select("key", "lang_key", "a")
        .join(around, "key", "left")
        .where(F.col("around").isNull() | (wide("around") * 100 < wide("a") * contained))
        .join(weakest, "key")
        .select("key", "lang_key", "a", "cut.*")
    )

    # ties at the last rank stay until their texts are known
    order, group = [F.desc("score"), F.desc("a")], F.pmod(F.xxhash64("key"), F.lit(GROUPS))
    within, overall = (Window.partitionBy("lang_key", *by) for by in (["group"], []))
    leading = kept.withColumn("group", group).withColumn("rank", F.rank().over(within.orderBy(*order))).where(F.col("rank") <= top)
    leading = leading.withColumn("rank", F.rank().over(overall.orderBy(*order))).where(F.col("rank") <= top)
    leading = written(leading.drop("rank"), "phrase-leaders")
    named = _texts(texts, _bitmaps(leading, range(2, longest + 1), least=20), longest - 1)
    best, order = leading.join(named, "key"), [*order, F.asc("phrase")]
    best = best.withColumn("rank", F.row_number().over(overall.orderBy(*order))).where(F.col("rank") <= top)
    totals = frequent.where(_length() == int(_LENGTH) + 1).select(F.col("key").alias("lang_key"), "n")
    return best.join(totals, "lang_key").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

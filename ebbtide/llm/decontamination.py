"""Benchmark passages in documents: winnowed fingerprints are joined and their hits extended."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import bitmap, in_bitmap, narrow
from ebbtide.llm.words import gram_hashes, word_hashes
from ebbtide.session import written

#: Words of a window, of a fingerprinted gram, and grams of which the smallest is kept:
#: any WINDOW shared words hold GRAMS grams, one of which both sides keep.
WINDOW = 10
GRAM = 5
GRAMS = WINDOW - GRAM + 1
BITMAP_BITS = 22

_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def words_of(text: str | None) -> np.ndarray:
    """Hashes of the words of a text: runs of digits, letters a to z (A-Z lower-cased) and all beyond ASCII."""
    return word_hashes((text or "").encode("utf-8", "surrogatepass").translate(_FOLD))


def kept(grams: np.ndarray) -> np.ndarray:
    """Which grams are the smallest of some ``GRAMS`` consecutive ones; none if there are fewer."""
    size = len(grams) - GRAMS + 1
    if size <= 0:
        return np.zeros(len(grams), bool)
    low = grams[:size].copy()
    for i in range(1, GRAMS):
        np.minimum(low, grams[i : i + size], out=low)
    # a gram is kept if it equals the largest of the minima over it
    out = np.zeros(len(grams), np.uint64)
    for i in range(GRAMS):
        np.maximum(out[i : i + size], low, out=out[i : i + size])
    return out == grams


def fingerprints(words: np.ndarray, lengths: tuple[int, ...], seen: bytes | None = None):
    """``hash, place, words around`` of what is kept of a text: winnowed grams, and all runs of ``lengths`` words.

    With ``seen``, only those whose bit is set there. Around a gram are the words that a window with
    it can reach; ``before`` of them are in front.
    """
    grams = gram_hashes(words, GRAM)
    at = _places(grams, seen)
    if len(at):
        at = at[kept(grams)[at]]
    yield from _around(words, grams, at, GRAM, WINDOW - GRAM)
    for n in lengths:
        grams = ~gram_hashes(words, n)  # apart from the winnowed ones
        yield from _around(words, grams, _places(grams, seen), n, 0)


def _places(grams: np.ndarray, seen: bytes | None) -> np.ndarray:
    return np.arange(len(grams)) if seen is None else np.flatnonzero(in_bitmap(grams, seen))


def _around(words: np.ndarray, grams: np.ndarray, at: np.ndarray, n: int, reach: int):
    for i in at.tolist():
        lo = max(0, i - reach)
        yield int(grams[i].view(np.int64)), i, i - lo, words[lo : i + n + reach].astype("<u8").tobytes()


_PRINT = "struct<hash:long,place:long,before:int,around:binary>"
_PRINT_ARROW = pa.struct([("hash", pa.int64()), ("place", pa.int64()), ("before", pa.int32()), ("around", pa.binary())])


def _extended(batches):
    """Of joined fingerprints, the span of document words that agree: at least a window, or the short item."""
    for b in batches:
        out = []
        columns = [b.column(n).to_pylist() for n in ("row", "class", "size", "place", "before", "around", "item_before", "item_around")]
        for row, item, size, place, before, around, item_before, item_around in zip(*columns):
            ours, theirs = np.frombuffer(around, "<u8"), np.frombuffer(item_around, "<u8")
            gram = GRAM if size >= WINDOW else size
            lo = hi = 0
            while lo < min(before, item_before) and ours[before - lo - 1] == theirs[item_before - lo - 1]:
                lo += 1
            while hi < min(len(ours) - before, len(theirs) - item_before) and ours[before + hi] == theirs[item_before + hi]:
                hi += 1
            if hi >= gram and lo + hi >= min(WINDOW, size):
                out.append((row, item, place - lo, place + hi))
        columns = list(zip(*out)) or [()] * 4
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["row", "class", "start", "end"])


def benchmark_classes(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``item_id, class, size, prints`` of the items that have words; items of the same words share a class."""

    def run(batches):
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                if len(words):
                    lengths = (len(words),) if len(words) < WINDOW else ()
                    prints = [dict(zip(("hash", "place", "before", "around"), p)) for p in fingerprints(words, lengths)]
                    if lengths:  # the item itself is all there is to look for
                        prints = [p for p in prints if len(p["around"]) == 8 * len(words) and p["hash"] == int((~gram_hashes(words, len(words)))[0].view(np.int64))]
                    out.append((item, xxhash.xxh3_128_hexdigest(words.tobytes()), len(words), prints))
            columns = list(zip(*out)) or [()] * 4
            types = [batch.schema.field(0).type, pa.string(), pa.int64(), pa.list_(_PRINT_ARROW)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["item_id", "class", "size", "prints"])

    kind = items.schema[id_col].dataType.simpleString()
    rows = narrow(items, item_id=id_col, text=text_col).mapInArrow(run, f"item_id {kind}, class string, size long, prints array<{_PRINT}>")
    return written(rows, "benchmark")


def contaminated_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text"):
    """Three tables: ``row, doc_id, n_words`` of all documents; ``row, class, start, end`` of hit words; ``class, item_id``.

    Spans are in words, end exclusive. A document's row number is its own, so repeated ids don't
    mix. Fingerprints of documents go into the join only if the bitmap of the benchmark's, of fixed
    size, holds them; the documents' texts are never moved.
    """
    classes = benchmark_classes(items, item_id_col, item_text_col)
    distinct = classes.groupBy("class", "size").agg(F.first("prints").alias("prints"))
    theirs = distinct.select("class", "size", F.inline("prints")).withColumnsRenamed({"before": "item_before", "around": "item_around"}).drop("place")
    lengths = tuple(sorted(r["size"] for r in distinct.where(F.col("size") < WINDOW).select("size").distinct().collect()))
    seen = bitmap(theirs, "hash", BITMAP_BITS)

    def run(batches):
        for batch in batches:
            sizes, prints = [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                sizes.append(len(words))
                prints.append([dict(zip(("hash", "place", "before", "around"), p)) for p in fingerprints(words, lengths, seen)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.list_(_PRINT_ARROW))], ["doc_id", "n_words", "prints"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = narrow(docs, doc_id=id_col, text=text_col).mapInArrow(run, f"doc_id {kind}, n_words long, prints array<{_PRINT}>")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "fingerprints")
    joined = rows.select("row", F.inline("prints")).join(theirs, "hash").select(
        "row", "class", "size", "place", "before", "around", "item_before", "item_around"
    )
    spans = joined.mapInArrow(_extended, "row long, class string, start long, end long").distinct()
    return rows.select("row", "doc_id", "n_words"), spans, classes.select("class", "item_id")


def find_contamination(docs: DataFrame, items: DataFrame, **columns: str) -> DataFrame:
    """``row, doc_id, n_words, n_hit, n_items, item_ids`` of every document.

    Items with at least ten words are looked for by windows of ten; shorter ones as a whole. A
    document's words inside any occurrence are hit. ``item_ids`` are the ids of the items found,
    distinct, as sorted strings; a null id counts in ``n_items`` only. Null or empty texts have no
    words, so nothing is found in or through them; repeated documents are judged each; either table
    may be empty.
    """
    rows, spans, members = contaminated_spans(docs, items, **columns)
    spans = written(spans, "spans")
    before = "coalesce(max(end) over (partition by row order by start, end rows between unbounded preceding and 1 preceding), 0)"
    hit = (
        spans.select("row", "start", "end").distinct()
        .selectExpr("row", f"greatest(0, end - greatest(start, {before})) as words")
        .groupBy("row").agg(F.sum("words").alias("n_hit"))
    )
    found = (
        spans.select("row", "class").distinct().join(members.distinct(), "class")
        .select("row", "item_id").distinct()
        .groupBy("row").agg(
            F.count(F.lit(1)).alias("n_items"), F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids")
        )
    )
    return rows.join(hit.join(found, "row"), "row", "left").select(
        "row",
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
    )

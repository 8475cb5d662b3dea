"""Passages that repeat across documents, by content-defined chunking with a gear hash."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import extended, narrow
from ebbtide.session import written

#: Bytes the gear hash looks back on, bits that are zero at a border, the shortest and the longest
#: chunk: 40 bytes on average.
REACH = 16
BORDER_BITS = 5
LEAST_CHUNK = 12
MOST_CHUNK = 96
SEGMENT = 1 << 20

_GEAR = np.random.default_rng(1009).integers(0, 1 << 16, 256).astype(np.uint32)


#: Tabs and line ends count as spaces, so that other line breaks hide no passage.
_SPACES = bytes(0x20 if 9 <= b <= 13 else b for b in range(256))


def gear(data: np.ndarray) -> np.ndarray:
    """The 16-bit gear hash after every byte.

    It shifts left by one with each byte, so its upper bits see the last 16 bytes and no more: the
    same bytes give the same borders wherever they stand. Computed for all places at once by
    doubling the number of bytes looked back on.
    """
    h = _GEAR[data]
    for span in (1, 2, 4, 8):
        more = h.copy()
        more[span:] += h[:-span] << np.uint32(span)
        h = more
    return h & np.uint32(0xFFFF)


def chunks(data: bytes) -> list[tuple[int, int, int]]:
    """``start, end, digest`` of all chunks of ``data`` but a last one that is too short to look up.

    A chunk ends where the upper bits of the hash are zero, at ``LEAST_CHUNK`` bytes or later. Where
    no such place comes within ``MOST_CHUNK`` bytes, it ends after the last smallest hash there, so
    that even a word repeated over and over is cut at the same letter everywhere.
    """
    if len(data) < LEAST_CHUNK:
        return []
    h = gear(np.frombuffer(data, np.uint8))
    ends = np.flatnonzero(h < 1 << (REACH - BORDER_BITS)) + 1
    found, s = [], 0
    for e in [*ends.tolist(), len(data)]:
        while e - s > MOST_CHUNK:
            part = h[s + MOST_CHUNK // 4 : s + MOST_CHUNK][::-1]
            cut = s + MOST_CHUNK - int(part.argmin())
            found.append((s, cut))
            s = cut
        if e - s >= LEAST_CHUNK:
            found.append((s, e))
            s = e
    digest = xxhash.xxh3_64_intdigest
    return [(s, e, digest(data[s:e]) - (1 << 63)) for s, e in found]


_CHUNKS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("digest", pa.int64())]))


def _cut(batches):
    """Chunks of every text, a row for each megabyte of it."""
    for batch in batches:
        for i in range(batch.num_rows):
            data = (batch.column(2)[i].as_py() or "").encode("utf-8", "surrogatepass").translate(_SPACES)
            for at in range(0, len(data), SEGMENT):
                found = [{"start": at + s, "end": at + e, "digest": d} for s, e, d in chunks(data[at : at + SEGMENT])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([found], _CHUNKS)], ["doc_id", "row", "chunks"]
                )


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_bytes: int = 128, bridge: int = 24
) -> DataFrame:
    """``doc_id, start, end, first_doc_id, first_start, is_first``: passages that other documents have too.

    Texts are cut into chunks by content, so that insertions move borders only nearby; chunks are
    told apart by digest. A run is of chunks that each occur in two documents or more, at most
    ``bridge`` bytes apart, and at least ``min_bytes`` long; places are bytes of the UTF-8 text, end
    exclusive. Of every chunk the occurrence with the smallest (doc_id, row, place) is the first, and
    a run falls into a span for each part whose chunks have their first occurrence in the same row;
    ``is_first`` tells whether that row is the span's own. Chunks from elsewhere that make up less
    than ``min_bytes`` beside a first occurrence belong to it. A passage of fewer than some 300 bytes
    may be missed, as may both ends of a run.

    A row for every span of every document: none for null, empty or unshared texts. Null ids are
    ids like others, before all; rows with the same id are different documents; an empty table has
    no spans. Digests are counted before they are shuffled, and the join that follows is one whose
    large groups Spark splits, so a chunk may be in a third of all documents.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    cut = rows.mapInArrow(_cut, f"doc_id {kind}, row long, chunks array<struct<start:long,end:long,digest:long>>")
    cut = written(cut, "chunks").select("doc_id", "row", F.inline("chunks"))
    place = F.struct("doc_id", "row", "start")
    shared = cut.groupBy("digest").agg(F.min("row").alias("low"), F.max("row").alias("high"), F.min(place).alias("first"))
    shared = shared.where("low <> high").select("digest", "first")
    found = cut.join(shared, "digest")
    # a new run begins where the chunk before ends too far away
    before = "partition by row order by start rows between unbounded preceding and 1 preceding"
    to_here = "order by start rows unbounded preceding"
    found = found.selectExpr(
        "*", "first.row = row as own", f"coalesce(start - max(end) over ({before}) > {int(bridge)}, true) as opens"
    ).selectExpr("*", f"sum(cast(opens as int)) over (partition by row {to_here}) as run")
    # stretches of a run with, or without, their first occurrence here
    turn = "coalesce(own <> lag(own) over (partition by row, run order by start), true)"
    found = found.selectExpr("*", f"{turn} as turns").selectExpr("*", f"sum(cast(turns as int)) over (partition by row, run {to_here}) as stretch")
    size = "max(end) over (partition by row, run{0}) - min(start) over (partition by row, run{0})"
    found = found.selectExpr(
        "*", f"{size.format('')} as run_bytes", f"{size.format(', stretch')} as bytes", "bool_or(own) over (partition by row, run) as leads"
    ).where(F.col("run_bytes") >= min_bytes)
    # less than a passage beside a first occurrence belongs to that
    stays = F.col("leads") & ~F.col("own") & (F.col("bytes") < min_bytes)
    found = found.withColumn("first", F.when(stays, place).otherwise(F.col("first")))
    moves = "coalesce(first.row <> lag(first.row) over (partition by row, run order by start), true)"
    found = found.selectExpr("*", f"{moves} as moves").selectExpr("*", f"sum(cast(moves as int)) over (partition by row, run {to_here}) as part")
    spans = found.groupBy("row", "run", "part").agg(
        F.min("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("first", "start").alias("first")
    )
    return spans.select(
        "doc_id",
        "start",
        "end",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"),
        (F.col("first.row") == F.col("row")).alias("is_first"),
    )


def without_repeats(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` (of distinct ids) with all but the first occurrence of every span cut from their texts.

    A character that a cut would split stays. Null texts, and documents without spans, stay as they are.
    """
    again = spans.where(~F.col("is_first")).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("+cuts"))
    joined = docs.join(again.withColumnRenamed("doc_id", "+id"), docs[id_col].eqNullSafe(F.col("+id")), "left").drop("+id")
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            out = []
            for text, cuts in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if text is not None and cuts:
                    data, kept, done = text.encode("utf-8", "surrogatepass"), [], 0
                    joined_cuts = []
                    for c in cuts:  # those that touch are one, so that no character stays between them
                        if joined_cuts and c["start"] <= joined_cuts[-1][1]:
                            joined_cuts[-1][1] = max(joined_cuts[-1][1], c["end"])
                        else:
                            joined_cuts.append([c["start"], c["end"]])
                    for s, e in joined_cuts:
                        while s < len(data) and data[s] & 0xC0 == 0x80:
                            s += 1
                        while e < len(data) and data[e] & 0xC0 == 0x80:
                            e -= 1
                        kept.append(data[done:s])
                        done = max(s, e)
                    text = b"".join([*kept, data[done:]]).decode("utf-8", "surrogatepass")
                out.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return extended(joined, run, {}).drop("+cuts")

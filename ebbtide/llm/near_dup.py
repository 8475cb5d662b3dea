"""Near-duplicates: similarity sketches, banding, exact verification on whole sets, connected groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import bitmap, in_bitmap, narrow
from ebbtide.llm.graph import components
from ebbtide.llm.sketches import COORDINATES, shingle_set, sketches
from ebbtide.session import written

#: Coordinates of a band, and bands: at a similarity of 0.8 a pair shares no band once in 350,000.
ROWS = 6
BANDS = COORDINATES // ROWS
#: Pairs whose sketches agree in fewer than 0.6 of the coordinates aren't compared: chance e**-26 at 0.8.
BELOW = 0.2
BATCH_SHINGLES = 1 << 21
#: Members of a bucket, and shingles of them, in one block, about.
BLOCK = 128
BLOCK_SHINGLES = 1 << 18
BITMAP_BITS = 23


def _sets_and_sketches(words: int):
    schema = {"doc_id": None, "n_shingles": pa.int64(), "key": pa.binary(), "sketch": pa.binary()}

    def done(ids, sets, kind):
        filled = [s for s in sets if len(s)]
        rows = iter(sketches(filled).astype("<u2"))
        drawn = [next(rows).tobytes() if len(s) else None for s in sets]
        keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        columns = [pa.array(ids, kind), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), pa.array(drawn, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, list(schema))

    def run(batches):
        for batch in batches:
            ids, sets, held = [], [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(doc)
                sets.append(shingle_set(text.as_py(), words))
                held += len(sets[-1])
                if held >= BATCH_SHINGLES or len(ids) >= 2048:
                    yield done(ids, sets, batch.schema.field(0).type)
                    ids, sets, held = [], [], 0
            if ids:
                yield done(ids, sets, batch.schema.field(0).type)

    return run


def _sets_of(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """``cid, values``: the sorted shingles of the classes in ``wanted`` (cid, key, rep), made anew from their texts.

    A bitmap of fixed size over the representatives' ids leaves out nearly all other texts.
    """
    marked = wanted.withColumn("mark", F.xxhash64("rep"))
    seen = bitmap(marked, "mark", BITMAP_BITS)

    def run(batches):
        for batch in batches:
            near = in_bitmap(batch.column(2).to_numpy().view(np.uint64), seen)
            for i in np.flatnonzero(near).tolist():
                values = shingle_set(batch.column(1)[i].as_py(), words)
                if len(values):
                    key = xxhash.xxh3_128_digest(values.tobytes())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), pa.array([key], pa.binary()), pa.array([values.astype("<u8").tobytes()], pa.binary())],
                        ["rep", "key", "values"],
                    )

    texts = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("mark"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = texts.mapInArrow(run, f"rep {kind}, key binary, values binary")
    return made.join(wanted.select("cid", "rep", "key"), ["rep", "key"]).dropDuplicates(["cid"]).select("cid", "values")


def _one_by_one(batch):
    """The rows of a batch; a row with two blocks is large, so only one is unpacked at a time."""
    for i in range(batch.num_rows):
        yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


class _Rule:
    """When two sets are linked: 100 * intersection >= percent * union."""

    def __init__(self, percent: int):
        self.percent = percent
        self.least = (percent / 100 - BELOW) * COORDINATES

    def sizes(self, n, m):
        return 100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)

    def linked(self, a: bytes, b: bytes) -> bool:
        x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * shared >= self.percent * (len(x) + len(y) - shared)

    def likely(self, batches):
        """Pairs whose sizes and sketches allow a link."""
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, COORDINATES) for c in ("sketch_a", "sketch_b"))
                n, m = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
                ok = ((x == y).sum(1) >= self.least) & self.sizes(n, m)
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    def verified(self, batches):
        for batch in batches:
            ok = [self.linked(a, b) for a, b in zip(batch.column("values_a").to_pylist(), batch.column("values_b").to_pylist())]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def open_pairs(self, row: dict):
        """Index pairs of two blocks of one bucket that may be linked and are for this bucket to test.

        Not those within a component, nor those with the bucket's smallest member (tested before),
        nor those that share an earlier band (tested there).
        """
        left, right = row["left"], row["right"]
        column = lambda side, name: np.array([m[name] for m in side])
        grid = lambda side: np.frombuffer(b"".join(m["sketch"] for m in side), "<u2").reshape(-1, COORDINATES)
        a, b = column(left, "cid"), column(right, "cid")
        open_to = (column(left, "root")[:, None] != column(right, "root")[None]) & self.sizes(column(left, "n")[:, None], column(right, "n")[None])
        open_to &= (a != row["low"])[:, None] & (b != row["low"])[None] & (a[:, None] != b[None])
        x, y = grid(left), grid(right)
        for i in np.flatnonzero(open_to.any(1)).tolist():
            js = np.flatnonzero(open_to[i])
            same = x[i] == y[js]
            banded = same[:, : BANDS * ROWS].reshape(len(js), BANDS, ROWS).all(2)
            ok = (same.sum(1) >= self.least) & (banded.argmax(1) == row["band"])
            yield from ((i, j) for j in js[ok].tolist())

    def needed(self, batches):
        """Members of a bucket that have a pair to test there."""
        for batch in batches:
            out = set()
            for row in _one_by_one(batch):
                for i, j in self.open_pairs(row):
                    out |= {(row["bucket"], row["left"][i]["cid"]), (row["bucket"], row["right"][j]["cid"])}
            columns = list(zip(*sorted(out))) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "cid"])

    def links(self, batches):
        """Links between components, one for each pair that becomes connected."""
        for batch in batches:
            out = []
            for row in _one_by_one(batch):
                root: dict = {}

                def top(c):
                    while c in root:
                        c = root[c]
                    return c

                for i, j in self.open_pairs(row):
                    a, b = row["left"][i], row["right"][j]
                    p, q = top(a["root"]), top(b["root"])
                    if p != q and self.linked(a["values"], b["values"]):
                        root[max(p, q)] = min(p, q)
                        out.append((a["cid"], b["cid"]))
            columns = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def _in_blocks(members: DataFrame) -> DataFrame:
    """Into how many blocks a bucket's members (columns ``bucket, n``) go: by their number and by their shingles."""
    size, shingles = F.count(F.lit(1)), F.sum("n")
    return members.groupBy("bucket").agg(F.ceil(F.greatest(size / BLOCK, shingles / BLOCK_SHINGLES)).alias("blocks"))


def _blocks(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs of blocks of each bucket: the members outside its largest component, and all members."""
    columns = [c for c in ("cid", "root", "n", "sketch", "values") if c in members.columns]
    dealt = members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")))
    block = lambda rows, name: rows.groupBy("bucket", "band", "low", "block").agg(F.collect_list(F.struct(*columns)).alias(name)).drop("block")
    left = block(dealt.where("root <> main"), "left")
    return left.join(block(dealt, "right").drop("band", "low"), "bucket")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``.

    Texts are linked if their sets of ``words``-word shingles (A-Z lower-cased, words between white
    space; a shorter text is one shingle) have at least ``percent`` % of their union in common.
    ``component_id`` is the smallest id reachable over links, ``kept`` whether it is the row's own.
    Null or empty texts, and texts of white space, have no shingles and no links; rows with a null
    id take part in no group (component null, not kept); repeated rows share everything; the result
    for an empty table is empty.

    Equal sets are one class throughout. Classes that share a band of the sketch are candidates.
    First every class is compared with the smallest class of each of its buckets. What is not
    connected then is compared within its buckets in blocks, except inside a component. So no bucket
    is gathered, copies add nothing, a large group of near copies is nearly linear work, and every
    candidate pair is either compared on its whole sets or already connected.
    """
    rule = _Rule(percent)
    docs = narrow(docs, doc_id=id_col, text=text_col)
    kind = docs.schema["doc_id"].dataType.simpleString()
    sets = written(docs.mapInArrow(_sets_and_sketches(words), f"doc_id {kind}, n_shingles long, key binary, sketch binary"), "sketches")
    classes = written(
        sets.where("key is not null and doc_id is not null").groupBy("key")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    bands = F.array(*[F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sketch", 2 * ROWS * b + 1, 2 * ROWS)).alias("bucket")) for b in range(BANDS)])
    banded = classes.select("cid", F.inline(bands))
    shared = banded.groupBy("bucket", "band").agg(F.count(F.lit(1)).alias("size"), F.min("cid").alias("low")).where("size > 1")
    shared = written(shared, "buckets")
    members = written(banded.drop("band").join(shared, "bucket").select("bucket", "band", "size", "low", "cid"), "members")
    values = written(_sets_of(docs, words, members.select("cid").distinct().join(classes, "cid").select("cid", "key", "rep")), "sets")

    side = lambda name, table: table.select(*[F.col(c).alias(name if c == "cid" else f"{c}_{name}") for c in table.columns])
    traits = classes.select("cid", "n", "sketch")
    pairs = members.where("cid <> low").select(F.col("cid").alias("a"), F.col("low").alias("b")).distinct()
    pairs = pairs.join(side("a", traits), "a").join(side("b", traits), "b").mapInArrow(rule.likely, "a long, b long")
    pairs = pairs.join(side("a", values), "a").join(side("b", values), "b")
    found = written(pairs.mapInArrow(rule.verified, "a long, b long"), "links")

    roots = written(components(found), "components")
    rooted = members.where("size > 2").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "cid"))
    parts = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("k"))
    mains = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max_by("root", F.struct("k", "root")).alias("main")).where("parts > 1")
    rooted = written(rooted.join(mains.select("bucket", "main"), "bucket"), "rooted")
    if not rooted.isEmpty():
        rooted = rooted.drop("size").join(traits, "cid")
        needed = _blocks(rooted, _in_blocks(rooted)).mapInArrow(rule.needed, "bucket long, cid long")
        needed = written(needed.distinct(), "needed")
        whole = rooted.join(needed, ["bucket", "cid"])
        more = _blocks(whole.join(values, "cid"), _in_blocks(whole)).mapInArrow(rule.links, "a long, b long")
        roots = components(found.unionByName(written(more, "links")))

    rooted = roots.withColumnRenamed("node", "cid").join(classes.select("cid", "key", "rep"), "cid")
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("component"))
    grouped = rooted.join(lowest, "root").select("key", "component")
    own = classes.select("key", "rep").join(grouped, "key", "left").select("key", F.coalesce("component", "rep").alias("component"))
    return sets.drop("sketch").join(own, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "doc_id"), F.lit(False)).alias("kept"),
    )

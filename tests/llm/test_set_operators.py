"""Near-duplicates, repeated passages, contamination and components against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import decontamination, graph, near_dup, sketches, substring_dedup
from ebbtide.llm.common import bitmap, in_bitmap
from ebbtide.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def _documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    return frozenset(zip(*[words[i:] for i in range(min(k, len(words)))])) if words else frozenset()


def _groups(rows, k):
    """doc_id -> (shingles, smallest id reachable) by comparing all pairs."""
    sets = [(i, _shingles(t, k)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = top(i), top(j)
                root[max(p, q)] = min(p, q)
    return {i: (len(s), top(i)) for i, s in sets}


def test_near_duplicates_query(spark):
    want = _groups(_documents(spark), 2)
    got = QUERIES["op2_near_duplicates"](spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want and len(got) == len(want)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.fixture(scope="module")
def family(spark):
    """A family of near copies around the threshold, chains, copies, short and empty texts."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 900, 60)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.choice(60, int(rng.integers(0, 9)), replace=False):
            words[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(5, "One"), (6, "one"), (7, "two words"), (8, "TWO\twords\n"), (9, ""), (10, None), (11, " \n "), (5, "One"), (None, "one")]
    return rows


def test_near_duplicates_of_a_family(spark, family):
    df = spark.createDataFrame([(i, t, 1) for i, t in family], "doc_id long, text string, cid int").withColumn("a.b", F.lit(0))
    for words in (2, 5):
        want = _groups(family, words)
        got = near_dup.near_duplicates(df, words=words).collect()
        assert len(got) == len(family)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
        assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, False)]
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


def test_sketches_agree_as_sets_do():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        errors = []
        for _ in range(60):
            x = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
            a, b = np.sort(x[:n]), np.sort(x[n // 3 : n // 3 + n])
            s = sketches.sketches([a, b])
            similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append((s[0] == s[1]).mean() - similarity)
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04
    assert len(sketches.sketches([])) == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (200, 200), (7, 3)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 103: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmaps_have_no_false_negatives(spark):
    values = [0, 1, 32767, 32768, 32769, 65535, 65536, -1, -(2**63), 2**63 - 1, 12345678901]
    bits = bitmap(spark.createDataFrame([(v,) for v in values] + [(None,)], "v long"), "v", 17)
    assert len(bits) == 1 << 14 and in_bitmap(np.array(values).view(np.uint64), bits).all()
    assert sum(bin(b).count("1") for b in bits) == len({v % (1 << 17) for v in values})


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _contamination(docs, items):
    windows = {}
    for item, text in items:
        words = WORD.findall(_lower(text))
        n = min(10, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[k : k + n]), set()).add(item)
    lengths, out = {len(w) for w in windows}, []
    for doc, text in docs:
        words, hit, found = WORD.findall(_lower(text)), set(), set()
        for n in lengths:
            for k in range(len(words) - n + 1):
                if at := windows.get(tuple(words[k : k + n])):
                    hit |= set(range(k, k + n))
                    found |= at
        out.append((doc, len(words), len(hit), sorted(map(str, found))))
    return sorted(out, key=str)


def test_decontamination_query(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    want = _contamination([tuple(r) for r in _documents(spark)], items)
    got = QUERIES["op10_decontamination"](spark, FOLDER).collect()
    digest = lambda ids: hashlib.sha256(",".join(ids).encode()).hexdigest()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=str) == sorted(
        ((d, n, h, len(i), digest(i), h > 0) for d, n, h, i in want), key=str
    )


def test_decontamination_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    text = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 12, n))
    items = [(1, "Short ITEM"), (2, text(30)), (3, text(9)), (4, None), (5, "..."), (6, "short-item"), (7, "a a a a a a a a a a a a a"), (2, text(12))]
    long_item = items[1][1]
    docs = [(1, f"x {long_item} y"), (2, "a " * 40), (3, None), (4, ""), (5, f"short item {items[2][1]}"), (6, text(4000) + " " + long_item[20:])]
    docs += [(7, " ".join(long_item.split()[5:16]).upper()), (7, " ".join(long_item.split()[5:14])), (8, "aa " + "a " * 11), (9, "ä " * 10**5 + long_item)]
    df = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, row string")
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, size int")
    got = decontamination.find_contamination(df, bench).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got), key=str) == _contamination(docs, items)
    none = decontamination.find_contamination(df, bench.limit(0))
    assert none.count() == len(docs) and none.where("n_hit > 0").count() == 0
    assert decontamination.find_contamination(df.limit(0), bench).count() == 0


def test_decontamination_with_items_of_every_short_length(spark):
    """A short item as long as the winnowed grams takes nothing from the long ones."""
    rng = np.random.default_rng(7)
    text = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 500, n))
    items = [(n, text(n)) for n in (5, 10, 13, 40)]
    docs = [(n, f"{text(30)} {item} {text(30)}") for n, item in items] + [(50, " ".join(items[3][1].split()[7:20])), (51, text(90)), (52, items[0][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for chosen in (items, [*items, *[(n, text(n)) for n in range(1, 10)]]):
        got = decontamination.find_contamination(df, spark.createDataFrame(chosen, "item_id long, text string")).collect()
        want = _contamination(docs, chosen)
        assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in got), key=str) == want
        assert sum(hit > 0 for _, _, hit, _ in want) >= 6


def test_chunks_resist_shifts():
    rng = np.random.default_rng(8)
    data = bytes(rng.integers(97, 123, 5000).astype(np.uint8))
    digests = lambda d: {x[2] for x in substring_dedup.chunks(d)}
    whole, moved = digests(data), digests(b"inserted" + data[:2000] + b"!" + data[2000:])
    assert len(whole - moved) <= 6 and len(whole) > 80
    found = substring_dedup.chunks(data)
    assert [e for _, e, _ in found][:-1] == [s for s, _, _ in found][1:] and substring_dedup.chunks(b"") == []
    assert len(digests(b"Onthor " * 400)) < 8


def test_repeated_passages(spark):
    rng = np.random.default_rng(9)
    text = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    passage = text(60)
    docs = [(i, text(80)) for i in range(40)] + [(50 + i, f"{text(20 + i)} {passage} {text(30)}") for i in range(5)]
    docs += [(90, None), (91, ""), (92, passage), (None, passage), (93, "é" * 9), (94, text(3) + " x" * 20000)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, row int")
    spans = substring_dedup.repeated_spans(df)
    rows = spans.collect()
    assert {r["doc_id"] for r in rows} == {50, 51, 52, 53, 54, 92, None}
    data = dict(docs)
    for r in rows:
        part = data[r["doc_id"]].encode()[r["start"] : r["end"]]
        assert part.decode() in passage or r["doc_id"] in (None, 92)
    assert {r["first_doc_id"] for r in rows} == {None} and [r["doc_id"] for r in rows if r["is_first"]] == [None]
    cut = dict(substring_dedup.without_repeats(df, spans).select("doc_id", "text").collect())
    assert cut[3] == data[3] and cut[None] == passage and len(cut[51]) < len(data[51]) - 200 and cut[90] is None
    assert substring_dedup.repeated_spans(df.limit(0)).count() == 0


def test_adjacent_passages_are_judged_apart(spark):
    """Of passages next to each other, each one keeps its first copy and loses the others; a first copy gets no holes."""
    rng = np.random.default_rng(11)
    text = lambda n: " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(n))
    docs, whole, once = [], {}, []
    for at in range(0, 60, 10):
        a, b, c, d, x = text(60), text(60), text(60), text(60), text(14)
        around = lambda t: f"{text(30)} {t} {text(30)}"
        # row 1 has the first of two passages, then the second; a short line inside, and in front of, a passage
        docs += [(at, around(a)), (at + 1, around(f"{a} {b}")), (at + 2, around(b)), (at + 3, around(f"{a} {b}"))]
        docs += [(at + 4, around(d)), (at + 5, around(f"{c} {d}")), (at + 6, around(f"{c} {d}")), (at + 7, around(c))]
        once += [t[150:-150] for t in (a, b, c, d)]
        p, q, r = text(40), text(40), text(60)
        docs += [(100 + at, around(x)), (101 + at, around(f"{p} {x} {q}")), (102 + at, around(f"{p} {x} {q}"))]
        docs += [(103 + at, around(f"{x} {r}")), (104 + at, around(f"{x} {r}"))]
        whole |= {101 + at: f"{p} {x} {q}", 103 + at: f"{x} {r}"}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    cut = dict(substring_dedup.without_repeats(df, substring_dedup.repeated_spans(df)).select("doc_id", "text").collect())
    assert [sum(t in left for left in cut.values()) for t in once] == [1] * len(once)
    assert all(t in cut[i] for i, t in whole.items())
    assert not any(t[150:-150] in cut[i + 1] for i, t in whole.items())


def test_repeated_passages_query(spark):
    """Documents that share 50 words are found; what is found shares at least 15."""
    docs = [tuple(r) for r in _documents(spark)]

    def sharing(k):
        seen = {}
        for doc, text in docs:
            words = text.split()
            for i in range(len(words) - k + 1):
                seen.setdefault(tuple(words[i : i + k]), set()).add(doc)
        return {d for at in seen.values() if len(at) > 1 for d in at}

    found = {r["doc_id"] for r in QUERIES["op5_substring_dedup"](spark, FOLDER).select("doc_id").collect()}
    assert len(sharing(50) - found) <= 0.02 * len(sharing(50)) and found <= sharing(15)

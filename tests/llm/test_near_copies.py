"""One row of each group of near copies."""

import itertools
import random
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from test_operators import ODD, documents, prose

from staywise.llm import components, near_copies, simhash


def test_rows_are_told_apart_by_text(spark):
    """Null and repeated ids lose no text, and a repeated id brings no copy back."""
    rows = [(None, prose(20 + i, 60), "a") for i in range(5)]
    rows += [(50, prose(30, 60), "a"), (50, prose(31, 60), "a"), (40, prose(31, 60), "a"), (None, prose(20, 60), "a")]
    kept = near_copies.one_row_of_each(documents(spark, rows)).collect()
    wanted = [(None, prose(20 + i, 60)) for i in range(5)] + [(40, prose(31, 60)), (50, prose(30, 60))]
    assert sorted(map(str, wanted)) == sorted(str((r.doc_id, r.text)) for r in kept)


def test_odd_rows(spark):
    out = near_copies.one_row_of_each(documents(spark, ODD))
    assert out.columns == documents(spark, []).columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 6, 8, 9, 10, 10, 11]
    assert near_copies.one_row_of_each(documents(spark, [])).count() == 0


def slow_set(text):
    found = text.encode().lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))}


def test_groups_by_brute_force(spark):
    """Pairs near the limit of four fifths, also such that only link through a third text."""
    rng = random.Random(3)
    texts = {}
    for i in range(0, 240, 4):
        base = prose(500 + i, 60 + i).split()
        for k in range(4):
            words = list(base)
            for _ in range(rng.randrange(1 + len(base) // 40)):
                words[rng.randrange(len(words))] = "swapped"
            texts[i + k] = " ".join(words[k:])
    sets = {i: slow_set(t) for i, t in texts.items()}
    root, close = {i: i for i in texts}, 0
    for a, b in itertools.combinations(texts, 2):
        common = len(sets[a] & sets[b])
        if 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
            close += (simhash.fingerprint(texts[a].encode()) ^ simhash.fingerprint(texts[b].encode())).bit_count() > 2
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    assert close > 30  # what the contract of the op10 query does not reach
    kept = near_copies.one_row_of_each(documents(spark, [(i, t, "s") for i, t in texts.items()])).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root.values()))


def test_common_passage_makes_no_pairs(spark, monkeypatch):
    """One passage in 3,000 otherwise different texts: no table grows with the square, copies of them link."""
    passage = prose(7, 40)
    rows = [(i, passage + " " + prose(10_000 + i, 40), "s") for i in range(3000)]
    rows += [(3000 + i, rows[i][1] + " end", "s") for i in range(50)]
    sizes = []
    real = near_copies.written
    monkeypatch.setattr(near_copies, "written", lambda frame: sizes.append((out := real(frame)).count()) or out)
    kept = near_copies.one_row_of_each(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(3000))
    assert max(sizes) < 10 * len(rows)


def test_result_does_not_depend_on_parts_and_frequent_shingles(spark, monkeypatch):
    rows = [(i, prose(900 + i // 3, 50) + " x" * (i % 3), "s") for i in range(90)]
    wanted = sorted(tuple(r) for r in near_copies.groups(documents(spark, rows)).collect())
    monkeypatch.setattr(near_copies, "PART_BYTES", 2000)
    monkeypatch.setattr(near_copies, "OFTEN", 2)
    assert wanted and sorted(tuple(r) for r in near_copies.groups(documents(spark, rows)).collect()) == wanted
    # Copies in many runs of gathered texts change nothing either.
    monkeypatch.setattr(near_copies, "GATHERED", 300)
    rows += [(1000 + i, rows[i % 2][1], "s") for i in range(400)]
    assert sorted(tuple(r) for r in near_copies.groups(documents(spark, rows).repartition(7)).collect()) == wanted


def test_columns_with_clashing_names(spark):
    rows = [(1, prose(1, 30), "a"), (2, prose(1, 30), "b"), (1, prose(1, 30), "a"), (3, prose(2, 30), "c")]
    docs = documents(spark, rows)
    for name in ("_id", "_row", "_copies", "_key", "node", "root", "r"):
        docs = docs.selectExpr("*", f"concat('{name}', doc_id) as {name}")
    kept = near_copies.one_row_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r._id, r._key, r.root) for r in kept.collect()) == [(1, "_id1", "_key1", "root1"), (3, "_id3", "_key3", "root3")]


def test_fingerprints_come_first(spark, monkeypatch):
    """Texts that SimHash puts together are checked there; what is close only there makes no link."""
    base = prose(77, 400).split()
    rows = [(i, " ".join([*base[: 399 - i], "swapped", *base[400 - i :]]), "s") for i in range(12)]
    rows += [(100 + i, prose(300 + i, 60), "s") for i in range(5)]
    asked = []
    real = near_copies.near_duplicates

    def near_duplicates(texts, width):
        asked.append((width, sorted(r.text for r in texts.collect())))
        return real(texts, width)

    monkeypatch.setattr(near_copies, "near_duplicates", near_duplicates)
    texts = near_copies.prefixes(documents(spark, rows))
    close = near_copies.fingerprint_links(documents(spark, rows), texts).collect()
    assert close and asked == [(5, sorted(r[1] for r in rows))]
    # Components that join texts without a common shingle change no result.
    wanted = sorted(tuple(r) for r in near_copies.groups(documents(spark, rows)).collect())
    monkeypatch.setattr(near_copies, "near_duplicates", lambda texts, width: real(texts, width).withColumn("component_id", F.min("doc_id").over(Window.partitionBy())))
    assert len({r[1] for r in wanted}) == 1 and sorted(tuple(r) for r in near_copies.groups(documents(spark, rows)).collect()) == wanted


def jobs_of(spark, run):
    """How many Spark jobs a function starts, each of which costs the driver memory."""
    group = f"jobs-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_stars_take_no_rounds(spark):
    """Pairs and stars are components already; a chain is not, and is still found."""
    stars = spark.createDataFrame([(1, i) for i in range(2, 40)] + [(100, 101), (100, 101), (7000, 7000), (203, 201)], "a long, b long")
    found = {}
    assert jobs_of(spark, lambda: found.update((r.node, r.root) for r in components.components(stars).collect())) <= 10
    assert found == {**dict.fromkeys(range(1, 40), 1), 100: 100, 101: 100, 201: 201, 203: 201}
    two = spark.createDataFrame([(5, 1), (5, 2)], "a long, b long")
    assert {r.node: r.root for r in components.components(two).collect()} == {1: 1, 2: 1, 5: 1}


def test_components_extended(spark):
    rng = random.Random(8)
    for n in (0, 3, 60, 200):
        old, more = ([(rng.randrange(150), rng.randrange(150)) for _ in range(k)] for k in (60, n))
        placed = components.components(spark.createDataFrame(old, "a long, b long"))
        found = components.extended(placed, spark.createDataFrame(more, "a long, b long")).collect()
        whole = components.components(spark.createDataFrame(old + more, "a long, b long")).collect()
        assert sorted(found) == sorted(whole)
        assert len({r.node for r in found}) == len(found)


def test_few_jobs_for_the_driver(spark):
    """Families of copies, near copies and chains; the driver's memory grows with the jobs."""
    rows = []
    for i in range(40):
        base = prose(3000 + i, 80).split()
        for k in range(4):
            rows.append((len(rows), " ".join([*base[: 80 - k], *prose(9000 + 4 * i + k, k + 1).split()]), "a"))
    docs = documents(spark, rows)
    kept = []
    assert jobs_of(spark, lambda: kept.extend(near_copies.one_row_of_each(docs).collect())) <= 150
    assert sorted(r.doc_id for r in kept) == list(range(0, 160, 4))


def test_memory_of_a_part():
    """Counting the texts of each shingle needs little more than the part, and counts right."""
    rng = np.random.default_rng(5)
    nodes = np.arange(1, 4001)
    hashes = [np.unique(rng.integers(0, 1 << 24, 200)).astype(np.uint64) << np.uint64(40) for _ in nodes]
    sizes = np.array([len(h) for h in hashes])
    rows = [(0, nodes[a : a + 500].tobytes(), sizes[a : a + 500].tobytes(), None, np.concatenate(hashes[a : a + 500]).tobytes()) for a in range(0, 4000, 500)]
    kinds = [pa.int64()] + [pa.binary()] * 4
    part = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "nodes", "counts", "sizes", "hashes"])
    tracemalloc.start()
    out = [*near_copies._repeated(1)(iter([part]))]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4 * 8 * sizes.sum()
    found = np.frombuffer(out[0].column("hashes")[0].as_py(), np.uint64)
    held = np.frombuffer(out[0].column("held")[0].as_py(), np.int64)
    keys, n = np.unique(np.concatenate(hashes), return_counts=True)
    assert (held == n[np.searchsorted(keys, found)]).all() and len(found) == n[n > 1].sum()

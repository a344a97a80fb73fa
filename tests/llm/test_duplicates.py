"""Near copies, repeated passages and near vectors against brute force."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from evenhand.llm import components, jaccard, nearvectors, shingles, suffixes
from evenhand.session import CLEANUP
from tests.llm import brute


def test_shingles_of_odd_texts():
    rnd = random.Random(3)
    for _ in range(500):
        text = "".join(rnd.choice("abA \n\t\x1c\xa0é") for _ in range(rnd.randint(0, 40)))
        assert len(shingles.shingle_set(text)) == len(brute.shingles(text))


def test_words_do_not_depend_on_the_cut():
    words = [f"word{i}" for i in range(400_000)]
    long = " ".join([*words, "q" * (shingles.SLICE + 5), "end"])
    hashes = shingles.word_hashes(long.encode())
    assert len(hashes) == len(words) + 2
    assert (hashes[:1000] == shingles.word_hashes(" ".join(words[:1000]).encode())).all()
    assert hashes[-1] == shingles.word_hashes(b"end")[0]


def test_near_copies(odd, odd_rows, nothing):
    found = brute.ordered(jaccard.join(odd).collect())
    assert found == brute.ordered(brute.jaccard_components([r[:2] for r in odd_rows]))
    assert jaccard.join(nothing).collect() == []


def test_long_lists_and_frequent_tokens(spark, monkeypatch):
    """Lists beyond all limits: chains of copies of copies and texts that are mostly one passage."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(4))
    rows, text = [], [word() for _ in range(90)]
    for i in range(70):  # each a copy of the one before, so far ends are no longer similar
        text = list(text)
        text[rnd.randrange(90)] = word()
        rows.append((1000 - i, " ".join(text)))
    passage = [word() for _ in range(60)]
    for i in range(70):  # three quarters and a bit less of a text in common
        rows.append((i, " ".join([*passage, *[word() for _ in range(rnd.randint(2, 30))]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert brute.ordered(jaccard.join(docs).collect()) == brute.ordered(brute.jaccard_components(rows))


def test_signatures_meet_for_all_similar_sets():
    """The guarantee itself, with any token frequent: two similar sets share a signature."""
    rnd = np.random.default_rng(5)
    universe = np.sort(rnd.integers(0, 2**63, 4000, dtype=np.uint64) * np.uint64(2))
    often = rnd.random(4000) < 0.8
    for _ in range(3000):
        n = int(rnd.integers(1, 120))
        shared = rnd.choice(4000, n, replace=False)
        left = np.unique(np.concatenate([shared, rnd.choice(4000, int(rnd.integers(0, n // 5 + 1)), replace=False)]))
        right = np.unique(np.concatenate([shared, rnd.choice(4000, int(rnd.integers(0, n // 5 + 1)), replace=False)]))
        common = len(np.intersect1d(left, right))
        if 100 * common >= 75 * (len(left) + len(right) - common) and not (len(left) == len(right) == common):
            a, b = (jaccard.signatures(universe[x], often[x]) for x in (left, right))
            assert len(np.intersect1d(a, b))


def test_one_of_each_keeps_rows_whole(odd, odd_rows):
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    groups = brute.groups([brute.shingles(r[1]) for r in odd_rows], brute.similar)
    named = lambda i: (odd_rows[i][0] is None, odd_rows[i][0] or 0)
    expected = {repr(odd_rows[min(g, key=named)][:2]) for g in groups}
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == sorted(expected)


def test_repeated_passages(odd, odd_rows, nothing):
    found = brute.ordered(suffixes.removed(odd).collect())
    assert found == brute.ordered(brute.passages([r[:2] for r in odd_rows]))
    assert suffixes.removed(nothing).collect() == []


def test_passages_of_random_texts(spark):
    rnd = random.Random(6)
    base = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    rows = [(500, base * 3)]
    for i in range(150):
        kind, at = rnd.random(), rnd.randint(0, 2900)
        rows.append((i, "ab" * rnd.randint(0, 150) if kind < 0.3 else "x" * rnd.randint(0, 200) if kind < 0.4 else base[at : at + rnd.randint(0, 150)] + "é" * rnd.randint(0, 40)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert brute.ordered(suffixes.removed(docs).collect()) == brute.ordered(brute.passages(rows))


def test_a_phrase_in_many_surroundings_is_no_group(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HEAVY", 20)
    rnd = random.Random(8)
    own = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(60))
    rows = [(i, own() + "one phrase with forty-nine characters, not fifty." + own()) for i in range(1500)]
    rows += [(2000 + i, rows[rnd.randrange(1500)][1][rnd.randrange(40) :]) for i in range(100)] + [(None, rows[3][1]), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    table = docs.filter("doc_id IS NOT NULL").selectExpr("doc_id", "xxhash64(text) AS tie", "text")
    stretches, windows = suffixes.filed(table, 8)
    counts = Counter()
    for r in stretches.filter("kind = 1").select("range", "low").collect():
        counts.update((r.range, int(low)) for low in np.frombuffer(r.low, dtype=np.uint32))
    assert max(counts.values()) <= suffixes.STEP * 20 < 1000 < windows.select("doc_id").distinct().count()
    assert brute.ordered(suffixes.removed(docs).collect()) == brute.ordered(brute.passages(rows))


def test_passages_by_windows_alone(odd, odd_rows, monkeypatch):
    monkeypatch.setattr(suffixes, "HEAVY", 1)
    assert brute.ordered(suffixes.removed(odd).collect()) == brute.ordered(brute.passages([r[:2] for r in odd_rows]))


def test_slices_of_long_texts_find_the_same_windows(monkeypatch):
    text = "".join(random.Random(7).choice("ab ") for _ in range(5000)).encode()
    whole = [(s.doc + first, s.begin + s.base + base, s.end + s.base + base) for first, base, s in suffixes._long_safe([text, b"", text[:300]])]
    monkeypatch.setattr(suffixes, "SLICE", 512)
    cut = [(s.doc + first, s.begin + s.base + base, s.end + s.base + base) for first, base, s in suffixes._long_safe([text, b"", text[:300]])]

    def windows(parts):
        return sorted((int(d), w) for doc, begin, end in parts for d, b, e in zip(doc, begin, end) for w in range(b, e - suffixes.LENGTH + 1))

    assert windows(whole) == windows(cut) == [(0, w) for w in range(4951)] + [(2, w) for w in range(251)]


def test_anchors_fill_ranges_evenly():
    """An anchor's hash is the least of a window's, which would all fall into the first ranges and bits."""
    rnd = random.Random(16)
    text = "".join(rnd.choice("abcdefgh ") for _ in range(100_000)).encode()
    hashes = suffixes.Stretches([text]).hash
    counts = np.bincount((hashes >> np.uint64(60)).astype(np.int64), minlength=16)
    assert len(hashes) > 5000 and counts.max() < 1.3 * counts.mean() and counts.min() > 0.7 * counts.mean()


def test_ties_tell_only_repeated_ids_apart(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, None), (None, "d"), (None, "e")], "doc_id int, text string")
    long = docs.select(docs.doc_id.cast("long"), "text")
    ties = {(r.doc_id, r.text): r.tie for r in long.withColumn("tie", suffixes.tie(docs)).collect() if r.doc_id is not None}
    assert ties[1, "a"] == ties[3, None] == 0 and ties[2, "b"] != ties[2, "c"] and 0 not in (ties[2, "b"], ties[2, "c"])
    monkeypatch.setattr(suffixes, "NAMED", 0)
    assert len({r.tie for r in long.withColumn("tie", suffixes.tie(docs)).collect()}) == 6
    assert {r.tie for r in long.filter("doc_id <> 2").withColumn("tie", suffixes.tie(docs.filter("doc_id <> 2"))).collect()} == {0}


def test_no_stretch_stays_on_disk_once_its_marks_are_written(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    own = random.Random(17)
    text = "".join(own.choice("abcdefgh ") for _ in range(3000))
    docs = spark.createDataFrame([(i, text[i:] + str(i)) for i in range(40)], "doc_id long, text string").repartition(3)
    docs.count()
    own_tie = suffixes.tie(docs)
    marks_before, setting = files(), spark.conf.get(CLEANUP, None)
    assert suffixes.repeated_spans(docs, own_tie).count() > 0
    assert spark.conf.get(CLEANUP, None) == setting
    heavy = []
    for _ in range(50):  # files go a moment after the query
        heavy = [f for f in files() - marks_before if f.endswith(".data")]
        if len(heavy) <= 4:
            break
        time.sleep(0.1)
    assert len(heavy) <= 4  # of the counts of rows alone


def test_columns_from_a_file(monkeypatch):
    letters = np.frombuffer(b"abcabcabcabcabcabc" + b"xbcabcabcabcabcabc", dtype=np.uint8)
    size, before = np.array([18, 18]), np.array([1, 1])
    here = [(c, o.tolist(), p.tolist()) for c, o, p in suffixes.build_columns(letters, size, before)]
    monkeypatch.setattr(suffixes, "IN_MEMORY", 0)
    assert here == [(c, o.tolist(), p.tolist()) for c, o, p in suffixes.build_columns(letters, size, before)]
    at = dict((c, p) for c, _, p in here)
    assert at[0] == [0, 17] and at[-1] == [0, 0]


def test_columns_filled_in_parts(monkeypatch):
    rnd = np.random.default_rng(18)
    size = rnd.integers(suffixes.LENGTH, suffixes.COLUMNS + 1, 50)
    before = np.minimum(size - suffixes.ANCHOR, rnd.integers(0, suffixes.LEFT + 1, 50))
    size = np.minimum(size, before + suffixes.COLUMNS - suffixes.LEFT)
    letters = rnd.integers(97, 99, int(size.sum())).astype(np.uint8)
    whole = [(c, o.tolist(), p.tolist()) for c, o, p in suffixes.build_columns(letters, size, before)]
    monkeypatch.setattr(suffixes, "ROWS_AT_ONCE", 7)
    assert whole == [(c, o.tolist(), p.tolist()) for c, o, p in suffixes.build_columns(letters, size, before)]


def test_texts_longer_than_a_slice(spark):
    rnd = random.Random(14)
    letters = "abcdefghijklmnopqrstuvwxyz     "
    long = "".join(rnd.choice(letters) for _ in range(2 * suffixes.SLICE + 1000))
    edge = suffixes.SLICE
    other = "".join(rnd.choice(letters) for _ in range(suffixes.SLICE + 500))
    rows = [
        (1, long), (2, other + long[edge - 70 : edge + 90]), (3, long[-300:] + other[100:400]), (4, "".join(rnd.choice(letters) for _ in range(900))),
        (5, long), (0, long[edge - 30 : edge + 19]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.removed(docs).collect()}
    sizes = {d: len(t) for d, t in rows}
    assert found == {
        0: (sizes[0], 0, 0), 1: (sizes[1], 0, 0), 2: (sizes[2], 160, 1), 3: (sizes[3], 600, 1), 4: (900, 0, 0), 5: (sizes[5], sizes[5], 1),
    }


def test_cleaned_documents(odd, odd_rows):
    kept = suffixes.cleaned(odd)
    assert kept.columns == odd.columns
    gone = {(d, n): (r, s) for d, n, r, s, _ in brute.passages([r[:2] for r in odd_rows])}
    texts = {}
    for row in kept.collect():
        texts.setdefault(row.doc_id, []).append(row.text)
    for doc_id, text, *_ in odd_rows:
        size = len((text or "").encode())
        removed = gone[doc_id, size][0]
        if removed == 0:
            assert text in texts[doc_id]
        elif removed == size:
            assert not any(texts.get(doc_id, []))
        else:
            assert any(size - removed - 12 <= len(t.encode()) <= size - removed for t in texts[doc_id])


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r.node: r.root for r in components.components(links).collect()}
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_near_vectors(spark):
    rnd = np.random.default_rng(8)
    rows = [(1, None, 1), (2, [0.0] * 64, 1), (3, [float("nan")] * 64, 1), (4, [1.0] * 64, None), (5, [1.0] * 3, 1), (6, [2.0] * 3, 1)]
    rows += [(7, [None] * 64, 1), (8, [float("inf")] * 64, 1), (None, [1.0] * 64, 2), (9, [1.0] * 64, 2), (9, [1.0] * 64, 2), (10, [3.0] * 64, 2)]
    center = rnd.standard_normal(64)
    for i in range(200):
        v = center + rnd.standard_normal(64) * rnd.choice([0.08, 0.14, 0.2, 1])
        rows.append((100 + i, (v * rnd.choice([1e-20, 1, 1e15])).tolist(), int(rnd.integers(3, 5))))
    rows += [(400 + i, rows[20 + i][1], rows[20 + i][2]) for i in range(10)]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType())])
    table = spark.createDataFrame([(*r, "x") for r in rows], schema).repartition(4)
    vectors = [None if v is None or None in v else np.array(v, dtype=np.float32).astype(float) for _, v, _ in rows]
    usable = [v is not None and np.isfinite(v).all() and v.any() for v in vectors]

    def linked(i, j):
        if not (usable[i] and usable[j]) or rows[i][2] is None or rows[i][2] != rows[j][2] or len(vectors[i]) != len(vectors[j]):
            return False
        a, b = vectors[i], vectors[j]
        return a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98

    n = [sum(linked(i, j) for j in range(len(rows)) if i != j) for i in range(len(rows))]
    expected = []
    for members in brute.groups(list(range(len(rows))), linked):
        first = min((rows[i][0] for i in members if rows[i][0] is not None), default=None)
        expected += [(rows[i][0], n[i], first, rows[i][0] == first) for i in members]
    assert brute.ordered(nearvectors.near_duplicates(table).collect()) == brute.ordered(expected)
    assert nearvectors.near_duplicates(table.limit(0)).collect() == []


def test_chunks_of_a_cell_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(nearvectors, "CHUNK", 16)
    rnd = np.random.default_rng(9)
    center = rnd.standard_normal(64)
    rows = [(i, (center + rnd.standard_normal(64) * 0.1).tolist(), 1) for i in range(120)]
    vectors = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    n = ((unit @ unit.T) >= 0.98).sum(axis=1) - 1
    found = nearvectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {r.vec_id: r.n_links for r in found} == dict(enumerate(n.tolist()))


def test_ranges_survive_packing():
    from evenhand.llm.ranges import packed_rows

    values = np.sort(np.random.default_rng(10).integers(0, 2**63, 1000, dtype=np.uint64))
    batch = packed_rows(values, 8)
    back = np.concatenate([np.frombuffer(b, "<u4").astype(np.uint64) + (np.uint64(r) << np.uint64(32)) for r, b in zip(*(c.to_pylist() for c in batch.columns))])
    assert isinstance(batch, pa.RecordBatch) and (back == values >> np.uint64(24)).all()

"""Filter diagrams and whitening against brute force."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from checks.compare import duck
from evenhand.llm import filter_audit, whitening
from evenhand.llm.statements import FILTERS_SQL

NAMES = "ABCDE"


def audited(rows, labels) -> set[tuple]:
    """Every order and step of every part, straight from the definition."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    ids = defaultdict(list)
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            ids[text or ""].append(doc_id)
    fails = defaultdict(list)
    for doc_id, text, _, source, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = [
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)), doc_id is not None and min(ids[text]) < doc_id,
        ]
        fails[source or ""].append((doc_id, dict(zip(NAMES, found))))
    out = set()
    for part, docs in fails.items():
        made, total = [], defaultdict(int)
        for order in itertools.permutations(NAMES):
            left = docs
            for step, name in enumerate(order, 1):
                gone = [d for d in left if d[1][name]]
                left = [d for d in left if not d[1][name]]
                failing = sum(d[1][name] for d in docs)
                alone = sum(d[1][name] and sum(d[1].values()) == 1 for d in docs)
                total[name] += len(gone)
                made.append((name, "".join(order), step, len(left), len(gone), failing - len(gone), alone,
                             sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)))
        out |= {(part, *m[1:], total[m[0]]) for m in made}
    return out


def extra_rows():
    """Texts that fail every combination of the filters, copies across sources and ids that repeat."""
    rnd = random.Random(3)
    rows = []
    for n in range(120):
        few, same, shouted, mark = (rnd.random() < 0.4 for _ in range(4))
        words = [f"w{i}" for i in range(20 if few else 80)]
        words = words[:5] * 16 if same and not few else words
        text = " ".join(words) + (" LOUD NOISE" * 9 if shouted else "") + (" a|b" if mark else "") + f" {n % 37}"
        rows.append((300 + n % 90, text, "en", rnd.choice(["a", "b", "", None, "nur hier"]), 1))
    return rows


LABELS = [(i, i % 3 == 0, i % 5 == 0) for i in range(0, 400, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (10, None, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(d, None if q is None else int(q), int(t), "x") for d, q, t in LABELS]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part string")


def test_all_orders_of_odd_rows(spark, odd, odd_rows, labels, nothing):
    rows = [*odd_rows, *extra_rows()]
    more = spark.createDataFrame([(*r, *[None] * 10) for r in extra_rows()], odd.schema)
    found = filter_audit.interactions(odd.union(more), labels).collect()
    assert len(found) == len({r.part for r in found}) * 600
    assert {tuple(r) for r in found} == audited(rows, LABELS)
    assert filter_audit.interactions(nothing, labels).collect() == []
    without = filter_audit.interactions(odd, labels.limit(0)).collect()
    assert {tuple(r) for r in without} == audited(odd_rows, [])


def test_statement_gives_the_same(spark):
    folder = "/root/testdata/sf0.001"
    found = filter_audit.interactions(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    cursor = duck(folder).execute(FILTERS_SQL)
    names = [c[0] for c in cursor.description]
    assert sorted(map(tuple, found.select(*names).collect())) == sorted(cursor.fetchall())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_neighbour_swaps_visit_every_order_once(n):
    order, seen = list(range(n)), [tuple(range(n))]
    for level in filter_audit.neighbour_swaps(n):
        order[level : level + 2] = order[level + 1], order[level]
        seen.append(tuple(order))
    assert len(seen) == len(set(seen)) == math.factorial(n)


def test_swapped_diagram_equals_one_built_in_that_order():
    rnd = random.Random(4)
    counts = {mask: (rnd.randint(1, 9), 0, 1) for mask in range(32) if rnd.random() < 0.6}
    diagram = filter_audit.Diagram(counts, 5)
    nodes = len(diagram.nodes)
    for level in (0, 3, 1, 2, 0):
        diagram.swap(level)
    for at, (filter_, kept, removed, alone) in enumerate(diagram.steps()):
        before = sum(1 << f for f in diagram.order[:at])
        here = {m: w for m, w in counts.items() if not m & before}
        assert kept[0] == sum(w[0] for m, w in here.items() if not m >> filter_ & 1)
        assert removed[0] == sum(w[0] for m, w in here.items() if m >> filter_ & 1)
        assert alone == counts.get(1 << filter_, filter_audit.NOTHING)
    for level in (0, 2, 1, 3, 0):
        diagram.swap(level)
    assert diagram.order == list(range(5)) and diagram.root == nodes - 1  # the first diagram's own nodes again
    with pytest.raises(ValueError):
        filter_audit.orders({}, "ABCDEFGHI")


def test_first_steps(spark, odd, labels):
    rows = filter_audit.interactions(odd, labels)
    of_a = {r["filter"]: r for r in filter_audit.first_steps(rows, ["a"]).collect()}
    assert set(of_a) == set(NAMES)
    assert sum(r.mean_removed for r in of_a.values()) == pytest.approx(
        sum(r.removed for r in rows.filter("part = 'a' AND filter_order = 'ABCDE'").collect()))


def vectors(dim=12, n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = (rng.standard_normal((n, dim)) * np.geomspace(1, 0.05, dim)) @ np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    return x.astype(np.float32)


def whitened(x: np.ndarray):
    """n, deviations, whitened components up to sign, explained, from the definition."""
    ints = np.floor(x.astype(np.float64) * 1024).astype(np.int64) + 100_000
    n, total = len(ints), ints.sum(axis=0)
    away = ints - total / n
    values, turned = np.linalg.eigh(away.T @ away / n)
    values, turned = values[::-1], turned[:, ::-1]
    deviations = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, total)) for row in ints]
    return n, deviations, away @ turned / np.sqrt(values), values / values.sum()


def table(spark, rows, parts=4):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string, component string, label int").repartition(parts)


def test_whitening_of_odd_rows(spark):
    x = vectors()
    rows = [(i, v.tolist(), "x", None, 1) for i, v in enumerate(x)] + [(5, x[5].tolist(), None, None, None), (None, x[7].tolist(), None, None, 1)]
    bad = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [1.0] * 11 + [None]), (904, [float("inf")] + [0.0] * 11), (905, [0.5] * 5),
           (906, [3e38] * 12)]
    df = table(spark, rows + [(i, v, None, None, 1) for i, v in bad])
    found = whitening.whiten(df).collect()
    used = np.array([r[1] for r in rows], dtype=np.float32)
    n, deviations, expected, explained = whitened(used)
    assert len(found) == 8 * len(rows) and {r.n for r in found} == {n}
    assert {r.identity_error for r in found} == {found[0].identity_error} and found[0].identity_error < 1e-10
    by_id = defaultdict(list)
    for r in found:
        by_id[r.vec_id].append(r)
    signs = {}
    for at, (vec_id, *_) in enumerate(rows):
        for r in by_id[vec_id]:
            value = expected[at, r.component - 1]
            sign = signs.setdefault(r.component, math.copysign(1, value * r.whitened))
            assert r.whitened == pytest.approx(sign * value, abs=1e-9) and r.deviation == deviations[at]
            assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)


def test_whitening_where_there_is_little_to_whiten(spark):
    assert whitening.whiten(table(spark, [(1, None, None, None, 1)], 1)).collect() == []
    assert whitening.whiten(table(spark, [(1, None, None, None, 1)], 1).limit(0)).collect() == []
    one = whitening.whiten(table(spark, [(1, [1.0, 2.0, 3.0], None, None, 1)], 1)).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in one] == [(c, None, None, None, 0) for c in (1, 2, 3)]
    flat = [(i, [float(i), 2.0 * i, 7.0], None, None, 1) for i in range(9)]
    rows = whitening.whiten(table(spark, flat, 3)).collect()
    assert {r.component for r in rows if r.whitened is not None} == {1} and rows[0].identity_error < 1e-10
    wide = whitening.whiten(table(spark, [(1, [-1e9, 1e9], None, None, 1), (2, [1e9, -1e9], None, None, 1)], 1)).collect()
    assert {r.deviation for r in wide} == {None}


@pytest.mark.parametrize("dim, n", [(1, 9), (5, 40), (30, 20), (24, 300)])
def test_spectra_grow_row_by_row_and_combine(dim, n):
    rng = np.random.default_rng(dim)
    x = np.floor(rng.standard_normal((n, dim)) * rng.uniform(1, 300, dim))
    x[n // 2 : n // 2 + 3] = x[0]  # repeated rows
    if dim > 4:
        x[:, 2], x[:, 3] = x[:, 1], 0  # equal and constant dimensions
    away = x - x.mean(axis=0)
    scatter = away.T @ away
    for cut in (0, 1, n // 3, n):
        left, right = whitening.Spectrum.nothing(dim), whitening.Spectrum.nothing(dim)
        for row in x[:cut]:
            left.add(row)
        for row in x[cut:]:
            right.add(row)
        left.combine(right)
        scale = np.abs(scatter).max()
        assert left.n == n and np.allclose(left.mean, x.mean(axis=0))
        assert np.allclose(left.values, np.linalg.eigvalsh(scatter), atol=1e-11 * scale)
        assert np.allclose(left.vectors.T @ left.vectors, np.eye(dim), atol=1e-11)
        assert np.allclose(scatter @ left.vectors, left.vectors * left.values, atol=1e-11 * scale)


def test_secular_roots_lie_between_the_poles():
    rng = np.random.default_rng(2)
    for _ in range(50):
        k = int(rng.integers(1, 40))
        poles, squares = np.sort(rng.uniform(0, 1e6, k)), 10 ** rng.uniform(-9, 6, k)
        origin, away = whitening.secular_roots(poles, squares)
        expected = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(squares), np.sqrt(squares)))
        assert np.allclose(poles[origin] + away, expected, rtol=1e-12, atol=1e-9)

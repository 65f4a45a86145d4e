import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessella.llm import components, exact_dedup, near_dedup, textkit

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    """doc_id -> (set size, smallest reachable doc_id), by all pairs."""
    sets = {i: shingle_set(t) for i, t in rows}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                p, q = sorted((root(a), root(b)))
                up[q] = p
    return {i: (len(sets[i]), root(i)) for i in sets}


@given(st.lists(st.integers(0, 2**40), max_size=300))
@settings(max_examples=60, deadline=None)
def test_rice_round_trip(values):
    x = np.unique(np.array(values, np.uint64))
    k, unary, rest = exact_dedup.rice_encode(x)
    assert (exact_dedup.rice_decode(k, len(x), unary, rest) == x).all()


def test_rice_is_small():
    x = np.unique(np.random.default_rng(1).integers(0, 2**32, 4096, dtype=np.uint64))
    _, unary, rest = exact_dedup.rice_encode(x)
    assert len(unary) + len(rest) < 3.1 * len(x)


@given(st.lists(st.text(alphabet="aB \t\né\x0b漢", max_size=30), min_size=1, max_size=20))
@settings(max_examples=60, deadline=None)
def test_words_as_split(texts):
    import pyarrow as pa

    seen = []
    for _, _, hashes, first in textkit.texts_words(pa.array(texts)):
        seen += [hashes[a:b].tolist() for a, b in zip(first, first[1:], strict=False)]
    want = [WORD.findall(t.translate(LOWER)) for t in texts]
    assert [len(x) for x in seen] == [len(x) for x in want]
    names = {}
    for a, b in zip(seen, want, strict=True):
        for h, w in zip(a, b, strict=True):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


def test_exact_groups_odd(odd):
    got = defaultdict(list)
    for r in exact_dedup.exact_groups(odd).collect():
        got[r.doc_id].append((r.keep_id, r.group_size, r.kept, r.text_sha256))
    empty = hashlib.sha256(b"").hexdigest()
    assert got[1] == [(2, 3, False, empty)] and got[2] == [(2, 3, True, empty)]
    assert [x[:3] for x in got[4]] == [(5, 2, False)] and [x[:3] for x in got[5]] == [(5, 2, True)]
    assert [x[:3] for x in got[8]] == [(8, 5, True)] * 2
    assert sorted(x[:3] for x in got[None]) == [(2, 3, False), (8, 5, False)]
    assert sum(map(len, got.values())) == odd.count()


def test_exact_groups_false_suspects(spark, monkeypatch):
    """Equal short fingerprints of unequal texts are told apart by their bytes."""
    monkeypatch.setattr(exact_dedup, "SPARE_BITS", 0)
    monkeypatch.setattr(exact_dedup, "BLOCK_ROWS", 7)
    docs = spark.createDataFrame([(i, f"text {i % 90}") for i in range(200)], "doc_id long, text string").repartition(5)
    want = {i: (max(j for j in range(200) if j % 90 == i % 90), sum(j % 90 == i % 90 for j in range(200))) for i in range(200)}
    assert {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_groups(docs).collect()} == want


def test_drop_copies(odd, none):
    out = exact_dedup.drop_copies(odd)
    assert out.columns == odd.columns
    assert {r.doc_id for r in out.collect()} == {2, 3, 5, 8, 9, 10, 11, None}
    assert exact_dedup.drop_copies(none).count() == 0 and exact_dedup.exact_groups(none).count() == 0


def test_near_groups_against_all_pairs(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    base = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega " * 3).split()
    # A chain of texts, each like the next only, and a crowd that shares a start.
    for i in range(40):
        rows.append((10_000 + i, " ".join([*(f"n{j}" for j in range(i, i + 60))])))
        rows.append((20_000 + i, " ".join(base[:40] + [f"x{i}_{j}" for j in range(i % 7)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 85):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs, percent).collect()}
        assert got == brute(rows, percent)


def test_near_groups_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in rng.integers(0, 60, 2):
            w[j] = f"c{i}_{j}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs, 85).collect()} == brute(rows, 85)


def test_blocks_are_no_square(spark):
    """3,000 members in one component and 3 outside of it: few copies, and each two across parts meet once."""
    rows = spark.range(3003).selectExpr("1L as key", "id", "case when id < 3000 then 0L else id end as part", "0L as largest", "3003L as members", "3L as out")
    dealt = near_dedup._block_pairs(rows).collect()
    assert len(dealt) <= 3003 + 3 * -(-3003 // near_dedup.BLOCK)
    groups = defaultdict(lambda: (set(), set()))
    for r in dealt:
        groups[r.key, r.low, r.high][r.role].add((r.id, r.part, r.outside))
    met = [tuple(sorted((x[0], y[0]))) for others, tests in groups.values() for x in tests for y in others if x[1] != y[1] and (not y[2] or x[0] < y[0])]
    assert len(met) == len(set(met)) == 3 * 3000 + 3


def test_near_groups_many_copies_and_outliers(spark):
    """A crowd of near copies and rows that share its bands but not its component; the plan meets no square of the crowd."""
    rng = np.random.default_rng(9)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, " ".join([*base, f"tail{i % 150}"])) for i in range(600)]
    for i in range(40):
        w = list(base)
        for j in rng.choice(80, 4, replace=False):
            w[j] = f"c{i}_{j}"
        rows.append((1000 + i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for percent in (60, 80):
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs, percent).collect()} == brute(rows, percent)


def test_near_groups_drawn_members(spark, monkeypatch):
    """With blocks of two rows nearly every bucket is met by members drawn by chance first; the result is the same."""
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    rows = [(i, " ".join(f"n{j}" for j in range(i, i + 60))) for i in range(30)] + [(100 + i, " ".join([f"m{j}" for j in range(50)] + [f"x{i}_{j}" for j in range(i % 9)])) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(docs, 85).collect()} == brute(rows, 85)


def test_near_groups_odd(odd, none):
    rows = near_dedup.near_groups(odd, 85).collect()
    assert len(rows) == odd.count()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows if r.doc_id is not None}
    assert got[1] == (0, 1, True) and got[2] == (0, 2, True) and got[3] == (0, 3, True)
    assert got[4] == (1, 4, True) and got[5] == (1, 4, False)
    assert got[7] == (6, 6, False) and got[8] == (6, 6, False) and got[10][1:] == (9, False)
    assert all(r.kept and r.component_id is None for r in rows if r.doc_id is None)
    assert near_dedup.near_groups(none).count() == 0
    out = near_dedup.drop_near_copies(odd)
    assert out.columns == odd.columns and {r.doc_id for r in out.collect()} == {None, 1, 2, 3, 4, 6, 9, 11}


def test_odd_sketch_estimates():
    rng = np.random.default_rng(5)
    for share in (0.8, 0.9, 0.97):
        n = 4000
        common = rng.integers(0, 2**63, int(n * share), dtype=np.uint64)
        rest = rng.integers(0, 2**63, n - len(common), dtype=np.uint64)
        half = len(rest) // 2
        a, b = np.concatenate((common, rest[:half])), np.concatenate((common, rest[half:]))
        s = near_dedup.odd_sketches(np.stack([near_dedup.minhash(a), near_dedup.minhash(b)])).view(np.uint64)
        z = int(np.bitwise_count(s[0] ^ s[1]).sum())
        estimate = 1 + near_dedup.SKETCH_BITS / (4 * near_dedup.SAMPLES) * np.log(1 - 2 * z / near_dedup.SKETCH_BITS)
        assert abs(estimate - share) < 0.08
        assert z <= near_dedup.sketch_bound(share - 0.05)


@pytest.mark.parametrize("one_task", [0, 40, 1 << 19])
def test_components_in_few_plans(spark, monkeypatch, one_task):
    """Links that one task holds take two tables, whatever their shape; more are contracted first, with the same result."""
    written, kept = [], components.scratch.materialize
    monkeypatch.setattr(components, "ONE_TASK", one_task, raising=False)
    monkeypatch.setattr(components.scratch, "materialize", lambda df, tag, *a: written.append(tag) or kept(df, tag, *a))
    rng = np.random.default_rng(1)
    path = [int(x) for x in rng.permutation(60)]
    rows = [*zip(path, path[1:], strict=False), *((100, x) for x in range(101, 130)), *((int(x), 200 + i) for i, x in enumerate(rng.integers(150, 200, 30))), (300, 300)]
    want = {x: x for r in rows[:-1] for x in r}
    while any(want[a] != want[b] for a, b in rows[:-1]):
        for a, b in rows[:-1]:
            want[a] = want[b] = min(want[a], want[b])
    got = components.components(spark.createDataFrame(rows, "a long, b long")).collect()
    assert len(got) == len(want) and {r.id: r.component for r in got} == want
    assert one_task < len(rows) or len(written) == 2


def test_components_without_links(spark):
    assert components.components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_components_of_long_path(spark):
    links = spark.range(1, 64).selectExpr("id - 1 as a", "id as b")
    got = {r.id: r.component for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(64)}

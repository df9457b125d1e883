"""SimHash groups, whitening and fill-in-middle against brute force."""

import hashlib
import math
import re
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from seqcal.llm import fill_in_middle as fim, simhash, whitening

from .test_contracts import WORD, order, rows_of, sha
from .texts import frame

LOWER = {i: i + 32 for i in range(65, 91)}


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_labels(values, radius):
    """Of each value the smallest index that links of at most radius bits reach."""
    parent = list(range(len(values)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= radius:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return [root(x) for x in range(len(values))]


def plain_groups(texts):
    prints = [plain_fingerprint(t) for _, t in texts]
    own = [x for x, (i, _) in enumerate(texts) if i is not None]
    labels = dict(zip(own, least_labels([prints[x] for x in own], 4)))
    least = {}
    for x, label in labels.items():
        least[label] = min(texts[x][0], least.get(label, texts[x][0]))
    return [(i, f"{p:016x}", least[labels[x]] if i is not None else None) for x, ((i, _), p) in enumerate(zip(texts, prints))]


def test_simhash_groups(spark, small):
    near = [(200 + k, " ".join(f"v{i if i != 7 * k else -k}" for i in range(400))) for k in range(30)]
    for texts in [*rows_of(spark, small), near]:
        got = simhash.near_copies(frame(spark, texts)).withColumn("fingerprint", simhash.hexadecimal("fingerprint")).collect()
        assert order(tuple(r) for r in got) == order(plain_groups(texts))
    assert len({r[2] for r in plain_groups(near)}) < len(near)  # the fixture has links
    assert simhash.near_copies(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        simhash.near_copies(frame(spark, []), radius=4, blocks=4)


def test_counting_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "COUNTED", 7)
    texts = [" ".join(f"w{i * k % 17}" for i in range(40)) for k in range(1, 6)] + ["", "a b", "a b c d"]
    got = np.concatenate([simhash.fingerprint_bits(*simhash.shingle_hashes(p)) for p in simhash.slices(pa.array(texts), lower=True)])
    assert got.tolist() == [plain_fingerprint(t) for t in texts]


def clustered(seed, centres, members, flips):
    rng = np.random.default_rng(seed)
    out = set()
    for c in rng.integers(0, 2**64, centres, dtype=np.uint64).tolist():
        for _ in range(members):
            out.add(c ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, flips + 1), replace=False)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_trees_find_all_within_the_radius(seed):
    values = np.array(clustered(seed, 6, 40, 6), dtype=np.uint64)
    np.random.default_rng(seed).shuffle(values)
    trees = np.sort(np.random.default_rng(seed + 1).integers(0, 3, len(values)))
    forest = simhash.Forest(values, trees)
    queries = np.array(clustered(seed, 6, 10, 3), dtype=np.uint64)
    for tree, root in enumerate(forest.roots.tolist()):
        q, node = forest.search(queries, np.full(len(queries), root), 4)
        own = np.flatnonzero(trees == tree)
        want = {(i, int(j)) for i, x in enumerate(queries.tolist()) for j in own if (x ^ int(values[j])).bit_count() <= 4}
        assert set(zip(q.tolist(), node.tolist())) == want and len(q) == len(want)
    assert (simhash.Forest(values[:1], trees[:1]).search(values[:1], np.array([0]), 4)[1] == [0]).all()


def test_children_are_keyed_by_their_distance_to_the_parent():
    values = np.array(clustered(9, 3, 30, 5), dtype=np.uint64)
    forest = simhash.Forest(values, np.zeros(len(values), dtype=np.int64))
    parent, edge = np.divmod(forest.keys, 65)
    assert len(forest.children) == len(values) - 1 and len(np.unique(forest.keys)) == len(forest.keys)
    assert (np.bitwise_count(values[forest.children] ^ values[parent]) == edge).all()


@pytest.mark.parametrize("blocks,nodes", [(6, 1024), (6, 3), (5, 8), (8, 16)])
def test_links_of_shards_with_several_trees(spark, blocks, nodes):
    values = clustered(blocks + nodes, 5, 25, 5)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    rows = simhash.links_within(spark.createDataFrame([(v,) for v in signed], "value long"), 4, blocks, nodes).collect()
    index = {v: i for i, v in enumerate(signed)}
    labels = np.arange(len(values))
    labels = simhash.merged(labels, np.array([index[r.a] for r in rows], dtype=np.int64), np.array([index[r.b] for r in rows], dtype=np.int64))
    assert labels.tolist() == least_labels(values, 4)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], "vec_id long, embedding array<float>, label int, place string, n int")


def exact_fit(rows, scale=256):
    x = [(i, tuple(math.floor(scale * float(np.float32(c))) for c in v)) for i, v in rows]
    fit = sorted({v for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = [[n * c - s for c, s in zip(v, sums)] for v in fit]
    cov = np.array([[float(Fraction(sum(a[i] * a[j] for a in y), n**3)) for j in range(len(sums))] for i in range(len(sums))])
    return x, n, sums, cov


def check_whitened(spark, rows, usable, components=4):
    got = whitening.whiten(vectors(spark, rows), components).collect()
    x, n, sums, cov = exact_fit(usable)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    assert len(got) == len(usable) * len(values) and {r.n for r in got} == {n}
    known = {}
    for r in got:
        known.setdefault((r.vec_id, r.deviation), {})[r.component] = r
    for i, v in x:
        own = known[i, sum((n * c - s) ** 2 for c, s in zip(v, sums))]
        z = (np.array(v) - np.array(sums) / n) @ axes / np.sqrt(values)
        assert np.allclose([abs(own[k + 1].whitened) for k in range(len(values))], abs(z), atol=1e-6)
        assert np.allclose([own[k + 1].explained for k in range(len(values))], values / np.trace(cov), rtol=1e-9)
        assert own[1].identity_error < 1e-9
    return got


def test_whitening_against_exact_fractions(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(120, 6)) * [3, 2, 1, 0.5, 0.2, 0.1] + rng.normal(size=6)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one vector holds over half of all rows
    odd = [(2000, None), (2001, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2002, [float("nan")] * 6), (2003, [float("inf")] + [1.0] * 5), (2004, []), (2005, [1.0, 2.0])]
    check_whitened(spark, rows + odd, rows)
    check_whitened(spark, rows, rows, 6)
    check_whitened(spark, [(None, v) for _, v in rows[:40]], [(None, v) for _, v in rows[:40]], 2)


def test_whitening_of_small_and_flat_tables(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    got = whitening.whiten(vectors(spark, [(1, [-0.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9)) for r in got) == [(1, 1, 2, 65536, 1.0), (2, 1, 2, 65536, 1.0)]


def test_whitening_query(spark, small):
    from seqcal.llm import queries

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    found = queries.QUERIES["op12_embedding_whitening"](spark, small).collect()
    x, n, sums, _ = exact_fit([(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)])
    assert order((r.vec_id, r.deviation) for r in found if r.component == 1) == order((i, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for i, v in x)
    assert len(found) == 4 * len(x) and found[0].identity_error < 1e-6


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**62), 2**62) | st.integers(-1000, 1000), min_size=3, max_size=3), min_size=1, max_size=6), st.sampled_from([0, 1]))
def test_square_sums_are_exact(rows, axis):
    values = np.array(rows, dtype=np.int64)
    want = [sum(v * v for v in c) for c in (zip(*rows) if axis == 0 else rows)]
    assert whitening.square_sums(values, axis).tolist() == want
    assert whitening.square_sums(values.astype(object) * 10**9, axis).tolist() == [w * 10**18 for w in want]


def test_square_sums_of_many_rows():
    values = np.full((5000, 2), 2**40 - 1, dtype=np.int64)
    assert whitening.square_sums(values, 0).tolist() == [5000 * (2**40 - 1) ** 2] * 2


def test_centred_values_are_exact_at_any_size(spark):
    x = np.array([[2**60, -5], [-(2**62), 7]], dtype=np.int64)
    for n, sums in ((2, [3, 4]), (10**12, [10**30, -(10**20)])):
        assert whitening.centred(x, n, sums).tolist() == [[n * int(a) - s for a, s in zip(row, sums)] for row in x]


UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_middle(doc_id, text, percent=50):
    text = text or ""
    units = UNIT.findall(text)
    h = [int(x, 16) for x in re.findall("." * 8, hashlib.sha256(f"42:{doc_id}".encode()).hexdigest())[:4]]
    if doc_id is None or not text or any(m in text for m in fim.MARKERS) or h[2] % 100 >= percent:
        return doc_id, len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MARKED = [(20, "has <P> in it"), (21, "<S>"), (22, "tail <M"), (23, "<<P"), (24, ">P><"), (25, "< P> <X> ends in space \t"), (27, "　wide\xa0space 漢字\n"), (28, "<P"), (29, ">")]


@pytest.mark.parametrize("percent", [50, 100])
def test_fill_in_middle(spark, small, percent):
    for texts in [*rows_of(spark, small), MARKED, [(i, t) for i in range(100, 160) for _, t in MARKED[2:6]]]:
        found = fim.restored(fim.fill_in_middle(frame(spark, texts), percent=percent)).collect()
        assert order(tuple(r)[:6] for r in found) == order(plain_middle(i, t, percent) for i, t in texts)
        assert order((r.doc_id, r.restored) for r in found) == order((i, t or "") for i, t in texts)
    assert fim.digests(fim.fill_in_middle(frame(spark, []))).count() == 0


def test_fill_in_middle_digests(spark, small):
    texts = rows_of(spark, small)[0]
    found = fim.digests(fim.fill_in_middle(frame(spark, texts))).collect()
    want = [plain_middle(i, t) for i, t in texts]
    assert order(tuple(r) for r in found) == order((*w[:5], sha(w[5]), sha(t or "")) for w, (_, t) in zip(want, texts))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.text(st.sampled_from("ab <>PSM\n　é😀"), max_size=30)), min_size=1, max_size=8), st.integers(1, 40))
def test_spans_of_any_length_give_the_same_outputs(texts, span):
    fim.SPAN, before = span, fim.SPAN
    try:
        for first, data, bounds in fim.byte_slices(pa.array([t for _, t in texts]), limit=25):
            own = texts[first : first + len(bounds) - 1]
            batch = fim.arranged(fim.split_words(first, data, bounds), [i for i, _ in own], 42, 100, 80)
            assert [tuple(r.values()) for r in batch.to_pylist()] == [plain_middle(i, t, 100) for i, t in own]
            form = np.array([list(fim.FORMS).index(x) for x in batch["form"].to_pylist()])
            for _, out, cuts in fim.byte_slices(batch["output"]):
                assert fim.rebuilt(out, cuts, form).to_pylist() == [t for _, t in own]
    finally:
        fim.SPAN = before


def test_outputs_without_their_markers_restore_to_null(spark):
    rows = [("psm", "<P>a<S>b<M>c", "acb"), ("psm", "<S>a<P>b<M>c", None), ("spm", "<S>a<P>b<M>c", "bca"), ("spm", "no markers", None), ("psm", "<P><P><S><M>", None), ("plain", "<P>", "<P>"), (None, None, ""), ("psm", None, None), ("psm", "x<P>a<S>b<M>c", None)]
    found = fim.restored(spark.createDataFrame(rows, "form string, output string, want string"), "text").collect()
    assert [r.text for r in found] == [r.want for r in found] and len(found) == len(rows)

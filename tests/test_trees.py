"""Trees against brute force, and the two ways of growing them against each other."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from decklens.operators import trees as T

FEATURES = ["a", "b", "c", "d"]


def _data(n=200, seed=1):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), np.round(rng.normal(size=n), 3), rng.integers(0, 2, n), np.zeros(n)]).astype(float)
    y = np.round(x[:, 0] * 0.3 + np.sin(3 * x[:, 1]) + rng.normal(size=n) * 0.3, 3)
    return x, y, (y > np.median(y)).astype(float), np.arange(n) % 5


@pytest.fixture(scope="module")
def frame(spark):
    x, y, c, fold = _data()
    return spark.createDataFrame([(i, *map(float, r), float(t), float(k), int(f)) for i, (r, t, k, f) in enumerate(zip(x, y, c, fold))],
                                 "row_id long, a double, b double, c double, d double, y double, k double, fold int").repartition(3).cache()


def _binned(frame, label):
    edges = T.bin_edges(frame, FEATURES)
    return edges, T.binned(frame, FEATURES, edges, "row_id", label, "fold").cache()


def _arrays(rows):
    pdf = rows.toPandas().sort_values("h")
    return pdf, T._matrix(pdf["bins"]), pdf["y"].to_numpy(), pdf["h"].to_numpy(), pdf["fold"].to_numpy()


def test_bins_keep_the_order_of_the_values(frame):
    edges, rows = _binned(frame, "y")
    pdf, bins, *_ = _arrays(rows)
    x = _data()[0][pdf["id"]]
    for f in range(4):
        assert len(edges[f]) == len(np.unique(x[:, f])) - 1
        assert all(len(np.unique(x[bins[:, f] == b, f])) == 1 for b in np.unique(bins[:, f]))


def test_null_features_are_an_error(frame):
    with pytest.raises(ValueError):
        T.bin_edges(frame.withColumn("a", F.when(F.col("row_id") > 5, F.col("a"))), FEATURES)


def _brute_split(bins, w, s, lam, least):
    """(gain, feature, bin) by trying every feature and bin."""
    best = (-np.inf, 0, 0)
    for f in range(bins.shape[1]):
        for b in range(256):
            left = bins[:, f] <= b
            lw, rw = w[left].sum(), w[~left].sum()
            if left.all() or not left.any() or lw < least or rw < least:
                continue
            gain = s[left].sum() ** 2 / (lw + lam) + s[~left].sum() ** 2 / (rw + lam) - s.sum() ** 2 / (w.sum() + lam)
            if gain > best[0] + 1e-9 * abs(gain):
                best = (gain, f, b)
    return best


def _brute_tree(bins, y, w, fewest, depth=None):
    """Nested (value, feature, bin, left, right) of a tree with all features."""
    value = (w * y).sum() / w.sum()
    if len(y) < fewest or np.ptp(y) == 0 or depth == 0:
        return value, None
    gain, f, b = _brute_split(bins, w, w * y, 0.0, 0.5)
    if gain == -np.inf:
        return value, None
    left = bins[:, f] <= b
    below = None if depth is None else depth - 1
    return value, (f, b, _brute_tree(bins[left], y[left], w[left], fewest, below), _brute_tree(bins[~left], y[~left], w[~left], fewest, below))


def _same(tree, i, node):
    value, split = node
    assert tree.value[i] == pytest.approx(value, abs=1e-9)
    if split is None:
        assert tree.feature[i] < 0
        return 1
    f, b, left, right = split
    assert (tree.feature[i], tree.cut[i]) == (f, b)
    return 1 + _same(tree, tree.left[i], left) + _same(tree, tree.left[i] + 1, right)


@pytest.mark.parametrize("label,fewest,depth", [("y", 2, None), ("k", 2, None), ("y", 5, None), ("k", 5, 3)])
def test_tree_equals_brute_force_split_by_split(frame, label, fewest, depth):
    _, rows = _binned(frame, label)
    _, bins, y, h, _ = _arrays(rows)
    w = T.bootstrap(h, 0, 42)
    inside = w > 0
    tree = T.grow(bins, y, w, T._seed(1), None, depth, fewest)
    assert _same(tree, 0, _brute_tree(bins[inside], y[inside], w[inside], fewest, depth)) == len(tree.feature)
    # the same tree as the top of the unlimited one
    whole = T.grow(bins, y, w, T._seed(1), None)
    assert np.allclose(whole.settle(bins, [(depth, fewest)])[0], tree.settle(bins, [(None, 2)])[0])


def test_drawn_features_and_stuck_nodes():
    bins = np.array([[0, 0, i] for i in range(8)], dtype=np.uint8)
    tree = T.grow(bins, np.arange(8.0), np.ones(8), T._seed(7), 1)
    assert (tree.feature >= 0).sum() == 7 and set(tree.feature[tree.feature >= 0]) == {2}


def test_poisson_weights_are_a_bootstrap():
    w = T.bootstrap(np.arange(200_000), 3, 42)
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.02)
    assert (T.bootstrap(np.arange(50), 3, 42) == w[:50]).all() and (T.bootstrap(np.arange(50), 4, 42) != w[:50]).any()


@pytest.mark.parametrize("logistic", [False, True])
def test_two_rounds_of_boosting_equal_brute_force(frame, logistic):
    _, rows = _binned(frame, "k" if logistic else "y")
    _, bins, y, h, fold = _arrays(rows)
    run = T.Boosting(0.1, 2, 0.8, 0)
    got = [m.copy() for _, m in T.boost(bins, y, h, fold, run, 2, logistic)]
    train = fold != 0
    mean = y[train].mean()
    margin = np.full(len(y), np.log(mean / (1 - mean)) if logistic else mean)
    assert np.allclose(got[0], margin)
    for turn in range(2):
        p = 1 / (1 + np.exp(-margin))
        g, w = (p - y, p * (1 - p)) if logistic else (margin - y, np.ones(len(y)))
        use = train & (T._uniform(h, T._seed(42, 2, turn)) < 0.8)

        def step(sample, every, depth):
            out = np.full(len(y), np.nan)
            gain, f, b = _brute_split(bins[sample], w[sample], g[sample], 1.0, 1.0) if depth else (-np.inf, 0, 0)
            if gain <= T.MIN_GAIN:
                out[every] = -0.1 * g[sample].sum() / (w[sample].sum() + 1.0)
                return out
            for side in (bins[:, f] <= b, bins[:, f] > b):
                part = step(sample & side, every & side, depth - 1)
                out[every & side] = part[every & side]
            return out
        margin = margin + step(use, np.ones(len(y), bool), 2)
        assert np.allclose(got[turn + 1], margin)


def test_rounds_are_a_prefix(frame):
    _, rows = _binned(frame, "y")
    run = [T.Boosting(0.1, 3, 0.8, f) for f in range(5)]
    short = {r["id"]: r["margin"] for r in T.boosted(rows, run, [4], False).collect()}
    both = T.boosted(rows, run, [4, 9], False).collect()
    assert len(short) == 200 and {r["id"]: r["margin"] for r in both if r["mark"] == 4} == short and len(both) == 400


@pytest.mark.parametrize("logistic", [False, True])
def test_shared_histograms_boost_the_same_trees(frame, logistic):
    _, rows = _binned(frame, "k" if logistic else "y")
    runs = [T.Boosting(0.3, 2, 1.0, 0), T.Boosting(0.1, 3, 0.7, 2)]

    def margins(local_rows):
        return {(r["run"], r["mark"], r["id"]): r["margin"] for r in T.boosted(rows, runs, [1, 3], logistic, local_rows=local_rows).collect()}
    one, two = margins(10**6), margins(10)
    assert len(one) == 2 * 2 * 40 and one == pytest.approx(two, abs=1e-9)

    def trees(local_rows):
        raws = T.boosted(rows, runs, [3], logistic, trees=True, local_rows=local_rows).collect()
        return {(r["run"], r["tree"]): T.Tree.load(bytes(r["raw"])) for r in raws}
    _, bins, *_ = _arrays(rows)
    a, b = trees(10**6), trees(10)
    assert a.keys() == b.keys() and all(np.allclose(a[k].value[T._place(a[k], bins)], b[k].value[T._place(b[k], bins)]) for k in a)


@pytest.mark.parametrize("label,m", [("y", None), ("k", 2)])
def test_shared_histograms_grow_the_same_forest(frame, label, m):
    _, rows = _binned(frame, label)
    caps = [(1, 2), (3, 5), (None, 2)]

    def values(local_rows):
        got = T.forest(rows, [0, 1, 2, 3, 4], [1, 2], caps, m, local_rows=local_rows).collect()
        return {(r["id"], r["fold"], r["mark"], r["cap"]): r["value"] for r in got}
    whole = values(10**6)
    assert len(whole) == 200 * 6
    for bound in (60, 15):
        assert values(bound) == pytest.approx(whole, abs=1e-9)
    _, bins, *_ = _arrays(rows)
    one, two = ({r["tree"]: T.Tree.load(bytes(r["raw"])) for r in T.forest_trees(rows, 3, (4, 2), m, local_rows=bound).collect()} for bound in (10**6, 30))
    assert one.keys() == two.keys() == {0, 1, 2}
    for t in one:
        assert np.allclose(one[t].value[T._place(one[t], bins)], two[t].value[T._place(two[t], bins)])


def test_importances(frame):
    edges, rows = _binned(frame, "y")
    for boosting in (False, True):
        trees = T.boosted(rows, [T.Boosting(0.3, 3, 1.0)], [5], False, trees=True) if boosting else T.forest_trees(rows, 5, (None, 2), None)
        got = T.importances(trees, 4, boosting)
        assert got.sum() == pytest.approx(1) and got[3] == 0 and got.argmax() in (0, 1)


def test_equal_rows_are_split_as_one(monkeypatch):
    rng = np.random.default_rng(3)
    some = np.unique(rng.integers(0, 9, (30, 3)).astype(np.uint8), axis=0)
    of = rng.integers(0, len(some), 400)
    y, h, fold = rng.integers(0, 2, 400).astype(float), np.arange(400), np.arange(400) % 5
    seen, real = [], T.best_splits
    monkeypatch.setattr(T, "best_splits", lambda bins, rows, *a: seen.append(len(rows)) or real(bins, rows, *a))
    for run in (T.Boosting(0.1, 3, 1.0, 0), T.Boosting(0.1, 3, 0.8, 0)):
        *_, (_, margin) = T.boost(some[of], y, h, fold, run, 3, True)
        assert len(margin) == 400 and len(np.unique(margin.round(12))) <= len(some)
    assert 0 < max(seen) <= len(some)


def test_tree_of_sums_equals_tree_of_rows():
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 6, (500, 4)).astype(np.uint8)
    y, w = rng.integers(0, 5, 500) / 4, rng.integers(0, 4, 500).astype(float)
    some, of = T._distinct(bins)
    rows = T.grow(bins, y, w, T._seed(2), 2, None, 5)
    sums = T._grow(some, *(np.bincount(of, x, len(some)) for x in (w, w * y, w * y * y, w > 0)), T._seed(2), 2, None, 5)
    assert (rows.feature == sums.feature).all() and (rows.cut == sums.cut).all() and (rows.rows == sums.rows).all() and np.allclose(rows.value, sums.value)


def _repeated(n=300, seed=5, rows=12):
    rng = np.random.default_rng(seed)
    some = np.unique(rng.integers(0, 7, (rows, 3)).astype(np.uint8), axis=0)
    return some, rng.integers(0, len(some), n), rng.integers(0, 2, n).astype(float), rng.integers(-2**60, 2**60, n), np.arange(n) % 5


def test_a_job_gets_each_feature_row_once(spark):
    some, of, y, h, fold = _repeated()
    rows = spark.createDataFrame([(i, int(h[i]), float(y[i]), int(fold[i]), bytearray(some[of[i]].tobytes())) for i in range(len(of))],
                                 "id long, h long, y double, fold int, bins binary")
    got = T._jobs(rows, 3).withColumn("part", F.spark_partition_id()).collect()
    assert len(got) == 3 * len(set(of.tolist())) and sum(len(r["members"]) for r in got) == 3 * len(of)
    assert len({r["part"] for r in got}) == 3 and all(len({r["part"] for r in got if r["job"] == j}) == 1 for j in range(3))


def test_of_two_children_only_the_smaller_is_summed_up(monkeypatch):
    rng = np.random.default_rng(6)
    bins, h, fold = rng.integers(0, 200, (600, 3)).astype(np.uint8), rng.integers(-2**60, 2**60, 600), np.arange(600) % 5
    bins[:, 1] = 4  # a feature that never varies
    y = (bins[:, 0] > 90) * 0.7 + rng.normal(size=600) * 0.2
    seen, real = [], T._histograms
    monkeypatch.setattr(T, "_histograms", lambda columns, rows, *a: seen.append((len(columns), len(rows))) or real(columns, rows, *a))
    kept = [(t, m.copy()) for t, m in T.boost(bins, y, h, fold, T.Boosting(0.3, 4, 1.0, 0), 3, False)]
    assert len(seen) == 12 and all(c == 2 for c, _ in seen)
    assert all(n == seen[0][1] if i % 4 == 0 else n <= seen[0][1] / 2 for i, (_, n) in enumerate(seen))
    monkeypatch.setattr(T, "KEPT_NODES", 0)  # every node's cells from its own rows
    for (a, x), (b, z) in zip(kept, T.boost(bins, y, h, fold, T.Boosting(0.3, 4, 1.0, 0), 3, False)):
        assert (a.feature == b.feature).all() and (a.cut == b.cut).all() and np.allclose(x, z, rtol=0, atol=1e-12)


def test_nodes_of_one_feature_row_are_not_searched(monkeypatch):
    some, of, y, h, _ = _repeated()
    sums = [np.bincount(of, x, len(some)) for x in (np.ones(len(of)), y, y * y, np.ones(len(of)))]
    seen, real = [], T.best_splits
    monkeypatch.setattr(T, "best_splits", lambda bins, rows, node, k, *a: seen.append(np.bincount(node, minlength=k).min()) or real(bins, rows, node, k, *a))
    tree = T._grow(some, *sums, T._seed(3), 2, None, 2)
    assert min(seen) >= 2
    leaf = T._place(tree, some)
    assert len(set(leaf.tolist())) == len(some) and np.allclose(tree.value[leaf], sums[1] / sums[0])


def test_caps_are_settled_as_by_walking_down():
    rng = np.random.default_rng(9)
    bins, y = rng.integers(0, 30, (400, 3)).astype(np.uint8), rng.normal(size=400).round(2)
    tree, caps = T.grow(bins, y, rng.integers(1, 3, 400).astype(float), T._seed(5), 2), [(0, 2), (3, 2), (3, 40), (None, 2), (None, 25)]
    got = tree.settle(bins, caps)
    for i, (deepest, fewest) in enumerate(caps):
        for r in range(0, 400, 7):
            at, depth = 0, 0
            while tree.feature[at] >= 0 and tree.rows[at] >= fewest and (deepest is None or depth < deepest):
                at, depth = tree.left[at] + (bins[r, tree.feature[at]] > tree.cut[at]), depth + 1
            assert got[i, r] == tree.value[at]
    assert tree.settle(bins[:0], caps).shape == (5, 0)


@pytest.mark.parametrize("drawn", [False, True])
def test_splits_of_many_nodes_equal_brute_force(drawn):
    """Nodes of few rows, bins that repeat, splits that leave too little weight."""
    rng = np.random.default_rng(11)
    bins, node = rng.integers(0, 4, (120, 3)).astype(np.uint8), rng.permutation(np.repeat(np.arange(30), 4))
    w, s = rng.integers(1, 3, 120).astype(float), rng.normal(size=120)
    some = T._drawn(np.arange(30, dtype=np.uint64), 3, 2) if drawn else None
    gain, feature, cut = T.best_splits(bins, np.arange(120), node, 30, some, w, s, 1.0, 2.5)
    for k in range(30):
        mine, cols = node == k, np.arange(3) if some is None else some[k]
        best = _brute_split(bins[mine][:, cols], w[mine], s[mine], 1.0, 2.5)
        assert gain[k] == pytest.approx(best[0], abs=1e-9)
        if best[0] > -np.inf:
            assert (feature[k], cut[k]) == (cols[best[1]], best[2])

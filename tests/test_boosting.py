"""The histogram booster against a plain numpy version, and the searches that share its fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import prepare as pp
from tidewatch.plans import boosting as bt
from tidewatch.plans import training as tr
from tidewatch.plans import trees
from tidewatch.settings import Settings

NAMES = ["f0", "f1", "f2", "f3", "same"]
SETTINGS = Settings(cv_folds=3)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(500, 4)).round(2)
    x[:, 3] = rng.integers(0, 3, 500)  # few values
    x = np.c_[x, x[:, 0]]  # a tie for every split on the first feature
    y = (x[:, 0] + x[:, 1] * (x[:, 3] > 0) + rng.normal(size=500) * 0.4 > 0.4).astype(int)
    return x, y


@pytest.fixture(scope="module")
def data(spark, rows):
    x, y = rows
    table = [(str(i), *map(float, x[i]), int(y[i]), 1.0 + i % 3) for i in range(len(y))]
    schema = "dealer_code string, " + ", ".join(f"{n} double" for n in NAMES) + ", churn_status int, w double"
    return spark.createDataFrame(table, schema).repartition(5)


@pytest.fixture(scope="module")
def binned(data):
    return bt.bin_rows(data, NAMES, "dealer_code", "churn_status", "w")


def plain_tree(x, g, h, params, cuts, level=0):
    """Nested (feature, threshold, gain, G, H, left, right), or (value,) for a leaf; columns all drawn."""
    lam, rate = params["reg_lambda"], params["learning_rate"]
    best = (max(params["gamma"], 1e-6),)
    for f in range(x.shape[1]) if level < params["max_depth"] else ():
        for cut in cuts[f]:
            left = x[:, f] <= cut
            a, b, c, d = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            if left.any() and not left.all() and min(b, d) >= params["min_child_weight"]:
                gain = a**2 / (b + lam) + c**2 / (d + lam) - g.sum()**2 / (h.sum() + lam)
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut)
    if len(best) == 1:
        return (-g.sum() / (h.sum() + lam) * rate,)
    gain, f, cut = best
    left = x[:, f] <= cut
    return (f, cut, gain, g.sum(), h.sum(), plain_tree(x[left], g[left], h[left], params, cuts, level + 1),
            plain_tree(x[~left], g[~left], h[~left], params, cuts, level + 1))


def plain_values(tree, x):
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    left = x[:, tree[0]] <= tree[1]
    out = np.empty(len(x))
    out[left], out[~left] = plain_values(tree[5], x[left]), plain_values(tree[6], x[~left])
    return out


def nested(tree, node=0):
    if tree.feature[node] < 0:
        return (tree.value[node],)
    return (tree.feature[node], tree.threshold[node], tree.gain[node], None, tree.cover[node],
            nested(tree, tree.left[node]), nested(tree, tree.right[node]))


def same_tree(a, b):
    assert len(a) == len(b)
    if len(a) == 1:
        assert a[0] == pytest.approx(b[0], abs=1e-9)
        return
    assert (a[0], a[1]) == (b[0], b[1])
    assert a[2] == pytest.approx(b[2], rel=1e-9) and a[4] == pytest.approx(b[4], rel=1e-9)
    same_tree(a[5], b[5]), same_tree(a[6], b[6])


@pytest.mark.parametrize("node_rows, over", [
    (0, {}), (0, {"gamma": 3.0}), (10_000, {}), (10_000, {"gamma": 3.0}), (10_000, {"min_child_weight": 25.0}),
    (150, {"max_depth": 5}), (0, {"reg_lambda": 7.0, "max_depth": 2})])
def test_gains_and_leaves_equal_a_plain_version(rows, binned, node_rows, over, monkeypatch):
    """With all nodes split by passes over all rows, with all finished in tasks, and with some of both."""
    monkeypatch.setattr(bt, "NODE_ROWS", node_rows)
    monkeypatch.setattr(bt, "STORE_AFTER", 3)  # margins are stored on the way
    x, y = rows
    w = 1.0 + np.arange(len(y)) % 3
    params = {**bt.DEFAULTS, "n_estimators": 4, "max_depth": 4, "learning_rate": 0.3, **over}
    model = bt.fit(binned, [bt.Spec(params)])[0]
    margin = np.zeros(len(y))
    for tree in model.trees:
        p = 1 / (1 + np.exp(-margin))
        want = plain_tree(x, w * (p - y), w * p * (1 - p), params, binned.cuts)
        same_tree(nested(tree), want)
        margin += plain_values(want, x)
    assert model.margins(x) == pytest.approx(margin, abs=1e-9)
    assert (model.importances()[4], model.importances().sum()) == (0, pytest.approx(1))  # ties go to the lower feature


def test_models_grown_together_equal_models_grown_alone(rows, data, monkeypatch):
    monkeypatch.setattr(bt, "NODE_ROWS", 120)
    folded = data.withColumn("fold", F.expr("cast(dealer_code as int) % 3"))
    binned = bt.bin_rows(folded, NAMES, "dealer_code", "churn_status", "w", "fold")
    specs = [bt.Spec({"n_estimators": n, "max_depth": d, "subsample": s, "colsample": c}, k, 9)
             for n, d, s, c, k in ((3, 2, 1.0, 1.0, 0), (6, 4, 0.6, 0.6, 1), (1, 3, 0.8, 1.0, -2))]
    together = bt.fit(binned, specs)
    for spec, model in zip(specs, together):
        alone = bt.fit(binned, [spec])[0]
        assert list(alone.node_rows()) == list(model.node_rows())
        assert len(model.trees) == spec.params["n_estimators"]
    # The first trees of a fit are the fit of fewer trees.
    fewer = bt.fit(binned, [bt.Spec({**specs[1].params, "n_estimators": 2}, 1, 9)])[0]
    assert list(fewer.node_rows()) == list(together[1].first(2).node_rows())


def test_draws_of_rows_and_columns(rows, binned):
    used = lambda m: [set(t.feature[t.feature >= 0].tolist()) for t in m.trees]
    model = bt.fit(binned, [bt.Spec({"n_estimators": 12, "colsample": 0.4, "subsample": 0.5, "max_depth": 3})])[0]
    assert all(len(u) <= 2 for u in used(model)) and len(set().union(*used(model))) == 5  # drawn once per tree
    share = np.array([t.cover[0] for t in model.trees[:1]]) / (0.25 * (1.0 + np.arange(500) % 3).sum())
    assert 0.35 < share[0] < 0.65
    draws = [bt._scatter(np.arange(4000, dtype=np.uint64) ^ bt._salt(42, t)) for t in range(2)]
    assert all(abs((d < 0.3).mean() - 0.3) < 0.03 for d in draws) and abs(np.corrcoef(draws)[0, 1]) < 0.05


def test_odd_inputs(spark, data):
    one = data.where("churn_status = 1")
    model = bt.fit(bt.bin_rows(one, NAMES, "dealer_code", "churn_status", "w"), [bt.Spec({"n_estimators": 2})])[0]
    assert all(t.value[0] != 0 for t in model.trees)
    none = bt.fit(bt.bin_rows(data.limit(0), NAMES, "dealer_code", "churn_status", "w"), [bt.Spec({"n_estimators": 2})])[0]
    assert none.margins(np.zeros((3, 5))).tolist() == [0.0] * 3
    flat = data.withColumns({n: F.lit(1.0) for n in NAMES})
    assert all(len(t.feature) == 1 for t in bt.fit(bt.bin_rows(flat, NAMES, "dealer_code", "churn_status", "w"),
                                                   [bt.Spec({"n_estimators": 2})])[0].trees)
    with pytest.raises(ValueError):
        tr.spec(SETTINGS, {"depth": 3})


def test_node_table_and_contributions(spark, rows, data, binned):
    model = bt.fit(binned, [bt.Spec({"n_estimators": 4, "max_depth": 3})])[0]
    again = bt.from_nodes(model.frame(spark), NAMES)
    assert list(again.node_rows()) == list(model.node_rows())
    leaves = trees.read_leaves(model)
    x = rows[0][:50]
    assert trees.contributions_of(leaves, x).sum(axis=1) + trees.base_value(leaves) == pytest.approx(model.margins(x))


def test_search_shares_fits_and_goes_on_from_stored_scores(spark, data, tmp_path, monkeypatch):
    train = data.drop("w")
    points = tr.grid_points({"n_estimators": [2, 4, 6], "max_depth": [2, 3]})
    assert [e.sizes for e in tr.ensembles(points)] == [(2, 4, 6)] * 2
    path = str(tmp_path / "scores")
    whole = tr.search(train, NAMES, points, SETTINGS, resume=path)
    assert whole.n_fits == 6 and len(whole.scores) == 6 and whole.frame(spark).count() == 6
    # A point alone has the score it has as a part of the larger ensemble.
    alone = tr.search(train, NAMES, [points[0]], SETTINGS)
    assert alone.n_fits == 3 and alone.best_score == pytest.approx(whole.scores[0][1], abs=1e-12)
    # By hand: predictions of the three held-out folds.
    folds = tr.with_folds(tr.weighted(train), SETTINGS)
    binned = bt.bin_rows(folds, NAMES, "dealer_code", "churn_status", tr.WEIGHT, tr.FOLD)
    by_hand = 0.0
    for k in range(3):
        model = bt.fit(binned, [tr.spec(SETTINGS, points[0], k)])[0]
        held = folds.where(F.col(tr.FOLD) == k).toPandas()
        said, truth = model.margins(held[NAMES].to_numpy()) >= 0, held["churn_status"].to_numpy() == 1
        by_hand += 2 * (said & truth).sum() / (said.sum() + truth.sum()) / 3
    assert whole.scores[0][1] == pytest.approx(by_hand)

    # A driver that is lost after the first group of fits leaves its scores; the next one does the others only.
    broken, calls = str(tmp_path / "broken"), []
    scores_of = tr.fold_scores

    def lost(*args):
        calls.append(1)
        if len(calls) > 1:
            raise RuntimeError("driver lost")
        return scores_of(*args)

    monkeypatch.setattr(tr, "MODELS_AT_ONCE", 3)
    monkeypatch.setattr(tr, "fold_scores", lost)
    with pytest.raises(RuntimeError):
        tr.search(train, NAMES, points, SETTINGS, resume=broken)
    monkeypatch.setattr(tr, "fold_scores", scores_of)
    again = tr.search(train, NAMES, points, SETTINGS, resume=broken)
    assert again.n_fits == 3 and again.scores == whole.scores
    assert tr.search(train, NAMES, points, SETTINGS, resume=broken).n_fits == 0
    other = data.drop("w").where("dealer_code <> '7'")  # other rows: stored scores do not count
    assert tr.search(other, NAMES, points[:1], SETTINGS, resume=broken).n_fits == 3


def test_contributions_of_short_and_long_paths(monkeypatch):
    """Leaves looked up by outcome and leaves worked out a row at a time give the same sums."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, 32, (3000, 12), dtype=np.uint8)
    g = (x[:, 0] > x[:, 1]) * 1.0 - (x[:, 2] > 9) * (x[:, 3] > x[:, 4]) + rng.normal(size=3000)
    nodes = bt.grow(x, g, np.full(3000, 0.25), np.arange(12), {**bt.DEFAULTS, "max_depth": 9}, 0)
    for row in nodes:
        row[2] = float(row[1])
    model = bt.Booster(tuple("abcdefghijkl"), (bt._tree(nodes),))
    leaves = trees.read_leaves(model)
    assert max(len(leaf.features) for leaf in leaves) > trees.SHORT > min(len(leaf.features) for leaf in leaves)
    some = x[:700].astype(float)
    phi = trees.contributions_of(leaves, some)
    assert phi.sum(axis=1) + trees.base_value(leaves) == pytest.approx(model.margins(some), abs=1e-9)
    monkeypatch.setattr(trees, "SHORT", 0)
    assert trees.contributions_of(leaves, some) == pytest.approx(phi, abs=1e-12)
    monkeypatch.setattr(trees, "CELLS", 1000)
    assert trees.contributions_of(leaves, some) == pytest.approx(phi, abs=1e-12)
    assert trees.contributions_of([], some).tolist() == np.zeros(some.shape).tolist()


def test_rows_of_a_few_partitions_are_dealt_over_the_cores(spark, data, monkeypatch):
    monkeypatch.setattr(bt, "TASK_ROWS", 100, raising=False)
    binned = bt.bin_rows(data.coalesce(1), NAMES, "dealer_code", "churn_status", "w")
    assert len(binned.rows.inputFiles()) == min(5, spark.sparkContext.defaultParallelism)


def test_sums_do_not_depend_on_how_rows_are_dealt(data, monkeypatch):
    """Passes over rows in five tasks and in one give equal nodes to the last bit."""
    monkeypatch.setattr(bt, "NODE_ROWS", 60)
    monkeypatch.setattr(bt, "STORE_AFTER", 2)
    models = []
    for task_rows in (100, 1000):
        monkeypatch.setattr(bt, "TASK_ROWS", task_rows)
        binned = bt.bin_rows(data, NAMES, "dealer_code", "churn_status", "w")
        models.append(bt.fit(binned, [bt.Spec({"n_estimators": 4, "max_depth": 4, "colsample": 0.8})])[0])
    assert list(models[0].node_rows()) == list(models[1].node_rows())


def test_cells_of_the_commonest_bins_are_filled_in():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 32, (5000, 7), dtype=np.uint8) * (rng.random((5000, 7)) < 0.2)
    x[:, 5], slot = 9, rng.integers(0, 3, 5000)
    g, h = np.rint(rng.normal(size=5000) * 1024) / 1024, np.rint(rng.random(5000) * 1024 + 1) / 1024
    plain, rare = bt._Sums(4, 7, False), bt._Sums(4, 7, True)  # one node has no rows
    for part in (slice(0, 4500), slice(4500, 5000)):
        plain.add(slot[part], x[part], g[part], h[part])
        rare.add(slot[part], x[part], g[part], h[part])
    assert (plain.result() == rare.result()).all()


def test_bytes_of_a_single_row_of_some_columns():
    x = np.arange(10, dtype=np.uint8).reshape(2, 5)
    assert bt._binary(x[:1][:, [0, 2, 3]]).to_pylist() == [bytes([0, 2, 3])]


def test_rows_that_a_tree_tests_alike_are_worked_out_once(monkeypatch):
    rng = np.random.default_rng(8)
    bins = rng.integers(0, 4, (400, 6), dtype=np.uint8)
    g = bins[:, 0] * 1.0 - (bins[:, 1] > 1) * bins[:, 2] + rng.normal(size=400)
    built = []
    for seed, depth in ((0, 3), (1, 9)):  # the deeper one has more tests than a word has bits
        rows = bt.grow(bins, g + seed * rng.normal(size=400) * 3, np.full(400, 0.25), np.arange(6),
                       {**bt.DEFAULTS, "max_depth": depth, "min_child_weight": 0.0}, 0)
        for row in rows:
            row[2] = float(row[1])
        built.append(bt._tree(rows))
    model = bt.Booster(tuple("abcdef"), (*built, bt._tree([bt._leaf(0, 1.0, 1.0, bt.DEFAULTS)])))
    x = np.r_[bins, bins[:300]].astype(float)
    want = trees.contributions_of(trees.read_leaves(model), x)
    seen, plain = [], trees.contributions_of
    monkeypatch.setattr(trees, "contributions_of", lambda leaves, some: seen.append(len(some)) or plain(leaves, some))
    assert trees.contributions_by_tree(trees.parts(model), x) == pytest.approx(want, abs=1e-12)
    assert len(seen) == 2 and max(seen) <= 400
    x[0, 0], x[1, 1], x[2, 2] = np.nan, np.inf, -np.inf
    assert trees.contributions_by_tree(trees.parts(model), x) == pytest.approx(plain(trees.read_leaves(model), x), abs=1e-12)


def test_bounds_of_bins_do_not_depend_on_the_blocks_of_features(data, monkeypatch):
    want = bt.find_cuts(data.coalesce(1), NAMES)
    for blocks in (1, 2, 3):  # the last one may have room for more features
        monkeypatch.setattr(bt, "CUT_BLOCKS", blocks)
        assert [c.tolist() for c in bt.find_cuts(data.coalesce(1), NAMES)] == [c.tolist() for c in want]
    assert bt.find_cuts(data, []) == () and all(len(c) == 0 for c in bt.find_cuts(data.where("false"), NAMES))

import itertools
import math

import numpy as np

from featflow.operators.models import fit_pipeline
from featflow.operators.treeshap import Ensemble, Tree, ensemble_from_spark, shap_values

FEATS = ["l_quantity", "l_discount", "l_tax"]


def _expvalue(tree, x, S):
    def rec(j):
        f = tree.feature[j]
        if f < 0:
            return tree.value[j]
        l, r = tree.left[j], tree.right[j]
        if f in S:
            return rec(l) if x[f] <= tree.threshold[j] else rec(r)
        return (tree.cover[l] * rec(l) + tree.cover[r] * rec(r)) / tree.cover[j]
    return rec(0)


def brute_force(ens, x):
    d = len(x)
    phi = np.zeros(d)
    for t, w in zip(ens.trees, ens.weights):
        for i in range(d):
            others = [k for k in range(d) if k != i]
            for r in range(d):
                for S in itertools.combinations(others, r):
                    c = math.factorial(r) * math.factorial(d - r - 1) / math.factorial(d)
                    phi[i] += w * c * (_expvalue(t, x, set(S) | {i}) - _expvalue(t, x, set(S)))
    return phi


def _node(i, f, thr, l, r, v, c):
    return {"id": i, "feature": f, "threshold": thr, "left": l, "right": r, "value": v, "cover": c}


def test_single_leaf_tree():
    ens = Ensemble([Tree.from_nodes([_node(0, -1, 0, -1, -1, 7.0, 10)])], [1.0], ["a", "b"])
    phi = ens.shap(np.array([[1.0, 2.0], [3.0, 4.0]]))
    assert np.all(phi == 0) and ens.expected_value() == 7.0


def test_feature_used_twice_and_unused_feature():
    nodes = [_node(0, 0, 5.0, 1, 2, 0, 10), _node(1, 0, 2.0, 3, 4, 0, 6),
             _node(2, 1, 1.0, 5, 6, 0, 4), _node(3, -1, 0, -1, -1, 1.0, 2),
             _node(4, -1, 0, -1, -1, 3.0, 4), _node(5, -1, 0, -1, -1, 10.0, 1),
             _node(6, -1, 0, -1, -1, -2.0, 3)]
    ens = Ensemble([Tree.from_nodes(nodes)], [1.0], ["a", "b", "c"])
    X = np.array([[1.0, 0.0, 9.0], [3.0, 2.0, 0.0], [7.0, 0.5, 1.0], [7.0, 3.0, 1.0]])
    phi = ens.shap(X)
    assert np.all(phi[:, 2] == 0)
    for i in range(len(X)):
        assert np.allclose(phi[i], brute_force(ens, X[i]), atol=1e-12)
    assert np.allclose(ens.expected_value() + phi.sum(1), ens.predict(X), atol=1e-12)


def test_spark_models_brute_force_and_additivity(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    for kind, kw in [("dt", {"maxDepth": 6}), ("rf", {"numTrees": 4, "maxDepth": 4}),
                     ("gbt", {"maxIter": 4, "maxDepth": 3})]:
        pm = fit_pipeline(li, FEATS, "l_extendedprice", kind, **kw)
        ens = ensemble_from_spark(spark, pm, FEATS)
        pdf = pm.transform(li).select(*FEATS, "prediction").limit(300).toPandas()
        X = pdf[FEATS].to_numpy()
        phi = ens.shap(X)
        assert np.allclose(ens.expected_value() + phi.sum(1), pdf["prediction"], atol=1e-6, rtol=0)
        for i in range(10):
            assert np.allclose(phi[i], brute_force(ens, X[i]), atol=1e-7)


def test_distributed_operator_keeps_rows_and_ids(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    pm = fit_pipeline(li, FEATS, "l_extendedprice", "dt")
    ens = ensemble_from_spark(spark, pm, FEATS)
    # The model's own prediction rides through the operator as an id column.
    scored = pm.transform(li).select("l_orderkey", "l_linenumber", *FEATS, "prediction")
    out = shap_values(scored, ens, FEATS, ["l_orderkey", "l_linenumber", "prediction"],
                      dtype="double", prefix="phi_", prediction_col="own")
    pdf = out.toPandas()
    assert len(pdf) == li.count()
    total = pdf["expected_value"] + pdf[["phi_" + f for f in FEATS]].sum(axis=1)
    assert np.isclose(total, pdf["prediction"], atol=1e-6).all()
    assert np.isclose(pdf["own"], pdf["prediction"], atol=1e-9).all()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan  # row-local work: no shuffle by key


def _random_tree(rng, depth, features, grow=1.0):
    """Random nodes; covers add up, some features repeat on a path."""
    nodes = []

    def build(d, cover):
        i = len(nodes)
        nodes.append(None)
        if d == 0 or cover < 2 or rng.random() > grow:
            nodes[i] = _node(i, -1, 0, -1, -1, float(rng.normal()), cover)
            return i
        part = int(rng.integers(1, cover))
        f, thr = int(rng.integers(features)), float(rng.normal())
        l, r = build(d - 1, part), build(d - 1, cover - part)
        nodes[i] = _node(i, f, thr, l, r, 0.0, cover)
        return i

    build(depth, 1 << 20)
    return Tree.from_nodes(nodes)


def test_random_trees_equal_brute_force():
    rng = np.random.default_rng(7)
    for depth, features in ((3, 2), (5, 4), (6, 8), (8, 7)):
        ens = Ensemble([_random_tree(rng, depth, features, 0.9) for _ in range(2)], [0.5, 2.0],
                       [f"f{i}" for i in range(features)])
        X = rng.normal(size=(3, features))
        phi = ens.shap(X)
        for i in range(len(X)):
            assert np.allclose(phi[i], brute_force(ens, X[i]), atol=1e-10)


def test_deep_and_wide_model_is_explained():
    """Depth 15, 30 features: no limit on either; additive on every row."""
    rng = np.random.default_rng(1)
    tree = _random_tree(rng, 15, 30, 0.97)
    assert tree.path_features() > 12
    ens = Ensemble([tree], [1.0], [f"f{i}" for i in range(30)])
    X = rng.normal(size=(200, 30))
    assert np.allclose(ens.expected_value() + ens.shap(X).sum(axis=1), ens.predict(X), atol=1e-9)


def test_shap_runs_when_workers_do_not_see_the_repo(tmp_path):
    """Driver started elsewhere, package only on the driver's sys.path: the
    operator must ship itself to the Python workers."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "from featflow.plans import learning\n"
        "s = SparkSession.builder.master('local[2]').getOrCreate()\n"
        "print('ROWS', learning.q_tree_shap_fixed(s, '/root/testdata/sf0.001').count())\n"
    ) % root
    # Keep what the parent's path has (libraries may be there), but not the repo.
    env = dict(os.environ, PYTHONPATH=os.pathsep.join(
        p for p in sys.path if p and os.path.abspath(p) != root))
    out = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 6000" in out.stdout, out.stderr[-2000:]


def test_rows_of_a_cell_are_walked_once(monkeypatch):
    """A few-feature model: each cell of its cuts is explained once, however many rows."""
    from featflow.operators.treeshap import Cells

    rng = np.random.default_rng(5)
    ens = Ensemble([_random_tree(rng, 4, 3, 0.9) for _ in range(3)], [0.2, 0.3, 0.5], list("abc"))
    X = rng.normal(size=(4000, 3))
    X[:40, 0] = ens.trees[0].threshold[ens.trees[0].feature == 0][0]  # on a cut
    X[7, 1], X[8, 2] = np.inf, -np.inf
    phi, prediction = ens.shap(X), ens.predict(X)
    walked = []
    plain = Tree.add_shap
    monkeypatch.setattr(Tree, "add_shap", lambda t, x, w, out: (walked.append(len(x)), plain(t, x, w, out)))
    cells = Cells(ens, 3)
    for part in (X[:1000], X[:1000], X[1000:], X, X[:0]):
        got, p = cells.explain(part)
        assert len(got) == len(p) == len(part)
    assert sum(walked) / 3 <= cells.count < 4000
    assert np.allclose(got, phi[:0]) and np.allclose(cells.explain(X)[0], phi, rtol=0, atol=1e-12)
    assert np.array_equal(cells.explain(X)[1], prediction)
    # A model with too many cells to remember them walks each cell once per batch.
    monkeypatch.setattr("featflow.operators.treeshap._KEPT_CELLS", 0)
    walked.clear()
    got, p = Cells(ens, 3).explain(np.concatenate([X, X]))
    assert sum(walked) / 3 <= cells.count
    assert np.allclose(got, np.concatenate([phi, phi]), rtol=0, atol=1e-12)
    assert np.array_equal(p, np.concatenate([prediction, prediction]))


def test_query_walks_cells_not_rows(spark, tmp_path):
    """Every row gets the walk's shares; a task walks the model's cells, not its rows."""
    from featflow.operators import treeshap as T

    rng = np.random.default_rng(6)
    ens = Ensemble([_random_tree(rng, 3, 2, 1.0)], [1.0], ["a", "b"])
    X = rng.normal(size=(3000, 2))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "id long, a double, b double")
    log = str(tmp_path)

    class Counted(Ensemble):
        def shap(self, x):
            import uuid
            with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(x)))
            return super().shap(x)
    out = T.shap_values(df.repartition(2), Counted(**vars(ens)), ["a", "b"], ["id"], dtype="double",
                        prefix="phi_", prediction_col="p").collect()
    want, p = ens.shap(X), ens.predict(X)
    assert len(out) == 3000
    for r in out:
        assert np.allclose([r["phi_a"], r["phi_b"]], want[r["id"]], atol=1e-12) and r["p"] == p[r["id"]]
    assert 0 < sum(int(f.read_text()) for f in tmp_path.iterdir()) < 1000


def test_many_cells_are_added_up_from_parts(monkeypatch):
    """a model of many features walks the cells of its parts, not its rows."""
    from featflow.operators import treeshap as T

    rng = np.random.default_rng(7)
    ens = Ensemble([_random_tree(rng, 5, 9, 1.0) for _ in range(6)], [0.1 * (i + 1) for i in range(6)],
                   list("abcdefghi"))
    X = rng.normal(size=(6000, 9))
    for f in range(9):  # on cuts
        X[f, f] = next(t.threshold[t.feature == f][0] for t in ens.trees if (t.feature == f).any())
    X[10, 1], X[11, 2] = np.inf, -np.inf
    phi, prediction = ens.shap(X), ens.predict(X)
    monkeypatch.setattr(T, "_PART_CELLS", 300)  # trees are cut below their nodes
    cells = T.Cells(ens, 9)
    assert cells.count > T._KEPT_CELLS and len(cells.parts) > 6
    assert all(p.count <= 300 for p in cells.parts)
    assert sum(len(p.ensemble.trees) for p in cells.parts) > 6
    walked = []
    plain = Ensemble.shap
    monkeypatch.setattr(Ensemble, "shap", lambda e, x: (walked.append(len(x)), plain(e, x))[1])
    for part in (X[:2000], X[2000:], X[:0], X):
        got, p = cells.explain(part)
    assert np.allclose(got, phi, rtol=0, atol=1e-12) and np.allclose(p, prediction, rtol=0, atol=1e-12)
    assert sum(walked) <= sum(p.count for p in cells.parts)
    # Leaves of too many features: each cell of a batch is walked.
    monkeypatch.setattr(T, "_PART_CELLS", 2)
    rest = T.Cells(ens, 9)
    assert rest.parts is None
    assert np.allclose(rest.explain(X)[0], phi, rtol=0, atol=1e-12)


def test_worker_remembers_the_last_model():
    from featflow.operators import treeshap as T

    rng = np.random.default_rng(8)
    one, two = (Ensemble([_random_tree(rng, 3, 2, 1.0)], [1.0], ["a", "b"]) for _ in range(2))
    cells = T.remembered_cells("one", one, 2)
    assert T.remembered_cells("one", one, 2) is cells
    assert T.remembered_cells("two", two, 2).ensemble is two
    assert len(T._REMEMBERED) == 1

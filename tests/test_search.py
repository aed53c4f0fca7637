"""The catalog searches the whole declared grid, once."""

from gaugeline.operators import regression as rg
from gaugeline.plans import catalog


def test_search_tries_every_combination_and_is_stored(spark, monkeypatch):
    runs = []

    def tiny(train, **_):  # the real grid with one-node forests
        runs.append(1)
        grid = [(n, d, b) for n in rg.FOREST_GRID["trees"] for d in rg.FOREST_GRID["depth"] for b in rg.leaf_bounds()]
        rows = [(f'{{"maxDepth":{d},"minInstancesPerNode":{b},"numTrees":{n}}}', float(n + d + b)) for n, d, b in grid]
        return spark.createDataFrame(rows, "params string, rmse double")

    monkeypatch.setattr(rg, "forest_search", tiny)
    monkeypatch.setattr(catalog, "_SEARCHES", {})
    first, again = (catalog._searched(spark, "/root/testdata/sf0.001") for _ in range(2))
    assert first.count() == again.count() == 27 and runs == [1]

import difflib

from routeloom.plans.queries import QUERIES


def test_fuzzy_gazetteer_scores_every_name(spark, tmp_path):
    regions, nations = {0: "AFRICA", 1: "AMERICA", 2: "MIDDLE EAST"}, [("KENYA", 0), ("PERU", 1), ("BRAZIL", 1), ("SAUDI ARABIA", 2)]
    labels = ["red widget", "small ring", "Brazil", "zebra", "bright africa", "saudi"]
    spark.createDataFrame(list(regions.items()), "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame(nations, "n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(x,) for x in labels], "p_name string").write.parquet(f"{tmp_path}/part.parquet")
    names = [(k, n.lower()) for k, n in regions.items()] + [(k, n.lower()) for n, k in nations]
    want = {}
    for label in map(str.lower, labels):
        best = max(((difflib.SequenceMatcher(None, label, n).ratio(), -k) for k, n in names))
        want[label] = (-best[1], round(best[0], 6))
    rows = QUERIES["fuzzy_gazetteer"](spark, str(tmp_path)).collect()
    assert {r.label: (r.r_regionkey, r.ratio) for r in rows} == want and len(rows) == len(labels)


def test_fuzzy_gazetteer_keeps_labels_without_a_gazetteer(spark, tmp_path):
    spark.createDataFrame([], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    spark.createDataFrame([], "n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([("red widget",)], "p_name string").write.parquet(f"{tmp_path}/part.parquet")
    assert [tuple(r) for r in QUERIES["fuzzy_gazetteer"](spark, str(tmp_path)).collect()] == [("red widget", None, None)]

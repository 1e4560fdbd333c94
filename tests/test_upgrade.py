"""PatId1 semantics on hand-made fixtures, checked against a brute-force model."""

import pandas as pd
from pyspark.sql import functions as F

from ledgerlift import schemas
from ledgerlift.plans import upgrade
from ledgerlift.sources import tpch
from tests.conftest import SF_SMALL, rows

IMP_SCHEMA = "Source string, Target string, Weight double, typeTrans string, fraud int"


def tx_frame(spark, pairs):
    """Transactions from (customer, merchant, repeat) triples."""
    data = [(c, m) for c, m, n in pairs for _ in range(n)]
    return spark.createDataFrame(data, "customer string, merchant string")


def brute_force_model(tx: pd.DataFrame, imp: pd.DataFrame, threshold, top=0.1, low=0.1):
    """Literal semantics: fan-out left join, ranks over all pairs, cuts, inner join."""
    def prank(s, ascending):
        n = len(s)
        if n == 1:
            return pd.Series([0.0], index=s.index)
        r = s.rank(method="min", ascending=ascending)
        return (r - 1) / (n - 1)

    key = ["customer", "merchant"]
    cs = tx.groupby(key, dropna=False).size().rename("transaction_count").reset_index()
    cs["merchant_rank"] = cs.groupby("merchant", dropna=False)["transaction_count"] \
        .transform(lambda s: prank(s, False))
    j = tx.merge(imp[["Source", "Weight"]], how="left", left_on="customer", right_on="Source")
    j.loc[j["customer"].isna(), "Weight"] = None
    j["weight"] = j["Weight"].astype("float64").fillna(1.0)
    sc = j.groupby(key, dropna=False)["weight"].mean().rename("avg_weight").reset_index()
    sc["weight_rank"] = sc.groupby("merchant", dropna=False)["avg_weight"] \
        .transform(lambda s: prank(s, True))
    totals = tx.groupby("merchant").size()
    elig = set(totals[totals > threshold].index)
    m = cs.dropna(subset=key).merge(sc.dropna(subset=key), on=key)
    m = m[m["merchant"].isin(elig) & (m["merchant_rank"] <= top) & (m["weight_rank"] <= low)]
    return sorted(zip(m["customer"], m["merchant"]))


def detect_pairs(spark, tx, imp, threshold, **kw):
    det = upgrade.detect_upgrades(tx, imp, threshold, detected_at="2025-01-01 00:00:00", **kw)
    return rows(det, "customer", "merchant")


def test_threshold_is_strict(spark):
    imp = spark.createDataFrame([], IMP_SCHEMA)
    tx = tx_frame(spark, [("c1", "m1", 10), ("c2", "m2", 11), ("c3", "m3", 9)])
    assert detect_pairs(spark, tx, imp, 10) == [("c2", "m2")]


def test_singleton_merchant_passes_and_ties_share_rank(spark):
    imp = spark.createDataFrame([], IMP_SCHEMA)
    # m1: single customer -> rank 0.0. m2: three customers tied -> all rank 0.0
    tx = tx_frame(spark, [("a", "m1", 3), ("b", "m2", 2), ("c", "m2", 2), ("d", "m2", 2)])
    assert detect_pairs(spark, tx, imp, 0) == [("a", "m1"), ("b", "m2"), ("c", "m2"), ("d", "m2")]


def test_rank_exactly_point_one_included(spark):
    # 11 customers with distinct counts, equal weights -> ranks 0, .1, .2 ...
    imp = spark.createDataFrame([], IMP_SCHEMA)
    tx = tx_frame(spark, [(f"c{i:02d}", "m", 20 - i) for i in range(11)])
    assert detect_pairs(spark, tx, imp, 0) == [("c00", "m"), ("c01", "m")]
    # 21 customers: ranks 0, .05, .1, .15 ... -> the first three pass
    tx = tx_frame(spark, [(f"c{i:02d}", "m", 30 - i) for i in range(21)])
    assert detect_pairs(spark, tx, imp, 0) == [("c00", "m"), ("c01", "m"), ("c02", "m")]


def test_null_customer_counts_in_rank_but_is_dropped(spark):
    data = [(None, "m")] * 5 + [("a", "m")] * 4 + [("b", "m")] * 1 + [("c", None)] * 3
    tx = spark.createDataFrame(data, "customer string, merchant string")
    imp = spark.createDataFrame([], IMP_SCHEMA)
    got = detect_pairs(spark, tx, imp, 0)
    # null customer holds rank 0.0 in m; a has rank 0.5 -> nothing but a null passes
    assert got == []
    pdf = pd.DataFrame(data, columns=["customer", "merchant"])
    assert got == brute_force_model(pdf, pd.DataFrame(columns=["Source", "Weight"]), 0)


def test_weights_default_fanout_and_nulls(spark):
    tx_rows = [("a", "m", 5), ("b", "m", 5), ("c", "m", 1), ("d", "m", 1), ("a", "n", 2)]
    imp_rows = [("a", None, 0.5, "t1", 0), ("a", None, 3.5, "t2", 0),  # two rows: mean 2.0
                ("b", None, None, "t1", 0),                            # null weight -> 1.0
                ("c", None, 0.1, "t1", 0)]                             # d: none -> 1.0
    tx = tx_frame(spark, tx_rows)
    imp = spark.createDataFrame(imp_rows, IMP_SCHEMA)
    scores = {(r["customer"], r["merchant"]): r["avg_weight"]
              for r in upgrade.importance_scores(tx, imp).collect()}
    assert scores == {("a", "m"): 2.0, ("b", "m"): 1.0, ("c", "m"): 0.1, ("d", "m"): 1.0,
                      ("a", "n"): 2.0}
    txp = pd.DataFrame([(c, m) for c, m, n in tx_rows for _ in range(n)],
                       columns=["customer", "merchant"])
    impp = pd.DataFrame(imp_rows, columns=["Source", "Target", "Weight", "typeTrans", "fraud"])
    for top, low in [(0.1, 0.1), (0.5, 0.5), (1.0, 0.4)]:
        assert detect_pairs(spark, tx, imp, 0, top_pct=top, low_pct=low) == \
            brute_force_model(txp, impp, 0, top, low)


def test_empty_input_and_no_eligible_merchant_give_schema(spark):
    imp = spark.createDataFrame([], IMP_SCHEMA)
    empty = spark.createDataFrame([], "customer string, merchant string")
    det = upgrade.detect_upgrades(empty, imp, 0, detected_at="t")
    assert det.columns == schemas.DETECTION_COLUMNS and det.count() == 0
    tx = tx_frame(spark, [("a", "m", 3)])
    det = upgrade.detect_upgrades(tx, imp, 50_000, detected_at="t")
    assert [(f.name, f.dataType) for f in det.schema.fields] == \
        [(f.name, f.dataType) for f in schemas.DETECTIONS.fields]
    assert det.count() == 0


def test_detection_record_constants(spark):
    imp = spark.createDataFrame([], IMP_SCHEMA)
    tx = tx_frame(spark, [("a", "m", 3)])
    r = upgrade.detect_upgrades(tx, imp, 0, detected_at="2025-05-05 10:00:00").collect()[0]
    assert (r.YStartTime, r.detectionTime, r.patternId, r.ActionType) == \
        ("2025-05-05 10:00:00", "2025-05-05 10:00:00", "PatId1", "UPGRADE")


def test_matches_brute_force_on_test_tables(spark):
    tx = tpch.transactions(spark, SF_SMALL)
    imp = tpch.customer_importance(spark, SF_SMALL)
    txp = tx.select("customer", "merchant").toPandas()
    impp = imp.toPandas()
    for threshold, top, low, method in [(500, 0.1, 0.1, "auto"), (600, 0.1, 0.1, "sliced"),
                                        (550, 0.3, 0.2, "auto"), (550, 0.3, 0.2, "window")]:
        got = detect_pairs(spark, tx, imp, threshold, top_pct=top, low_pct=low, method=method)
        got = sorted((int(c), int(m)) for c, m in got)
        assert got == brute_force_model(txp, impp, threshold, top, low)


def test_raising_threshold_never_adds_detections(spark):
    tx = tpch.transactions(spark, SF_SMALL)
    imp = tpch.customer_importance(spark, SF_SMALL)
    prev = None
    for t in (450, 550, 600, 640):
        cur = set(detect_pairs(spark, tx, imp, t))
        if prev is not None:
            assert cur <= prev
        prev = cur


def test_per_scope_equals_independent_runs(spark):
    tx = tpch.transactions(spark, SF_SMALL).withColumn("part", (F.col("l_orderkey") % 3).cast("int"))
    imp = tpch.customer_importance(spark, SF_SMALL)
    scoped = upgrade.detect_upgrades(tx, imp, 150, detected_at="t", scope=["part"])
    for p in range(3):
        alone = detect_pairs(spark, tx.filter(F.col("part") == p), imp, 150)
        assert rows(scoped.filter(F.col("part") == p), "customer", "merchant") == alone


def test_hot_merchant_is_sliced_and_matches_window(spark):
    # sf0.01: the marketplace merchant holds about a third of all pairs
    from ledgerlift.operators import rank
    from ledgerlift.plans.registry import HOT_MERCHANT, HOT_SLICES, hot_merchant_transactions
    sf = "/root/testdata/sf0.01"
    tx = hot_merchant_transactions(spark, sf)
    imp = tpch.customer_importance(spark, sf)
    scored = upgrade.with_avg_weight(upgrade.customer_pairs(tx), imp).select("merchant", "avg_weight").distinct()
    spread = rank._by_range(scored, HOT_SLICES, F.col("merchant"), F.col("avg_weight"))
    assert spread.filter(F.col("merchant") == HOT_MERCHANT).select(F.spark_partition_id()).distinct().count() > 1
    sliced = detect_pairs(spark, tx, imp, 600, slices=HOT_SLICES)
    assert sliced == detect_pairs(spark, tx, imp, 600, method="window")
    assert any(m == str(HOT_MERCHANT) for _, m in sliced)


def test_preaggregated_weight_equals_fanout_average(spark):
    from ledgerlift.plans.reports import importance_join
    tx = tpch.transactions(spark, SF_SMALL, with_category=True)
    imp = tpch.customer_importance(spark, SF_SMALL)
    fan = (importance_join(tx, imp).groupBy("customer", "merchant")
           .agg(F.avg("weight").alias("fan_weight")))
    got = upgrade.importance_scores(tx, imp).join(fan, ["customer", "merchant"])
    worst = got.select(F.max(F.abs(F.col("avg_weight") - F.col("fan_weight"))
                             / F.col("fan_weight")).alias("d")).first()["d"]
    assert got.count() == fan.count() and worst <= 1e-12


def test_row_order_does_not_matter(spark):
    tx = tpch.transactions(spark, SF_SMALL)
    imp = tpch.customer_importance(spark, SF_SMALL)
    shuffled = tx.orderBy(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey")).repartition(5)
    assert detect_pairs(spark, shuffled, imp, 500) == detect_pairs(spark, tx, imp, 500)

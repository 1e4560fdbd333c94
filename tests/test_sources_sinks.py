import os

import pytest
from pyspark.sql import functions as F

from ledgerlift import schemas
from ledgerlift.operators.quality import quality_report, split_valid
from ledgerlift.sinks import tables
from ledgerlift.sinks.writers import detection_batches, write_detection_batches
from ledgerlift.sources import dimension, files
from tests.conftest import rows

HEADER = "step,customer,age,gender,zipcodeOri,merchant,zipMerchant,category,amount,fraud\n"


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_csv_parsing_with_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "in", "transactions.csv")
    _write(p, HEADER + "3,CX-77,2,F,10115,MX-12,20095,books,12.5,0\n"
               "4,CX-78,6,M,10117,MX-13,20097,travel,80.0,1\n")
    df = files.read_transactions_csv(spark, p)
    assert df.schema == schemas.TRANSACTIONS
    assert rows(df, "customer", "amount") == [("CX-77", 12.5), ("CX-78", 80.0)]


def test_single_quotes_kept_or_stripped(spark, tmp_dir):
    p = os.path.join(tmp_dir, "q.csv")
    _write(p, HEADER + "0,'C1',4,M,1,'M1',1,es_food,1.0,0\n")
    assert files.read_transactions_csv(spark, p).first().customer == "'C1'"
    assert files.read_transactions_csv(spark, p, strip_quotes=True).first().customer == "C1"


def test_malformed_rows_go_to_corrupt_column(spark, tmp_dir):
    p = os.path.join(tmp_dir, "bad.csv")
    _write(p, HEADER + "0,C1,4,M,1,M1,1,es_food,notanumber,0\n1,C2,4,M,1,M1,1,es_food,2.0,0\n")
    df = files.read_transactions_csv(spark, p, corrupt_col="_corrupt").cache()
    assert df.filter(F.col("_corrupt").isNotNull()).count() == 1
    df2 = files.read_transactions_csv(spark, p, mode="DROPMALFORMED")
    assert len(df2.collect()) == 1  # count() alone skips parsing (column pruning)


def test_role_files_last_match_wins_and_missing_is_error(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "landing")
    _write(os.path.join(folder, "a_transactions.csv"), HEADER)
    _write(os.path.join(folder, "b_Transactions.csv"), HEADER + "0,C1,4,M,1,M1,1,x,1.0,0\n")
    _write(os.path.join(folder, "CustomerImportance.csv"),
           "Source,Target,Weight,typeTrans,fraud\nC1,M1,2.5,x,0\n")
    assert files.pick_role_file(spark, folder, "transactions.csv").endswith("b_Transactions.csv")
    tx, imp = files.load_landing_folder(spark, folder)
    assert tx.count() == 1 and imp.first().Weight == 2.5
    with pytest.raises(FileNotFoundError):
        files.pick_role_file(spark, folder, "nothing.csv")


def test_importance_validation_and_fallback(spark):
    good = spark.createDataFrame([("C1", "M1", 1.0, "t", 0, "extra")],
                                 "Source string, Target string, Weight double, typeTrans string, "
                                 "fraud int, note string")
    assert dimension.validated_importance(good) is good
    bad = spark.createDataFrame([("C1", 1.0)], "Source string, Weight double")
    fb = dimension.importance_frame(spark, [("C9", "M9", 4.55, "t", 0)])
    assert dimension.validated_importance(bad, fb) is fb
    with pytest.raises(ValueError):
        dimension.validated_importance(bad)
    seeded = dimension.seed_if_empty(spark.createDataFrame([], schemas.IMPORTANCE), fb)
    assert seeded.count() == 1 and not dimension.is_empty(seeded)


def test_quality_split(spark):
    df = spark.createDataFrame([(0, "c", "m", 1.0), (1, None, "m", 2.0), (2, "c", "m", -1.0),
                                (2, "c", "m", -1.0)], "step int, customer string, merchant string, amount double")
    valid, rejected = split_valid(df)
    assert valid.count() == 1
    assert rows(rejected, "reject_reason") == [("missing_customer",), ("negative_amount",),
                                               ("negative_amount",)]
    r = quality_report(df, ["step", "customer", "merchant", "amount"]).first()
    assert (r.total_rows, r.valid_rows, r.rejected_rows, r.duplicate_keys) == (4, 1, 3, 1)


def test_tables_create_append_replace(spark, tmp_dir):
    names = tables.create_tables(spark, database="ll_test")
    assert "ll_test.pattern_detections" in names
    det = spark.createDataFrame([("t", "t", "PatId1", "UPGRADE", "c", "m")], schemas.DETECTIONS)
    assert tables.append_if_exists(det, "ll_test.pattern_detections")
    assert spark.table("ll_test.pattern_detections").count() == 1
    assert not tables.append_if_exists(det, "ll_test.absent_table")
    with pytest.raises(ValueError):
        tables.append_if_exists(det.drop("merchant"), "ll_test.pattern_detections")
    tables.replace_table(det, "ll_test.detections_copy")
    tables.replace_table(det.union(det), "ll_test.detections_copy")
    assert spark.table("ll_test.detections_copy").count() == 2
    assert tables.column_listing(det)[0] == ("YStartTime", "string", True)


def test_detection_batches_of_fifty(spark, tmp_dir):
    data = [("t", "t", "PatId1", "UPGRADE", f"c{i:03d}", f"m{i % 3}") for i in range(120)]
    det = spark.createDataFrame(data, schemas.DETECTIONS)
    sizes = rows(detection_batches(det, 50).groupBy("batch_id").count(), "batch_id", "count")
    assert sizes == [(0, 50), (1, 50), (2, 20)]
    out = os.path.join(tmp_dir, "det")
    write_detection_batches(det, out, 50)
    names = sorted(__import__("glob").glob(os.path.join(out, "*.csv")))
    assert [sum(1 for _ in open(n)) - 1 for n in names] == [50, 50, 20]
    first = spark.read.option("header", "true").csv(names[0])
    assert rows(first, "merchant", "customer") == sorted(
        (m, c) for *_, c, m in data)[:50]
    out2 = os.path.join(tmp_dir, "det2")
    write_detection_batches(det.repartition(1), out2, 50, exact=False)
    per_file = [sum(1 for _ in open(f)) - 1 for f in
                __import__("glob").glob(os.path.join(out2, "*.csv"))]
    assert sorted(per_file) == [20, 50, 50]


def test_raw_layout_partitioned_by_date_prunes(spark, tmp_dir):
    from ledgerlift.sinks.writers import write_partitioned_parquet
    from ledgerlift.sources import tpch
    from tests.conftest import SF_SMALL
    out = os.path.join(tmp_dir, "raw")
    tx = tpch.transactions(spark, SF_SMALL).select("customer", "merchant", "amount", "order_date")
    write_partitioned_parquet(tx, out, "order_date")
    back = spark.read.parquet(out)
    assert back.count() == tx.count()
    one_day = back.filter("year = 1995 AND month = 3 AND day = 1")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan
    assert one_day.count() == tx.filter("to_date(order_date) = DATE'1995-03-01'").count()


def test_jdbc_options_need_complete_partitioning():
    from ledgerlift.sources.jdbc import jdbc_read_options
    opts = jdbc_read_options("jdbc:postgresql://db/x", "customer_importance", {"user": "u"},
                             partition_column="id", lower_bound=0, upper_bound=100,
                             num_partitions=4)
    assert opts["numPartitions"] == "4" and opts["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_read_options("jdbc:x", "t", partition_column="id")


def test_detection_files_with_quotes_and_day_first_times(spark, tmp_dir):
    p = os.path.join(tmp_dir, "det.csv")
    _write(p, "YStartTime,detectionTime,patternId,ActionType,customer,merchant\n"
              "09-08-2025 00:54,09-08-2025 00:54,PatId1,UPGRADE,'C17','M15'\n"
              "2025-08-09 00:54:10,2025-08-09 00:54:10,PatId1,UPGRADE,C18,M15\n")
    df = files.read_detections_csv(spark, p)
    got = rows(df, "customer", "merchant", "detected_at")
    import datetime as dt
    assert got == [("C17", "M15", dt.datetime(2025, 8, 9, 0, 54)),
                   ("C18", "M15", dt.datetime(2025, 8, 9, 0, 54, 10))]


def test_importance_chain(spark, tmp_dir):
    from ledgerlift.sources.dimension import importance_chain, importance_frame, seed_if_empty
    full = importance_frame(spark, [("C1", "M1", 2.0, "es_food", 0)])
    seed = importance_frame(spark, [("C2", "M1", 3.0, "es_food", 0)])
    assert rows(seed_if_empty(full, seed)) == rows(full)          # only an empty table is seeded
    assert rows(seed_if_empty(full.limit(0), seed)) == rows(seed)
    assert rows(importance_chain(spark, lambda s: full, seed, seed)) == rows(full)
    assert rows(importance_chain(spark, lambda s: full.limit(0), seed)) == rows(seed)
    assert rows(importance_chain(spark, lambda s: full.drop("Weight"), fallback=seed)) == rows(seed)
    assert rows(importance_chain(spark, lambda s: None, fallback=seed)) == rows(seed)
    path = os.path.join(tmp_dir, "imp.csv")
    with open(path, "w") as f:  # an extra column, another order
        f.write("note,Weight,Source,Target,typeTrans,fraud\nx,1.5,C9,M9,es_home,1\n")
    assert rows(files.read_importance_csv(spark, path)) == [("C9", "M9", 1.5, "es_home", 1)]

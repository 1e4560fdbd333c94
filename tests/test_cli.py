"""The application commands end to end on CSV files derived from the test tables."""

import glob
import os
import shutil

from pyspark.sql import functions as F

from ledgerlift import cli, schemas
from ledgerlift.plans import upgrade
from ledgerlift.sources import files, tpch
from ledgerlift.streaming.files import read_outputs
from tests.conftest import SF_SMALL, rows


def _landing_source(spark, folder):
    tx = tpch.as_transaction_records(tpch.transactions(spark, SF_SMALL))
    tx.coalesce(1).write.option("header", "true").csv(os.path.join(folder, "tx"))
    imp = tpch.customer_importance(spark, SF_SMALL).withColumn(
        "Source", F.col("Source").cast("string"))
    imp.coalesce(1).write.option("header", "true").csv(os.path.join(folder, "imp"))
    src = os.path.join(folder, "source")
    os.makedirs(src)
    shutil.copy(glob.glob(os.path.join(folder, "tx", "*.csv"))[0],
              os.path.join(src, "transactions.csv"))
    shutil.copy(glob.glob(os.path.join(folder, "imp", "*.csv"))[0],
              os.path.join(src, "CustomerImportance.csv"))
    return src, tx


def test_ingest_stream_and_detect(spark, tmp_dir):
    src, tx = _landing_source(spark, tmp_dir)
    landing = os.path.join(tmp_dir, "landing")
    cli.main(["ingest", "--source", src, "--landing", landing, "--chunk-size", "1500"], spark)
    chunks = sorted(glob.glob(os.path.join(landing, "*.csv")))
    assert len(chunks) == 4
    assert sum(len(files.read_transactions_csv(spark, c).collect()) for c in chunks) == 6000

    imp_path = os.path.join(src, "CustomerImportance.csv")
    out, log = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "log")
    cli.main(["stream", "--landing", landing, "--importance", imp_path, "--out", out,
              "--log", log, "--threshold", "140", "--files-per-batch", "2", "--once",
              "--checkpoint", os.path.join(tmp_dir, "ckpt")], spark)
    streamed = read_outputs(spark, out)
    assert read_outputs(spark, log).count() == 4

    det_out = os.path.join(tmp_dir, "det")
    cli.main(["detect", "--transactions", landing, "--importance", imp_path, "--out", det_out,
              "--threshold", "140", "--per-file"], spark)
    batch = spark.read.schema(schemas.DETECTIONS).option("header", "true").csv(det_out)
    assert rows(batch, "customer", "merchant") == rows(streamed, "customer", "merchant")

    # whole-input detection equals the library call on the same rows
    whole_out = os.path.join(tmp_dir, "whole")
    cli.main(["detect", "--transactions", landing, "--importance", imp_path, "--out", whole_out,
              "--threshold", "550"], spark)
    whole = spark.read.schema(schemas.DETECTIONS).option("header", "true").csv(whole_out)
    expect = upgrade.detect_upgrades(files.read_transactions_csv(spark, landing),
                                     files.read_importance_csv(spark, imp_path), 550,
                                     detected_at="t")
    assert rows(whole, "customer", "merchant") == rows(expect, "customer", "merchant")

import glob
import os

import pandas as pd


from ledgerlift import schemas
from ledgerlift.operators.chunking import assign_chunks, chunk_progress, with_row_position
from ledgerlift.sinks.writers import write_chunked_csv
from ledgerlift.sources.files import read_transactions_csv
from ledgerlift.sources import tpch
from tests.conftest import SF_SMALL, rows


def test_three_rows_size_two(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "step int, customer string")
    ch = assign_chunks(df, ["step"], 2)
    assert rows(ch, "step", "chunk_id") == [(0, 0), (1, 0), (2, 1)]
    prog = chunk_progress(ch, 2).orderBy("chunk_number").collect()
    assert [(r.chunk_number, r.total_chunks, r.start, r.end, r.size, r.progress_pct)
            for r in prog] == [(1, 2, 0, 2, 2, 66.7), (2, 2, 2, 3, 1, 100.0)]


def test_positions_equal_sorted_order(spark):
    tx = tpch.transactions(spark, SF_SMALL).select(*tpch.ROW_KEY)
    got = with_row_position(tx, tpch.ROW_KEY, "pos", num_partitions=7).toPandas()
    expect = got.drop(columns=["pos"]).sort_values(tpch.ROW_KEY).reset_index(drop=True)
    ordered = got.sort_values("pos").reset_index(drop=True)
    assert list(ordered["pos"]) == list(range(len(got)))
    assert ordered.drop(columns=["pos"]).equals(expect)


def test_chunk_files_round_trip(spark, tmp_dir):
    extra = [c for c in tpch.ROW_KEY if c not in ("merchant", "amount")]
    tx = tpch.as_transaction_records(tpch.transactions(spark, SF_SMALL), keep=extra)
    cols = schemas.TRANSACTIONS.fieldNames()

    flat = os.path.join(tmp_dir, "flat")
    write_chunked_csv(tx, flat, tpch.ROW_KEY, 1500, keep_cols=cols)
    names = sorted(glob.glob(os.path.join(flat, "*.csv")))
    assert len(names) == 4
    ordered = tx.orderBy(*tpch.ROW_KEY).select(*cols).toPandas()
    got = pd.concat([read_transactions_csv(spark, n).toPandas() for n in names],
                    ignore_index=True)
    assert [len(read_transactions_csv(spark, n).collect()) for n in names] == [1500] * 4
    assert got.astype(str).equals(ordered.astype(str))  # files in name order = chunk order

    parted = os.path.join(tmp_dir, "parted")
    write_chunked_csv(tx, parted, tpch.ROW_KEY, 1500, keep_cols=cols, layout="partitioned")
    dirs = sorted(glob.glob(os.path.join(parted, "chunk_id=*")))
    assert len(dirs) == 4
    for d in dirs:
        assert len(glob.glob(os.path.join(d, "*.csv"))) == 1
    back = read_transactions_csv(spark, parted)
    sizes = rows(back.groupBy("chunk_id").count(), "chunk_id", "count")
    assert sizes == [(0, 1500), (1, 1500), (2, 1500), (3, 1500)]

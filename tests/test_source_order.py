"""Positions and chunk files in source order: several files, many splits, no global sort."""

import glob
import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlift import schemas
from ledgerlift.operators.source_order import assign_source_chunks, with_source_position, write_source_chunks
from ledgerlift.sources.files import read_transactions_csv
from tests.conftest import SF_SMALL

HEADER = ",".join(schemas.TRANSACTIONS.fieldNames())
SPLITS = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1000"}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SPLITS}
    for k, v in SPLITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _csv(folder, sizes, seed=1):
    """Unsorted transaction files; the age column numbers the lines of all files."""
    rng = random.Random(seed)
    lines = []
    for k, size in enumerate(sizes):
        own = [f"{rng.randrange(180)},C{rng.randrange(50)},{len(lines) + i},M,28007,M{rng.randrange(9)},28007,"
               f"{'x' * rng.randrange(40)},{rng.random():.2f},0" for i in range(size)]
        lines += own
        with open(os.path.join(folder, f"part{k:02d}_transactions.csv"), "w") as f:
            f.write("\n".join([HEADER, *own]) + "\n" * (k % 2))
    return lines


def test_unsorted_csv_comes_back_in_line_order(spark, tmp_dir, small_splits):
    sizes = [3000, 0, 1, 2500, 7]
    _csv(tmp_dir, sizes)
    df = read_transactions_csv(spark, tmp_dir)
    out = with_source_position(df, "pos", line_col="line", file_col="file")
    assert df.rdd.getNumPartitions() > 8
    got = out.select(F.col("age").cast("long").alias("n"), "pos", "line", "file").collect()
    assert sorted(r.pos for r in got) == list(range(sum(sizes))) and all(r.n == r.pos for r in got)
    for k, size in enumerate(sizes):
        own = [r for r in got if f"part{k:02d}_" in r.file]
        assert sorted(r.line for r in own) == list(range(size))
        assert all(r.n == sum(sizes[:k]) + r.line for r in own)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan
    assert "Exchange rangepartitioning" not in plan and "Sort" not in plan


@pytest.mark.parametrize("sizes,chunk", [([3000, 0, 2500, 7], 100), ([40, 30, 25], 1000), ([1000], 1000), ([60] * 20, 25)])
def test_chunk_files_hold_consecutive_lines(spark, tmp_dir, small_splits, sizes, chunk):
    source, out = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "out")
    os.makedirs(source)
    _csv(source, sizes)
    write_source_chunks(read_transactions_csv(spark, source), out, chunk)
    seen = []
    for path in glob.glob(os.path.join(out, "*.csv")):
        with open(path) as f:
            lines = f.read().splitlines()
        ages = [int(x.split(",")[2]) for x in lines[1:]]
        if not ages:  # an empty task of the union may leave a header
            continue
        assert lines[0] == HEADER and ages == list(range(ages[0], ages[0] + len(ages))) and ages[0] % chunk == 0
        assert len(ages) == min(chunk, sum(sizes) - ages[0])
        seen += ages
    assert sorted(seen) == list(range(sum(sizes)))


def test_parquet_positions_equal_file_row_number(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rows")
    spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x")).repartition(3).write \
        .option("parquet.block.size", 4096).parquet(path)
    got = assign_source_chunks(spark.read.parquet(path), 700, row_index=True)
    sql = (f"select x, sum(1) over (order by filename, file_row_number) - 1 as row_pos "
           f"from read_parquet('{path}/*.parquet', filename=true, file_row_number=true)")
    want = sorted((x, int(p), int(p) // 700) for x, p in duckdb.sql(sql).fetchall())
    assert sorted((r.x, r.row_pos, r.chunk_id) for r in got.collect()) == want


def test_parquet_chunk_files(spark, tmp_dir):
    out = os.path.join(tmp_dir, "out")
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    write_source_chunks(df.select("l_orderkey", "_metadata").drop("_metadata"), out, 1000, row_index=True)
    sizes = sorted(sum(1 for _ in open(f)) - 1 for f in glob.glob(os.path.join(out, "*.csv")))
    n = df.count()
    assert [s for s in sizes if s] == sorted([1000] * (n // 1000) + ([n % 1000] if n % 1000 else []))


def test_changed_splits_are_an_error(spark, tmp_dir, small_splits):
    _csv(tmp_dir, [3000])
    df = read_transactions_csv(spark, tmp_dir)
    out = with_source_position(df)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "33333")
    with pytest.raises(Exception, match="splits of the source have changed"):
        out.collect()


def test_nothing_to_number(spark, tmp_dir):
    _csv(tmp_dir, [0, 0])
    df = read_transactions_csv(spark, tmp_dir)
    assert with_source_position(df).count() == 0
    with pytest.raises(ValueError):
        assign_source_chunks(df, 0)

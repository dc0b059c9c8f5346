"""Clustered layout, point-to-cell join with a hot cell, incremental views, streaming quarantine and block terrain."""

import glob
import math
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from alpina.operators.point_grid import cut_cells, points_in_cells
from alpina.operators.quality import QuarantineError
from alpina.operators.terrain_blocks import BLOCK, cut_blocks, halos, terrain_cells_from_blocks
from alpina.operators.terrain_tiles import terrain_cells_from_tiles
from alpina.session import delete_path, local_path
from alpina.sinks import views
from alpina.sinks.clustered import along_curve, clustering_columns, in_box, insert_clustered, recluster, write_clustered
from alpina.sinks.keyed import KeyedTable
from alpina.sinks.tables import create_typed_table
from alpina.sinks.views import AggregateView
from alpina.streaming.bronze import bronze_stream
from alpina.streaming.quarantine import DONE, read_side, run_quarantined, store_batch

TILE = "tile_id string, e_min double, n_max double, z array<array<double>>"


# ------------------------------------------------------------------ clustered layout
def scattered(spark, n):
    return spark.range(n).select("id", (F.xxhash64("id", F.lit(1)) % 100000).cast("double").alias("east"),
                                 (F.xxhash64("id", F.lit(2)) % 100000).alias("north"))


def overlapping(path, box):
    """(row groups whose statistics meet the box, all row groups)."""
    hit = total = 0
    for f in glob.glob(f"{local_path(path)}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            total += 1
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in box}
            hit += all(s.min <= high and s.max >= low for s, (low, high) in ((stats[c], box[c]) for c in box))
    return hit, total


def scanned_rows(df):
    """Rows that the scan of an executed frame gave to the plan."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_box_reads_a_small_share_of_the_row_groups(spark, scratch):
    df, box = scattered(spark, 40000), {"east": (-5000.0, 5000.0), "north": (20000, 30000)}
    p, plain = scratch("curve"), scratch("plain")
    write_clustered(df, p, ["east", "north"], rows_per_file=250)
    df.repartition(64).write.parquet(plain)
    hit, total = overlapping(p, box)
    assert total > 60 and hit <= total * 0.1
    assert overlapping(plain, box)[0] == 64
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned_rows(in_box(spark.read.parquet(p), box)) <= 0.1 * 40000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = sorted(r["id"] for r in in_box(df, box).collect())
    assert want and sorted(r["id"] for r in in_box(spark.read.parquet(p), box).collect()) == want
    # a second delivery is laid out for itself; one rewrite merges both
    write_clustered(df.withColumn("id", F.col("id") + 40000), p, ["east", "north"], rows_per_file=250)
    assert recluster(spark, p, ["east", "north"], rows_per_file=500) == 80000
    hit, total = overlapping(p, box)
    assert total > 60 and hit <= total * 0.1


def test_rows_without_a_place_are_kept_and_one_place_is_split(spark, scratch):
    rows = [(1, None, 1.0), (2, math.nan, 2.0), (3, math.inf, 3.0), (4, 5.0, None), (5, 5.0, 5.0), (6, -1e308, 1e308), (7, 1e308, -1e308)]
    df = spark.createDataFrame(rows, "id long, _place double, n double")
    got = along_curve(df, ["_place", "n"], rows_per_file=2)
    assert got.columns == ["id", "_place", "n"] and sorted(r["id"] for r in got.collect()) == [1, 2, 3, 4, 5, 6, 7]
    hot = spark.range(8000).select("id", F.lit(1.0).alias("e"), F.lit(2.0).alias("n"))
    sizes = [r["count"] for r in along_curve(hot, ["e", "n"], rows_per_file=1000).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 and max(sizes) < 2500
    empty = scratch("empty")
    write_clustered(df.limit(0), empty, ["n"])
    assert spark.read.schema(df.schema).parquet(empty).count() == 0
    with pytest.raises(TypeError):
        along_curve(spark.createDataFrame([("a",)], "s string"), ["s"])


def test_insert_follows_the_tables_own_clustering(spark, scratch):
    loc = scratch("typed")
    name = "clustered_" + loc.rsplit("-", 1)[-1]
    create_typed_table(spark, name, [("id", "BIGINT", None), ("day", "DATE", None), ("north", "INT", None)], cluster_by=["day", "north"], location=loc)
    assert clustering_columns(spark, name) == ["day", "north"]
    df = spark.range(3000).select((F.col("id") % 77).cast("string").alias("north"), F.expr("date_add(date'2024-01-01', CAST(id % 91 AS INT))").alias("day"), "id")
    insert_clustered(df, name, rows_per_file=200)
    assert spark.table(name).agg(F.sum("id"), F.max("north")).first() == (3000 * 2999 // 2, 76)
    assert len(glob.glob(f"{local_path(loc)}/*.parquet")) > 10
    spark.sql(f"DROP TABLE {name}")


# ------------------------------------------------------------------ points and cells
def test_a_cell_with_most_points_is_dealt_to_many_tasks(spark):
    pts = spark.range(20000).select("id", F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id") * 1.0).alias("e"), F.lit(7.0).alias("n"))
    cells = spark.createDataFrame([(0, 0, 2020), (0, 0, 2021), (100, 0, 2020), (999900, 0, 2020)], "cell_e long, cell_n long, year int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = points_in_cells(pts, cells, "e", "n", 100, split_rows=500)
        assert sorted(got.columns) == sorted(["id", "e", "n", "cell_e", "cell_n", "year"])
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == got.count() and max(sizes) < sum(sizes) * 0.4
        keyed = pts.select(F.lit(0).alias("cell_e"), F.when(F.col("id") > 50, F.lit(0)).alias("cell_n"))
        assert cut_cells(keyed, 500).collect() == [(0, 0, 40)]  # 19,949 points in parts of 500
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    plain = sorted((r["id"], c) for r in pts.collect() for e, c in ((0, 2020), (0, 2021), (100, 2020)) if e <= r["e"] < e + 100)
    assert sorted((r["id"], r["year"]) for r in got.collect()) == plain


def test_points_without_a_cell(spark):
    pts = spark.createDataFrame([(1, 5.0, 5.0), (1, 5.0, 5.0), (2, None, 5.0), (3, 500.0, 5.0)], "id int, e double, n double")
    cells = spark.createDataFrame([(0, 0, "a")], "cell_e long, cell_n long, label string")
    got = sorted(((r["id"], r["label"] or "") for r in points_in_cells(pts, cells, "e", "n", 100, how="left", split_rows=1).collect()))
    assert got == [(1, "a"), (1, "a"), (2, ""), (3, "")]
    assert points_in_cells(pts, cells, "e", "n", 100).count() == 2
    assert points_in_cells(pts.limit(0), cells, "e", "n", 100).count() == 0
    with pytest.raises(ValueError):
        points_in_cells(pts.withColumn("label", F.lit(1)), cells, "e", "n", 100)


# ------------------------------------------------------------------ incremental views
class Source:
    """Files as rows in memory; remembers which ones a refresh read."""

    def __init__(self, spark):
        self.spark, self.files, self.seen = spark, {}, []

    def listing(self):
        return self.spark.createDataFrame([(f, m) for f, (m, _) in self.files.items()], "file_id string, modified long")

    def read(self, wanted):
        self.seen = sorted(r["file_id"] for r in wanted.collect())
        rows = [(f, *r) for f in self.seen for r in self.files[f][1]]
        return self.spark.createDataFrame(rows, "_file string, g string, x double")


def test_view_equals_a_recompute_and_reads_changed_files_only(spark, scratch):
    rng, s = random.Random(3), Source(spark)
    v = AggregateView(scratch("view"), ("g",), {"n": ("count", None), "known": ("count", "x"), "total": ("sum", "x"), "least": ("min", "x"),
                                                 "most": ("max", "x"), "mean": ("avg", "x"), "kinds": ("approx_distinct", "x")})

    def rows(n):
        return [(rng.choice(["a", "b", None]), rng.choice([None, float(rng.randrange(50))])) for _ in range(n)]

    def check():
        want = spark.createDataFrame([r for _, rs in s.files.values() for r in rs], "g string, x double").groupBy("g").agg(
            F.count(F.lit(1)), F.count("x"), F.sum("x"), F.min("x"), F.max("x"), F.avg("x"), F.countDistinct("x"))
        order = lambda d: sorted(map(tuple, d.collect()), key=str)
        assert order(v.read(spark)) == order(want)

    s.files = {"f1": (1, rows(20)), "f2": (1, rows(20)), "none": (1, [])}
    assert v.refresh(s.listing(), s.read) == 3
    check()
    s.files["f3"] = (2, [*rows(10), ("a", 1000.0)])
    assert v.refresh(s.listing(), s.read) == 1 and s.seen == ["f3"]
    check()
    s.files["f3"] = (3, rows(5))  # rewritten: its largest value goes
    del s.files["f1"]             # removed
    assert v.refresh(s.listing(), s.read) == 2 and s.seen == ["f3"]
    check()
    s.seen = []
    assert v.refresh(s.listing(), s.read) == 0 and s.seen == []


def test_view_is_whole_after_a_refresh_that_died(spark, scratch, monkeypatch):
    s = Source(spark)
    v = AggregateView(scratch("viewdie"), ("g",), {"n": ("count", None)})
    s.files = {"f1": (1, [("a", 1.0)])}

    def dies(*a, **k):
        raise IOError("lost")

    from alpina.sinks import tables
    for step in range(2):  # the first refresh of all, and one over an existing view
        with monkeypatch.context() as m:
            m.setattr(tables, "write_text_file", dies)
            with pytest.raises(IOError):
                v.refresh(s.listing(), s.read)
        if step:
            assert v.read(spark).collect() == [("a", 1)]
        assert v.refresh(s.listing(), s.read) == 1
        s.files["f2"] = (2, [("a", 1.0), ("b", 1.0)])
    assert sorted(map(tuple, v.read(spark).collect())) == [("a", 2), ("b", 1)]
    with pytest.raises(ValueError):
        views.AggregateView("p", ("_g",), {})
    with pytest.raises(ValueError):
        views.AggregateView("p", ("g",), {"m": ("median", "x")})


# ------------------------------------------------------------------ streaming quarantine
def test_a_corrupt_file_is_rejected_and_the_stream_goes_on(spark, scratch):
    land, store, ck = scratch("q_land"), scratch("q_store"), scratch("q_ck")
    schema = StructType([StructField(c, StringType()) for c in ("a", "_corrupt_record")])

    def put(name, lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{land}/{name}")

    def run():
        s = bronze_stream(spark, f"{land}/*/*.txt", schema, "json", {"columnNameOfCorruptRecord": "_corrupt_record", "maxFilesPerTrigger": "1"})
        return run_quarantined(s, store, ck, "source_file")

    def good():
        return sorted(r["a"] for r in read_side(spark, store, "good").collect())

    put("d1", ['{"a": "1"}', '{"a": "2"}'])
    put("d2", ['{"a": "3"}', '{"a": broken'])
    put("d3", ['{"a": "4"}'])
    with pytest.raises(QuarantineError):
        run()
    assert good() == ["1", "2", "4"]
    errors = read_side(spark, store, "errors").collect()
    assert len(errors) == 1 and "/d2/" in errors[0]["file"] and errors[0]["n_corrupt"] == 1
    # a later run without bad files ends well, and reads nothing again
    put("d4", ['{"a": "5"}'])
    assert run() == 1 and good() == ["1", "2", "4", "5"]
    assert run() == 0
    # a replayed batch replaces itself; one that died half-way is in neither table
    batch = spark.createDataFrame([("9", None, "x"), ("8", "bad", "y")], "a string, _corrupt_record string, _source_file string")
    for _ in range(2):
        store_batch(batch, 77, store)
    assert good() == ["1", "2", "4", "5", "9"] and read_side(spark, store, "errors").count() == 2
    delete_path(spark, f"{store}/batch=77/{DONE}")
    assert good() == ["1", "2", "4", "5"]


# ------------------------------------------------------------------ terrain in blocks
def raster(n, m, seed):
    rng = random.Random(seed)
    return [[math.nan if rng.random() < 0.04 else None if rng.random() < 0.02 else rng.uniform(0, 60) for _ in range(m)] for _ in range(n)]


@pytest.mark.parametrize("block_px", [5, 10, 40])
def test_blocks_give_the_cells_of_the_whole_raster(spark, block_px):
    tiles = spark.createDataFrame([("t1", 1000.0, 2000.0, raster(40, 40, 1)), ("t2", 1080.0, 2000.0, raster(20, 35, 2)), ("t3", 0.0, 0.0, [])], TILE)
    want = {r["cell_id"]: r.asDict() for r in terrain_cells_from_tiles(tiles, 2.0, 10).collect()}
    got = {r["cell_id"]: r.asDict() for r in terrain_cells_from_blocks(cut_blocks(tiles, block_px, 2.0), 2.0, 10).collect()}
    assert set(got) == set(want) and len(got) > 80
    for c, row in want.items():
        for k, x in row.items():
            assert got[c][k] == (pytest.approx(x, abs=1e-9) if isinstance(x, float) else x), (c, k)


def test_stored_blocks_move_halo_lines_only(spark, scratch):
    tiles = spark.createDataFrame([(f"t{i}", 100.0 * i, 0.0, raster(20, 20, i)) for i in range(6)], TILE)
    t = KeyedTable(spark, scratch("blocks"), ["tile_id", *BLOCK], ["version"], buckets=4)
    t.write(cut_blocks(tiles, 5, 2.0).withColumn("version", F.lit(1)))
    blocks = t.read()
    cells = terrain_cells_from_blocks(blocks, 2.0, 10)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    moved = [x for x in plan.splitlines() if "Exchange" in x and "Broadcast" not in x]
    assert len(moved) <= 1 and all("hashpartitioning" in x for x in moved)
    assert cells.count() == terrain_cells_from_tiles(tiles, 2.0, 10).count()
    lines = halos(blocks).where("tile_id = 't0' AND block_row = 0 AND block_col = 0").first()
    assert lines["halo_n"] is None and lines["halo_w"] is None and len(lines["halo_s"]) == 5 and len(lines["halo_e"]) == 5


def test_uneven_blocks_fail(spark):
    tiles = spark.createDataFrame([("t", 0.0, 0.0, raster(10, 10, 1))], TILE)
    with pytest.raises(Exception, match="does not divide"):
        terrain_cells_from_blocks(cut_blocks(tiles, 4, 2.0), 2.0, 10).collect()

"""Queries of rasters and geometries, over arrays and values of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow import functions as X
from envflow.operators import geo
from envflow.operators import raster as R
from envflow.registry import query, table
from envflow.shared import work_dir, written
from envflow.sources import netcdf

#: Embeddings stand for rasters of 8 columns: cell (at // 8, at % 8).
COLUMNS = 8


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cells_of(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", COLUMNS)


_CELLS_SQL = "c AS (SELECT vec_id, CAST((i - 1) // 8 AS INTEGER) AS row, CAST((i - 1) % 8 AS INTEGER) AS col, CAST(embedding[i] AS DOUBLE) AS value FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings))"


@query(f"WITH {_CELLS_SQL} SELECT vec_id, row, col, value FROM c")
def explode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested arrays as rows: an array of rows, each an array of cells; empty ones give none."""
    at = F.sequence(F.lit(0), F.floor(F.size("embedding") / COLUMNS).cast("int") - 1)
    rows = F.transform(at, lambda r: F.struct(r.alias("row"), F.slice("embedding", r * COLUMNS + 1, F.lit(COLUMNS)).alias("cells")))
    nested = table(spark, sf_dir, "embeddings").select("vec_id", rows.alias("lines"))
    lines = nested.select("vec_id", F.explode("lines").alias("line")).select("vec_id", "line.row", F.posexplode("line.cells").alias("col", "value"))
    return lines.select("vec_id", "row", "col", F.col("value").cast("double").alias("value"))


@query("""WITH v AS (SELECT event_type AS product, CASE WHEN value = 10.0 OR event_id % 10 < 5 THEN NULL ELSE value END AS v FROM events)
SELECT product, min(v) AS min, max(v) AS max, round(CAST(sum(CAST(v AS DECIMAL(28,6))) AS DOUBLE) / count(v), 6) AS mean, round(coalesce(count(v) / count(*) * 100, 0.0), 6) AS valid_pct FROM v GROUP BY 1""")
def raster_masked_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of cells that are neither fill nor of low quality."""
    cells = table(spark, sf_dir, "events").select(F.col("event_type").alias("product"), "value", (F.col("event_id") % 10 / 10).alias("qa"))
    return R.masked_stats(cells, ["product"], X.masked(F.col("value"), 10.0, F.col("qa")))


@query("""WITH v AS (SELECT event_id, CASE WHEN value * 100 * 0.001 BETWEEN 0 AND 5 THEN value * 100 * 0.001 END AS aod, event_id % 16 AS qa FROM events),
n AS (SELECT count(*) FILTER (aod IS NOT NULL AND (qa & 3) = 0) AS n_strict, count(*) AS n FROM v)
SELECT event_id, round(aod, 6) AS aod, n_strict, round(CASE WHEN NOT (n_strict > greatest(1000, CAST(floor(n * 0.005) AS BIGINT))) OR (qa & 3) = 0 THEN aod END, 6) AS kept FROM v, n""")
def raster_aod_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled depths, masked by quality bits if enough cells pass, in one plan."""
    cells = table(spark, sf_dir, "events").select("event_id", R.aerosol(F.col("value") * 100).alias("aod"), (F.col("event_id") % 16).alias("qa"))
    out = R.strict_or_relaxed(cells, "aod", F.col("qa").bitwiseAND(3) == 0)
    return out.select("event_id", F.round("aod", 6).alias("aod"), "n_strict", F.round("kept", 6).alias("kept"))


@query("""SELECT event_type, round(greatest(0.3, least(coalesce(quantile_cont(value / 40, 0.98), 1.5), 2.5)), 6) AS upper_limit FROM events GROUP BY 1""")
def percentile_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = table(spark, sf_dir, "events").select("event_type", (F.col("value") / 40).alias("v"))
    return R.display_limits(cells, ["event_type"], "v").withColumn("upper_limit", F.round("upper_limit", 6))


@query("""SELECT CAST(user_id // 12 AS INTEGER) AS row, CAST(user_id % 12 AS INTEGER) AS col, arg_min(value, (event_id % 3) * 1000000000 + event_id) AS value FROM events WHERE value <> 10.0 GROUP BY ALL""")
def mosaic_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles in order; the first valid value of each cell."""
    id_, user = F.col("event_id"), F.col("user_id")
    cells = table(spark, sf_dir, "events").select(F.floor(user / 12).cast("int").alias("row"), (user % 12).cast("int").alias("col"), ((id_ % 3) * 1000000000 + id_).alias("place"), X.masked(F.col("value"), 10.0).alias("value"))
    return R.mosaic(cells, "place")


@query(f"WITH {_CELLS_SQL} SELECT vec_id // 50 AS file, vec_id % 50 AS layer, CAST(row AS BIGINT) AS row, CAST(col AS BIGINT) AS col, round(floor(value / 0.001::DOUBLE + 0.5) * 0.001::DOUBLE, 6) AS value FROM c")
def netcdf_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rasters in NetCDF files of fifty records, as scaled short integers, read by ranges of bytes."""
    folder = work_dir(spark, "netcdf")
    rasters = table(spark, sf_dir, "embeddings").select(F.floor(F.col("vec_id") / 50).alias("file"), (F.col("vec_id") % 50).alias("layer"), "embedding")
    written(netcdf.write_netcdf(rasters, folder, "file", "layer", "embedding", 8, COLUMNS, "PRODUCT/value", -32768, 0.001), "files")
    cells = netcdf.read_netcdf(spark, folder, "value", "PRODUCT")
    return cells.select(F.regexp_extract("path", "([0-9]+)[.]nc$", 1).cast("bigint").alias("file"), "layer", "row", "col", F.round("value", 6).alias("value"))


@query(f"WITH {_CELLS_SQL} SELECT vec_id, min(row) AS row0, max(row) AS row1, min(col) AS col0, max(col) AS col1 FROM c WHERE value > 0.2 GROUP BY 1")
def valid_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir).withColumn("value", F.when(F.col("value") > 0.2, F.col("value")))
    return R.valid_extent(cells, ["vec_id"])


@query(f"""WITH {_CELLS_SQL}, t AS (SELECT vec_id, CAST(x AS INTEGER) AS x, CAST(y AS INTEGER) AS y FROM embeddings, range(13) a(x), range(13) b(y))
SELECT t.vec_id, x, y, value FROM t LEFT JOIN c ON c.vec_id = t.vec_id AND row = CAST(floor((y + 0.5) * 0.7) AS INTEGER) AND col = CAST(floor((x + 0.5) * 0.7) AS INTEGER)""")
def grid_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest source cell of each target cell of every raster, looked up in the raster's own array: no shuffle."""
    n = F.sequence(F.lit(0), F.lit(12))
    targets = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.explode(n).alias("x")).select("vec_id", "embedding", "x", F.explode(n).alias("y"))
    at = lambda c: F.floor((F.col(c) + 0.5) * 0.7)
    return targets.select("vec_id", "x", "y", R.lookup(F.col("embedding"), at("y"), at("x"), 8, COLUMNS).alias("value"))


@query("""SELECT c_custkey FROM customer WHERE c_custkey % 100 + 0.5 BETWEEN 10 AND 40 AND c_custkey % 70 + 0.5 BETWEEN 5 AND 30""")
def point_in_bbox_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells whose centres lie in a polygon, by the even-odd rule."""
    ring = F.array(*(F.array(F.lit(float(x)), F.lit(float(y))) for x, y in ((10, 5), (40, 5), (40, 30), (10, 30), (10, 5))))
    x, y = F.col("c_custkey") % 100 + 0.5, F.col("c_custkey") % 70 + 0.5
    return table(spark, sf_dir, "customer").where(X.polygon_holds(ring, x, y)).select("c_custkey")


@query("""SELECT n_regionkey AS id, CAST(min(n_nationkey) AS DOUBLE) AS min_x, CAST(min(n_nationkey % 7) AS DOUBLE) AS min_y, CAST(max(n_nationkey) AS DOUBLE) AS max_x, CAST(max(n_nationkey % 7 + 1) AS DOUBLE) AS max_y FROM nation GROUP BY 1""")
def bbox_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes around GeoJSON geometries of several kinds."""
    k = F.col("n_nationkey")
    line = F.format_string('{"type":"LineString","coordinates":[[%d,%d],[%d,%d]]}', k, k % 7, k, k % 7 + 1)
    nested = F.concat(F.lit('{"type":"GeometryCollection","geometries":['), line, F.lit("]}"))
    shapes = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("id"), F.explode(geo.vertices(F.when(k % 2 == 0, line).otherwise(nested))).alias("p"))
    return geo.bbox_by(shapes.select("id", F.col("p")[0].alias("x"), F.col("p")[1].alias("y")), ["id"], "x", "y")

"""Rasters as tables of cells (product, row, col, value, qa)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.functions import clamp, finite, masked, tile_address
from envflow.operators.aggregates import exact_mean, percentile_by


def cells_of(df: DataFrame, key: str, array: str, columns: int) -> DataFrame:
    """(key, row, col, value) of arrays in row-major order with so many columns."""
    flat = df.select(key, F.posexplode(array).alias("_at", "value"))
    return flat.select(key, F.floor(F.col("_at") / columns).cast("int").alias("row"), (F.col("_at") % columns).cast("int").alias("col"), F.col("value").cast("double").alias("value"))


def masked_stats(cells: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Least, largest and mean valid value (null without one) and the valid share in percent (0 without cells)."""
    valid = F.when(finite(value), value)
    out = cells.withColumn("_v", valid).groupBy(*keys)
    share = F.coalesce(F.try_divide(F.count("_v"), F.count("*")) * 100, F.lit(0.0))
    return out.agg(F.min("_v").alias("min"), F.max("_v").alias("max"), exact_mean(F.col("_v")).alias("mean"), F.round(share, 6).alias("valid_pct"))


def strict_or_relaxed(cells: DataFrame, value: str, strict: Column, least: int = 1000, share: float = 0.005) -> DataFrame:
    """Masks by the strict rule where enough cells pass it, and else by value alone. Adds kept and n_strict.

    The choice is a one-row aggregate in the same plan: enough is more than max(least, int(share * cells)).
    """
    good = F.col(value).isNotNull()
    counts = cells.agg(F.count_if(good & strict).alias("n_strict"), F.count("*").alias("_n"))
    counts = counts.select("n_strict", (F.col("n_strict") > F.greatest(F.lit(least), F.floor(F.col("_n") * share))).alias("_strict"))
    out = cells.crossJoin(F.broadcast(counts))
    return out.withColumn("kept", F.when(~F.col("_strict") | strict, F.col(value))).drop("_strict")


def aerosol(raw: Column, fill=None, scale=None, offset=None) -> Column:
    """Scaled optical depth within 0..5, by the file's metadata or 0.001 and 0."""
    value = masked(raw.cast("double"), fill) * F.coalesce(scale, F.lit(0.001)) + F.coalesce(offset, F.lit(0.0)) if scale is not None else masked(raw.cast("double"), fill) * 0.001
    return F.when(value.between(0, 5), value)


def display_limits(cells: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, upper_limit): the 98th percentile, interpolated, within 0.3..2.5; 1.5 for groups without a valid value."""
    return percentile_by(cells, keys, value, 0.98, "_high").select(*keys, clamp(F.col("_high"), 0.3, 2.5, 1.5).alias("upper_limit"))


def mosaic(cells: DataFrame, order: str, value: str = "value") -> DataFrame:
    """For each (row, col) the first valid value by order."""
    return cells.where(finite(F.col(value))).groupBy("row", "col").agg(F.min_by(value, order).alias(value))


def valid_extent(cells: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """First and last row and column with a valid value."""
    return cells.where(finite(F.col(value))).groupBy(*keys).agg(F.min("row").alias("row0"), F.max("row").alias("row1"), F.min("col").alias("col0"), F.max("col").alias("col1"))


def to_coordinates(row: Column, col: Column, a: float, b: float, c: float, d: float, e: float, f: float) -> Column:
    """struct(x, y) of the upper left corner of a cell under the affine transform (a, b, c, d, e, f)."""
    return F.struct((F.lit(a) * col + F.lit(b) * row + F.lit(c)).alias("x"), (F.lit(d) * col + F.lit(e) * row + F.lit(f)).alias("y"))


def resample(cells: DataFrame, targets: DataFrame, source_row: Column, source_col: Column, keys: tuple[str, ...] = ()) -> DataFrame:
    """targets with the nearest cell's value: source_row and source_col map a target to its source cell; null outside.

    keys name the columns that tell rasters apart, in cells and in targets; without them cells is one raster.
    """
    mapped = targets.withColumn("_r", F.floor(source_row).cast("int")).withColumn("_c", F.floor(source_col).cast("int"))
    source = cells.select(F.col("row").alias("_r"), F.col("col").alias("_c"), *keys, "value")
    return mapped.join(source, [*keys, "_r", "_c"], "left").drop("_r", "_c")


def lookup(array: Column, row: Column, col: Column, rows: int, columns: int) -> Column:
    """The cell (row, col) of an array in row-major order; null outside. The array stays whole, so nothing is shuffled for it."""
    inside = row.between(0, rows - 1) & col.between(0, columns - 1)
    return F.when(inside, F.get(array, (row * columns + col).cast("int"))).cast("double")


def reproject(tiles: DataFrame, targets: DataFrame, array: str, cells: int, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """targets (lon, lat and whatever else) with the value of the sinusoidal cell that holds each, one row for every tile row of its tile.

    tiles are rows (h, v, array of cells x cells values and whatever else, such as a day). Targets are mapped back to tile, row and
    column, and meet whole tiles by an equi-join on the tile. Tiles that no target lies in are left out by a filter on h and v before
    any array is read: their list has no more entries than the grid has tiles. Targets outside the grid, or in no tile, have no row.
    """
    aimed = targets.withColumn("_at", tile_address(F.col(lon), F.col(lat), cells)).where("_at IS NOT NULL")
    wanted = sorted((r.h, r.v) for r in aimed.select("_at.h", "_at.v").distinct().collect())
    asked = F.col("h").isin(sorted({h for h, _ in wanted})) & F.col("v").isin(sorted({v for _, v in wanted}))
    met = tiles.where(asked).join(aimed, (F.col("h") == F.col("_at.h")) & (F.col("v") == F.col("_at.v")))
    value = lookup(F.col(array), F.col("_at.row"), F.col("_at.col"), cells, cells)
    return met.withColumn("value", value).drop("_at", array)

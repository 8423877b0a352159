"""Readers of files: weather days (JSON), air-quality rows (CSV), boundaries (GeoJSON), listings and rasters."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow import schemas


#: Endings of file names and the readers' formats.
KINDS = {"parquet": "parquet", "json": "json", "geojson": "json", "csv": "csv", "txt": "text", "nc": "raster", "hdf": "raster", "tif": "raster"}


def read_weather(spark: SparkSession, *paths: str) -> DataFrame:
    """Day files, one JSON document each, with source_file. What can't be parsed is kept in _corrupt_record."""
    reader = spark.read.schema(schemas.WEATHER_FILE).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
    return reader.json(list(paths)).withColumn("source_file", F.col("_metadata.file_path"))


def read_air(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of air-quality files, all as text; a byte-order mark before the header does no harm."""
    return spark.read.schema(schemas.AIR_FILE).option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", True).csv(list(paths))


def read_features(spark: SparkSession, *paths: str) -> DataFrame:
    """Features of GeoJSON collections: properties as a map, geometry as JSON text."""
    spec = "features ARRAY<STRUCT<properties: MAP<STRING, STRING>, geometry: STRING>>"
    return spark.read.schema(spec).option("multiLine", True).json(list(paths)).select(F.explode("features").alias("f")).select("f.properties", "f.geometry")


def read_table(spark: SparkSession, fmt: str, *paths: str, schema=None, **options: str) -> DataFrame:
    """Parquet, JSON lines, CSV and text by one call; corrupt files are skipped only where options say so."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(list(paths))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length, modificationTime) of all files below a folder; their contents aren't read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.load(path).select("path", "length", "modificationTime")


def files_in_order(spark: SparkSession, path: str, glob: str | None = None, most: int = 0) -> DataFrame:
    """list_files by path; the first most of them, or all for 0."""
    every = list_files(spark, path, glob).orderBy("path")
    return every.limit(most) if most else every


def kind_of(path: Column, kinds: dict[str, str] = KINDS) -> Column:
    """What reads a file, by its ending in any case (gz is looked through); null for other endings."""
    end = F.regexp_extract(F.lower(path), r"\.([a-z0-9]+)(?:\.gz)?$", 1)
    return reduce(lambda out, k: out.when(end == k, F.lit(kinds[k])), list(kinds)[1:], F.when(end == next(iter(kinds)), F.lit(next(iter(kinds.values())))))


Decoder = Callable[[str, bytes], Iterator[pd.DataFrame]]


def _decoded(spark: SparkSession, path: str, decode: Decoder, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    names = schemas.CELLS.fieldNames()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"], strict=True):
                error = None
                try:
                    for part in decode(name, content):
                        yield part[names].assign(path=name, error=None)
                except (ValueError, KeyError, OSError, ImportError) as e:
                    error = f"{type(e).__name__}: {e}"
                yield pd.DataFrame({c: [None] for c in names}).assign(path=name, error=error or "")

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.CELLS.fields)
    return reader.load(path).select("path", "content").mapInPandas(run, f"{fields}, path string, error string")


def read_rasters(spark: SparkSession, path: str, decode: Decoder, glob: str | None = None) -> DataFrame:
    """Cells of raster files. decode(path, content) gives frames of CELLS; what a file gives before it fails is kept.

    The libraries that formats like NetCDF and HDF need are the caller's: decode imports them in the task. Files that
    fail are told by raster_report.
    """
    return _decoded(spark, path, decode, glob).where("error IS NULL").select(*schemas.CELLS.fieldNames())


def raster_report(spark: SparkSession, path: str, decode: Decoder, glob: str | None = None) -> DataFrame:
    """(path, cells, error) for every raster file; error is null for those that can be read. Spark skips files without bytes."""
    each = _decoded(spark, path, decode, glob).groupBy("path").agg(F.count_if(F.col("error").isNull()).alias("cells"), F.max("error").alias("error"))
    return each.select("path", "cells", F.nullif("error", F.lit("")).alias("error"))

"""NetCDF classic files (CDF-1, CDF-2 and CDF-5) as a planned scan, without a library of the format.

Planning is a stage of its own: tasks read the headers alone and tell where the rows of a variable lie. Then the byte ranges of whole rows,
``RANGE_BYTES`` each at most, are dealt out over all tasks, which read them with one request each. So a large file is many tasks' work, other variables
aren't read, and the driver holds no header. A file that can't be read, or ends before its data do, is an error row. Fill values, scale and
offset come from the file's attributes and are applied as column expressions.

Classic files have no groups; a group here is what stands before a slash in a variable's name.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from envflow.functions import finite
from envflow.sources.files import list_files
from envflow.sources.rest import Store

#: Bytes of a variable that a task reads at a time.
RANGE_BYTES = 8 << 20
#: Fixed values of the format: types by their numbers, and the tags of lists.
TYPES = {1: "i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8", 7: "u1", 8: ">u2", 9: ">u4", 10: ">i8", 11: ">u8"}
DIMENSION, VARIABLE, ATTRIBUTE, STREAMING = 10, 11, 12, 0xFFFFFFFF


class _Header:
    """Reads a header's fields one after the other."""

    def __init__(self, file: BinaryIO):
        self.file = file
        magic = self.take(4)
        if magic[:3] != b"CDF" or magic[3] not in (1, 2, 5):
            raise ValueError("no NetCDF classic file")
        self.version = magic[3]

    def take(self, n: int) -> bytes:
        got = self.file.read(n)
        if len(got) < n:
            raise ValueError("the header is cut off")
        return got

    def number(self, wide: bool) -> int:
        return struct.unpack(">Q" if wide else ">I", self.take(8 if wide else 4))[0]

    def size(self) -> int:
        return self.number(self.version == 5)

    def padded(self, n: int) -> bytes:
        return self.take(n + -n % 4)[:n]

    def name(self) -> str:
        return self.padded(self.size()).decode()

    def list_of(self, tag: int, item) -> list:
        found, n = self.number(False), self.size()
        if found not in (0, tag) or found == 0 and n:
            raise ValueError("a list with another tag")
        return [item() for _ in range(n)]

    def attribute(self) -> tuple[str, object]:
        name, kind = self.name(), TYPES[self.number(False)]
        n = self.size()
        raw = self.padded(n * np.dtype(kind).itemsize)
        if kind == "S1":
            return name, raw.decode(errors="replace")
        values = np.frombuffer(raw, dtype=kind)
        return name, values[0].item() if len(values) == 1 else values.tolist()

    def variable(self) -> dict:
        name, n = self.name(), self.size()
        dims = [self.size() for _ in range(n)]
        attributes, kind = dict(self.list_of(ATTRIBUTE, self.attribute)), TYPES[self.number(False)]
        self.size()  # the size of the data, which follows from the dimensions
        return {"name": name, "dims": dims, "attributes": attributes, "kind": kind, "begin": self.number(self.version != 1)}


def read_header(file: BinaryIO, length: int) -> list[dict]:
    """The variables of an open file of so many bytes: name, kind, shape, attributes, begin, and step from one record to the next (0 without records)."""
    h = _Header(file)
    records = h.size()
    dims = h.list_of(DIMENSION, lambda: (h.name(), h.size()))
    h.list_of(ATTRIBUTE, h.attribute)
    out = h.list_of(VARIABLE, h.variable)
    width = {}
    for v in out:
        v["record"] = bool(v["dims"]) and dims[v["dims"][0]][1] == 0
        rest = [dims[d][1] for d in v["dims"][v["record"] :]]
        width[v["name"]] = int(np.prod(rest, dtype=np.int64)) * np.dtype(v["kind"]).itemsize
        v["shape"] = rest
    recorded = [v for v in out if v["record"]]
    step = sum(width[v["name"]] + -width[v["name"]] % 4 for v in recorded) if len(recorded) != 1 else width[recorded[0]["name"]]
    if records == STREAMING or h.version == 5 and records == 2**64 - 1:  # the number of records follows from the file's length
        records = (length - min((v["begin"] for v in recorded), default=length)) // step if step else 0
    for v in out:
        v["step"] = step if v["record"] else 0
        v["shape"] = [records, *v["shape"]] if v["record"] else v["shape"]
    return out


_RANGES = "path STRING, kind STRING, at BIGINT, layer BIGINT, row BIGINT, rows BIGINT, cols BIGINT, fill DOUBLE, scale DOUBLE, shift DOUBLE, error STRING"


def _ranges_of(path: str, length: int, file: BinaryIO, variable: str, range_bytes: int) -> Iterator[tuple]:
    """Byte ranges of whole rows of a variable. Its last two dimensions are rows and columns, those before them together the layer."""
    found = [v for v in read_header(file, length) if v["name"] == variable]
    if not found:
        raise KeyError(f"no variable {variable}")
    v = found[0]
    shape, width = v["shape"] or [1], np.dtype(v["kind"]).itemsize
    if v["kind"] == "S1":
        raise ValueError(f"{variable} holds text")
    *layers, rows, cols = shape if len(shape) > 1 else [shape[0], 1]
    one_record = v["step"] and len(shape) == 1  # a number for each record
    told = {k: v["attributes"].get(k) for k in ("_FillValue", "missing_value", "scale_factor", "add_offset")}
    number = lambda x: float(x) if isinstance(x, (int, float)) else None
    fill = number(told["_FillValue"]) if told["_FillValue"] is not None else number(told["missing_value"])
    constants = (fill, number(told["scale_factor"]), number(told["add_offset"]))
    in_record = layers[1:] if v["step"] and len(shape) > 2 else []
    each = max(1, range_bytes // max(1, cols * width))
    if v["step"] and len(shape) == 2 or one_record:
        # a row of each record: rows lie a step apart
        for r in range(rows):
            yield path, v["kind"], v["begin"] + r * v["step"], 0, r, 1, cols, *constants, None
        return
    total = int(np.prod(layers, dtype=np.int64)) if layers else 1
    below = int(np.prod(in_record, dtype=np.int64)) if in_record else 1
    for layer in range(total):
        start = v["begin"] + ((layer // below) * v["step"] + (layer % below) * rows * cols * width if v["step"] else layer * rows * cols * width)
        for first in range(0, rows, each):
            n = min(each, rows - first)
            yield path, v["kind"], start + first * cols * width, layer, first, n, cols, *constants, None


def _planned(files: DataFrame, variable: str, range_bytes: int) -> DataFrame:
    names = [x.split()[0] for x in _RANGES.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store = Store()
        for frame in frames:
            for path in frame["path"]:
                rows: list[tuple] = []
                try:
                    where, name = store._of(path)
                    with where.open_input_file(name) as file:
                        length = file.size()
                        for r in _ranges_of(path, length, file, variable, range_bytes):
                            end = r[2] + r[5] * r[6] * np.dtype(r[1]).itemsize
                            if end > length:
                                raise ValueError(f"{length} bytes, of which data need {end}")
                            rows.append(r)
                            if len(rows) >= 10_000:
                                yield pd.DataFrame(rows, columns=names).astype(object)
                                rows = []
                except (ValueError, KeyError, OSError, struct.error, UnicodeDecodeError) as e:
                    rows.append((path, *[None] * (len(names) - 2), f"{type(e).__name__}: {e}"))
                if rows:
                    yield pd.DataFrame(rows, columns=names).astype(object)

    return files.select("path").mapInPandas(run, _RANGES)


def _variable(group: str | None, variable: str) -> str:
    return f"{group}/{variable}" if group else variable


def plan(spark: SparkSession, path: str, variable: str, group: str | None = None, glob: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The byte ranges of a variable in the files below path, and a row with an error for each file that can't be read."""
    files = list_files(spark, path, glob) if glob else list_files(spark, path)
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return _planned(files.select("path").repartition(n, "path"), _variable(group, variable), range_bytes)


def read_netcdf(spark: SparkSession, path: str, variable: str, group: str | None = None, glob: str | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Cells (path, layer, row, col, raw, value) of a variable in the files below path.

    raw is the stored number; value is null for fill values and what isn't finite, and else scaled and shifted as the file says. The
    last two dimensions are row and column, those before them are numbered together as layer; a variable of one dimension has one column. Files
    that can't be read give no cells (see report). A file whose data end early gives none of them.
    """
    ranges = plan(spark, path, variable, group, glob, range_bytes)
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bad = ranges.where("error IS NOT NULL").select("path").distinct()
    dealt = ranges.where("error IS NULL").join(bad, "path", "left_anti").repartition(n, "path", "at")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, opened, file = Store(), None, None
        for frame in frames:
            for r in frame.itertuples(index=False):
                if opened != r.path:
                    where, name = store._of(r.path)
                    opened, file = r.path, where.open_input_file(name)
                kind = np.dtype(r.kind)
                raw = np.frombuffer(file.read_at(r.rows * r.cols * kind.itemsize, r.at), dtype=kind).astype(float)
                yield pd.DataFrame({
                    "path": r.path, "layer": r.layer, "row": np.repeat(np.arange(r.row, r.row + r.rows), r.cols), "col": np.tile(np.arange(r.cols), r.rows),
                    "raw": raw, "fill": r.fill, "scale": r.scale, "shift": r.shift,
                })

    cells = dealt.mapInPandas(run, "path STRING, layer BIGINT, row BIGINT, col BIGINT, raw DOUBLE, fill DOUBLE, scale DOUBLE, shift DOUBLE")
    number = lambda c: F.nanvl(F.col(c), F.lit(None).cast("double"))  # noqa: E731  a frame's column of nothing is NaN
    valid = finite(F.col("raw")) & (number("fill").isNull() | (F.col("raw") != number("fill")))
    value = F.when(valid, F.col("raw") * F.coalesce(number("scale"), F.lit(1.0)) + F.coalesce(number("shift"), F.lit(0.0)))
    return cells.select("path", "layer", "row", "col", "raw", value.alias("value"))


def report(spark: SparkSession, path: str, variable: str, group: str | None = None, glob: str | None = None) -> DataFrame:
    """(path, cells, error) for every file below path: how many cells of the variable it has, or why it can't be read."""
    ranges = plan(spark, path, variable, group, glob).groupBy("path").agg(F.coalesce(F.sum(F.col("rows") * F.col("cols")), F.lit(0)).alias("cells"), F.max("error").alias("error"))
    return ranges.select("path", F.when(F.col("error").isNull(), F.col("cells")).otherwise(0).alias("cells"), "error")


def write_netcdf(df: DataFrame, folder: str, key: str, layer: str, array: str, rows: int, cols: int, variable: str, fill: int, scale: float) -> DataFrame:
    """Writes one CDF-2 file for each value of key, named after it, with the arrays of its rows as records of rows x cols short integers; (path, records).

    A value is stored as the nearest multiple of scale, and fill where it is null, not finite or beyond 16 bits. Records are in order of layer, whose values are
    a variable of their own. A key's rows are one file and one task's work, so a key is for what belongs in one file.
    """
    name = variable.encode()

    def text(b: bytes) -> bytes:
        return struct.pack(">I", len(b)) + b + b"\0" * (-len(b) % 4)

    def header(records: int) -> bytes:
        dims = struct.pack(">II", DIMENSION, 3) + text(b"layer") + struct.pack(">I", 0) + text(b"row") + struct.pack(">I", rows) + text(b"col") + struct.pack(">I", cols)
        size = 2 * rows * cols
        attributes = struct.pack(">II", ATTRIBUTE, 2) + text(b"_FillValue") + struct.pack(">IIhxx", 3, 1, fill) + text(b"scale_factor") + struct.pack(">IId", 6, 1, scale)
        one = text(name) + struct.pack(">IIII", 3, 0, 1, 2) + attributes + struct.pack(">II", 3, size + -size % 4)
        two = text(b"layer") + struct.pack(">II", 1, 0) + struct.pack(">II", 0, 0) + struct.pack(">II", 6, 8)
        start = b"CDF\x02" + struct.pack(">I", records) + dims + struct.pack(">II", 0, 0) + struct.pack(">II", VARIABLE, 2)
        begin = len(start) + len(one) + len(two) + 16
        return start + one + struct.pack(">Q", begin) + two + struct.pack(">Q", begin + size + -size % 4)

    def write(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(layer)
        values = np.array([[np.nan if x is None else x for x in a] for a in frame[array]], dtype=float).reshape(len(frame), rows * cols)
        stored = np.floor(values / scale + 0.5)
        good = np.isfinite(stored) & (np.abs(stored) < 2**15) & (stored != fill)
        shorts = np.where(good, stored, fill).astype(">i2")
        pad = b"\0" * (-2 * rows * cols % 4)
        path = f"{folder.rstrip('/')}/{frame[key].iloc[0]}.nc"
        records = (s.tobytes() + pad + struct.pack(">d", float(n)) for s, n in zip(shorts, frame[layer], strict=True))
        Store().put(path, iter([header(len(frame)), *records]))
        return pd.DataFrame({"path": [path], "records": [len(frame)]})

    return df.select(key, layer, array).groupBy(key).applyInPandas(write, "path STRING, records BIGINT")

"""NetCDF classic files of all three versions, written here byte by byte, against what was written."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from envflow.sources import netcdf

KINDS = {"b": (1, "i1"), "h": (3, ">i2"), "i": (4, ">i4"), "f": (5, ">f4"), "d": (6, ">f8"), "q": (10, ">i8")}


def build(version, dims, variables, records=0, streaming=False):
    """A file's bytes. dims: [(name, length)], 0 for records; variables: [(name, dim numbers, kind, attributes, values)]."""
    wide = version == 5
    size = lambda n: struct.pack(">Q" if wide else ">I", n)
    offset = lambda n: struct.pack(">I" if version == 1 else ">Q", n)
    text = lambda s: size(len(s)) + s.encode() + b"\0" * (-len(s) % 4)
    listed = lambda tag, items: struct.pack(">I", tag if items else 0) + size(len(items)) + b"".join(items)

    def attribute(name, value):
        if isinstance(value, str):
            return text(name) + struct.pack(">I", 2) + size(len(value)) + value.encode() + b"\0" * (-len(value) % 4)
        kind, number = value
        raw = np.array([number], dtype=KINDS[kind][1]).tobytes()
        return text(name) + struct.pack(">I", KINDS[kind][0]) + size(1) + raw + b"\0" * (-len(raw) % 4)

    arrays = [np.array(v[4], dtype=KINDS[v[2]][1]) for v in variables]
    recorded = [bool(v[1]) and dims[v[1][0]][1] == 0 for v in variables]
    each = [a[0].nbytes if r and len(a) else a.nbytes for a, r in zip(arrays, recorded, strict=True)]
    pad = lambda n: n + -n % 4
    alone = sum(recorded) == 1

    def head(begins):
        found = [text(name) + size(len(at)) + b"".join(map(size, at)) + listed(12, [attribute(*x) for x in attrs.items()]) + struct.pack(">I", KINDS[kind][0]) + size(pad(n)) + offset(b) for (name, at, kind, attrs, _), n, b in zip(variables, each, begins, strict=True)]
        count = (b"\xff" * (8 if wide else 4)) if streaming else size(records)
        return b"CDF" + bytes([version]) + count + listed(10, [text(n) + size(k) for n, k in dims]) + listed(12, [attribute("title", "a test")]) + listed(11, found)

    at, begins = len(head([0] * len(variables))), []
    for n, r in zip(each, recorded, strict=True):
        begins.append(None if r else at)
        at += 0 if r else pad(n)
    for i, (n, r) in enumerate(zip(each, recorded, strict=True)):
        if r:
            begins[i] = at
            at += n if alone else pad(n)
    out = head(begins) + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 4) for a, r in zip(arrays, recorded, strict=True) if not r)
    for k in range(records):
        out += b"".join(a[k : k + 1].tobytes() + (b"" if alone else b"\0" * (-a[k].nbytes % 4)) for a, r in zip(arrays, recorded, strict=True) if r)
    return out


def cells(spark, path, *args, **more):
    return {(r.layer, r.row, r.col): r.value for r in netcdf.read_netcdf(spark, str(path), *args, **more).collect()}


def flat(values, scale=1.0, shift=0.0, fill=None):
    a = np.array(values, dtype=float)
    a = a.reshape(-1, *a.shape[-2:]) if a.ndim > 1 else a.reshape(1, -1, 1)
    return {(i, j, k): None if x == fill or not np.isfinite(x) else x * scale + shift for (i, j, k), x in np.ndenumerate(a)}


@pytest.mark.parametrize("version", [1, 2, 5])
@pytest.mark.parametrize("range_bytes", [8 << 20, 24])
def test_variables_of_any_shape(spark, tmp_path, version, range_bytes):
    rng = np.random.default_rng(version)
    grid, cube, series = rng.integers(-50, 50, (5, 7)), rng.normal(size=(2, 3, 5, 7)), rng.normal(size=6)
    grid[1, 2], series[3] = -9, np.nan
    moving, bytes_, one = rng.integers(0, 9, (4, 5, 7)), rng.integers(0, 9, (4, 3)), rng.normal(size=4)
    dims = [("time", 0), ("y", 5), ("x", 7), ("a", 2), ("b", 3), ("n", 6)]
    variables = [
        ("PRODUCT/grid", [1, 2], "h", {"_FillValue": ("h", -9), "scale_factor": ("d", 0.5), "add_offset": ("d", 10.0), "units": "mol"}, grid),
        ("cube", [3, 4, 1, 2], "f", {}, cube.astype(">f4")), ("series", [5], "d", {"missing_value": ("d", 1.25)}, series),
        ("moving", [0, 1, 2], "i", {"missing_value": ("i", 3)}, moving), ("bytes", [0, 4], "b", {}, bytes_), ("one", [0], "d", {}, one),
    ]
    (tmp_path / "file.nc").write_bytes(build(version, dims, variables, 4, streaming=version == 2))
    assert cells(spark, tmp_path, "grid", "PRODUCT", range_bytes=range_bytes) == flat(grid, 0.5, 10.0, -9)
    assert cells(spark, tmp_path, "cube", range_bytes=range_bytes) == flat(cube.astype(">f4"))
    got = cells(spark, tmp_path, "series", range_bytes=range_bytes)
    assert {k: v for k, v in got.items() if k[1] != 3} == {k: v for k, v in flat(series).items() if k[1] != 3} and got[0, 3, 0] is None
    assert cells(spark, tmp_path, "moving", range_bytes=range_bytes) == flat(moving, fill=3)
    assert cells(spark, tmp_path, "bytes", range_bytes=range_bytes) == flat(bytes_) and cells(spark, tmp_path, "one", range_bytes=range_bytes) == flat(one)
    ranges = netcdf.plan(spark, str(tmp_path), "cube", range_bytes=range_bytes).collect()
    assert len(ranges) == (6 if range_bytes > 100 else 30) and all(r.rows * r.cols * 4 <= max(range_bytes, 28) for r in ranges)


def test_a_single_record_variable_is_not_padded(spark, tmp_path):
    values = np.arange(15).reshape(5, 3)
    (tmp_path / "file.nc").write_bytes(build(1, [("t", 0), ("x", 3)], [("v", [0, 1], "b", {}, values)], 5))
    assert cells(spark, tmp_path, "v") == flat(values)


def test_bad_files_are_rows_of_the_report(spark, tmp_path):
    good = build(2, [("y", 40), ("x", 30)], [("v", [0, 1], "d", {}, np.arange(1200).reshape(40, 30))])
    files = {"good.nc": good, "cut.nc": good[:-100], "head.nc": good[:40], "hdf.nc": b"\x89HDF\r\n\x1a\n" + b"x" * 100, "other.nc": build(1, [("x", 2)], [("w", [0], "i", {}, [1, 2])])}
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    told = {r.path.rpartition("/")[2]: (r.cells, r.error) for r in netcdf.report(spark, str(tmp_path), "v", glob="*.nc").collect()}
    assert told.pop("good.nc") == (1200, None) and set(told) == set(files) - {"good.nc"}
    assert all(n == 0 and e for n, e in told.values()) and "of which data need" in told["cut.nc"][1] and "no variable v" in told["other.nc"][1]
    got = netcdf.read_netcdf(spark, str(tmp_path), "v")
    assert got.count() == 1200 and got.select("path").distinct().count() == 1 and got.agg(F.sum("value")).first()[0] == 1199 * 600


def test_written_files_are_read_back(spark, tmp_path):
    rows = [(f, n, [None if (n + i) % 11 == 0 else (n * 7 + i) * 0.25 - 100 for i in range(6)]) for f in ("a", "b") for n in range(9)] + [("a", 9, [float("nan"), 1e9, 0.1, 0.125, -0.125, 0.0])]
    df = spark.createDataFrame(rows, "name string, n int, v array<double>")
    told = netcdf.write_netcdf(df, f"file://{tmp_path}/out", "name", "n", "v", 2, 3, "G/v", -999, 0.25).collect()
    assert sorted((r.path.rpartition("/")[2], r.records) for r in told) == [("a.nc", 10), ("b.nc", 9)]
    got = {(r.path[-4], r.layer, r.row * 3 + r.col): r.value for r in netcdf.read_netcdf(spark, f"{tmp_path}/out", "v", "G").collect()}
    want = {(f, n, i): None if x is None or not abs(x) < 8191 else np.floor(x / 0.25 + 0.5) * 0.25 for f, n, a in rows for i, x in enumerate(a)}
    assert got == want

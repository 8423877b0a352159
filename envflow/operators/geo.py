"""Boxes, geometries and spatial joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envflow.functions import bbox_overlap, finite, rings_meet
from envflow.operators.blocks import blocks, unpacked
from envflow.shared import written

_POINT = "array<double>"


def vertices(geojson: Column) -> Column:
    """All [x, y] of a GeoJSON geometry text; a collection's members count, two levels deep. Null if it can't be read."""

    def flat(text: Column) -> Column:
        kind, part = F.get_json_object(text, "$.type"), F.get_json_object(text, "$.coordinates")
        lines = lambda c: F.flatten(F.from_json(c, f"array<array<{_POINT}>>"))
        return (
            F.when(kind == "Point", F.array(F.from_json(part, _POINT)))
            .when(kind.isin("LineString", "MultiPoint"), F.from_json(part, f"array<{_POINT}>"))
            .when(kind.isin("Polygon", "MultiLineString"), lines(part))
            .when(kind == "MultiPolygon", F.flatten(F.flatten(F.from_json(part, f"array<array<array<{_POINT}>>>"))))
        )

    def members(text: Column) -> Column:
        return F.from_json(F.get_json_object(text, "$.geometries"), "array<string>")

    def deep(text: Column, level: int) -> Column:
        own = flat(text)
        if not level:
            return own
        inner = F.flatten(F.transform(members(text), lambda g: F.coalesce(deep(g, level - 1), F.array().cast(f"array<{_POINT}>"))))
        return F.when(F.get_json_object(text, "$.type") == "GeometryCollection", inner).otherwise(own)

    return deep(geojson, 2)


def bbox_by(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(x).alias("min_x"), F.min(y).alias("min_y"), F.max(x).alias("max_x"), F.max(y).alias("max_y"))


#: Levels of grid cells: those of level l are cell * 2**l wide.
TOP = 60


def overlap_join(a: DataFrame, b: DataFrame, box_a: tuple[str, str, str, str], box_b: tuple[str, str, str, str], cell: float) -> DataFrame:
    """Pairs of rows whose boxes have a point in common, each once, found by an equi-join on grid cells of mixed levels.

    A box is in the cells of the level that is as wide as it is, or of level 0, whose cells are cell wide: in four at most, whatever its
    size. The smaller box of a pair is looked up at the level of the larger, so a side also has its cells, four at most, at each level that the
    other side has; there are few levels, as each is twice as wide as the last. A pair counts in the cell of the larger box that holds the
    lower left corner of the overlap. Columns of a and b have different names. Boxes that are null, inside out or not finite meet nothing.
    Rows of the very same box are one box in the join, with a list of the rest of their columns; pairs of lists are dealt out and unpacked in the end.
    """

    def sized(df: DataFrame, box: tuple[str, str, str, str], name: str) -> DataFrame:
        x0, y0, x1, y1 = (F.col(c).cast("double") for c in box)
        whole = reduce(lambda s, t: s & t, (finite(c) for c in (x0, y0, x1, y1)))
        width = F.greatest(x1 - x0, y1 - y0, F.lit(float(cell)))
        level = F.least(F.lit(TOP), F.greatest(F.lit(0), F.ceil(F.log2(width / cell)).cast("int")))
        return df.where(whole & (x0 <= x1) & (y0 <= y1)).withColumn(f"{name}level", level)

    def placed(df: DataFrame, box: tuple[str, str, str, str], name: str, level: Column) -> DataFrame:
        at = lambda c: F.floor(F.col(c) / (F.lit(float(cell)) * F.pow(F.lit(2.0), level)))
        return df.withColumn(f"{name}x", F.explode(F.sequence(at(box[0]), at(box[2])))).withColumn(f"{name}y", F.explode(F.sequence(at(box[1]), at(box[3]))))

    def at_levels(df: DataFrame, box: tuple[str, str, str, str], name: str, levels: list[int], equal: bool) -> DataFrame:
        own = F.col(f"{name}level")
        above = F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda at: (at >= own) if equal else (at > own))
        return placed(df.withColumn(f"{name}at", F.explode(above)), box, name, F.col(f"{name}at"))

    own = {name: [*dict.fromkeys(box)] for name, box in (("_a", box_a), ("_b", box_b))}
    left, right = (written(blocks(sized(df, box, name), [*own[name], f"{name}level"], f"{name}rows"), "boxes") for df, box, name in ((a, box_a, "_a"), (b, box_b, "_b")))
    lists = {name: df.groupBy(f"{name}level").agg(F.max(F.size(f"{name}rows"))).collect() for df, name in ((left, "_a"), (right, "_b"))}
    levels_a, levels_b = (sorted(r[0] for r in lists[name]) for name in ("_a", "_b"))
    most = max((r[1] for r in lists["_a"]), default=0) * max((r[1] for r in lists["_b"]), default=0)
    overlap = bbox_overlap(tuple(map(F.col, box_a)), tuple(map(F.col, box_b)))

    def met(large: DataFrame, small: DataFrame, box: tuple[str, str, str, str], big: str, little: str) -> DataFrame:
        width = F.lit(float(cell)) * F.pow(F.lit(2.0), F.col(f"{big}level"))
        corner = lambda i: F.floor(F.greatest(F.col(box_a[i]), F.col(box_b[i])) / width)
        both = placed(large, box, big, F.col(f"{big}level")).join(small, (F.col(f"{big}level") == F.col(f"{little}at")) & (F.col(f"{big}x") == F.col(f"{little}x")) & (F.col(f"{big}y") == F.col(f"{little}y")))
        return both.where(overlap & (F.col(f"{big}x") == corner(0)) & (F.col(f"{big}y") == corner(1))).select(*own["_a"], *own["_b"], "_arows", "_brows")

    in_a = met(left, at_levels(right, box_b, "_b", levels_a, True), box_a, "_a", "_b")
    in_b = met(right, at_levels(left, box_a, "_a", levels_b, False), box_b, "_b", "_a")
    rows = unpacked(in_a.unionAll(in_b), "_arows", "_brows", most, *own["_a"], *own["_b"])
    return rows.select(*(c if c in own[name] else F.col(f"{name}rows").getField(c).alias(c) for df, name in ((a, "_a"), (b, "_b")) for c in df.columns))


def spatial_join(a: DataFrame, b: DataFrame, ring_a: str, ring_b: str, cell: float, suffixes: tuple[str, str] = ("_left", "_right")) -> DataFrame:
    """Pairs of rows whose polygons have a point in common; names that both sides have get a suffix.

    Boxes are joined on grid cells first (see overlap_join); the exact test runs on those pairs only. Null and empty
    rings meet nothing. Shapes with holes, of several parts or of many points are joined by polygons.polygon_join.
    """
    both = set(a.columns) & set(b.columns)
    a, b = (df.withColumnsRenamed({c: c + suffix for c in both}) for df, suffix in ((a, suffixes[0]), (b, suffixes[1])))
    ring_a, ring_b = (r + s if r in both else r for r, s in ((ring_a, suffixes[0]), (ring_b, suffixes[1])))

    def boxed(df: DataFrame, ring: str, name: str) -> DataFrame:
        along = lambda i: F.transform(ring, lambda p: p[i])
        return df.withColumns({f"{name}x0": F.array_min(along(0)), f"{name}y0": F.array_min(along(1)), f"{name}x1": F.array_max(along(0)), f"{name}y1": F.array_max(along(1))})

    box = lambda name: (f"{name}x0", f"{name}y0", f"{name}x1", f"{name}y1")
    pairs = overlap_join(boxed(a, ring_a, "_l"), boxed(b, ring_b, "_m"), box("_l"), box("_m"), cell)
    return pairs.where(rings_meet(F.col(ring_a), F.col(ring_b))).drop(*box("_l"), *box("_m"))

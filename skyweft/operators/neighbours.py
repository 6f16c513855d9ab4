"""The k nearest stations of every target, exactly, without comparing all pairs.

Targets are dealt into boxes, coarse ones first. Any k stations (pivots, here those nearest to a box's centre) bound what a box needs: a station that is
farther from each of the box's corners than all pivots are has k stations nearer to every place in the box, as the places nearer to one station than
to another are a half-plane and a box is convex. So a box keeps those of its parent's stations that some corner reaches, wherever it lies, and a target
ranks only its own box's. Boxes are few beside targets; the only shuffle of the targets is their join with the boxes, and ranking is done within a row.

Up to `LISTED` stations of a time slot are one array at the top. More are dealt into blocks of some hundred, finer where stations are dense. Coarse boxes
keep blocks, by the blocks' bounds and with the outermost stations of blocks as pivots, then take their stations, and finer boxes keep stations. Of stations
at one place only the k that ties prefer can be anyone's neighbours; the others are left out first.

`nearest_in_batches` ends the same search in NumPy: a box's targets, `PART` at a time, meet the stations of the blocks it keeps in one Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from .. import checkpoints
from ..functions.geo import degrees_apart
from ..functions.nearest import SLACK, nearest_rows

SIZES = (0.05, 0.2, 0.8, 3.2, 12.8)
LISTED = 5_000
BLOCK = 128
TAKEN = 50_000
PART = 50_000
MAX_STATIONS = 200_000
BOUNDS = ("y0", "y1", "x0", "x1")


def _bound(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ranked(stations: Column, lat: Column, lon: Column, k: int) -> Column:
    """The first k of an array of stations by (distance in degrees, seq), each with its distance d."""
    with_d = F.transform(stations, lambda s: F.struct(degrees_apart(lat, lon, s["lat"], s["lon"]).alias("d"), s["seq"].alias("seq"), s.alias("s")))
    return F.slice(F.sort_array(with_d), 1, k)


def _corners() -> list[tuple[Column, Column]]:
    return [(F.col(y), F.col(x)) for y in ("y0", "y1") for x in ("x0", "x1")]


def _reached(items: Column, pivots: Column, k: int, lat_of, lon_of) -> Column:
    """Of items those that the row's box (y0, y1, x0, x1) can need for k neighbours: some corner is no farther from them than from the farthest of k pivots
    (lat, lon). lat_of, lon_of: the item's place that is nearest to a lat or lon."""
    lat, lon = (F.col("y0") + F.col("y1")) / 2, (F.col("x0") + F.col("x1")) / 2
    near = F.slice(F.sort_array(F.transform(pivots, lambda p: F.struct(degrees_apart(lat, lon, p["lat"], p["lon"]).alias("d"), p["lat"].alias("lat"), p["lon"].alias("lon")))), 1, k)
    farthest = lambda ps, y, x: F.array_max(F.transform(ps, lambda p: degrees_apart(y, x, p["lat"], p["lon"]))) + SLACK
    reach = _bound(near, lambda ps: F.struct(*(farthest(ps, y, x).alias(f"d{i}") for i, (y, x) in enumerate(_corners()))))

    def around(r: Column) -> Column:
        most = F.greatest(*(r[f"d{i}"] for i in range(4))) + SLACK
        sides = ((F.col("y0") - most).alias("y0"), (F.col("y1") + most).alias("y1"), (F.col("x0") - most).alias("x0"), (F.col("x1") + most).alias("x1"))
        return F.struct(r.alias("r"), *sides)

    def kept(a: Column, item: Column) -> Column:
        # the rectangle around all four circles is the cheaper test
        inside = (lat_of(item, a["y0"]) >= a["y0"]) & (lat_of(item, a["y1"]) <= a["y1"]) & (lon_of(item, a["x0"]) >= a["x0"]) & (lon_of(item, a["x1"]) <= a["x1"])
        n0, n1, n2, n3 = (degrees_apart(lat_of(item, y), lon_of(item, x), y, x) <= a["r"][f"d{i}"] for i, (y, x) in enumerate(_corners()))
        return inside & (n0 | n1 | n2 | n3)

    return F.when(F.size(pivots) < k, items).otherwise(_bound(_bound(reach, around), lambda a: F.filter(items, lambda item: kept(a, item))))


STATION = (lambda s, lat: s["lat"], lambda s, lon: s["lon"])
WITHIN = (lambda b, lat: F.greatest(F.least(lat, b["y1"]), b["y0"]), lambda b, lon: F.greatest(F.least(lon, b["x1"]), b["x0"]))


def _keys(level: int) -> list[str]:
    return [f"__y{level}", f"__x{level}"]


def _boxed(rows: DataFrame, level: int, finer: int) -> DataFrame:
    """rows of boxes with the keys of their boxes of a coarser level: each side is four times as long."""
    return rows.withColumns({c: F.shiftright(f, 2 * (level - finer)) for c, f in zip(_keys(level), _keys(finer))})


def _bounds(lat: str, lon: str) -> list[Column]:
    return [f(c).alias(n) for n, f, c in zip(BOUNDS, (F.min, F.max) * 2, (lat, lat, lon, lon))]


def _entry(payload: Sequence[str]) -> Column:
    return F.struct("lat", "lon", "seq", *(c for c in payload if c not in ("lat", "lon", "seq")))


def _placed(targets: DataFrame) -> DataFrame:
    return targets.na.drop(subset=["lat", "lon"]).withColumns({c: F.floor(F.col(x) / SIZES[0]) for c, x in zip(_keys(0), ("lat", "lon"))})


def nearest_stations(targets: DataFrame, stations: DataFrame, k: int, payload: Sequence[str], by: Sequence[str] = (), max_stations: int | None = LISTED) -> DataFrame:
    """targets (lat, lon, ...) with a column `near`: an array of struct(d, seq, s) of up to k stations, nearest first, ties by seq. s has lat,
    lon, seq and the payload columns. by: columns, such as a time slot, that both sides must share. Targets without a place or, by group, without
    stations have no row. More than max_stations in a group are searched by blocks (None: there are few)."""
    by, entry = list(by), _entry(payload)
    stations, placed = stations.na.drop(subset=["lat", "lon"]), _placed(targets)
    finest = placed.groupBy(*by, *_keys(0)).agg(*_bounds("lat", "lon"))
    if max_stations is not None and _most(stations, by, max_stations) > max_stations:
        finest = checkpoints.cut(finest)
        level, above = _taken(finest, stations, entry, k, by)
        finer = range(above - 1, -1, -1)
    else:
        level, above, finer = stations.groupBy(*by).agg(F.collect_list(entry).alias("__st")), None, (3, 1)
    for i in finer:
        box = _under(finest, level, i, above, by)
        level, above = box.select(*by, *_keys(i), _reached(F.col("__st"), F.col("__st"), k, *STATION).alias("__st")), i
    found = _boxed(placed, above, 0).join(level, by + _keys(above))
    return found.select(*targets.columns, ranked(F.col("__st"), F.col("lat"), F.col("lon"), k).alias("near"))


def many(stations: DataFrame, by: Sequence[str] = ()) -> bool:
    """Whether a group has more stations than one array takes."""
    return _most(stations.na.drop(subset=["lat", "lon"]), list(by), LISTED) > LISTED


Finish = Callable[[pa.Table, np.ndarray, np.ndarray, pa.StructArray], pa.Array]


def nearest_in_batches(targets: DataFrame, stations: DataFrame, k: int, payload: Sequence[str], by: Sequence[str], made: StructField, finish: Finish) -> DataFrame:
    """targets with the column `made`, which finish makes of targets, of the places of their up to k nearest stations (a row a target, nearest first, ties
    by seq), of the distances, and of the stations that the places are of. The rows are those of nearest_stations()."""
    by, entry, columns = list(by), _entry(payload), targets.columns
    blocks = checkpoints.cut(_blocks(stations.na.drop(subset=["lat", "lon"]), entry, k, by))
    last = _last(blocks, by)
    keys = [*by, *_keys(last)]
    placed = _boxed(_placed(targets), last, 0).withColumn("__part", F.lit(0))
    boxes = checkpoints.cut(placed.groupBy(*keys).agg(*_bounds("lat", "lon"), F.count(F.lit(1)).alias("__n")))
    pairs = _pairs(boxes, last, blocks, last, k, by)[0].select(*keys, "__id").withColumn("__part", F.lit(0))
    if (boxes.agg(F.max("__n")).first()[0] or 0) > PART:
        parts = boxes.select(*keys, F.ceil(F.col("__n") / PART).cast("int").alias("__parts"))
        hashed = F.xxhash64(*(F.to_json(c) if "map<" in t else F.col(c) for c, t in targets.dtypes))
        placed = placed.join(parts, keys).withColumn("__part", F.pmod(hashed, F.col("__parts")).cast("int"))
        pairs = pairs.join(parts, keys).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)))
    met = [*keys, "__part"]
    near = pairs.join(blocks.select(*by, "__id", "__s"), [*by, "__id"]).select(*met, "__s")
    kind = to_arrow_type(made.dataType)

    def run(own: pa.Table, blocks: pa.Table) -> pa.Table:
        own = own.select(columns)
        if not own.num_rows or not blocks.num_rows:
            return own.slice(0, 0).append_column(made.name, pa.nulls(0, kind))
        s = pa.concat_arrays(c.flatten() for c in blocks.column("__s").chunks)
        s = s.take(pc.array_sort_indices(pc.struct_field(s, "seq"), null_placement="at_start"))
        mine = (pc.cast(own.column(c), pa.float64()).to_numpy() for c in ("lat", "lon"))
        places = (pc.cast(pc.struct_field(s, c), pa.float64()).to_numpy(zero_copy_only=False) for c in ("lat", "lon"))
        return own.append_column(made.name, finish(own, *nearest_rows(*mine, *places, k), s).cast(kind))

    # boxes are few and each is much work: Spark would join partitions by their bytes
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = [x.repartition(n, *met).groupBy(*met) for x in (placed, near)]
    return sides[0].cogroup(sides[1]).applyInArrow(run, StructType([*targets.schema.fields, made]))


def nearest_of_any(targets: DataFrame, stations: DataFrame, k: int, payload: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """nearest_stations() by arrays where stations are few, else in batches."""
    if not many(stations, by):
        return nearest_stations(targets, stations, k, payload, by, None)

    def near(own: pa.Table, chosen: np.ndarray, d: np.ndarray, s: pa.StructArray) -> pa.Array:
        s = s.take(pa.array(chosen.ravel()))
        each = pa.StructArray.from_arrays([pa.array(d.ravel()), pc.struct_field(s, "seq"), s], ["d", "seq", "s"])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * d.shape[1], pa.int32()), each)

    made = stations.select(F.array(F.struct(F.lit(0.0).alias("d"), "seq", _entry(payload).alias("s"))).alias("near")).schema["near"]
    return nearest_in_batches(targets, stations, k, payload, by, made, near)


def _most(stations: DataFrame, by: list[str], limit: int) -> int:
    """The number of stations of the largest group, if that is over limit; else limit at most."""
    if not by:
        return stations.limit(limit + 1).count()
    return stations.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def _under(finest: DataFrame, above: DataFrame, level: int, parent: int | None, by: list[str], of: int = 0) -> DataFrame:
    """The boxes of a level with their bounds and what their boxes of the level above keep (parent None: what there is). of: the level of finest."""
    box = _boxed(finest, level, of).groupBy(*by, *_keys(level)).agg(*(f(c).alias(c) for f, c in zip((F.min, F.max) * 2, BOUNDS)))
    if parent is None:
        return box.join(above, by) if by else box.crossJoin(F.broadcast(above))
    return _boxed(box, parent, level).join(above, by + _keys(parent))


def _blocks(stations: DataFrame, entry: Column, k: int, by: list[str]) -> DataFrame:
    """Stations in blocks of about BLOCK: squares of the coarse lattice, halved as often as their own number asks for."""
    here = Window.partitionBy(*by, "lat", "lon").orderBy("seq")
    first = stations.withColumn("__n", F.row_number().over(here)).where(F.col("__n") <= k)
    size, square = SIZES[3], ["__sy", "__sx"]
    dealt = first.select(*by, "lat", "lon", F.floor(F.col("lat") / size).alias("__sy"), F.floor(F.col("lon") / size).alias("__sx"), entry.alias("s"))
    halved = F.least(F.greatest(F.ceil(F.log2(F.count(F.lit(1)) / BLOCK) / 2), F.lit(0)), F.lit(20))
    cut = dealt.join(dealt.groupBy(*by, *square).agg((size / F.pow(F.lit(2.0), halved)).alias("__size")), by + square)
    place = F.struct("lat", "lon", F.col("s.seq").alias("seq"))
    outer = F.array_distinct(F.array(F.min_by(place, "lat"), F.max_by(place, "lat"), F.min_by(place, "lon"), F.max_by(place, "lon")))
    key = F.struct(*square, F.floor(F.col("lat") / F.col("__size")).alias("y"), F.floor(F.col("lon") / F.col("__size")).alias("x"))
    return cut.groupBy(*by, key.alias("__id")).agg(*_bounds("lat", "lon"), outer.alias("outer"), F.collect_list("s").alias("__s"))


def _last(blocks: DataFrame, by: list[str]) -> int:
    """The level of boxes that take their stations from blocks, the finer the more stations there are in the fullest box."""
    counts = blocks.groupBy(*by, F.floor(F.col("y0") / SIZES[2]), F.floor(F.col("x0") / SIZES[2])).agg(F.sum(F.size("__s")).alias("n"))
    most, last = counts.agg(F.max("n")).first()[0] or 0, 2
    while most > TAKEN and last:
        most, last = most / 16, last - 1
    return last


def _pairs(finest: DataFrame, of: int, blocks: DataFrame, last: int, k: int, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Boxes of level last with the ids of the blocks that they can need, a row each; and the columns of the boxes."""
    level, above = blocks.groupBy(*by).agg(F.collect_list(F.struct("__id", *BOUNDS, "outer")).alias("__bl")), None
    for i in range(4, last - 1, -1):
        box = _under(finest, level, i, above, by, of)
        kept = _reached(F.col("__bl"), F.flatten(F.transform("__bl", lambda b: b["outer"])), k, *WITHIN)
        level, above = box.select(*by, *_keys(i), *(BOUNDS if i == last else ()), kept.alias("__bl")), i
    box = [*by, *_keys(last), *BOUNDS]
    return level.select(*box, F.explode(F.col("__bl")["__id"]).alias("__id")), box


def _taken(finest: DataFrame, stations: DataFrame, entry: Column, k: int, by: list[str]) -> tuple[DataFrame, int]:
    """Boxes of some level with the stations they can need, from blocks; and that level."""
    blocks = checkpoints.cut(_blocks(stations, entry, k, by))
    last = _last(blocks, by)
    pairs, box = _pairs(finest, 0, blocks, last, k, by)
    lists = pairs.join(blocks.select(*by, "__id", "__s"), [*by, "__id"]).groupBy(*box).agg(F.flatten(F.collect_list("__s")).alias("__st"))
    return lists.select(*by, *_keys(last), _reached(F.col("__st"), F.col("__st"), k, *STATION).alias("__st")), last


def nearest_by_rank(targets: DataFrame, stations: DataFrame, k: int, key: str, payload: Sequence[str]) -> DataFrame:
    """The same pairs as rows (target columns, rank, d, s), by a join and a rank: simplest, for small inputs and as a check."""
    t, s = targets.alias("t"), stations.select(F.struct("lat", "lon", "seq", *(c for c in payload if c not in ("lat", "lon", "seq"))).alias("s")).alias("s")
    pairs = t.crossJoin(F.broadcast(s)).withColumn("d", degrees_apart(F.col("t.lat"), F.col("t.lon"), F.col("s.s.lat"), F.col("s.s.lon")))
    w = Window.partitionBy(f"t.{key}").orderBy("d", F.col("s.s.seq"))
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

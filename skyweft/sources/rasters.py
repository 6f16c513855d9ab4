"""Rasters and polygons: decoding files into long tables, and writing products.

A raster becomes rows (tile, r, c, lat, lon, value) once; Parquet is what everything else reads. Decoders are plain Python over whole files, one task
a file: baseline GeoTIFF (strips or tiles, uncompressed or deflate, integer or float samples) and NetCDF-3 (classic and 64-bit offset).
"""

from __future__ import annotations

import json
import re
import struct
import urllib.request
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CELLS = "path string, r bigint, c bigint, lat double, lon double, value double"
#: Fixed value: how a tile's file name gives its south-west corner.
TILE_NAME = r"^ASTGTM2_N(\d{2})E(\d{3})_dem\.tif"


def tile_corner(path: Column) -> tuple[Column, Column]:
    """(lat, lon) from a file name, NULLs if it isn't a tile's."""
    name = F.element_at(F.split(path, "/"), -1)
    part = lambda i: F.nullif(F.regexp_extract(name, TILE_NAME, i), F.lit("")).try_cast("int")
    return part(1), part(2)


def parse_tile_name(name: str) -> tuple[int | None, int | None]:
    m = re.match(TILE_NAME, name)
    return (int(m[1]), int(m[2])) if m else (None, None)


_TIFF_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def read_geotiff(data: bytes, masked: bool = False) -> tuple[np.ndarray, tuple[float, float, float, float]]:
    """(values, (west edge, north edge, x step, y step)) of the first band; y step is negative for a north-up raster. masked: nodata becomes NaN."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if not order or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    tags: dict[int, tuple] = {}
    at = struct.unpack_from(order + "I", data, 4)[0]
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, count, where = struct.unpack_from(order + "HHII", data, at + 2 + 12 * i)
        code = _TIFF_TYPES.get(kind)
        if code is None:
            continue
        size = struct.calcsize("=" + code) * count
        start = at + 2 + 12 * i + 8 if size <= 4 else where
        tags[tag] = (data[start : start + count],) if code == "s" else struct.unpack_from(order + code * count, data, start)
    width, height = tags[256][0], tags[257][0]
    bits, form = tags.get(258, (8,))[0], tags.get(339, (1,))[0]
    kind = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[form] }{bits // 8}")
    packed, predictor = tags.get(259, (1,))[0], tags.get(317, (1,))[0]
    if packed not in (1, 8, 32946) or tags.get(277, (1,))[0] != 1:
        raise ValueError("only single-band rasters, uncompressed or deflated, are read")
    tiled = 324 in tags
    offsets, sizes = (tags[324], tags[325]) if tiled else (tags[273], tags[279])
    bw, bh = (tags[322][0], tags[323][0]) if tiled else (width, tags.get(278, (height,))[0])
    out = np.zeros((height, width), kind.newbyteorder("="))
    across = -(-width // bw)
    for i, (start, size) in enumerate(zip(offsets, sizes)):
        part = data[start : start + size]
        part = part if packed == 1 else zlib.decompress(part)
        y, x = i // across * bh, i % across * bw
        rows = bh if tiled else min(bh, height - y)
        block = np.frombuffer(part, kind, rows * bw).reshape(rows, bw).astype(out.dtype)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=block.dtype)
        out[y : y + rows, x : x + bw] = block[: height - y, : width - x]
    step, tie = tags.get(33550, (1.0, 1.0, 0.0)), tags.get(33922, (0, 0, 0, 0, 0, 0))
    values = out.astype(float)
    if masked and 42113 in tags:
        values[values == float(tags[42113][0].split(b"\0")[0])] = np.nan
    return values, (tie[3] - tie[0] * step[0], tie[4] + tie[1] * step[1], step[0], -step[1])


def write_geotiff(values: np.ndarray, west: float, north: float, x_step: float, y_step: float, nodata: float | None = None) -> bytes:
    """A small uncompressed float64 GeoTIFF."""
    height, width = values.shape
    body = values.astype("<f8").tobytes()
    text = (str(nodata).encode() + b"\0") if nodata is not None else None
    doubles = [(33550, struct.pack("<3d", x_step, abs(y_step), 0)), (33922, struct.pack("<6d", 0, 0, 0, west, north, 0))]
    entries = [(256, 4, 1, width), (257, 4, 1, height), (258, 3, 1, 64), (259, 3, 1, 1), (262, 3, 1, 1), (273, 4, 1, None), (277, 3, 1, 1), (278, 4, 1, height), (279, 4, 1, len(body)), (339, 3, 1, 3)]
    n = len(entries) + 2 + (text is not None)
    at = 8 + 2 + 12 * n + 4
    extra, table = b"", []
    for tag, raw in doubles:
        table.append((tag, 12, len(raw) // 8, at + len(extra)))
        extra += raw
    if text is not None:
        table.append((42113, 2, len(text), at + len(extra) if len(text) > 4 else int.from_bytes(text.ljust(4, b"\0"), "little")))
        extra += text if len(text) > 4 else b""
    table += [(t, k, c, at + len(extra) if v is None else v) for t, k, c, v in entries]
    head = struct.pack("<2sHIH", b"II", 42, 8, n) + b"".join(struct.pack("<HHII", *e) for e in sorted(table)) + struct.pack("<I", 0)
    return head + extra + body


_NC_TYPES = {1: "b", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}


def read_netcdf(data: bytes) -> dict[str, tuple[tuple[str, ...], np.ndarray, dict]]:
    """{variable: (dimension names, values, attributes)} of a NetCDF-3 file."""
    if data[:3] != b"CDF" or data[3] not in (1, 2):
        raise ValueError("not a NetCDF-3 file")
    wide, at = data[3] == 2, 8
    records = struct.unpack_from(">i", data, 4)[0]

    def number() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from(">i", data, at - 4)[0]

    def name() -> str:
        nonlocal at
        n = number()
        at += n + -n % 4
        return data[at - n - -n % 4 : at - -n % 4].decode()

    def attributes() -> dict:
        nonlocal at
        number()
        out = {}
        for _ in range(number()):
            key, kind, n = name(), number(), number()
            dtype = np.dtype(_NC_TYPES[kind])
            raw = data[at : at + n * dtype.itemsize]
            at += n * dtype.itemsize + -(n * dtype.itemsize) % 4
            out[key] = raw.decode("utf-8", "replace") if kind == 2 else np.frombuffer(raw, dtype).tolist()
        return out

    number()
    dims = [(name(), number()) for _ in range(number())]
    attributes()
    number()
    found, step = [], 0
    for _ in range(number()):
        key = name()
        of = [number() for _ in range(number())]
        extra = attributes()
        kind, size = number(), number()
        at += 8 if wide else 4
        start = struct.unpack_from(">q" if wide else ">i", data, at - (8 if wide else 4))[0]
        recorded = bool(of) and dims[of[0]][1] == 0
        step += size if recorded else 0
        found.append((key, of, extra, np.dtype(_NC_TYPES[kind]), start, recorded))
    out = {}
    for key, of, extra, dtype, start, recorded in found:
        shape = [dims[d][1] or records for d in of]
        if recorded:
            one = int(np.prod(shape[1:], dtype=int))
            values = np.concatenate([np.frombuffer(data, dtype, one, start + i * step) for i in range(records)]) if records else np.zeros(0, dtype)
        else:
            values = np.frombuffer(data, dtype, int(np.prod(shape, dtype=int)), start)
        values = values.reshape(shape)
        if dtype.kind == "f" or "scale_factor" in extra or "_FillValue" in extra:
            raw, values = values, values.astype(float)
            for key_ in ("_FillValue", "missing_value"):
                if key_ in extra:
                    values[raw == extra[key_][0]] = np.nan
            values = values * extra.get("scale_factor", [1.0])[0] + extra.get("add_offset", [0.0])[0]
        out[key] = (tuple(dims[d][0] for d in of), values, extra)
    return out


def product_variable(names: list[str]) -> str:
    """Which variable holds a product's field: visibility, then vis000, then the first."""
    for wanted in ("visibility", "vis000", "elevation"):
        if wanted in names:
            return wanted
    return names[0]


def _cells(path: str, values: np.ndarray, lats: np.ndarray, lons: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Row by row, so that a raster's long form is never whole in memory."""
    cols = np.arange(len(lons))
    step = max(1, 100_000 // max(1, len(lons)))
    for r in range(0, len(lats), step):
        part = values[r : r + step]
        n = len(part)
        flat = part.astype(float).ravel()
        yield pa.record_batch(
            [pa.array([path] * flat.size), pa.array(np.repeat(np.arange(r, r + n), len(cols))), pa.array(np.tile(cols, n)), pa.array(np.repeat(lats[r : r + n].astype(float), len(cols))), pa.array(np.tile(lons.astype(float), n)), pa.array(flat, mask=np.isnan(flat))],
            names=["path", "r", "c", "lat", "lon", "value"],
        )


def read_rasters(spark: SparkSession, path: str, masked: bool = True, skip_bad: bool = False) -> DataFrame:
    """GeoTIFF files as long rows, latitudes ascending whichever way a file runs; lat and lon are cell centres. skip_bad: a file that can't be decoded
    is one row with NULLs but for its path, so that a directory isn't lost to one bad tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    values, (west, north, dx, dy) = read_geotiff(data, masked)
                except (ValueError, KeyError, struct.error, zlib.error):
                    if not skip_bad:
                        raise
                    yield pa.record_batch([pa.array([name]), *(pa.array([None], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()))], names=["path", "r", "c", "lat", "lon", "value"])
                    continue
                lats = north + (np.arange(values.shape[0]) + 0.5) * dy
                lons = west + (np.arange(values.shape[1]) + 0.5) * dx
                if dy < 0:
                    values, lats = values[::-1], lats[::-1]
                yield from _cells(name, values, lats, lons)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, CELLS)


def read_grids(spark: SparkSession, path: str) -> DataFrame:
    """NetCDF-3 products as long rows: the field variable's first time and level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = read_netcdf(data)
                field = product_variable([k for k, (dims, _, _) in found.items() if len(dims) >= 2])
                values = found[field][1]
                while values.ndim > 2:
                    values = values[0]
                axis = lambda *names: next(found[n][1] for n in names if n in found)
                yield from _cells(name, values, axis("lat", "latitude", "y"), axis("lon", "longitude", "x"))

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, CELLS)


def read_rings(text: str) -> list[list[tuple[float, float]]]:
    """The outer rings (lon, lat) of a GeoJSON document; ValueError if it has none."""
    rings: list[list[tuple[float, float]]] = []

    def walk(node) -> None:
        kind = node.get("type")
        if kind == "FeatureCollection":
            for f in node["features"]:
                walk(f)
        elif kind == "Feature":
            walk(node["geometry"] or {})
        elif kind == "GeometryCollection":
            for g in node["geometries"]:
                walk(g)
        elif kind == "Polygon":
            rings.append([(float(p[0]), float(p[1])) for p in node["coordinates"][0]])
        elif kind == "MultiPolygon":
            rings.extend([(float(p[0]), float(p[1])) for p in polygon[0]] for polygon in node["coordinates"])

    walk(json.loads(text))
    if not rings:
        raise ValueError("the boundary is empty")
    return rings


def file_server_url(url: str) -> str:
    """The download address that belongs to an OPeNDAP address."""
    return url.replace("/dodsC/", "/fileServer/")


def download(url: str, timeout: float = 30.0) -> bytes:
    """A product's bytes, within the time."""
    with urllib.request.urlopen(file_server_url(url), timeout=timeout) as answer:
        return answer.read()


def blocks_geojson(runs: DataFrame, west: float, south: float, step: float) -> DataFrame:
    """(block_id, cls, geojson): each block of outlines() as a MultiPolygon of its runs, one row a block; made of expressions, so blocks of any number are
    written by the executors."""
    x0, x1, y0, y1 = F.lit(west) + F.col("c0") * step, F.lit(west) + (F.col("c1") + 1) * step, F.lit(south) + F.col("r") * step, F.lit(south) + (F.col("r") + 1) * step
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    ring = F.concat(F.lit("[["), F.concat_ws(",", *(F.format_string("[%.6f,%.6f]", a, b) for a, b in corners)), F.lit("]]"))
    parts = runs.groupBy("block_id", "cls").agg(F.array_sort(F.collect_list(F.struct("r", "c0", ring.alias("ring")))).alias("parts"))
    body = F.concat_ws(",", F.transform("parts", lambda p: p["ring"]))
    return parts.select("block_id", "cls", F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), body, F.lit("]}")).alias("geojson"))


def write_grid(grid: DataFrame, path: str, partition: tuple[str, ...] = ("source_type", "date", "slot"), attributes: dict | None = None) -> None:
    """A product as Parquet partitioned by what it is looked up by, replaced partition by partition, and its attributes beside it."""
    spark = grid.sparkSession
    grid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*partition).parquet(path)
    if attributes:
        rows = [(k, json.dumps(v)) for k, v in sorted(attributes.items())]
        spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}_meta")


def write_csv(table: DataFrame, path: str) -> None:
    """CSV with a header and a byte order mark on its first column's name, as spreadsheets like it."""
    first, *rest = table.columns
    table.select(F.col(first).alias("﻿" + first), *rest).write.mode("overwrite").option("header", True).csv(path)


def read_models(spark: SparkSession, paths: dict[str, str], schema: str) -> DataFrame:
    """The summaries of several models by name, as one table; a model without files is left out."""
    found = None
    for model, path in paths.items():
        file = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(file):
            continue
        rows = spark.read.schema(schema).option("header", True).csv(path).withColumn("model", F.lit(model))
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        raise ValueError("no model has a summary")
    return found

"""Products as files: NetCDF-3 and PNG bytes of a slot's grid, and the atomic publication of a slot's outputs.

The grid of one slot is as large as the target grid, whatever the number of slots, and becomes files in one task; slots are spread over the cluster.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ..commits import create_once, read_text
from ..operators.scoring import COLOUR_SEGMENTS

FILL = 9.969209968386869e36
#: The colours at the ends of the colour scale's segments, in between they are mixed.
ANCHORS = ((94, 0, 74), (215, 48, 39), (254, 224, 139), (166, 217, 106), (26, 152, 80))


def write_netcdf(lat: np.ndarray, lon: np.ndarray, variables: dict[str, np.ndarray], attributes: dict[str, dict] | None = None) -> bytes:
    """A NetCDF-3 file of (lat, lon) variables as 64-bit floats, missing cells as fill values. attributes: texts and numbers by variable, "" for the file's."""
    attributes = attributes or {}
    text = lambda s: struct.pack(">i", len(s.encode())) + s.encode() + b"\0" * (-len(s.encode()) % 4)

    def listed(found: dict) -> bytes:
        if not found:
            return struct.pack(">ii", 0, 0)
        out = struct.pack(">ii", 12, len(found))
        for key, value in found.items():
            out += text(key)
            out += struct.pack(">i", 2) + text(value) if isinstance(value, str) else struct.pack(">iid", 6, 1, float(value))
        return out

    dims = [("lat", len(lat)), ("lon", len(lon))]
    each = [("lat", (0,), np.asarray(lat, float), attributes.get("lat", {})), ("lon", (1,), np.asarray(lon, float), attributes.get("lon", {}))]
    for name, values in variables.items():
        if values.shape != (len(lat), len(lon)):
            raise ValueError(f"{name} is not a grid of lat and lon")
        each.append((name, (0, 1), np.where(np.isnan(values), FILL, values), {"_FillValue": FILL} | attributes.get(name, {})))
    head = b"CDF\x02" + struct.pack(">i", 0) + struct.pack(">ii", 10, len(dims)) + b"".join(text(n) + struct.pack(">i", size) for n, size in dims) + listed(attributes.get("", {}))
    described = [text(n) + struct.pack(f">i{len(of)}i", len(of), *of) + listed(a) + struct.pack(">ii", 6, min(8 * v.size, 2**31 - 4)) for n, of, v, a in each]
    at = len(head) + 8 + sum(len(d) + 8 for d in described)
    places = []
    for *_, v, _a in each:
        places.append(at)
        at += 8 * v.size
    table = b"".join(d + struct.pack(">q", p) for d, p in zip(described, places))
    return head + struct.pack(">ii", 11, len(each)) + table + b"".join(v.astype(">f8").tobytes() for *_, v, _a in each)


def colours() -> np.ndarray:
    """Red, green, blue and alpha of each colour bin, and of a missing cell (transparent) behind them."""
    parts = [np.linspace(a, b, n, endpoint=False) for (_, n), a, b in zip(COLOUR_SEGMENTS, ANCHORS, ANCHORS[1:])]
    opaque = np.concatenate(parts).round().astype(np.uint8)
    return np.vstack([np.hstack([opaque, np.full((len(opaque), 1), 255, np.uint8)]), np.zeros((1, 4), np.uint8)])


def write_png(bins: np.ndarray) -> bytes:
    """A picture of colour bins, a pixel a cell, rows from north to south; negative bins are missing."""
    table = colours()
    pixels = table[np.where(bins < 0, len(table) - 1, bins)]
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    lines = np.concatenate([np.zeros((len(bins), 1), np.uint8), pixels.reshape(len(bins), -1)], axis=1)
    head = struct.pack(">IIBBBBB", bins.shape[1], bins.shape[0], 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(lines.tobytes(), 6)) + part(b"IEND", b"")


def bins_of(km: np.ndarray) -> np.ndarray:
    """Colour bins, -1 where a value is missing."""
    out, low, first = np.full(km.shape, -1), -np.inf, 0
    with np.errstate(invalid="ignore"):
        for high, n in COLOUR_SEGMENTS:
            base = 0.0 if first == 0 else low
            inside = (km >= low) & (km < high)
            out[inside] = first + np.clip(np.floor((km[inside] - base) / (high - base) * n), 0, n - 1)
            low, first = high, first + n
        out[km >= low] = first - 1
    return out


def product_files(grid: DataFrame, by: Sequence[str] = ("slot",), value: str = "v", to_km: float = 0.001, units: str = "m") -> DataFrame:
    """grid (by, r, c, lat, lon, value) -> (by, netcdf, png): each slot's files."""
    kinds = ", ".join(f"{c} {grid.schema[c].dataType.simpleString()}" for c in by)

    def files(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        r, c = rows["r"].to_numpy(), rows["c"].to_numpy()
        values = np.full((r.max() - r.min() + 1, c.max() - c.min() + 1), np.nan)
        values[r - r.min(), c - c.min()] = rows[value].to_numpy(float)
        lat, lon = (np.full(n, np.nan) for n in values.shape)
        lat[r - r.min()], lon[c - c.min()] = rows["lat"], rows["lon"]
        made = write_netcdf(lat, lon, {"visibility": values}, {"visibility": {"units": units}})
        north_first = values[::-1] if lat[0] < lat[-1] else values
        return pd.DataFrame([{**dict(zip(by, key)), "netcdf": made, "png": write_png(bins_of(north_first * to_km))}])

    return grid.select(*by, "r", "c", "lat", "lon", value).groupBy(*by).applyInPandas(files, f"{kinds}, netcdf binary, png binary")


class Publication:
    """A slot's outputs, all or none: they are written into a new folder and seen once the slot's next pointer, which names the folder, appears. A later
    publication of the slot replaces all of them at once; who has opened the older ones may read on."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _version(self, slot: str) -> int:
        folder = self._path(f"{self.root}/slots/{slot}")
        if not self._fs.exists(folder):
            return 0
        return max((int(f.getPath().getName()) for f in self._fs.listStatus(folder) if f.getPath().getName().isdigit()), default=0)

    def outputs(self, slot: str) -> dict[str, str]:
        """The paths of what is published for a slot, by name; none before the first publication."""
        version = self._version(slot)
        return json.loads(read_text(self.spark, f"{self.root}/slots/{slot}/{version}")) if version else {}

    def publish(self, slot: str, writers: dict[str, Callable[[str], None]]) -> dict[str, str]:
        """Calls each writer with its path. If one raises, nothing is published and what there is is deleted."""
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        paths = {name: f"{folder}/{name}" for name in writers}
        try:
            for name, write in writers.items():
                write(paths[name])
        except Exception:
            self._fs.delete(self._path(folder), True)
            raise
        while not create_once(self.spark, f"{self.root}/slots/{slot}/{self._version(slot) + 1}", json.dumps(paths)):
            pass  # another writer's publication is older now
        return paths

    def write_bytes(self, data: bytes) -> Callable[[str], None]:
        """A writer of one file."""

        def write(path: str) -> None:
            out = self._fs.create(self._path(path), True)
            out.write(bytearray(data))
            out.close()

        return write

"""Product files and their publication."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.operators import grids, scoring
from skyweft.sources import products, rasters


def test_netcdf_reads_back():
    values = np.array([[1.0, np.nan, 3.5], [4.0, 5.0, -6.25]])
    data = products.write_netcdf(np.array([21.0, 22.0]), np.array([110.0, 111.0, 112.0]), {"visibility": values, "x": values * 2}, {"visibility": {"units": "m", "beta": 10}, "": {"title": "t"}})
    found = rasters.read_netcdf(data)
    assert found["visibility"][0] == ("lat", "lon") and found["visibility"][2]["units"] == "m" and found["visibility"][2]["beta"] == [10.0]
    assert np.array_equal(found["visibility"][1], values, equal_nan=True) and np.array_equal(found["x"][1], values * 2, equal_nan=True)
    assert found["lat"][1].tolist() == [21.0, 22.0] and found["lon"][1].tolist() == [110.0, 111.0, 112.0]
    with pytest.raises(ValueError):
        products.write_netcdf(np.zeros(1), np.zeros(1), {"v": np.zeros((2, 2))})


def pixels(png):
    width, height = struct.unpack(">II", png[16:24])
    n = struct.unpack(">I", png[33:37])[0]
    lines = np.frombuffer(zlib.decompress(png[41 : 41 + n]), np.uint8).reshape(height, 1 + 4 * width)
    return lines[:, 1:].reshape(height, width, 4)


def test_pictures_have_the_bins_colours(spark):
    km = np.array([[0.0, 0.99, 1.01], [9.99, 10.01, 19.99], [20.01, 35.0, np.nan], [-1.0, 1.0, 30.0]])
    bins = products.bins_of(km)
    flat = spark.createDataFrame([(i, None if np.isnan(x) else float(x)) for i, x in enumerate(km.ravel())], "i int, km double")
    wanted = {r.i: -1 if r.b is None else r.b for r in flat.select("i", scoring.colour_bin(F.col("km")).alias("b")).collect()}
    assert bins.ravel().tolist() == [wanted[i] for i in range(km.size)]
    shown, table = pixels(products.write_png(bins)), products.colours()
    assert np.array_equal(shown, table[np.where(bins < 0, len(table) - 1, bins)]) and shown[2, 2, 3] == 0
    assert not np.array_equal(shown[0, 1], shown[0, 2]) and not np.array_equal(shown[1, 0], shown[1, 1])


def test_files_of_each_slot(spark):
    grid = grids.target_grid(spark, 110.0, 21.0, 110.3, 21.2, 0.1).crossJoin(spark.range(2).withColumnRenamed("id", "slot")).withColumn("v", F.col("r") * 100.0 + F.col("c") + 1000 * F.col("slot"))
    found = {r.slot: r for r in products.product_files(grid).collect()}
    assert set(found) == {0, 1}
    values = rasters.read_netcdf(bytes(found[1].netcdf))["visibility"][1]
    assert values.shape == (3, 4) and values[2, 3] == 1203.0
    assert pixels(bytes(found[0].png)).shape == (3, 4, 4)


def test_a_slot_is_published_as_a_whole(spark, tmp_path):
    shelf = products.Publication(spark, f"file://{tmp_path}/out")
    assert shelf.outputs("0800") == {}
    names = ("stations", "grid", "netcdf", "png")
    first = shelf.publish("0800", {n: shelf.write_bytes(n.encode()) for n in names})
    assert shelf.outputs("0800") == first and set(first) == set(names)

    def broken(path):
        raise OSError("no space")

    with pytest.raises(OSError):
        shelf.publish("0800", {"stations": shelf.write_bytes(b"x"), "grid": broken})
    assert shelf.outputs("0800") == first
    second = shelf.publish("0800", {n: shelf.write_bytes(b"2") for n in names})
    assert shelf.outputs("0800") == second != first
    assert all(open(p.removeprefix("file://"), "rb").read() == b"2" for p in second.values())
    assert open(first["png"].removeprefix("file://"), "rb").read() == b"png"  # an open reader goes on

"""Cell ids of the half-degree grid, as column arithmetic.

The globe has 360 rows of 720 cells; ids count from 1 in the south-west corner,
eastwards, then northwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROW, CELLS = 720, 259_200


def cell_id(lat: Column, lon: Column) -> Column:
    """The id of the cell whose centre is (lat, lon)."""
    return (((lat + 90.25) * 2 - 1) * ROW + (lon + 180.25) * 2).cast("int")


def cell_lat(cell: Column) -> Column:
    return F.floor((cell - 1) / ROW) / 2 - 89.75


def cell_lon(cell: Column) -> Column:
    return F.pmod(cell - 1, F.lit(ROW)) / 2 - 179.75


def bin_centre(x: Column, step: float = 0.5) -> Column:
    """The centre of the bin that holds a coordinate; longitudes over 180 wrap."""
    wrapped = F.when(x > 180, x - 360).otherwise(x)
    return F.floor(wrapped / step) * step + step / 2


def nearest_centre(x: Column, step: float = 0.5) -> Column:
    """The nearest cell centre; a coordinate on an edge goes to the even neighbour."""
    return F.bround((x - step / 2) / step) * step + step / 2


def snap_down(x: Column, step: float) -> Column:
    return F.floor(x / step) * step


def snap_up(x: Column, step: float) -> Column:
    return F.ceil(x / step) * step


def tile_name(lat: Column, lon: Column) -> Column:
    """The 10-degree tile, named by its north-west corner, such as 10N_020W."""
    top = (F.floor(lat / 10) * 10 + 10).cast("int")
    left = (F.floor(lon / 10) * 10).cast("int")
    return F.concat(
        F.lpad(F.abs(top).cast("string"), 2, "0"), F.when(top >= 0, "N").otherwise("S"), F.lit("_"),
        F.lpad(F.abs(left).cast("string"), 3, "0"), F.when(left >= 0, "E").otherwise("W"),
    )


def tile_corner(name: Column) -> tuple[Column, Column]:
    """The south-west corner (lat, lon) of the 10-degree tile of that name; the inverse of ``tile_name``."""
    lat, lon = F.substring(name, 1, 2).cast("int"), F.substring(name, 5, 3).cast("int")
    top = F.when(F.substring(name, 3, 1) == "N", lat).otherwise(-lat)
    return top - 10, F.when(F.substring(name, 8, 1) == "E", lon).otherwise(-lon)


def tile_cells(name: Column) -> Column:
    """The ids of the 400 cells of a 10-degree tile."""
    south, west = tile_corner(name)
    steps = F.sequence(F.lit(0), F.lit(19))
    row = F.transform(steps, lambda i: F.transform(steps, lambda j: cell_id(south + 0.25 + i / 2, west + 0.25 + j / 2)))
    return F.flatten(row)


def neighbours(cell: Column, keep_centre: bool = True, last: int | None = CELLS) -> Column:
    """The ids of the 3 x 3 block around a cell, wrapped at the date line and cut at the poles; a grid without a ``last`` cell has no northern end."""
    shifts = [(row, col) for row in (-1, 0, 1) for col in (-1, 0, 1) if keep_centre or (row, col) != (0, 0)]
    place = F.pmod(cell - 1, F.lit(ROW))
    around = []
    for row, col in shifts:
        turn = F.lit(0)
        if col < 0:
            turn = F.when(place == 0, ROW).otherwise(0)
        elif col > 0:
            turn = F.when(place == ROW - 1, -ROW).otherwise(0)
        around.append((cell + row * ROW + col + turn).cast("int"))
    return F.filter(F.array(*around), lambda x: x >= 1 if last is None else x.between(1, last))


def polar(cell: Column) -> Column:
    """True in the rows next to a pole, whose blocks have six cells."""
    return (cell <= ROW) | (cell > CELLS - ROW)

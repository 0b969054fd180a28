"""Scene folders for tests: a hill with a lake, seen by three sensors through drifting round clouds."""

from __future__ import annotations

import datetime
import json
import math
import os

import numpy as np

from quadrille.config import KELVIN, SENSORS
from quadrille.sources.geotiff import encode

CRS, LEFT, TOP, CELLS, SIZE = "EPSG:32633", 500_000.0, 5_400_000.0, 64, 30.0
ZONES = {"North": (20, 12, 34, 30), "South": (34, 12, 50, 30), "East": (20, 30, 50, 52)}  # first and last row and column, ends left out
#: sensor, day, tier, radius of the cloud in cells, and whether its metadata states factors of its own.
SCENES = [
    ("LT05", "20100312", "T1", 9, False), ("LT05", "20100617", "T1", 0, False), ("LE07", "20100703", "T1", 12, False), ("LE07", "20100719", "T1", 6, True), ("LT05", "20101008", "T1", 15, False),
    ("LE07", "20110124", "T1", 5, False), ("LT05", "20110604", "T1", 10, False), ("LC08", "20110620", "T1", 8, True), ("LC08", "20110722", "T1", 100, False), ("LC08", "20110823", "T2", 4, False), ("LE07", "20111111", "T1", 7, False),
]


def factors(own: bool) -> dict[str, float]:
    return {"sr_scale": 3.0e-05, "sr_offset": -0.15, "st_scale": 0.0035, "st_offset": 150.0} if own else {"sr_scale": 2.75e-05, "sr_offset": -0.2, "st_scale": 0.00341802, "st_offset": 149.0}


def ground(day: datetime.date, k: int) -> dict[str, np.ndarray]:
    """Reflectances, temperature and quality word of every cell."""
    row, col = np.mgrid[0:CELLS, 0:CELLS]
    height = 600 * np.exp(-((row - 30) ** 2 + (col - 40) ** 2) / 300)
    summer = math.sin(2 * math.pi * (day.timetuple().tm_yday - 105) / 365)
    lake = (row - 45) ** 2 + (col - 18) ** 2 < 60
    rough = np.sin(1.7 * row + k) * np.cos(2.3 * col - k)
    red = np.where(lake, 0.02, 0.08 - 0.00006 * height + 0.01 * rough)
    nir = np.where(lake, 0.01, 0.22 + 0.12 * summer + 0.0001 * height + 0.02 * rough)
    return {"red": red, "nir": nir, "heat": 18 + 13 * summer - 0.0065 * height - 4 * lake + 0.5 * rough, "lake": lake}


def scene(sensor: str, date: str, tier: str, cloud: int, own: bool, k: int) -> tuple[str, dict[str, bytes]]:
    day = datetime.datetime.strptime(date, "%Y%m%d").date()
    name = f"{sensor}_L2SP_191026_{date}_{day + datetime.timedelta(days=30):%Y%m%d}_02_{tier}"
    g, f, row, col = ground(day, k), factors(own), *np.mgrid[0:CELLS, 0:CELLS]
    qa = np.full((CELLS, CELLS), 64, np.uint16)
    qa[g["lake"]] |= 128
    away = np.hypot(row - (7 * k) % CELLS, col - (11 * k) % CELLS)
    qa[away < cloud + 1], qa[away < cloud], qa[:2] = 2, 8, 1
    sr = lambda v: np.round((v - f["sr_offset"]) / f["sr_scale"])
    s = SENSORS[sensor]
    bands = {s.red: sr(g["red"]), s.nir: sr(g["nir"]), s.thermal: np.round((g["heat"] + KELVIN - f["st_offset"]) / f["st_scale"]), "QA_PIXEL": qa}
    files = {f"{name}_{tag}.TIF": encode(v.astype(np.uint16), LEFT, TOP, SIZE, epsg=32633) for tag, v in bands.items()}
    sections = {
        "IMAGE_ATTRIBUTES": {"CLOUD_COVER": cloud / 2, "SUN_ELEVATION": 40 + k},
        "LEVEL1_RADIOMETRIC_RESCALING": {"REFLECTANCE_MULT_BAND_3": 7e-05, "TEMPERATURE_MULT_BAND_6": 0.5},  # must not be taken
        "LEVEL2_SURFACE_REFLECTANCE_PARAMETERS": {"REFLECTANCE_MULT_BAND_4": f["sr_scale"], "REFLECTANCE_ADD_BAND_4": f["sr_offset"]},
        "LEVEL2_SURFACE_TEMPERATURE_PARAMETERS": {f"TEMPERATURE_MULT_BAND_{s.thermal}": f["st_scale"], f"TEMPERATURE_ADD_BAND_{s.thermal}": f["st_offset"]},
    }
    if k % 2:
        files[f"{name}_MTL.json"] = json.dumps({"LANDSAT_METADATA_FILE": {a: {b: str(v) for b, v in c.items()} for a, c in sections.items()}}).encode()
    else:
        files[f"{name}_MTL.txt"] = "\n".join(line for a, c in sections.items() for line in (f"  GROUP = {a}", *(f"    {b} = {v}" for b, v in c.items()), f"  END_GROUP = {a}")).encode()
    return name, files


def write(folder: str) -> tuple[str, str]:
    """Scene folders and the zone layer below a folder; their two paths."""
    for k, args in enumerate(SCENES):
        name, files = scene(*args, k)
        os.makedirs(f"{folder}/scenes/{name}")
        for file, body in files.items():
            with open(f"{folder}/scenes/{name}/{file}", "wb") as f:
                f.write(body)
    corner = lambda r, c: [LEFT + c * SIZE, TOP - r * SIZE]
    features = [{"type": "Feature", "properties": {"NM_BAIRRO": z}, "geometry": {"type": "Polygon", "coordinates": [[corner(a, b), corner(a, d), corner(c, d), corner(c, b), corner(a, b)]]}} for z, (a, b, c, d) in ZONES.items()]
    with open(f"{folder}/zones.geojson", "w", encoding="utf-8") as f:
        json.dump({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32633"}}, "features": features}, f)
    return f"{folder}/scenes", f"{folder}/zones.geojson"

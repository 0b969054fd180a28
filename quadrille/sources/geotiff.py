"""GeoTIFF bands: their heads, the strips or tiles that a window touches, and whole bands as long tables."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format: field sizes and types, and the tags used.
SIZES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8, 16: 8}
CODES = {1: "B", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, ROWS, STRIP_BYTES, PREDICTOR, TILE_W, TILE_H, TILES, TILE_BYTES, FORMAT, SCALE, TIE, KEYS, NODATA = (
    256, 257, 258, 259, 273, 277, 278, 279, 317, 322, 323, 324, 325, 339, 33550, 33922, 34735, 42113,
)
PROJECTED, GEOGRAPHIC, OWN, TEXTS = 3072, 2048, 32767, 34737


def _widths() -> np.ndarray:
    """Width in bits of each code behind a clear code: it grows one code early, up to 12."""
    n = 258 + np.maximum(0, np.arange(1 << 12) - 1)  # entries in the table when the code is read
    return np.clip(np.floor(np.log2(n + 1)).astype(int) + 1, 9, 12)


CODE_BITS = np.concatenate([[0], np.cumsum(_widths())])


def _resolve(pointer: np.ndarray) -> np.ndarray:
    """Where chains of pointers to earlier places end: places that point to themselves."""
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return pointer
        pointer = further


def lzw_decode(data: bytes) -> bytes:
    """TIFF's variant, a whole run between two clear codes at a time.

    The widths of codes depend on their number alone, so a run's codes are cut out at once.  A code above 257 stands for
    what an earlier code stood for and one byte more; in the output that is a copy of the earlier place, so lengths and
    bytes are found by following pointers to all earlier places at the same time.
    """
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    bit, end, out = 0, 8 * len(data), []
    while bit + 9 <= end:
        count = int(np.searchsorted(CODE_BITS, end - bit, side="right")) - 1
        at = bit + CODE_BITS[:count]
        width = np.diff(CODE_BITS[: count + 1])
        byte = at >> 3
        word = padded[byte] << 16 | padded[byte + 1] << 8 | padded[byte + 2]
        found = (word >> (24 - width - (at & 7)).astype(np.uint32) & ((1 << width) - 1).astype(np.uint32)).astype(np.int64)
        stop = np.flatnonzero((found == 256) | (found == 257))
        n = int(stop[0]) if len(stop) else count
        codes = found[:n]
        if n:
            earlier = np.where(codes < 256, np.arange(n), codes - 258)
            if (earlier[codes > 257] >= np.flatnonzero(codes > 257)).any():
                raise ValueError("damaged LZW data")
            # a copy is one byte longer than what it copies: its length is the length of its chain
            length, pointer = (codes >= 256).astype(np.int64), earlier
            while True:
                more = length[pointer]
                if not more.any():
                    break
                length, pointer = length + more, pointer[pointer]
            length += 1
            start = np.cumsum(length) - length
            owner = np.repeat(np.arange(n), length)
            place = np.arange(len(owner))
            source = np.where(codes[owner] < 256, place, start[earlier[owner]] + place - start[owner])
            out.append(codes[owner[_resolve(source)]].astype(np.uint8))
        if not len(stop) or found[n] == 257:
            break
        bit += int(CODE_BITS[n + 1])
    return np.concatenate(out).tobytes() if out else b""


def lzw_encode(data: bytes) -> bytes:
    acc, bits, out, width = 0, 0, bytearray(), 9

    def put(code: int) -> None:
        nonlocal acc, bits
        acc, bits = acc << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(acc >> bits & 255)
        acc &= (1 << bits) - 1

    put(256)
    table, entry = {bytes([i]): i for i in range(256)}, b""
    following = 258
    for i in range(len(data)):
        longer = entry + data[i : i + 1]
        if longer in table:
            entry = longer
            continue
        put(table[entry])
        table[longer] = following
        following += 1
        if following == 4094:
            put(256)
            table, following, width = {bytes([i]): i for i in range(256)}, 258, 9
        elif following >= 1 << width:
            width += 1
        entry = data[i : i + 1]
    if entry:
        put(table[entry])
        following += 1
        if following >= 1 << width and width < 12:
            width += 1
    put(257)
    if bits:
        out.append(acc << (8 - bits) & 255)
    return bytes(out)


Read = Callable[[int, int], bytes]


def header(read: Read) -> tuple[str, dict[int, tuple]]:
    """Byte order and tags of the first image of a file, classic or big, of which ``read(place, size)`` gives bytes."""
    start = read(0, 16)
    order = {b"II": "<", b"MM": ">"}[start[:2]]
    magic = struct.unpack_from(order + "H", start, 2)[0]
    if magic not in (42, 43):
        raise ValueError("not a TIFF")
    word, count_code, entry = ("I", "H", 12) if magic == 42 else ("Q", "Q", 20)
    at = struct.unpack_from(order + word, start, 4 if magic == 42 else 8)[0]
    size = struct.calcsize(order + count_code)
    (count,) = struct.unpack(order + count_code, read(at, size))
    table, inline = read(at + size, entry * count), entry - 4 - struct.calcsize(word)
    tags: dict[int, tuple] = {}
    for i in range(count):
        tag, kind, n = struct.unpack_from(f"{order}HH{word}", table, entry * i)
        if kind not in CODES and kind != 2:
            continue
        length, where = SIZES[kind] * n, entry * i + entry - inline
        value = table[where : where + length] if length <= inline else read(struct.unpack_from(order + word, table, where)[0], length)
        tags[tag] = (value.rstrip(b"\0 "),) if kind == 2 else struct.unpack(f"{order}{n}{CODES[kind]}", value)
    return order, tags


def tags_of(body: bytes) -> tuple[str, dict[int, tuple]]:
    return header(lambda at, size: body[at : at + size])


def _place(tags: dict[int, tuple]) -> tuple[int, int, float, float, float, str | None]:
    size, tie, keys = tags.get(SCALE, (1.0,))[0], tags.get(TIE, (0.0,) * 6), tags.get(KEYS, ())
    return tags[HEIGHT][0], tags[WIDTH][0], tie[3] - tie[0] * size, tie[4] + tie[1] * size, size, _system(tags, keys)


def _system(tags: dict[int, tuple], keys: tuple) -> str | None:
    """The code of a raster's system, or the definition in its texts; nothing where it has neither."""
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    code = codes.get(PROJECTED, codes.get(GEOGRAPHIC))
    if code and code != OWN:
        return f"EPSG:{code}"
    text = tags.get(TEXTS, (b"",))[0].decode("utf-8", "replace")
    at = min((text.find(k) for k in ("PROJCS[", "GEOGCS[") if k in text), default=-1)
    return text[at:].split("|")[0] if at >= 0 else None


def place(body: bytes) -> tuple[int, int, float, float, float, str | None]:
    """``rows, cols, left, top, size, crs`` from the tags alone."""
    return _place(tags_of(body)[1])


class Band:
    """A band of which only the strips or tiles are read that a window touches.

    Plain, LZW or deflate; predictors 1, 2 and 3.  Other layouts are an error, never misread.
    """

    def __init__(self, read: Read) -> None:
        self.read = read
        self.order, self.tags = header(read)
        tags = self.tags
        self.samples, self.predictor = tags.get(SAMPLES, (1,))[0], tags.get(PREDICTOR, (1,))[0]
        if self.samples != 1 or self.predictor not in (1, 2, 3):
            raise ValueError(f"{self.samples} samples a cell, predictor {self.predictor}")
        self.rows, self.cols, self.left, self.top, self.size, self.crs = _place(tags)
        self.compression = tags.get(COMPRESSION, (1,))[0]
        if self.compression not in (1, 5, 8, 32946):
            raise ValueError(f"compression {self.compression}")
        kind = {1: "u", 2: "i", 3: "f"}[tags.get(FORMAT, (1,))[0]]
        self.dtype = np.dtype(f"{self.order}{kind}{tags[BITS][0] // 8}")
        self.tiled = TILES in tags
        self.width, self.height = (tags[TILE_W][0], tags[TILE_H][0]) if self.tiled else (self.cols, min(self.rows, tags.get(ROWS, (self.rows,))[0]))
        self.offsets, self.sizes = (tags[TILES], tags[TILE_BYTES]) if self.tiled else (tags[STRIPS], tags[STRIP_BYTES])
        self.nodata = float(tags[NODATA][0]) if NODATA in tags else None

    def block(self, i: int) -> np.ndarray:
        """The cells of a strip or tile."""
        raw = self.read(self.offsets[i], self.sizes[i])
        if self.compression == 5:
            raw = lzw_decode(raw)
        elif self.compression != 1:
            raw = zlib.decompress(raw)
        rows = self.height if self.tiled else min(self.height, self.rows - i * self.height)
        native = self.dtype.newbyteorder("=")
        if self.predictor == 3:  # bytes of a row stand by significance, each as its difference from the one before
            planes = np.cumsum(np.frombuffer(raw, np.uint8, rows * self.width * self.dtype.itemsize).reshape(rows, -1), axis=1, dtype=np.uint8)
            planes = planes.reshape(rows, self.dtype.itemsize, self.width).transpose(0, 2, 1)
            return np.ascontiguousarray(planes).view(self.dtype.newbyteorder(">")).reshape(rows, self.width).astype(native)
        cells = np.frombuffer(raw, self.dtype, rows * self.width).reshape(rows, self.width).astype(native)
        return np.cumsum(cells, axis=1, dtype=native) if self.predictor == 2 else cells

    def window(self, row0: int, row1: int, col0: int, col1: int) -> np.ndarray:
        """Cells ``[row0, row1) x [col0, col1)`` as doubles; NaN beyond the band and where it has no data."""
        out = np.full((max(0, row1 - row0), max(0, col1 - col0)), np.nan)
        across = -(-self.cols // self.width)
        a, b, c, d = max(row0, 0), min(row1, self.rows), max(col0, 0), min(col1, self.cols)
        if a >= b or c >= d:
            return out
        for br in range(a // self.height, (b - 1) // self.height + 1):
            for bc in range(c // self.width, (d - 1) // self.width + 1):
                cells = self.block(br * across + bc)
                top, left = br * self.height, bc * self.width
                r0, r1, c0, c1 = max(a, top), min(b, top + len(cells)), max(c, left), min(d, left + self.width)
                out[r0 - row0 : r1 - row0, c0 - col0 : c1 - col0] = cells[r0 - top : r1 - top, c0 - left : c1 - left]
        if self.nodata is not None:
            out[out == self.nodata] = np.nan
        return out


def decode(body: bytes) -> tuple[np.ndarray, tuple[float, float, float]]:
    """The band and ``(left, top, cell size)``.

    Cells of the file's no-data value become NaN, and the band a double.
    """
    band = Band(lambda at, size: body[at : at + size])
    cells = band.window(0, band.rows, 0, band.cols)
    return cells if band.nodata is not None else cells.astype(band.dtype.newbyteorder("=")), (band.left, band.top, band.size)


def encode(band: np.ndarray, left: float, top: float, size: float, compress: bool = True, epsg: int | None = None) -> bytes:
    """One band, little-endian, a strip of 64 rows at a time."""
    band = np.ascontiguousarray(band, band.dtype.newbyteorder("<"))
    height, width = band.shape
    strips = [band[a : a + 64].tobytes() for a in range(0, height, 64)]
    strips = [lzw_encode(s) if compress else s for s in strips]
    kind = {"u": 1, "i": 2, "f": 3}[band.dtype.kind]
    n = len(strips)
    fields: list[tuple[int, int, tuple]] = [
        (WIDTH, 4, (width,)), (HEIGHT, 4, (height,)), (BITS, 3, (band.dtype.itemsize * 8,)), (COMPRESSION, 3, (5 if compress else 1,)), (262, 3, (1,)),
        (STRIPS, 4, (0,) * n), (277, 3, (1,)), (ROWS, 4, (64,)), (STRIP_BYTES, 4, tuple(map(len, strips))), (FORMAT, 3, (kind,)), (SCALE, 12, (size, size, 0.0)), (TIE, 12, (0.0, 0.0, 0.0, left, top, 0.0)),
    ]
    if epsg:  # a projected system, cells as areas
        fields.append((KEYS, 3, (1, 1, 0, 3, 1024, 0, 1, 1, 1025, 0, 1, 1, PROJECTED, 0, 1, epsg)))
    extra = 8 + 2 + 12 * len(fields) + 4
    blobs, places = [], []
    for _, kind_, values in fields:
        long = SIZES[kind_] * len(values) > 4
        places.append(extra if long else None)
        if long:
            blobs.append(SIZES[kind_] * len(values))
            extra += blobs[-1]
    starts = tuple(extra + sum(map(len, strips[:i])) for i in range(n))
    fields = [(t, k, starts if t == STRIPS else v) for t, k, v in fields]
    head, tail = struct.pack("<2sHIH", b"II", 42, 8, len(fields)), b""
    for (tag, kind_, values), place in zip(fields, places, strict=True):
        data = struct.pack(f"<{len(values)}{CODES[kind_]}", *values)
        head += struct.pack("<HHI", tag, kind_, len(values)) + (data.ljust(4, b"\0") if place is None else struct.pack("<I", place))
        tail += data if place is not None else b""
    return head + struct.pack("<I", 0) + tail + b"".join(strips)


PIXELS = "path string, row int, col int, x double, y double, value double, error string"


def _long(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        for path, body in zip(f["path"], f["content"], strict=True):
            try:
                band, (left, top, size) = decode(bytes(body))
            except Exception as e:  # one bad file must not end the run; its error is a row
                yield pd.DataFrame({"path": [path], "row": [None], "col": [None], "x": [None], "y": [None], "value": [None], "error": [repr(e)[:200]]})
                continue
            for a in range(0, len(band), 256):
                part = band[a : a + 256]
                row, col = np.indices(part.shape)
                row, col = row.ravel() + a, col.ravel()
                yield pd.DataFrame({"path": path, "row": row, "col": col, "x": left + (col + 0.5) * size, "y": top - (row + 0.5) * size, "value": part.ravel().astype(float), "error": None})


def read_bands(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Cells of all matching files in long form; an unreadable file is one row with its ``error``."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(_long, PIXELS)


def scene_pixels(bands: DataFrame, pixels: DataFrame) -> DataFrame:
    """Bands side by side: ``scene_id, row, col, x, y, qa, dn_red, dn_nir, dn_st`` by one aggregation over cells."""
    roles = {"file_qa": "qa", "file_red": "dn_red", "file_nir": "dn_nir", "file_lst": "dn_st"}
    names = bands.select("scene_id", F.explode(F.array(*[F.struct(F.col(f).alias("path"), F.lit(r).alias("role")) for f, r in roles.items()])).alias("b")).select("scene_id", "b.*").where("path is not null")
    cells = pixels.where("error is null").join(names, "path")
    return cells.groupBy("scene_id", "row", "col", "x", "y").agg(*[F.max(F.when(F.col("role") == r, F.col("value"))).cast("int").alias(r) for r in roles.values()])

"""Gridded forecasts in GRIB edition 2: a data source, a parser for files that only Spark can read, and an encoder.

``register(spark)`` makes ``spark.read.format("grib")`` available. A task reads
one file: it goes from message to message by the lengths they begin with and
reads the short sections that say what a message is about; data of messages
that filters on member, variable, level, fxx, init or valid_time rule out are
never read. With the option ``values`` set to false no data are read at all, and
there is one row per message. :func:`messages` does the same over a column of
bytes, as ``binaryFile`` gives it, for stores that only Spark's readers reach.

Regular latitude-longitude grids; simple packing, complex packing with or
without spatial differences, and plain IEEE numbers; bitmaps. A file or message
that is cut off, is no GRIB, or uses something else gives one row whose
``error`` says why and whose other columns are null as far as they are unknown.
"""

from __future__ import annotations

import io
import re
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage

SCHEMA = "path string, message int, error string, init timestamp_ntz, member string, variable string, level string, fxx int, valid_time timestamp_ntz, lat double, lon double, value double"
#: Columns that a message's head decides.
HEAD = ("init", "member", "variable", "level", "fxx", "valid_time")

# Fixed values of the format: (discipline, category, number) of what forecasts here use.
VARIABLES = {(0, 0, 0): "t", (0, 1, 11): "sde", (0, 2, 1): "si", (0, 2, 2): "u", (0, 2, 3): "v", (0, 3, 0): "sp", (0, 3, 1): "prmsl", (0, 3, 5): "gh", (0, 4, 7): "sdswrf", (0, 6, 1): "tcc", (2, 0, 0): "lsm"}
# Hours of a unit of time, by its code.
HOURS = {0: 1 / 60, 1: 1, 2: 24, 10: 3, 11: 6, 12: 12, 13: 1 / 3600}
# Kinds of level, by their codes.
LEVELS = {1: "surface", 100: "isobaric", 101: "sea", 103: "above_ground"}
_MISSING = (1 << 32) - 1


class Unreadable(ValueError):
    """A message that is broken or uses a template that isn't known here."""


@dataclass(frozen=True)
class Head:
    """What a message is about, and where its data sections are (offset and length in the file)."""

    init: datetime
    member: str
    variable: str
    level: str
    fxx: int
    grid: bytes
    packing: bytes
    bitmap: tuple[int, int]
    data: tuple[int, int]

    @property
    def valid_time(self) -> datetime:
        return self.init + timedelta(hours=self.fxx)


def _signed(raw: bytes) -> int:
    """Sign and magnitude, as the format has negative numbers."""
    n = int.from_bytes(raw, "big")
    top = 1 << (8 * len(raw) - 1)
    return n if n < top else top - n


def _extent(file, start: int, size: int) -> int:
    """Where the message that begins at an offset ends."""
    file.seek(start)
    intro = file.read(16)
    if len(intro) < 16 or intro[:4] != b"GRIB":
        raise Unreadable("no GRIB message")
    if intro[7] != 2:
        raise Unreadable(f"edition {intro[7]}")
    end = start + int.from_bytes(intro[8:16], "big")
    if not start + 16 < end <= size:
        raise Unreadable("cut off")
    return end


def _heads(file, start: int, end: int) -> Iterator[Head]:
    """The fields of a message; most have one. Data and bitmaps are passed over."""
    file.seek(start + 6)
    discipline = file.read(1)[0]
    at, found = start + 16, {}
    while at < end - 4:
        file.seek(at)
        mark = file.read(6)
        size, number = int.from_bytes(mark[:4], "big"), mark[4]
        if size < 5 or at + size > end - 4:
            raise Unreadable("cut off")
        # A field may use the bitmap of the one before it.
        if number == 7 or (number == 6 and mark[5] != 254):
            found[number] = (at, size)
        elif number != 6:
            file.seek(at)
            found[number] = file.read(size)
        at += size
        if number == 7:
            yield _told(discipline, found)
    file.seek(end - 4)
    if file.read(4) != b"7777":
        raise Unreadable("no end")


def _told(discipline: int, found: dict) -> Head:
    if not {1, 3, 4, 5, 6, 7} <= found.keys() or any(len(found[k]) < least for k, least in ((1, 19), (3, 72), (4, 34), (5, 11))):
        raise Unreadable("sections are missing")
    one, four = found[1], found[4]
    init = datetime(int.from_bytes(one[12:14], "big"), *one[14:19])
    kind = int.from_bytes(four[7:9], "big")
    if kind not in (0, 1, 8, 11):
        raise Unreadable(f"product template {kind}")
    if four[17] not in HOURS:
        raise Unreadable(f"unit of time {four[17]}")
    fxx = _signed(four[18:22]) * HOURS[four[17]]
    if kind in (8, 11):  # a mean or sum up to a time
        stop = four[34:41] if kind == 8 else four[37:44]
        fxx = (datetime(int.from_bytes(stop[:2], "big"), *stop[2:7]) - init).total_seconds() / 3600
    member = "c00" if kind in (0, 8) or four[34] in (0, 1) else f"p{four[35]:02d}"
    key = (discipline, four[9], four[10])
    height = _signed(four[24:28]) / 10.0 ** _signed(four[23:24])
    level = LEVELS.get(four[22], str(four[22])) + (f":{height:g}" if four[22] in (100, 103) else "")
    return Head(init, member, VARIABLES.get(key, "-".join(map(str, key))), level, round(fxx), found[3], found[5], found[6], found[7])


def _coordinates(three: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Latitudes and longitudes of all points in the order of the values."""
    if int.from_bytes(three[12:14], "big") != 0:
        raise Unreadable(f"grid template {int.from_bytes(three[12:14], 'big')}")
    ni, nj = struct.unpack(">II", three[30:38])
    basic, parts = struct.unpack(">II", three[38:46])
    unit = basic / parts if basic not in (0, _MISSING) and parts not in (0, _MISSING) else 1e-6
    first, last = ((_signed(three[a : a + 4]) * unit, _signed(three[a + 4 : a + 8]) * unit) for a in (46, 55))
    mode = three[71]
    if mode & 0b10000 or ni * nj == 0:
        raise Unreadable(f"scanning mode {mode}")
    (lat0, lon0), (lat1, lon1) = first, last
    if not mode & 128 and lon1 < lon0:
        lon1 += 360
    # Rounding brings coordinates back to the decimals that they were written with.
    lat, lon = np.round(np.linspace(lat0, lat1, nj), 6), np.round(np.linspace(lon0, lon1, ni), 6)
    if mode & 32:
        return np.tile(lat, ni), np.repeat(lon, nj)
    return np.repeat(lat, ni), np.tile(lon, nj)


def _numbers(raw: bytes, bits: int, count: int) -> np.ndarray:
    """``count`` unsigned numbers of so many bits each."""
    if not bits:
        return np.zeros(count, np.int64)
    if len(raw) * 8 < bits * count:
        raise Unreadable("cut off")
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f">u{bits // 8}", count).astype(np.int64)
    flags = np.unpackbits(np.frombuffer(raw, np.uint8, -(-bits * count // 8)), count=bits * count).reshape(count, bits)
    out = np.zeros(count, np.int64)
    for k in range(bits):
        out = (out << 1) | flags[:, k]
    return out


def _grouped(five: bytes, raw: bytes, count: int) -> tuple[np.ndarray, np.ndarray | None]:
    """Whole numbers of complex packing, and which are missing (None: none)."""
    kind = int.from_bytes(five[9:11], "big")
    bits, policy = five[19], five[22]
    n, width0, width_bits, length0, step, last, length_bits = struct.unpack(">IBBIBIB", five[31:47])
    at, starts, least, order = 0, [], 0, 0
    if kind == 3:
        order, octets = five[47], five[48]
        if order not in (1, 2):
            raise Unreadable(f"differences of order {order}")
        extra = [raw[i * octets : (i + 1) * octets] for i in range(order + 1)]
        starts, least, at = [int.from_bytes(x, "big") for x in extra[:-1]], _signed(extra[-1]), octets * (order + 1)
    parts = []
    for width in (bits, width_bits, length_bits):
        parts.append(_numbers(raw[at:], width, n))
        at += -(-width * n // 8)
    refs, widths, lengths = parts[0], parts[1] + width0, parts[2] * step + length0
    lengths[-1] = last
    if lengths.sum() != count:
        raise Unreadable("groups don't add up")
    flags = np.unpackbits(np.frombuffer(raw[at:], np.uint8))
    if len(flags) < (widths * lengths).sum():
        raise Unreadable("cut off")
    out, missing = np.repeat(refs, lengths), np.zeros(count, bool)
    # Values of all groups of one width are unpacked together.
    begin, bit = np.cumsum(lengths) - lengths, np.cumsum(widths * lengths) - widths * lengths
    for width in np.unique(widths):
        own = np.flatnonzero(widths == width)
        size = lengths[own]
        inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        places = np.repeat(begin[own], size) + inside
        value = np.zeros(len(places), np.int64)
        for k in range(int(width)):
            value = (value << 1) | flags[np.repeat(bit[own], size) + inside * width + k]
        if policy:
            # The largest number, and by policy 2 also the one below it, mean a missing value: of a group's values, or of its reference where it has no others.
            top = (1 << int(width)) - 1 if width else None
            missing[places] = value > top - policy if width else np.repeat(refs[own] > (1 << bits) - 1 - policy, size)
        out[places] += value
    if kind == 3:
        there = out[~missing]
        there[order:] += least
        there[: min(order, len(there))] = starts[: len(there)]
        if order == 1:
            there = np.cumsum(there)
        elif len(there) > 2:
            # x[i] = d[i] + 2 x[i-1] - x[i-2]: the differences add up first, then what they are differences of.
            rises = np.cumsum(np.concatenate([there[1:2] - there[:1], there[2:]]))
            there = np.concatenate([there[:1], there[0] + np.cumsum(rises)])
        out[~missing] = there
    return out, missing if policy else None


def _values(head: Head, bitmap: bytes, data: bytes, points: int) -> np.ndarray:
    """Values of all points, NaN where they are missing."""
    five = head.packing
    count, kind = struct.unpack(">IH", five[5:11])
    missing = None
    if kind == 4:
        if five[11] not in (1, 2):
            raise Unreadable("precision of numbers")
        if len(data) - 5 < count * 4 * five[11]:
            raise Unreadable("cut off")
        found = np.frombuffer(data, f">f{4 * five[11]}", count, 5).astype(np.float64)
    elif kind in (0, 2, 3):
        reference = struct.unpack(">f", five[11:15])[0]
        binary, decimal = 2.0 ** _signed(five[15:17]), _signed(five[17:19])
        whole, missing = (_numbers(data[5:], five[19], count), None) if kind == 0 else _grouped(five, data[5:], count)
        found = (reference + whole * binary) / 10.0**decimal
    else:
        raise Unreadable(f"data template {kind}")
    if missing is not None:
        found = np.where(missing, np.nan, found)
    if bitmap[5] == 255:
        out = found
    elif bitmap[5] == 0:
        there = np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=6), count=points).astype(bool)
        if there.sum() != count:
            raise Unreadable("bitmap and data don't fit")
        out = np.full(points, np.nan)
        out[there] = found
    else:
        raise Unreadable(f"bitmap {bitmap[5]}")
    if len(out) != points:
        raise Unreadable("grid and data don't fit")
    return out


def _read(file, where: tuple[int, int]) -> bytes:
    file.seek(where[0])
    raw = file.read(where[1])
    if len(raw) < where[1]:
        raise Unreadable("cut off")
    return raw


def _arrow_schema() -> pa.Schema:
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "timestamp_ntz": pa.timestamp("us")}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SCHEMA.split(", ")])


def _batch(path: str, number: int, error: str | None, head: Head | None, lat=None, lon=None, value=None) -> pa.RecordBatch:
    n = 1 if value is None else len(value)
    told = {"path": path, "message": number, "error": error, **{c: getattr(head, c) if head else None for c in HEAD}}
    schema = _arrow_schema()
    columns = [pa.repeat(pa.scalar(told[c], schema.field(c).type), n) for c in told]
    for x in (lat, lon, value):
        columns.append(pa.nulls(n, pa.float64()) if x is None else pa.array(x, pa.float64(), from_pandas=True))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def scan(file, path: str, wanted=lambda head: True, values: bool = True) -> Iterator[pa.RecordBatch]:
    """The rows of an open file. What isn't wanted isn't read; a message that can't be read is one row with an error, and the file's last if it doesn't tell where the next one begins."""
    file.seek(0, io.SEEK_END)
    size, at, number = file.tell(), 0, 0
    while at < size or number == 0:
        head = None
        try:
            end = _extent(file, at, size)
        except Unreadable as e:
            yield _batch(path, number, str(e), None)
            return
        try:
            for head in _heads(file, at, end):
                if not wanted(head):
                    continue
                if values:
                    lat, lon = _coordinates(head.grid)
                    yield _batch(path, number, None, head, lat, lon, _values(head, _read(file, head.bitmap), _read(file, head.data), len(lat)))
                else:
                    yield _batch(path, number, None, head)
        except (Unreadable, ValueError, IndexError, struct.error) as e:
            yield _batch(path, number, str(e) or type(e).__name__, head)
        at, number = end, number + 1


def messages(files: DataFrame, path: str = "path", content: str = "content", values: bool = True) -> DataFrame:
    """The rows of files whose bytes are a column: ``messages(spark.read.format("binaryFile").load(...))``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield from scan(io.BytesIO(raw or b""), name, values=values)

    return files.select(F.col(path).cast("string"), content).mapInArrow(run, SCHEMA)


# The data source


def _holds(filters: tuple, head: Head) -> bool:
    return all(test(getattr(head, column)) for column, test in filters)


def _test(f: Filter):
    """(column, test) of a filter that a message's head decides, or None."""
    if not isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, In, IsNotNull)) or len(f.attribute) != 1 or f.attribute[0] not in HEAD:
        return None
    column, kind = f.attribute[0], type(f)
    value = getattr(f, "value", None)
    if kind is IsNotNull:
        return column, _there
    return column, _Compare(kind.__name__, value)


def _there(value) -> bool:
    return value is not None


@dataclass(frozen=True)
class _Compare:
    kind: str
    value: object

    def __call__(self, x) -> bool:
        v = self.value
        if v is None or (self.kind != "In" and type(v) is not type(x)):
            return True  # left to Spark
        return {"EqualTo": lambda: x == v, "In": lambda: x in v, "GreaterThan": lambda: x > v, "GreaterThanOrEqual": lambda: x >= v, "LessThan": lambda: x < v, "LessThanOrEqual": lambda: x <= v}[self.kind]()


def _store(path: str):
    """(file system, path in it), as executors see them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"[a-z][a-z0-9+.-]*:", path) else (fs.LocalFileSystem(), path)


class GribSource(DataSource):
    """Options: path (a file, or a folder with all files below it), suffix (of files; default any), values.

    Writes rows (name, content): a file for each name below the path, made of the
    contents of its rows in their order. Rows of one name have to be in one partition.
    """

    @classmethod
    def name(cls) -> str:
        return "grib"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> GribReader:
        return GribReader(self.options)

    def writer(self, schema, overwrite: bool) -> GribWriter:
        if overwrite:
            raise ValueError("files are only added; append to a new folder")
        return GribWriter(self.options)


@dataclass
class _File(InputPartition):
    path: str


class GribReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.suffix = options.get("path", ""), options.get("suffix", "")
        self.with_values = options.get("values", "true").lower() != "false"
        self.filters: tuple = ()

    def pushFilters(self, filters: list[Filter]):
        """Filters on what heads say are applied before data are read. Spark applies them again, as rows with an error have no head."""
        self.filters = tuple(t for t in map(_test, filters) if t)
        return filters

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        store, path = _store(self.path)
        info = store.get_file_info(path)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.is_file else [f for f in store.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and "/_staged-" not in f.path]
        return [_File(f.path) for f in sorted(found, key=lambda f: f.path) if f.path.endswith(self.suffix)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.path)
        with store.open_input_file(partition.path) as file:
            yield from scan(file, partition.path, lambda head: _holds(self.filters, head), self.with_values)


@dataclass
class _Written(WriterCommitMessage):
    names: list[str]
    staged: str


class GribWriter(DataSourceWriter):
    """Tasks write to places of their own; the driver moves whole files to theirs once all tasks are done, so a task that is repeated or lost leaves nothing behind."""

    def __init__(self, options):
        self.path = options.get("path", "").rstrip("/")

    def write(self, rows) -> _Written:
        store, path = _store(self.path)
        staged, names, name, out = f"{path}/_staged-{uuid.uuid4().hex}", [], None, None
        store.create_dir(staged, recursive=True)
        try:
            for row in rows:
                if row["name"] != name:
                    if out:
                        out.close()
                    name = row["name"]
                    if name in names:
                        raise ValueError(f"rows of {name} are apart")
                    names.append(name)
                    store.create_dir(f"{staged}/{name}".rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(f"{staged}/{name}")
                out.write(bytes(row["content"]))
        finally:
            if out:
                out.close()
        return _Written(names, staged)

    def commit(self, messages: list) -> None:
        store, path = _store(self.path)
        for m in filter(None, messages):
            for name in m.names:
                store.create_dir(f"{path}/{name}".rpartition("/")[0], recursive=True)
                store.move(f"{m.staged}/{name}", f"{path}/{name}")
            store.delete_dir(m.staged)

    def abort(self, messages: list) -> None:
        store, _ = _store(self.path)
        for m in filter(None, messages):
            store.delete_dir(m.staged)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, with filters pushed to it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(GribSource)


# Slices that a forecast should have


def slices(runs: DataFrame, members: list[str], variables: list[str], first: int = 0, last: int = 240, step: int = 3, product: str = "atmos.25") -> DataFrame:
    """(init, member, variable, fxx, product) of each run: the lead hours, and the coarser product from beyond 240 hours on, which has six-hourly steps."""
    if product == "atmos.5":
        step = max(step, 6)
    hours = F.explode(F.sequence(F.lit(first), F.lit(last), F.lit(step)))
    each = runs.select("init").distinct().select("init", F.explode(F.array(*map(F.lit, members))).alias("member")).select("*", F.explode(F.array(*map(F.lit, variables))).alias("variable")).select("*", hours.alias("fxx"))
    return each.withColumn("product", F.when(F.col("fxx") > 240, "atmos.5").otherwise(product))


# Writing


def encoded(init: datetime, member: int, variable: str, fxx: int, lats: tuple[float, float, int], lons: tuple[float, float, int], values: np.ndarray, decimals: int = 2) -> bytes:
    """One message with simple packing: lats and lons as (first, last, number), values by rows of latitude, NaN where missing."""
    codes = {name: key for key, name in VARIABLES.items()}[variable]
    there = ~np.isnan(values)
    whole = np.round(values[there] * 10**decimals).astype(np.int64)
    # The reference is a 32-bit float; a power of two below the least value is one exactly.
    low = int(whole.min()) if len(whole) else 0
    reference = 0 if low >= 0 else -(1 << (-low).bit_length())
    whole = whole - reference
    bits = int(whole.max()).bit_length() if len(whole) else 0
    flags = ((whole[:, None] >> np.arange(bits - 1, -1, -1)) & 1).astype(np.uint8) if bits else np.zeros(0, np.uint8)
    packed = np.packbits(flags.ravel()).tobytes()

    def signed(n: int, octets: int) -> bytes:
        return (abs(n) | (n < 0) << (8 * octets - 1)).to_bytes(octets, "big")

    def section(number: int, body: bytes) -> bytes:
        return struct.pack(">IB", len(body) + 5, number) + body

    micro = lambda x: signed(round(x * 1e6), 4)
    (lat0, lat1, nj), (lon0, lon1, ni) = lats, lons
    mode = 64 if lat1 > lat0 else 0
    step = lambda a, b, n: abs(round((b - a) / max(n - 1, 1) * 1e6))
    one = struct.pack(">HHBBBHBBBBBBB", 7, 2, 2, 1, 1, init.year, init.month, init.day, init.hour, init.minute, init.second, 0, 1)
    three = struct.pack(">BIBBHBBIBIBIIIII", 0, ni * nj, 0, 0, 0, 6, 0, 0, 0, 0, 0, 0, ni, nj, 0, _MISSING) + micro(lat0) + micro(lon0) + b"\x30" + micro(lat1) + micro(lon1) + struct.pack(">IIB", step(lon0, lon1, ni), step(lat0, lat1, nj), mode)
    four = struct.pack(">HHBBBBBHBBIBBIBBI", 0, 1, codes[1], codes[2], 4, 0, 0, 0, 0, 1, fxx, 1, 0, 0, 255, 0, 0) + struct.pack(">BBB", 1 if member == 0 else 3, member, 0)
    five = struct.pack(">IHf", int(there.sum()), 0, reference) + signed(0, 2) + signed(decimals, 2) + bytes([bits, 0])
    six = b"\xff" if there.all() else b"\x00" + np.packbits(there).tobytes()
    body = section(1, one) + section(3, three) + section(4, four) + section(5, five) + section(6, six) + section(7, packed) + b"7777"
    return b"GRIB" + struct.pack(">HBBQ", 0, codes[0], 2, len(body) + 16) + body


def packed(cells: DataFrame, lats: tuple[float, float, int], lons: tuple[float, float, int], decimals: int = 2) -> DataFrame:
    """(init, member, fxx, variable, content): a message for each field of ``cells`` (init, member as a number, fxx, variable, j, i, value), whose points are as many as the grid has."""

    def run(group: pa.Table) -> pa.Table:
        first = group.slice(0, 1).to_pylist()[0]
        field = np.full(lats[2] * lons[2], np.nan)
        field[group.column("j").to_numpy() * lons[2] + group.column("i").to_numpy()] = group.column("value").to_numpy()
        raw = encoded(first["init"], first["member"], first["variable"], first["fxx"], lats, lons, field, decimals)
        return pa.table({"init": pa.array([first["init"]], pa.timestamp("us")), "member": pa.array([first["member"]], pa.int32()), "fxx": pa.array([first["fxx"]], pa.int32()), "variable": [first["variable"]], "content": pa.array([raw], pa.binary())})

    keys = ["init", "member", "fxx", "variable"]
    return cells.select("init", F.col("member").cast("int").alias("member"), F.col("fxx").cast("int").alias("fxx"), "variable", "j", "i", F.col("value").cast("double").alias("value")).groupBy(*keys).applyInArrow(run, "init timestamp_ntz, member int, fxx int, variable string, content binary")

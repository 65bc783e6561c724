"""GRIB files: round trips through the encoder, packings made by hand, filters, broken files."""

import io
import struct
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from forelight.sources import grib, readers

INIT = datetime(2024, 1, 5, 6)
LATS, LONS = (39.0, 41.4, 5), (248.0, 251.9, 7)


def field(seed, missing=0.3, low=-50, high=90):
    r = np.random.default_rng(seed)
    x = np.round(r.uniform(low, high, 35), 2)
    x[r.random(35) < missing] = np.nan
    return x


def rows(raw, **kw):
    return [r for b in grib.scan(io.BytesIO(raw), "f", **kw) for r in b.to_pylist()]


@pytest.mark.parametrize("missing", [0, 0.4, 1])
@pytest.mark.parametrize("low", [-50, 0, 7])
def test_round_trip(missing, low):
    x = field(1, missing, low)
    out = rows(grib.encoded(INIT, 7, "sde", 246, LATS, LONS, x))
    assert [r["value"] for r in out] == [None if np.isnan(v) else v for v in x]
    assert [(r["lat"], r["lon"]) for r in out] == [(round(a, 6), round(o, 6)) for a in np.linspace(*LATS) for o in np.linspace(*LONS)]
    first = out[0]
    assert (first["init"], first["member"], first["variable"], first["level"], first["fxx"], first["valid_time"], first["message"], first["error"]) == (INIT, "p07", "sde", "surface", 246, datetime(2024, 1, 15, 12), 0, None)
    assert rows(grib.encoded(INIT, 0, "prmsl", 0, (41.4, 39.0, 5), LONS, x))[0]["member"] == "c00"


def sections(raw):
    at, out = 16, []
    while raw[at : at + 4] != b"7777":
        n = int.from_bytes(raw[at : at + 4], "big")
        out.append(raw[at : at + n])
        at += n
    return out


def message(parts):
    body = b"".join(parts) + b"7777"
    return b"GRIB" + struct.pack(">HBBQ", 0, 0, 2, len(body) + 16) + body


def section(number, body):
    return struct.pack(">IB", len(body) + 5, number) + body


def signed(n, octets):
    return (abs(n) | (n < 0) << (8 * octets - 1)).to_bytes(octets, "big")


def bits(values, width):
    text = "".join(f"{v:0{width}b}" for v in values) if width else ""
    return int((text + "0" * (-len(text) % 8)) or "0", 2).to_bytes(-(-len(text) // 8), "big") if text else b""


def grouped(whole, order, size=6, policy=0, missing=()):
    """Sections 5 and 7 of complex packing, with differences of an order (0: none); numbers to two decimals."""
    there = [v for i, v in enumerate(whole) if i not in missing]
    starts, least, d = there[:order], 0, list(there)
    for _ in range(order):
        d = [b - a for a, b in zip(d, d[1:], strict=False)]
    if order:
        least = min(d)
        d = [0] * order + [v - least for v in d]
    d = iter(d)
    stream = [None if i in missing else next(d) for i in range(len(whole))]
    groups = [stream[i : i + size] for i in range(0, len(stream), size)]
    refs, widths, raw = [], [], ""
    for g in groups:
        known = [v for v in g if v is not None]
        if not known:
            refs.append(None)
            widths.append(0)
            continue
        low = min(known)
        spare = policy if len(known) < len(g) else 0
        width = (max(known) - low + spare).bit_length()
        refs.append(low)
        widths.append(width)
        raw += "".join(f"{(1 << width) - 1 if v is None else v - low:0{width}b}" for v in g) if width else ""
    ref_bits = (max([r for r in refs if r is not None] + [0]) + policy).bit_length() or 1
    refs = [(1 << ref_bits) - 1 if r is None else r for r in refs]
    lengths = [len(g) for g in groups]
    raw += "0" * (-len(raw) % 8)
    head = struct.pack(">IHf", len(whole), 3 if order else 2, 0.0) + signed(0, 2) + signed(2, 2) + bytes([ref_bits, 0, 1, policy]) + bytes(8)
    head += struct.pack(">IBBIBIB", len(groups), 0, 6, size, 1, lengths[-1], 4) + (bytes([order, 4]) if order else b"")
    extra = b"".join(v.to_bytes(4, "big") for v in starts) + signed(least, 4) if order else b""
    data = extra + bits(refs, ref_bits) + bits(widths, 6) + bits([0] * len(groups), 4) + (int(raw, 2).to_bytes(len(raw) // 8, "big") if raw else b"")
    return section(5, head), section(7, data)


@pytest.mark.parametrize("order", [0, 1, 2])
@pytest.mark.parametrize("policy", [0, 1, 2])
def test_complex_packing(order, policy):
    r = np.random.default_rng(order)
    whole = [int(v) for v in r.integers(0, 4000, 35)]
    whole[12:18] = [77] * 6  # a group without bits
    missing = {3, 4, 20, *range(24, 30)} if policy else set()
    one, three, four, *_ = sections(grib.encoded(INIT, 2, "t", 3, LATS, LONS, field(1, 0)))
    five, seven = grouped(whole, order, policy=policy, missing=missing)
    out = rows(message([one, three, four, five, section(6, b"\xff"), seven]))
    assert [x["value"] for x in out] == [None if i in missing else v / 100 for i, v in enumerate(whole)]


def test_plain_numbers_and_a_second_field():
    x, y = field(3, 0), field(4, 0.5)
    one, three, four, *_ = sections(grib.encoded(INIT, 2, "u", 3, LATS, LONS, x))
    five = section(5, struct.pack(">IHB", 35, 4, 2))
    other = sections(grib.encoded(INIT, 2, "v", 3, LATS, LONS, y))
    raw = message([one, three, four, five, section(6, b"\xff"), section(7, x.astype(">f8").tobytes()), *other[2:]])
    out = rows(raw)
    assert [r["variable"] for r in out] == ["u"] * 35 + ["v"] * 35
    assert [r["value"] for r in out] == [*x, *(None if np.isnan(v) else v for v in y)]


def test_scanning_by_columns_and_from_the_south():
    parts = sections(grib.encoded(INIT, 1, "t", 0, LATS, LONS, field(2, 0)))
    parts[1] = parts[1][:71] + bytes([64 | 32])
    out = rows(message(parts))
    assert [(r["lat"], r["lon"]) for r in out[:6]] == [(39.0, 248.0), (39.6, 248.0), (40.2, 248.0), (40.8, 248.0), (41.4, 248.0), (39.0, 248.65)]


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    base = tmp_path_factory.mktemp("grib")
    for k, member in enumerate((0, 1, 2)):
        raw = b"".join(grib.encoded(INIT, member, v, fxx, LATS, LONS, field(100 * k + fxx)) for fxx in (0, 3, 246) for v in ("sde", "prmsl"))
        (base / f"m{member}.grib2").write_bytes(raw)
    whole = (base / "m1.grib2").read_bytes()
    (base / "cut.grib2").write_bytes(whole[:-40])
    (base / "none.grib2").write_bytes(b"not a grid at all, but long enough")
    (base / "empty.grib2").write_bytes(b"")
    # A message in the middle that uses what isn't known; those after it are read.
    odd = sections(grib.encoded(INIT, 5, "t", 0, LATS, LONS, field(9)))
    odd[2] = odd[2][:7] + struct.pack(">H", 99) + odd[2][9:]
    (base / "odd.grib2").write_bytes(message(odd) + grib.encoded(INIT, 5, "t", 3, LATS, LONS, field(9)))
    return base


def test_the_data_source(spark, files):
    grib.register(spark)
    df = spark.read.format("grib").load(str(files))
    good = df.where("error is null")
    names = {r.path.rpartition("/")[2]: r.n for r in good.groupBy("path").count().withColumnRenamed("count", "n").collect()}
    assert names == {"m0.grib2": 210, "m1.grib2": 210, "m2.grib2": 210, "cut.grib2": 175, "odd.grib2": 35}
    errors = {(r.path.rpartition("/")[2], r.message): r.error for r in df.where("error is not null").collect()}
    assert errors == {("cut.grib2", 5): "cut off", ("none.grib2", 0): "no GRIB message", ("empty.grib2", 0): "no GRIB message", ("odd.grib2", 0): "product template 99"}
    # The same through Spark's own reader of bytes.
    name = F.element_at(F.split("path", "/"), -1)
    # That one passes over empty files.
    df, other = df.withColumn("path", name).where("path <> 'empty.grib2'"), grib.messages(spark.read.format("binaryFile").load(str(files))).withColumn("path", name)
    assert df.exceptAll(other).isEmpty() and other.exceptAll(df).isEmpty()


def test_filters_reach_the_heads(spark, files, monkeypatch):
    grib.register(spark)
    df = spark.read.format("grib").option("suffix", "m1.grib2").load(str(files))
    assert df.where("variable = 'sde' and fxx between 1 and 10 and member = 'p01'").count() == 35
    assert df.where("fxx in (0, 246)").count() == 140 and df.where("fxx > 240").select("value").count() == 70
    heads = df.sparkSession.read.format("grib").option("suffix", "m1.grib2").option("values", "false").load(str(files))
    assert [tuple(r) for r in heads.orderBy("message").select("fxx", "variable", "value").collect()] == [(f, v, None) for f in (0, 3, 246) for v in ("sde", "prmsl")]


class Counted(io.BytesIO):
    read_bytes = 0

    def read(self, n=-1):
        out = super().read(n)
        self.read_bytes += len(out)
        return out


def test_data_of_other_fields_are_not_read():
    big = np.arange(200 * 300, dtype=float)
    raw = b"".join(grib.encoded(INIT, 1, v, f, (0.0, 20.0, 200), (0.0, 30.0, 300), big) for f in (0, 3, 6) for v in ("sde", "t"))
    file = Counted(raw)
    out = list(grib.scan(file, "f", lambda h: h.variable == "t" and h.fxx == 3))
    assert sum(map(len, out)) == len(big) and file.read_bytes < len(raw) / 5


def test_filters_that_heads_decide():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, StringContains

    reader = grib.GribReader({"path": "x"})
    filters = [EqualTo(("variable",), "t"), In(("fxx",), (0, 3)), GreaterThan(("value",), 3.0), StringContains(("member",), "p"), IsNotNull(("fxx",)), GreaterThan(("init",), "a text")]
    assert list(reader.pushFilters(filters)) == filters
    head = grib.Head(INIT, "p01", "t", "surface", 3, b"", b"", (0, 0), (0, 0))
    assert [c for c, _ in reader.filters] == ["variable", "fxx", "fxx", "init"]
    assert grib._holds(reader.filters, head)
    assert not grib._holds(reader.filters, grib.Head(INIT, "p01", "t", "surface", 6, b"", b"", (0, 0), (0, 0)))


def test_slices_change_their_product_after_240_hours(spark):
    runs = spark.createDataFrame([(INIT,)], "init timestamp_ntz")
    got = [tuple(r) for r in grib.slices(runs, ["c00"], ["t"], 234, 252, 3).select("fxx", "product").orderBy("fxx").collect()]
    assert got == [(f, "atmos.5" if f > 240 else "atmos.25") for f in range(234, 253, 3)]
    assert [r.fxx for r in grib.slices(runs, ["c00"], ["t"], 0, 12, 3, "atmos.5").orderBy("fxx").collect()] == [0, 6, 12]


def test_what_is_late_or_broken_is_null(spark, files):
    grib.register(spark)
    got = spark.read.format("grib").load(f"{files}/cut.grib2").where("error is null").groupBy("init", "member", "variable", "fxx").agg({"value": "max"})
    runs = spark.createDataFrame([(INIT,)], "init timestamp_ntz")
    wanted = grib.slices(runs, ["p01"], ["sde", "prmsl"], 0, 6, 3)
    out = readers.with_expected(got, wanted, ["init", "member", "variable", "fxx"])
    assert {(r.variable, r.fxx): r["max(value)"] is None for r in out.collect()} == {(v, f): f == 6 for v in ("sde", "prmsl") for f in (0, 3, 6)}


def test_groups_become_messages(spark):
    cells = [(INIT, m, 3, "sde", j, i, float(10 * j + i + m)) for m in (0, 4) for j in range(5) for i in range(7) if (i + j + m) % 3]
    df = spark.createDataFrame(cells, "init timestamp_ntz, member int, fxx int, variable string, j int, i int, value double")
    files = grib.packed(df, LATS, LONS)
    out = grib.messages(files.selectExpr("concat(member, '-', fxx) AS path", "content")).where("value is not null")
    lat, lon = (list(np.round(np.linspace(*x), 6)) for x in (LATS, LONS))
    assert sorted((r.init, r.member, r.fxx, r.variable, lat.index(r.lat), lon.index(r.lon), r.value) for r in out.collect()) == sorted((a, f"p{m:02d}" if m else "c00", *rest) for a, m, *rest in cells)


def test_arrow_schema_is_the_schema(spark):
    assert spark.createDataFrame([], grib.SCHEMA).toArrow().schema.types == grib._arrow_schema().types
    assert isinstance(grib._batch("p", 0, "e", None), pa.RecordBatch)


def test_files_are_written_whole_or_not_at_all(spark, tmp_path):
    grib.register(spark)
    raw = {f"{k % 3}/run{k % 3}.grib2": [grib.encoded(INIT, k % 3, "t", f, LATS, LONS, field(f)) for f in (0, 3, 6)] for k in range(3)}
    df = spark.createDataFrame([(n, i, c) for n, cs in raw.items() for i, c in enumerate(cs)], "name string, i int, content binary")
    path = str(tmp_path / "out")
    df.repartition("name").sortWithinPartitions("name", "i").select("name", "content").write.format("grib").mode("append").save(path)
    assert {str(p.relative_to(path)): p.read_bytes() for p in (tmp_path / "out").rglob("*") if p.is_file()} == {n: b"".join(cs) for n, cs in raw.items()}
    assert not list((tmp_path / "out").glob("_staged*"))
    assert spark.read.format("grib").load(f"file://{path}").where("error is null and fxx = 3").count() == 3 * 35
    with pytest.raises(Exception, match="apart"):
        df.coalesce(1).orderBy("i").select("name", "content").write.format("grib").mode("append").save(str(tmp_path / "apart"))
    assert not [p for p in (tmp_path / "apart").rglob("*.grib2") if "_staged" not in str(p)]

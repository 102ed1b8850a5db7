"""The Avro data source: round trips, foreign layouts, splits, pruning, replacement, damage."""

import json
import os
import random
from datetime import date, datetime, timezone

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.sources import avro, tables

SCHEMA = "id long, flag boolean, small int, f float, x double, name string, day date, time timestamp"


def rows(n, seed=1):
    rng = random.Random(seed)
    maybe = lambda value: None if rng.random() < 0.2 else value
    out = []
    for i in range(n):
        big = rng.choice([0, -1, 63, 64, -64, -65, 2**31, -(2**63), 2**63 - 1, rng.randint(-(2**40), 2**40)])
        text = rng.choice(["", "é😀", "a" * rng.randint(0, 300), "x"])
        time = datetime.fromtimestamp(rng.randint(-(10**9), 2 * 10**9), timezone.utc).replace(tzinfo=None)
        out.append((big, maybe(i % 2 == 0), maybe(rng.randint(-(2**31), 2**31 - 1)), maybe(float(i)), maybe(rng.choice([1e300, -0.0, float("inf"), i / 7])),
                    maybe(text), maybe(date(1960 + i % 90, 1, 1 + i % 28)), maybe(time)))
    return out


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_round_trip(spark, tmp_path, n):
    frame = spark.createDataFrame(rows(n), SCHEMA)
    path = str(tmp_path / "t")
    avro.write(frame.repartition(3) if n else frame, path)
    back = avro.read(spark, path, frame.schema if n == 0 else None)
    assert sorted(map(str, back.collect())) == sorted(map(str, frame.collect()))
    assert back.select("name", "id").exceptAll(frame.select("name", "id")).isEmpty()


def plain_long(value):
    z, out = (value << 1) ^ (value >> 63), b""
    z &= (1 << 64) - 1
    while z >= 0x80:
        out += bytes([z & 0x7F | 0x80])
        z >>= 7
    return out + bytes([z])


def container(schema, blocks, codec=b"null", sync=b"0123456789abcdef"):
    entries = {b"avro.schema": json.dumps(schema).encode(), b"avro.codec": codec}
    head = b"Obj\x01" + plain_long(len(entries)) + b"".join(plain_long(len(k)) + k + plain_long(len(v)) + v for k, v in entries.items()) + plain_long(0) + sync
    return head + b"".join(plain_long(n) + plain_long(len(raw)) + raw + sync for n, raw in blocks)


LONG_TEXT = {"type": "record", "name": "R", "fields": [{"name": "n", "type": "long"}, {"name": "s", "type": ["string", "null"]}]}


def record(n, s):
    return plain_long(n) + (plain_long(1) if s is None else plain_long(0) + plain_long(len(s.encode())) + s.encode())


def test_written_by_others(spark, tmp_path):
    """No compression, a union with null last, blocks of unlike sizes."""
    rng, want, blocks = random.Random(3), [], []
    for size in (1, 700, 0, 3):
        part = [(rng.randint(-(2**62), 2**62), rng.choice([None, "", "äö" * rng.randint(0, 90)])) for _ in range(size)]
        want += part
        blocks.append((size, b"".join(record(*r) for r in part)))
    (tmp_path / "a.avro").write_bytes(container(LONG_TEXT, blocks))
    got = [tuple(r) for r in avro.read(spark, str(tmp_path)).collect()]
    assert got == want


@pytest.mark.parametrize("damage", ["cut", "sync", "byte", "count", "magic", "length"])
def test_damage_raises(spark, tmp_path, damage):
    path = str(tmp_path / "t")
    avro.write(spark.createDataFrame(rows(3000), SCHEMA).coalesce(1), path)
    (name,) = [os.path.join(path, f) for f in os.listdir(path)]
    raw = bytearray(open(name, "rb").read())
    if damage == "cut":
        raw = raw[:-400]
    elif damage == "sync":
        raw[-1] ^= 1
    elif damage == "byte":
        raw[len(raw) // 2] ^= 0x55
    elif damage == "magic":
        raw[0] = 0
    else:
        body = b"".join(record(i, "abc") for i in range(50))
        raw = container(LONG_TEXT, [(51 if damage == "count" else 49, body)]) if damage == "count" else container(LONG_TEXT, [(50, body + b"\x00")])
    open(name, "wb").write(bytes(raw))
    schema = "n long, s string" if damage in ("count", "length") else SCHEMA
    with pytest.raises(Exception, match="DamagedFile|ends within|no Avro|sync|block|record|branch|number|length|cut off"):
        avro.read(spark, path, schema).collect()


def test_splits_share_the_blocks(tmp_path):
    blocks = [(1, record(i, "x" * (i % 50))) for i in range(300)]
    path = tmp_path / "a.avro"
    path.write_bytes(container(LONG_TEXT, blocks))
    size = path.stat().st_size
    for step in (7, 97, 1000, size):
        seen = []
        for at in range(0, size, step):
            with pa.OSFile(str(path)) as file:
                seen += [avro.decode([(n, raw)], avro.fields_of(schema), {"n"})["n"][0].as_py() for schema, n, raw in avro.blocks_of(file, "a", at, min(at + step, size))]
        assert seen == list(range(300))


def test_partitions_are_pruned_and_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = spark.range(600).select("id", F.expr("date_add(date'2024-01-01', cast(id % 6 as int))").alias("event_date"), F.expr("if(id % 2 = 0, 'a/b', 'c')").alias("asset_class"),
                                    F.expr("timestamp_seconds(1704067200 + (id % 6) * 86400)").alias("time"))
    tables.write_days(frame.drop("event_date"), path, fmt=avro.FORMAT)
    table = tables.read_table(spark, path, fmt=avro.FORMAT)
    assert table.count() == 600 and table.select(*frame.columns).exceptAll(frame).isEmpty()
    reader = avro.FlatAvroReader(path, table.schema)
    everything = len(reader.partitions())
    days = tables.read_days(spark, path, "2024-01-02", "2024-01-03", fmt=avro.FORMAT)
    assert days.count() == 200 and table.count() == 600
    pruned = avro.FlatAvroReader(path, table.schema)
    between = [avro.ds.GreaterThanOrEqual(("event_date",), date(2024, 1, 2)), avro.ds.LessThanOrEqual(("event_date",), date(2024, 1, 3))]
    left = list(pruned.pushFilters([*between, avro.ds.EqualTo(("asset_class",), "c"), avro.ds.EqualTo(("id",), 5)]))
    assert [f.attribute for f in left] == [("id",)] and 0 < len(pruned.partitions()) < everything / 3
    tables.write_days(frame.filter("event_date = '2024-01-02'").limit(3).drop("event_date"), path, fmt=avro.FORMAT)
    again = tables.read_table(spark, path, fmt=avro.FORMAT)
    assert again.filter("event_date = '2024-01-02' and asset_class = 'c'").count() == 3 and again.filter("event_date <> '2024-01-02'").count() == 500
    assert not [name for _, folders, _ in os.walk(path) for name in folders if name.startswith("_temporary")]


def test_types_that_are_not_written(spark, tmp_path):
    with pytest.raises(Exception, match="no type"):
        avro.write(spark.range(1).select(F.array("id").alias("a")), str(tmp_path / "t"))
    with pytest.raises(Exception, match="give a schema"):
        avro.read(spark, str(tmp_path / "nothing"))

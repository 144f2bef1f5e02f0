"""As-of lookup over sorted ranges, batches of any date, bad CSV lines, many touched partitions."""

import itertools
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from estrella.operators import history, upsert
from estrella.plans import retail
from estrella.session import work_path
from estrella.sources import files

DAY = date(2020, 1, 1)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def valid_at(versions, key, day):
    if key is None or day is None:
        return None
    hits = [v for v in versions if v[0] == key and v[2] <= day and (v[3] is None or day <= v[3])]
    return hits[0][1] if hits else None


@pytest.mark.parametrize("partitions", [1, 7])
def test_version_at(spark, partitions):
    rnd = random.Random(partitions)
    versions = []
    for key in [*range(20), 99]:
        day = DAY + timedelta(rnd.randint(0, 30))
        for i in range(rnd.randint(0, 5)):
            end = day + timedelta(rnd.randint(0, 20))
            open_ = rnd.random() < 0.2
            versions.append((key, f"{key}-{i}", day, None if open_ else end))
            if open_:
                break
            day = end + timedelta(rnd.randint(1, 6))  # gaps between versions
    rows = [(i, rnd.choice([*range(25), None]), DAY + timedelta(rnd.randint(-5, 120))) for i in range(300)]
    rows += [(1000 + i, 99, DAY + timedelta(i % 3)) for i in range(200)] + [(5000, 3, None)] + [(1, 99, DAY)] * 20
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        past = spark.createDataFrame([(*v, v[3] is None) for v in versions], "k int, name string, fecha_desde date, fecha_hasta date, es_vigente boolean")
        asked = spark.createDataFrame(rows, "id int, k int, day date").repartition(3)
        got = history.version_at(asked, past, "k", "day", ["name"])
        assert got.columns == ["id", "k", "day", "name_vigente"]
        assert _rows(got) == sorted(((*r, valid_at(versions, r[1], r[2])) for r in rows), key=str)
        assert history.version_at(asked.limit(0), past, "k", "day", ["name"]).collect() == []
        assert {r["name_vigente"] for r in history.version_at(asked, past.limit(0), "k", "day", ["name"]).collect()} == {None}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_a_hot_key_spreads(spark, monkeypatch):
    """Two thirds of the rows are one key's, most of them of one day."""
    past = spark.createDataFrame([(1, "a", DAY, None, True), (2, "b", DAY, None, True)], "k int, name string, fecha_desde date, fecha_hasta date, es_vigente boolean")
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") % 3 == 0, F.col("id") % 500).otherwise(1).cast("int").alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(DAY)).otherwise(F.date_add(F.lit(DAY), (F.col("id") % 9).cast("int"))).alias("day"),
    )
    dealt = []
    carried = history._carried
    monkeypatch.setattr(history, "_carried", lambda events: dealt.append(carried(events)) or dealt[0])
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        seen = history.version_at(rows, past, "k", "day", ["name"])
        assert seen.filter("k = 1 AND name_vigente = 'a'").count() == 4004
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    sizes = [r["count"] for r in dealt[0].filter("_key = 1 AND _kind = 1").groupBy("_part").count().collect()]
    assert sum(sizes) == 4004 and len(sizes) >= 5 and max(sizes) < 0.3 * 4004


TRACKED = ["city", "score"]
OBS = "k int, sk long, city string, score int"


def plain_chains(seen):
    """{key: versions} from (batch, day, key, city, score)."""
    out = []
    for key in sorted({s[2] for s in seen}):
        days = {}
        for batch, day, k, city, score in sorted(seen, key=lambda s: s[0]):
            if k == key:
                days[day] = (city, score)
        turns = [(d, days[d]) for d in sorted(days)]
        turns = [t for i, t in enumerate(turns) if i == 0 or turns[i - 1][1] != t[1]]
        for (day, state), after in itertools.zip_longest(turns, turns[1:]):
            out.append((key, key * 10, *state, day, after[0] - timedelta(1) if after else None, after is None))
    return sorted(out, key=str)


def test_batches_in_any_order_give_one_history(spark):
    rnd = random.Random(4)
    batches = []
    for number in range(1, 5):
        day = DAY + timedelta(rnd.randint(0, 6))
        rows = [(k, k * 10, rnd.choice(["x", "y", None]), rnd.choice([1, None])) for k in rnd.sample(range(8), 5)]
        batches.append((number, day, rows))
    first = [(k, k * 10, "x", 1) for k in range(6)]
    start = spark.createDataFrame([(*r, DAY, None, True) for r in first], f"{OBS}, fecha_desde date, fecha_hasta date, es_vigente boolean")
    seen = [(0, DAY, r[0], *r[2:]) for r in first] + [(n, d, r[0], *r[2:]) for n, d, rows in batches for r in rows]
    want = plain_chains(seen)
    for order in ([0, 1, 2, 3], [3, 1, 0, 2], [2, 3, 1, 0, 2]):
        past, log = start, history.observations_of(start, "k", "sk", TRACKED)
        for at in order:
            number, day, rows = batches[at]
            batch = history.observed(spark.createDataFrame(rows, OBS), "k", "sk", TRACKED, F.lit(day), number)
            past, log = history.splice_history(past, log, batch, "k", "sk", TRACKED)
        assert _rows(past) == want
        assert history.broken_versions(past, "k").count() == 0
        gaps = past.alias("a").join(past.alias("b"), "k").filter("a.fecha_desde < b.fecha_desde AND a.fecha_hasta >= b.fecha_desde")
        assert gaps.count() == 0


def test_splice_leaves_other_keys_alone(spark):
    odd = spark.createDataFrame([(1, 10, "x", 1, DAY, None, True), (2, 20, "x", 1, DAY, None, True)], f"{OBS}, fecha_desde date, fecha_hasta date, es_vigente boolean")
    log = history.observations_of(odd, "k", "sk", TRACKED).filter("k = 1")  # nothing known of key 2
    batch = history.observed(spark.createDataFrame([(1, 10, "y", 1), (None, None, "z", 1)], OBS), "k", "sk", TRACKED, F.lit(date(2019, 5, 1)), 1)
    past, _ = history.splice_history(odd, log, batch, "k", "sk", TRACKED)
    assert _rows(past) == sorted([(1, 10, "y", 1, date(2019, 5, 1), date(2019, 12, 31), False), (1, 10, "x", 1, DAY, None, True), (2, 20, "x", 1, DAY, None, True)], key=str)


def test_bad_lines(spark, tmp_path):
    good = [f'{i},"a, ""{i}""",x{i}' for i in range(500)]
    bad = {2: "1,2", 40: "1,2,3,4", 41: '7,"open,3', 222: "8," + "y" * 300 + ",z", 223: 'a,b,"c'}
    lines = ["id,text,code", *good]
    for at, line in bad.items():
        lines.insert(at - 1, line)
    lines.insert(100, "")
    lines.insert(101, "   ")
    one, two = tmp_path / "in" / "one.csv", tmp_path / "in" / "two.csv"
    one.parent.mkdir()
    one.write_text("\n".join(lines) + "\n")
    two.write_text('id,text,code\r\n9,,"",\r\nx,"","é"\r\ny,,\r\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", 2000)  # many blocks
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        df, rejects = files.import_csv(spark, str(one.parent), ["id", "text", "code"], longest=250)
        found = {(r["archivo"].rsplit("/", 1)[1], r["linea"]): r for r in rejects.collect()}
        rows = {r["id"]: r for r in df.collect()}
        again = files.read_raw_csv(spark, str(two), ["id", "text", "code"])
        assert len(spark.read.text(str(one)).select(F.expr("_metadata.file_block_start")).distinct().collect()) > 3
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    moved = {at + (2 if at > 100 else 0) for at in bad} | {0}
    assert {line for name, line in found if name == "one.csv"} == moved - {0}
    assert {found["one.csv", at + (2 if at > 100 else 0)]["texto"] for at in bad} == set(bad.values())
    reasons = [found["one.csv", at + (2 if at > 100 else 0)]["motivo_rechazo"] for at in sorted(bad)]
    assert reasons == ["Faltan campos: 2 de 3", "Sobran campos: 4 de 3", "Comillas sin cerrar", "Linea demasiado larga: 304 caracteres", "Comillas sin cerrar"]
    assert [found["two.csv", 2]["motivo_rechazo"]] == ["Sobran campos: 4 de 3"]
    assert len(rows) == 502 and rows["7"]["text"] == 'a, "7"' and rows["x"]["text"] == "" and rows["y"]["text"] is None
    assert again.columns == df.columns


def test_bad_lines_are_rejects_of_the_batch(spark, tmp_path):
    (tmp_path / "shippers.csv").write_text("shipperID,companyName,phone\n1,One,555\n2,Two\n3,Three,556\n")
    (tmp_path / "regions.csv").write_text("regionID,regionDescription\n1,Eastern\n")
    house = retail.RetailWarehouse(spark, work_path(spark), as_of=date(2026, 6, 16))
    raw = retail.read_batch(spark, {t: str(tmp_path / f"{t}.csv") for t in ("shippers", "regions")}, batch=1)
    tables = house._import(raw, "txt", "importacion", "adquisicion")
    assert tables["shippers"].count() == 2 and tables["regions"].count() == 1
    rejects = house._dqm("dqm_registro_rechazado").select("tabla_origen", "clave_registro", "motivo_rechazo", "decision")
    assert _rows(rejects) == [("txt_shippers", "shippers.csv:3", "Faltan campos: 2 de 3", "RECHAZADO")]


def test_many_touched_partitions(spark, many=450):
    """Far more than an expression tree of one condition per folder would bear."""
    path = work_path(spark)
    spark.range(many).selectExpr("id k", "id v", "CAST(id AS INT) p").coalesce(1).write.partitionBy("p").parquet(path)
    batch = spark.range(many).selectExpr("id k", "-id v", "CAST(id AS INT) p")
    affected = upsert.upsert_partitions(path, batch.coalesce(1), ["k"], ["v"], ["p"])
    assert len(affected) == many
    assert spark.read.parquet(path).agg(F.sum("v"), F.count("v")).first()[:] == (-many * (many - 1) // 2, many)


def test_insert_new_without_order(spark):
    target = spark.createDataFrame([(1, "old"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(1, "x"), (2, "y"), (2, "x"), (None, "p"), (None, "p")], "k int, v string")
    got = _rows(upsert.insert_new(target, source, ["k"]))
    assert got == sorted([(1, "old"), (None, "n"), (2, "x"), (None, "p"), (None, "p")], key=str)

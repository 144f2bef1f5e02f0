from decimal import Decimal

from pyspark.sql import functions as F

from estrella.functions import numbers as num
from estrella.functions import text as txt
from estrella.operators import staging
from estrella.operators.staging import Field
from estrella.sources import files


def _one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


def test_null_tokens_differ_by_batch(spark):
    assert _one(spark, " NULL ", lambda c: txt.text_or_null(c)) is None
    assert _one(spark, "  ", lambda c: txt.text_or_null(c)) == ""
    assert _one(spark, "  ", lambda c: txt.text_or_null(c, ("", "NULL"))) is None


def test_char_cuts_and_casts_never_raise(spark):
    assert _one(spark, "ABCDEFG", lambda c: txt.typed(c, "char(5)")) == "ABCDE"
    assert _one(spark, "12x", lambda c: txt.typed(c, "int")) is None
    assert _one(spark, "40000", lambda c: txt.typed(c, "int", via="smallint")) is None


def test_narrow_rounding(spark):
    assert _one(spark, "2.345", lambda c: txt.typed(c, "decimal(10,4)", via="decimal(10,2)")) == Decimal("2.3500")
    assert _one(spark, "2.34567", lambda c: txt.typed(c, "decimal(10,4)")) == Decimal("2.3457")


def test_dates_from_timestamp_text(spark):
    assert str(_one(spark, "1998-01-02 00:00:00.000", lambda c: txt.typed(c, "date"))) == "1998-01-02"
    assert str(_one(spark, " 1998-01-02 10:00", lambda c: txt.first_ten(c).try_cast("date"))) == "1998-01-02"


def test_scrub_number(spark):
    assert _one(spark, " $1,234.50 ", lambda c: txt.scrubbed(c).try_cast("decimal(10,2)")) == Decimal("1234.50")
    assert _one(spark, "-3.5%", lambda c: txt.scrubbed(c).try_cast("decimal(10,2)")) == Decimal("-3.50")
    assert _one(spark, "n/a", lambda c: txt.scrubbed(c).try_cast("bigint")) is None


def test_full_name_needs_both_parts(spark):
    df = spark.createDataFrame([("Ana", "Paz"), (None, "Paz")], "a string, b string")
    assert [r.n for r in df.select(txt.full_name(F.col("a"), F.col("b")).alias("n")).collect()] == ["Ana Paz", None]


def test_stage_and_cast_rejects(spark):
    raw = spark.createDataFrame([("1", " 5 ", "NULL"), ("2", "five", "1998-01-01")], "id string, q string, d string")
    fields = [Field("id", "int"), Field("q", "int"), Field("d", "date")]
    assert [(r.id, r.q, str(r.d)) for r in staging.stage(raw, fields).orderBy("id").collect()] == [
        (1, 5, "None"),
        (2, None, "1998-01-01"),
    ]
    rejects = staging.cast_rejects("t", raw, fields, ["id"]).collect()
    assert [tuple(r) for r in rejects] == [("t", "2", "Valor no convertible en q: five", "RECHAZADO")]


def test_score_split_keeps_every_row(spark):
    raw = spark.createDataFrame([("A", "4"), ("B", "0"), ("C", ""), ("D", None), ("E", "99999999999999999999")], "customer_id string, score string")
    score = F.col("score")
    ok, bad = staging.split_valid("s", raw, staging.valid_score(score), ["customer_id"], staging.score_reason(score))
    assert [r.customer_id for r in ok.collect()] == ["A"]
    reasons = {r.clave_registro: r.motivo_rechazo for r in bad.collect()}
    assert set(reasons) == {"B", "C", "D", "E"}
    assert reasons["C"].startswith("Score invalido: valor <vacio>") and "valor 0." in reasons["B"]


def test_corrections_and_propagation(spark):
    dim = spark.createDataFrame([(1, "X", "Bras�lia"), (2, "Y", "Lima")], "sk int, name string, city string")
    assert staging.corrupted(dim, ["city"]).count() == 1
    fixes = spark.createDataFrame([("X", "Brasília")], "name string, city string")
    fixed = staging.apply_corrections(dim, "name", fixes, ["city"])
    assert sorted(tuple(r) for r in fixed.collect()) == [(1, "X", "Brasília"), (2, "Y", "Lima")]
    mart = spark.createDataFrame([(1, "Bras�lia", 5), (2, "Lima", 6)], "sk int, capital string, n int")
    fresh = staging.propagate(mart, fixed, "sk", {"capital": "city"})
    assert sorted(tuple(r) for r in fresh.collect()) == [(1, "Brasília", 5), (2, "Lima", 6)]


def test_csv_separators_quotes_and_empties(spark, tmp_path):
    path = tmp_path / "w.csv"
    path.write_text('Country Name;"GDP ($)";code\n"Côte; d""Or";"$1,000";007\nPerú;"";\n', encoding="utf-8")
    df = files.read_raw_csv(spark, str(path), ["country", "gdp", "code"], sep=";")
    assert df.dtypes == [("country", "string"), ("gdp", "string"), ("code", "string")]
    assert [tuple(r) for r in df.collect()] == [('Côte; d"Or', "$1,000", "007"), ("Perú", "", None)]


def test_publish_reads_and_replaces_the_same_table(spark, tmp_path):
    first = files.publish(spark.range(3), str(tmp_path))
    second = files.publish(spark.read.parquet(first).union(spark.range(1)), str(tmp_path))
    assert files.read_mart(spark, second).count() == 4 and files.exists(spark, first)


def test_delete_where_keeps_unknown(spark):
    df = spark.createDataFrame([("txt2_a",), ("txt_a",), (None,)], "t string")
    assert sorted(str(r.t) for r in files.delete_where(df, F.col("t").startswith("txt2_")).collect()) == ["None", "txt_a"]


def test_percentage_and_thresholds(spark):
    df = spark.createDataFrame([(1, 8, 0)], "a long, b long, z long")
    row = df.select(num.percentage(F.col("a"), F.col("b"), 1), num.percentage(F.col("a"), F.col("z"), 2)).first()
    assert (row[0], row[1]) == (Decimal("12.5"), Decimal("0"))
    states = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (9.0,)], "v double").select(num.evaluate(F.col("v"), 1, 5).alias("s"))
    assert [r.s for r in states.collect()] == ["OK", "OK", "WARNING", "ERROR"]

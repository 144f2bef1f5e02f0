from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from estrella.operators import indicators, integrity, profile, rules


def _counts(df):
    return {(r.campo, r.control): (r.resultado, r.cant_errores) for r in df.collect()}


def test_null_semantics_of_each_rule(spark):
    df = spark.createDataFrame(
        [("1", "ABCDE", "1998-01-01 00", "0.5", "2"), ("1", "ABC", "NULL", "1.5", "0"), ("x", None, "soon", "-1", None), ("", "", None, None, "9" * 25)],
        "id string, code string, day string, disc string, qty string",
    )
    got = _counts(
        rules.check(
            "t",
            df,
            [
                rules.not_null("id"),
                rules.unique(["id"], "DUP"),
                rules.primary_key("id", "PK"),
                rules.castable_int("id"),
                rules.length_is("code", 5, "L5"),
                rules.length_is("code", 5, "L5 needed", needed=True),
                rules.date_prefix("day"),
                rules.date_prefix("day", "needed", needed=True),
                rules.numeric_between("disc", 0, 1, "R01", "WARNING"),
                rules.int_between("qty", 1, None, "POS"),
                rules.expected_nulls("day"),
                rules.numeric_key(["id", "qty"], "KEY"),
                rules.required("code", "REQ"),
            ],
        )
    )
    assert got[("id", "NOT NULL")] == ("ERROR", 1)
    assert got[("id", "DUP")] == ("ERROR", 1)
    assert got[("id", "PK")] == ("ERROR", 2)
    assert got[("id", "CASTEABLE_A_ENTERO")] == ("ERROR", 2)
    assert got[("code", "L5")] == ("ERROR", 2)
    assert got[("code", "L5 needed")] == ("ERROR", 3)
    assert got[("day", "FORMATO_FECHA")] == ("ERROR", 1)
    assert got[("day", "needed")] == ("ERROR", 3)
    assert got[("disc", "R01")] == ("WARNING", 2)
    assert got[("qty", "POS")] == ("ERROR", 2)
    assert got[("day", "NULOS_ESPERADOS")] == ("OK", 2)
    assert got[("id/qty", "KEY")] == ("ERROR", 2)
    assert got[("code", "REQ")] == ("ERROR", 2)


def test_a_final_newline_is_not_a_number(spark):
    df = spark.createDataFrame([("12\n",)], "v string")
    assert rules.check("t", df, [rules.numeric("v")]).first().cant_errores == 1


def test_unique_counts_groups_and_includes_the_null_group(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert rules.check("t", df, [rules.unique(["k"], "DUP")]).first().cant_errores == 2


def test_keys_and_values_are_rows_of_the_offenders(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("MX").alias("c"))
    rule = rules.forbidden("c", "MX")
    for rows in (df, df.limit(2)):
        assert rules.check("t", rows, [rule]).first().detalle == f"Hay registros con valor MX: {rows.count()}"
    found = rules.offenders("t", df, ["k"], [rule])
    assert found.count() == 100 and found.first().valor == "MX"


def test_a_number_too_long_for_the_type_is_out_of_range(spark):
    df = spark.createDataFrame([("1" + "0" * 40,), ("5",), (None,)], "v string")
    assert rules.check("t", df, [rules.numeric_between("v", 0, 1, "R")]).first().cant_errores == 2
    assert rules.check("t", df, [rules.numeric_between("v", 0, None, "R")]).first().cant_errores == 0


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a string, b string")
    got = profile.profile("t", empty, {"a": ("",), "b": ()}).collect()
    assert sorted((r.campo, *tuple(r)[2:]) for r in got) == [("a", 0, 0, 0, None, None), ("b", 0, 0, 0, None, None)]


def test_one_scan_answers_all_row_rules(spark, tmp_path, capsys):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("string(id) a", "string(id) b", "string(id) unused").write.parquet(path)
    checks = [rules.not_null("a"), rules.numeric("a"), rules.castable_int("b"), rules.not_null("b")]
    rules.check("t", spark.read.parquet(path), checks).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan parquet") == 1 and "unused" not in plan


def test_roll_up(spark):
    def rolled(*states, **kw):
        df = spark.createDataFrame([(s,) for s in states], "resultado string")
        return rules.roll_up(df, **kw).first().resultado

    assert rolled("OK", "WARNING", "ERROR") == "ERROR"
    assert rolled("OK", "WARNING") == "WARNING"
    assert rolled("OK") == "OK"
    assert rolled("ERROR", soften=True) == "WARNING"


def test_profile(spark):
    df = spark.createDataFrame([("9", "NULL"), ("10", ""), ("9", None), (" ", "z")], "a string, b string")
    got = {r.campo: tuple(r)[2:] for r in profile.profile("t", df, {"a": profile.BLANK_TRIMMED, "b": ("", "NULL")}).collect()}
    assert got["a"] == (4, 1, 3, " ", "9")
    assert got["b"] == (4, 3, 3, "", "z")


@pytest.fixture
def link(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, 99), (4, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "pk int")
    return integrity.ForeignKey("c", child, "fk", parent, "pk", "id")


def test_foreign_keys(link):
    row = integrity.check_foreign_keys([link]).first()
    assert (row.resultado, row.cant_errores) == ("ERROR", 2) and row.detalle.startswith("2 ")
    together = integrity.count_together({"a": link, "b": link})
    assert [r.cant_errores for r in integrity.check_foreign_keys(list(together.values())).collect()] == [2, 2]
    rejects = integrity.reject_orphans(link, "Falta: ").orderBy("clave_registro").collect()
    assert [(r.clave_registro, r.motivo_rechazo) for r in rejects] == [("2", "Falta: 99"), ("3", "Falta: 99")]


def test_foreign_key_shares_treat_nulls_as_asked(link):
    share = indicators.foreign_key_share
    values = [share(link, "x").first(), share(link, "x", null_is_orphan=True).first(), share(link, "x", only_present=True).first()]
    assert [v.valor_calculado for v in values] == [Decimal("50"), Decimal("75"), Decimal("66.67")]


def test_share_of_an_empty_table_is_zero(spark):
    empty = spark.createDataFrame([], "x int")
    row = indicators.shares("t", empty, [indicators.null_share("x")]).first()
    assert (row.valor_calculado, row.resultado) == (0, "OK")


def test_thresholds_must_be_ordered(spark):
    with pytest.raises(ValueError):
        indicators.shares("t", spark.range(1), [indicators.null_share("id", warn=5, error=1)])


def test_outliers_use_the_base_for_quartiles_and_total(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 1000, -5, 0]], "v double")
    base = lambda: F.col("v") > 0
    wanted = [indicators.Outliers("v", base, base), indicators.Outliers("v", base, lower=True, name="LOWER")]
    upper, both = indicators.outlier_shares("t", df, wanted).orderBy(F.desc("indicador")).collect()
    nothing = indicators.outlier_shares("t", df.filter("v > 9999"), wanted).first()
    assert (nothing.valor_calculado, nothing.resultado) == (0, "OK")
    assert upper.valor_calculado == Decimal("20") and both.valor_calculado == Decimal("40")
    assert both.resultado == "ERROR"


def test_count_difference_is_only_a_warning(spark):
    row = indicators.count_difference("t", spark.range(5), spark.range(2)).first()
    assert (row.valor_calculado, row.resultado) == (3, "WARNING")


def test_gate_looks_at_the_latest_run(spark):
    scripts = spark.createDataFrame([(1, "a"), (2, "b")], "script_id long, script_nombre string")
    runs = spark.createDataFrame([(1, 1), (2, 1), (3, 2)], "log_id long, script_id long")
    found = spark.createDataFrame(
        [(1, "t", "i", 5.0, "ERROR"), (2, "t", "i", 0.0, "OK"), (3, "u", "j", 9.0, "ERROR")],
        "log_id long, tabla string, indicador string, valor_calculado double, resultado string",
    )
    assert [r.tabla for r in indicators.gate(found, runs, scripts, ["a", "b"]).collect()] == ["u"]
    with pytest.raises(RuntimeError):
        indicators.gate(found, runs, scripts, ["b"], strict=True)

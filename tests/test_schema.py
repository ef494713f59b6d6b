import pytest
from pyspark.sql import functions as F

from cotejo import RegistryError
from cotejo.errors import require_columns
from cotejo.operators import schema as S


def frame(spark, ddl):
    return spark.createDataFrame([], ddl)


def test_find_columns(spark):
    df = frame(spark, "`Expediénte` string, ` STATUS ` string, `CM_BASE.Id` string, estado string")
    assert S.case_column(df) == "Expediénte"
    assert S.find_status(df) == "estado"
    assert S.find_status(df.drop("estado")) == " STATUS "
    assert S.find_qualified(df, ["EXPEDIEN_1", "ID"]) == "CM_BASE.Id"
    assert S.find_ignoring_case(df, "Estado") == "estado"
    assert S.find_column(df, ["nada"]) is None
    with pytest.raises(RegistryError, match="EXPEDIENTE"):
        S.case_column(frame(spark, "a string"))


def test_later_qualified_column_wins(spark):
    df = frame(spark, "`A.Estado` string, `B.Estado` string")
    assert S.find_qualified(df, ["ESTADO"]) == "B.Estado"


def test_evolution_types_and_names(spark):
    target = frame(spark, "oid long, EXPEDIENTE string")
    stage = frame(
        spark, "Expediente string, a int, b smallint, c double, d float, e date, f boolean, g bigint, Shape string, EXPEDIENTE_KEY string"
    )
    evolved = S.evolve_to(target, stage)
    assert dict(evolved.dtypes) == {
        "oid": "bigint", "EXPEDIENTE": "string", "a": "int", "b": "smallint", "c": "double", "d": "float",
        "e": "timestamp_ntz", "f": "string", "g": "bigint",
    }
    synced = S.add_sync_columns(evolved)
    assert synced.columns[-4:] == ["EXPEDIENTE_KEY", "Fecha_Actualizacion", "EN_REPORTE", "FECHA_REPORTE"]
    assert S.add_sync_columns(synced).columns == synced.columns
    assert ("EXPEDIENTE", "Expediente") in S.transfer_pairs(synced, stage)
    assert not {"oid", "EXPEDIENTE_KEY", "Shape"} & {t for t, _ in S.transfer_pairs(synced, stage)}


def test_empty_target(spark):
    t = S.empty_target(frame(spark, "row_seq long, EXPEDIENTE string, EXPEDIENTE_KEY string"))
    assert t.columns == ["oid", "EXPEDIENTE", "EXPEDIENTE_KEY", "Fecha_Actualizacion", "EN_REPORTE", "FECHA_REPORTE"]


def test_blocked():
    assert S.is_blocked("ObjectId") and S.is_blocked("Shape_Área") and not S.is_blocked("ESTADO")


def test_short_names():
    plan = S.short_names(["Expediente", "EXPEDIENTE_KEY", "", "2026 año", "Área (ha)", "__x__", "expedientes"])
    assert [b for _, b in plan] == ["expediente", "expedient1", "campo", "f_2026_ano", "area_ha", "x", "expedient2"]
    many = S.short_names(["columna_larga"] * 12)
    assert many[10][1] == "columna_10" and len({b for _, b in many}) == 12


def test_pick_wanted(spark):
    present, missing = S.pick_wanted(frame(spark, "estado string, Expediente string"), ("EXPEDIENTE", "ESTADO", "X"))
    assert (present, missing) == (["Expediente", "estado"], ["X"])
    with pytest.raises(RegistryError):
        S.pick_wanted(frame(spark, "a string"), ("X",))


def test_small_helpers(spark):
    df = frame(spark, "a string, CONSECTIVO string, FECHA_X date, FECHA string")
    assert S.repair_aliases(df).columns[1] == "CONSECUTIVO"
    assert S.standard_date(df).columns == ["a", "CONSECTIVO", "FECHA"]
    assert S.standard_date(frame(spark, "a string")) is None
    assert S.preferred_date(frame(spark, "Fecha_Actualizacion date, FECHA_INGRESO date")) == "FECHA_INGRESO"
    assert S.preferred_date(frame(spark, "a string")) is None
    assert S.with_first(df, "n", 1).columns[0] == "n"
    assert S.place_after(df, "FECHA", "a").columns == ["a", "FECHA", "CONSECTIVO", "FECHA_X"]
    assert S.with_defaults(df, ["a", "z"]).columns[-1] == "z"
    assert S.common_columns(frame(spark, "x int, a int"), df, exclude=()) == ["a"]
    assert dict(S.keys_as_text(frame(spark, "k int"), ["k"]).dtypes) == {"k": "string"}
    with pytest.raises(RegistryError, match="several columns"):
        S.upper_headers(frame(spark, "a string, `a ` string"))
    with pytest.raises(RegistryError, match="missing"):
        require_columns(["a"], ["b"])


def test_clean_text_columns(spark):
    df = spark.createDataFrame([("á ", 1)], "t string, n int")
    assert S.clean_text_columns(df).first() == ("A", 1)
    assert S.clean_text_columns(df, lambda c: F.upper(c), ["t", "none"]).first() == ("Á ", 1)

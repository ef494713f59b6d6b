"""Nothing stored is lost: odd spellings, values that do not fit, small parcels, ties."""

from datetime import datetime

from cotejo.operators import merge as M
from cotejo.operators import overlap as O
from cotejo.operators import reconcile as R
from cotejo.operators import schema as S
from tests.conftest import rows

NOW = datetime(2026, 3, 1, 12)


def test_sync_columns_in_other_spellings_keep_values(spark):
    df = spark.createDataFrame([(1, "K1", 1)], "oid long, expediente_key string, en_reporte int")
    out = S.add_sync_columns(df)
    assert rows(out, "oid", "EXPEDIENTE_KEY", "EN_REPORTE") == [(1, "K1", 1)]
    assert set(S.SYNC_COLUMNS) <= set(out.columns)


def test_uncastable_values_stay(spark):
    target = S.add_sync_columns(spark.createDataFrame([(1, "A", 5.0), (2, "B", 6.0)], "oid long, EXPEDIENTE_KEY string, AREA double"))
    winners = spark.createDataFrame([("A", 1, "12,5 ha"), ("B", 2, "7")], "EXPEDIENTE_KEY string, row_seq long, AREA string")
    out = R.upsert(target, winners, NOW)
    assert rows(out, "EXPEDIENTE_KEY", "AREA", "ACCION") == [("A", 5.0, "NOCHANGE"), ("B", 7.0, "UPDATE")]
    assert rows(R.values_not_valid(target, winners)) == [("A", "AREA", "12,5 ha")]


def test_merge_of_other_types_keeps_the_text(spark):
    source = spark.createDataFrame([("x", "abc"), ("y", "3")], "EXPEDIENTE string, N string")
    target = spark.createDataFrame([("x", 1), ("y", 2), ("z", 4)], "EXPEDIENTE string, N int")
    assert rows(M.merged(M.compare(source, target)), "EXPEDIENTE", "N") == [("x", "abc"), ("y", "3"), ("z", "4")]


def squares(spark, size, n=300):
    return spark.sql(
        f"SELECT id AS oid, concat('E', id) AS EXPEDIENTE, 'VIGENTE' AS ESTADO, id * {size} * 0.75D AS xmin, 0D AS ymin, "
        f"id * {size} * 0.75D + {size} AS xmax, {size}D AS ymax FROM range({n})"
    )


def test_candidates_follow_true_pairs_at_any_scale(spark):
    for size in (1e-5, 1.0, 1e4):
        df = squares(spark, size)
        pairs = O.candidate_pairs(df, df)
        assert pairs.count() == 3 * 300 - 2  # each square, and its neighbours
        grid = O._cells(df.withColumn("level", O._level(1.0)), 1.0).groupBy("level", "cx", "cy").count()
        assert grid.agg({"count": "max"}).first()[0] <= 6


def test_small_overlap_is_an_overlap(spark):
    ring = "array({0}D, {0}D + 0.0005D, {0}D + 0.0005D, {0}D)"
    text = (
        "SELECT {i} AS oid, 'P{i}' AS EXPEDIENTE, 'VIGENTE' AS ESTADO, {x}D AS xmin, 0D AS ymin, {x}D + 0.0005D AS xmax, 0.0005D AS ymax, "
        + "{r} AS xs, array(0D, 0D, 0.0005D, 0.0005D) AS ys, array(4) AS ring_sizes"
    )
    df = spark.sql(" UNION ALL ".join(text.format(i=i, x=x, r=ring.format(x)) for i, x in ((1, 0.0), (2, 0.0002), (3, 0.0012))))
    found = rows(O.overlaps(df, df, shape="ring"), "EXPEDIENTE_BASE", "EXPEDIENTE", "TIPO", "PORCENTAJE_TRASLAPE")
    assert found == [("P1", "P2", "TRASLAPA", 60.0), ("P2", "P1", "TRASLAPA", 60.0)]
    near = rows(O.overlaps(df, df, shape="ring", xy_tol=0.001), "EXPEDIENTE_BASE", "EXPEDIENTE", "TIPO")
    assert ("P2", "P3", "TOCA") in near


def test_polygons_are_measured_once(spark):
    df = squares(spark, 1.0, 4).selectExpr("*", "array(xmin, xmax, xmax, xmin) AS xs", "array(ymin, ymin, ymax, ymax) AS ys", "array(4) AS ring_sizes")
    plan = O.overlaps(df, df, shape="ring")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_subject_ids_are_trimmed(spark):
    df = squares(spark, 1.0, 3).selectExpr("oid", "concat(' ', EXPEDIENTE, ' ') AS EXPEDIENTE", "xmin", "ymin", "xmax", "ymax")
    wanted = spark.createDataFrame([("E1",), ("E9",)], "EXPEDIENTE string")
    assert rows(O.subject_problems(df, wanted)) == [("E9", "EXPEDIENTE_NO_ENCONTRADO")]


def test_ranking_of_qualified_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`T.Id` int, `T.Expediente` int, `U.expediente` int")
    assert S.find_qualified(df, ["EXPEDIENTE", "ID"]) == "U.expediente" and S.find_qualified(df, ["x", "id"]) == "T.Id"
    assert S.find_qualified(df, ["x"]) is None

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cotejo import RegistryError
from cotejo.operators import reconcile as R
from cotejo.plans.registry_etl import RegistryRun, RunInfo, run_registry_etl
from cotejo.plans.sheet_audit import audit_sheet
from cotejo.sources.publish import published
from cotejo.sources.reports import read_table, run_folder
from cotejo.sources.snapshots import keep_snapshot
from tests.conftest import rows

NOW = datetime(2026, 3, 1, 12)
OLD = datetime(2020, 1, 1)
LATER = datetime(2026, 4, 1, 12)
STAGE = "row_seq long, Expediente string, ESTADO string, AREA double"
ATTR = "oid long, EXPEDIENTE_KEY string, EXPEDIENTE string, ESTADO string, AREA string, Fecha_Actualizacion timestamp_ntz"
BASE = "oid long, EXPEDIENTE string, ESTADO string, xmin double, ymin double, xmax double, ymax double"


def tables(spark):
    stage = spark.createDataFrame(
        [
            (1, "2026-a-1", "Vigente", 1.0), (2, " 2026-Á-1 ", "Archivado", 2.0), (3, "2026-B-2", None, None),
            (4, "", "x", 1.0), (5, None, "x", 1.0), (6, "2026-C-3", "Vigente", 3.0), (7, "2026-D-4", " ", 4.0),
        ],
        STAGE,
    )
    attr = spark.createDataFrame(
        [
            (1, "2026-B-2", "2026-B-2", None, None, OLD), (2, "2026-A-1", "x", "Vigente", "2.0", OLD),
            (3, "2026-A-1", "x", "Vigente", "2.0", None), (4, "VIEJO", "viejo", "SIN_DATOS", None, OLD),
            (5, "VIEJO2", "viejo2", "Vigente", None, OLD), (6, "", "", "Vigente", None, None),
            (7, None, None, None, None, None), (8, "2026-A-1", "x", "y", "2.0", OLD),
            (9, "2026-C-3", "2026-C-3", "Vigente", "3.0", OLD),
        ],
        ATTR,
    )
    base = spark.createDataFrame(
        [
            (1, "2026-A-1", "Vigente", 0.0, 0.0, 1.0, 1.0), (2, "2026-a-1", "Vigente", 0.0, 0.0, 1.0, 1.0),
            (3, "OTRO", "Vigente", 0.0, 0.0, 1.0, 1.0), (4, "OTRO", "SIN_DATOS", 0.0, 0.0, 1.0, 1.0),
            (5, None, "Vigente", 0.0, 0.0, 1.0, 1.0),
        ],
        BASE,
    )
    return stage, attr, base


def run(spark, **kw):
    return RegistryRun(*tables(spark), RunInfo(NOW), **kw)


def test_actions_and_values(spark):
    got = {r.oid: r for r in run(spark).attr_rows.collect()}
    assert {k: v.ACCION for k, v in got.items()} == {
        1: "NOCHANGE", 2: "UPDATE", 4: None, 5: "SET_SIN_DATOS", 6: "SET_SIN_DATOS", 7: "SET_SIN_DATOS",
        9: "NOCHANGE", 17: "INSERT",
    }
    # The last staged row wins, values are cast to the target's type, the key of the new row is filled.
    assert (got[2].EXPEDIENTE, got[2].ESTADO, got[2].AREA, got[2].EN_REPORTE) == (" 2026-Á-1 ", "Archivado", "2.0", 1)
    assert got[2].Fecha_Actualizacion == NOW and got[9].Fecha_Actualizacion == OLD and got[9].FECHA_REPORTE == NOW
    assert got[17].EXPEDIENTE_KEY == "2026-D-4"
    assert (got[5].ESTADO, got[5].EN_REPORTE, got[5].FECHA_REPORTE) == ("SIN_DATOS", 0, None)


def test_second_run_changes_nothing(spark):
    first = run(spark)
    again = R.upsert(first.attr_rows.drop("ACCION"), first.winners, NOW)
    assert rows(again.groupBy("ACCION").count()) == sorted([(None, 4), ("NOCHANGE", 4)], key=str)
    assert rows(again.drop("ACCION")) == rows(first.attr_rows.drop("ACCION"))


def test_row_counts_add_up(spark):
    r = run(spark)
    inserted = r.attr_rows.where("ACCION = 'INSERT'").count()
    assert r.attr_rows.count() == r.attr_before.count() - R.duplicate_losers(r.attr_before).count() + inserted
    matched = r.attr_rows.where("ACCION IN ('UPDATE', 'NOCHANGE')").count()
    assert inserted + matched == r.winners.count()


def test_polygon_sync_keeps_duplicates_when_not_deduplicated(spark):
    r = run(spark)
    out = R.sync(r.base_before, r.winners, NOW)
    assert rows(out, "oid", "ACCION") == [(1, "UPDATE"), (2, "UPDATE"), (3, "SET_SIN_DATOS"), (4, "SET_SIN_DATOS"), (5, None)]
    assert rows(R.one_row_per_missing_key(out.where("ACCION = 'SET_SIN_DATOS'"))) == [("OTRO", "OTRO")]


def test_archived_compares_with_the_state_before(spark):
    assert rows(run(spark).archived()) == [(" 2026-Á-1 ", "2026-A-1", "VIGENTE", "ARCHIVADO")]


def test_sheets_agree_with_summary(spark, tmp_path):
    info = RunInfo(NOW, excel_path="/in/hoja.xlsx", labels={"HOJA_USADA": "Hoja1"})
    run_registry_etl(*tables(spark), info, str(tmp_path))
    folder = run_folder(str(tmp_path), NOW)
    sheet = lambda n: read_table(spark, f"{folder}/{n}")
    summary = dict(rows(sheet("RESUMEN")))
    assert summary["HOJA_USADA"] == "Hoja1" and summary["CM_BASE_INSERTS"] == "0"
    assert (summary["EXCEL_PATH"], summary["REPORTE_XLSX"]) == ("/in/hoja.xlsx", folder) and "GDB_PATH" not in summary
    assert summary["VALORES_NO_VALIDOS"] == "0"
    assert int(summary["DUPLICADOS_ORIGEN"]) == sheet("DUPLICADOS_ORIGEN").count() == 1
    assert int(summary["ESTADOS_VACIOS"]) == sheet("ESTADOS_VACIOS").count() == 2
    assert int(summary["EXCEL_SIN_CM_BASE"]) == sheet("EXCEL_SIN_CM_BASE").count() == 3
    assert int(summary["CM_BASE_SIN_EXCEL"]) == sheet("CM_BASE_SIN_EXCEL").count() == 1
    assert int(summary["CM_ATRIBUTOS_DUPLICADOS_ELIMINADOS"]) == 2
    assert sheet("LOG_CM_ATRIBUTOS").where("ACCION = 'DELETE_DUP'").count() == 2
    assert sheet("LOG_CM_BASE").count() == 2 + 1 + 3 + 1
    assert sheet("tables/CM_ATRIBUTOS").count() == 8
    with pytest.raises(Exception, match="already exists"):
        run_registry_etl(*tables(spark), info, str(tmp_path))


def test_a_run_that_died_can_be_run_again(spark, tmp_path):
    stage, attr, base = tables(spark)
    broken = stage.withColumn("ESTADO", F.when(F.col("row_seq") >= 0, F.raise_error(F.lit("boom"))).cast("string"))
    with pytest.raises(Exception, match="boom"):
        run_registry_etl(broken, attr, base, RunInfo(NOW), str(tmp_path))
    folder = run_folder(str(tmp_path), NOW)
    assert published(spark, folder) is None
    run_registry_etl(stage, attr, base, RunInfo(NOW), str(tmp_path))
    assert len(published(spark, folder)) == 9 + 4
    assert read_table(spark, f"{folder}/tables/CM_ATRIBUTOS").count() == 8


def test_second_run_leaves_the_snapshots_where_they_are(spark, tmp_path):
    """From bucketed snapshots, neither table is shuffled for the upsert and the sync, and rows are those of a run without."""
    stage, attr, base = tables(spark)
    names = {"CM_ATRIBUTOS": "snap_attr", "CM_BASE": "snap_base"}
    first = run_registry_etl(stage, attr, base, RunInfo(NOW), str(tmp_path), snapshots=names, buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plain = RegistryRun(stage, first.attr_rows.drop("ACCION"), first.base_rows.drop("ACCION"), RunInfo(LATER))
        second = RegistryRun(stage, spark.table("snap_attr"), spark.table("snap_base"), RunInfo(LATER))
        for name in ("attr_rows", "base_rows"):
            again, want = getattr(second, name), getattr(plain, name)
            assert again.columns == want.columns and rows(again) == rows(want)
            plan = again._jdf.queryExecution().executedPlan().toString()
            moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
            assert moved and all("EXPEDIENTE_KEY" in line or "_row_key" in line for line in moved)
            assert plan.count("Bucketed: true") >= 1 and not _above_bucketed_scan(plan)
            wide = want._jdf.queryExecution().executedPlan().toString()
            assert wide.count("Exchange hashpartitioning") > plan.count("Exchange hashpartitioning")
        with pytest.raises(Exception, match="already exists"):
            keep_snapshot(first.attr_rows, "snap_attr", 8)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for table in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def _above_bucketed_scan(plan):
    """Hash exchanges on the way from a bucketed scan to the join: lines above it in the tree with less indent."""
    lines, found = plan.splitlines(), []
    for i, line in enumerate(lines):
        if "Bucketed: true" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for up in reversed(lines[:i]):
                at = len(up) - len(up.lstrip(" :+-"))
                if at < depth:
                    depth = at
                    if "Join" in up:
                        break
                    found += [up] if "Exchange hashpartitioning" in up else []
    return found


def test_strict_mode_stops_on_duplicates(spark, tmp_path):
    with pytest.raises(RegistryError, match="duplicate keys"):
        run_registry_etl(*tables(spark), RunInfo(NOW), str(tmp_path), on_duplicates="fail")
    folder = run_folder(str(tmp_path), NOW)
    assert rows(read_table(spark, f"{folder}/DUPLICADOS_ORIGEN")) == [("2026-A-1", 2)]
    assert read_table(spark, f"{folder}/RESUMEN").first().ESTADO_ETL == "DETENIDO_POR_DUPLICADOS"


def test_missing_case_column(spark):
    stage, attr, base = tables(spark)
    with pytest.raises(RegistryError, match="EXPEDIENTE"):
        RegistryRun(stage.drop("Expediente"), attr, base, RunInfo(NOW))


def test_without_status_column(spark):
    stage, attr, base = tables(spark)
    r = RegistryRun(stage.drop("ESTADO"), attr.drop("ESTADO"), base.drop("ESTADO"), RunInfo(NOW))
    assert r.blank_statuses().count() == 0 and r.archived().count() == 0
    assert r.attr_rows.where("ACCION = 'SET_SIN_DATOS'").count() == 0


def test_duplicates_keep_latest_date_then_lowest_id(spark):
    data = [(1, "K", None), (2, "K", OLD), (3, "K", NOW), (4, "K", NOW), (5, "", NOW), (6, "", NOW), (7, None, None)]
    df = spark.createDataFrame(data, "oid long, EXPEDIENTE_KEY string, FECHA_INGRESO timestamp_ntz")
    assert rows(R.drop_duplicates(df), "oid") == [(3,), (5,), (6,), (7,)]
    assert rows(R.duplicate_losers(df), "oid") == [(1,), (2,), (4,)]


def test_most_complete_row(spark, tmp_path):
    data = [(1, "A", "x", None, None), (2, "A", "x", "y", ""), (3, "A", "x", " ", "z"), (4, None, None, None, None), (5, " ", "x", "y", "z")]
    df = spark.createDataFrame(data, "row_seq long, EXPEDIENTE string, ESTADO string, PROYECTO string, CANTON string")
    assert rows(R.keep_most_complete(df), "row_seq") == [(2,), (4,), (5,)]
    out = audit_sheet(df, str(tmp_path), NOW)
    assert rows(out["AUDITORIA"]) == [(5, 3, 2, 1)]
    assert rows(out["DATOS"].where("ESTADO = 'PENDIENTE'"), "row_seq") == [(4,)]


def test_hot_key_plans(spark):
    """One key with most rows: limited per task before the shuffle, and split by AQE in the look-up join."""
    n = 60_000
    base = spark.range(n).select(
        F.col("id").alias("oid"), F.when(F.col("id") % 3 < 2, "HOT").otherwise(F.concat(F.lit("K"), "id")).alias("EXPEDIENTE_KEY"),
        F.sha2(F.col("id").cast("string"), 512).alias("v"),
    ).repartition(8, "oid")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        winners = R.one_per_key(base.select("oid", "EXPEDIENTE_KEY"), "EXPEDIENTE_KEY", F.desc("oid"))
        assert "Partial" in winners._jdf.queryExecution().executedPlan().toString()
        joined = R.lookup_join(base, winners.withColumnRenamed("oid", "w"), "EXPEDIENTE_KEY")
        assert joined.count() == n
        joined.write.format("noop").mode("overwrite").save()
        held = joined.agg(F.sum("w"), F.count("v"))
        held.collect()
        assert "skew=true" in held._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_metrics_store_the_staged_rows_alone(spark, monkeypatch):
    """Each snapshot is read once, for its counts, so it is not written first."""
    from queryset import registry

    sf, written, store = "/root/testdata/sf0.001", [], registry.stored
    monkeypatch.setattr(registry, "stored", lambda df: written.append(df.columns) or store(df))
    found = rows(registry.run_metrics(spark, sf))
    assert len(written) == 1 and "row_seq" in written[0] and "ACCION" not in written[0]
    assert found == rows(registry._stored_run(spark, sf).summary())

import os
from datetime import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cotejo import RegistryError
from cotejo.functions import dates as D
from cotejo.functions import predicates as P
from cotejo.functions.units import area_km2
from cotejo.operators import activity as A
from cotejo.operators import classify as C
from cotejo.operators import export as E
from cotejo.operators import meetings as M
from cotejo.operators import merge as G
from cotejo.plans import monthly_reports as MR
from cotejo.plans.classification import classify_sheet
from cotejo.plans.sheet_merge import merge_sheets
from cotejo.sources import files, inventory, publish, reports, sheets
from tests.conftest import rows

NOW = datetime(2026, 3, 1, 12)


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf8")
    return str(path)


def test_dates(spark):
    texts = ["3/4/2026", "03-04-2026 5:06", "2026-4-3", "2026-04-03T05:06:07", "31/02/2026", "2026", "x", None, " 3.4.2026 "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    d = datetime(2026, 4, 3)
    got = [r[0] for r in df.select(D.parse_lenient("t")).collect()]
    assert got == [d, d.replace(hour=5, minute=6), d, datetime(2026, 4, 3, 5, 6, 7), None, None, None, None, d]
    assert D.month_bounds(2026, 12)[1].isoformat() == "2027-01-01"
    with pytest.raises(RegistryError):
        D.month_bounds(2026, 13)
    ids = spark.createDataFrame([("2026-X",), ("NAN",), (" 202",), ("1e3 ",), (None,)], "i string")
    assert [r[0] for r in ids.select(D.case_year("i")).collect()] == [2026, None, None, None, None]


def test_month_filter_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where(D.in_month("ts", 2024, 1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_typed_dates_are_not_reparsed(spark):
    df = spark.sql("select date'2026-03-04' d, '4/3/2026' t")
    assert df.select(D.as_timestamp(df, "d"), D.as_timestamp(df, "t")).first() == (datetime(2026, 3, 4), datetime(2026, 3, 4))


def test_status_policies(spark):
    states = ["ARCHIVADO", "archivado", " archivado ", "EXTINTO", "NO_UBICADO", None, "", "Vigente"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(states)], "i int, s string")
    kept = lambda c: [r[0] for r in df.where(c).select("i").orderBy("i").collect()]
    assert kept(P.status_exportable_strict("s")) == [1, 2, 3, 6, 7]
    assert kept(P.status_exportable_lenient("s")) == [2, 3, 5, 6, 7]
    assert kept(P.status_overlap_untrimmed("s")) == [2, 4, 5, 6, 7]
    assert kept(P.status_overlap_trimmed("s")) == [5, 6, 7]
    assert kept(P.status_overlap_exact("s")) == [1, 2, 4, 5, 6, 7]


def test_classification_plan(spark, tmp_path):
    df = spark.createDataFrame(
        [("2026-EXP-1", "Vigente", "x", "Arena", "", "PRIVADO", ""), ("2020-MUN-2", "Archivado", None, None, None, None, None),
         ("2020-MUN-3", "Vigente", "x", "Arena", None, "", None)],
        "EXPEDIENTE string, ESTADO string, CLASE string, MATERIALES string, REGIMEN_JURIDICO string, SUBCLASE string, FINALIDAD string",
    )
    assert rows(C.by_age(df, 2026), C.GROUP) == [("ARCHIVADOS",), ("METALICOS",), ("PERMISOS_ESPECIALES",)]
    counts, control = classify_sheet(df, "clean_text", str(tmp_path), NOW)
    classify_sheet(df, "clean_text", str(tmp_path), datetime(2026, 3, 2))
    assert rows(counts) == [("ARCHIVADOS", 1), ("NO_METALICOS", 1), ("PERMISO_ESPECIAL", 1)]
    assert control.first()[0] == 0
    assert (tmp_path / "AGRUPADO_20260301_120000" / "RESUMEN").exists()
    with pytest.raises(RegistryError, match="missing"):
        C.by_clean_text(df.drop("SUBCLASE"))
    units = spark.sql("select 5.0D a, explode(array('KM2', 'ha ', 'M2', 'x')) u")
    assert [r[0] for r in units.select(area_km2("a", "u")).collect()] == [5.0, 0.05, 0.000005, None]


def test_merge(spark, tmp_path):
    a = spark.createDataFrame([("1", "x", 5), ("2", "Y", 6), (None, "n", 1), ("9", "q", 1)], "expediente string, nombre string, n int")
    b = spark.createDataFrame([(" 1 ", "X ", 5), ("2", None, 7), (None, "n", 2), ("3", "z", 3)], "EXPEDIENTE string, NOMBRE string, N int")
    outcome = merge_sheets(a, b, str(tmp_path), ("A", "B"), NOW)
    assert outcome.first() == (1, 1, 2)
    folder = tmp_path / "MERGE_A_CON_B_20260301_120000"
    got = rows(reports.read_table(spark, str(folder / "DATOS_ACTUALIZADOS")))
    assert got == sorted(
        [("1", "X ", 5, "SIN_CAMBIO"), ("2", "Y", 6, "ACTUALIZADO"), (None, "n", 2, "NO_EN_ORIGEN"), ("3", "z", 3, "NO_EN_ORIGEN")], key=str
    )
    changes = rows(reports.read_table(spark, str(folder / "REPORTE_CAMBIOS")))
    assert changes == [("2", "N", "7", "6"), ("2", "NOMBRE", None, "Y")]
    twice = a.union(spark.sql("select '1', 'w', 8")).withColumn("row_seq", F.monotonically_increasing_id())
    with pytest.raises(Exception, match="duplicate id"):
        G.merged(G.compare(twice, b)).collect()
    last = G.merged(G.compare(twice, b, on_duplicates="last")).where("EXPEDIENTE = '1'").first()
    assert (last.NOMBRE, last.N) == ("w", 8)


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [("METALICOS", "Vigente"), ("METALICOS", "ARCHIVADO"), ("PERMISO_ESPECIAL", None), ("NO_METALICOS", "x"), ("OTRO", "x")],
        "GRUPO_CATASTRO string, ESTADO string",
    )
    manifest = E.export_groups(df, str(tmp_path / "seg"))
    assert rows(manifest) == [("METALICOS", 1, "EXPORTADO"), ("NO_METALICOS", 1, "EXPORTADO"), ("PERMISO_ESPECIAL", 0, "SIN_REGISTROS")]
    assert sorted(p.name for p in (tmp_path / "seg").glob("GRUPO*")) == ["GRUPO_CATASTRO=METALICOS", "GRUPO_CATASTRO=NO_METALICOS"]
    plan, missing = E.write_single_export(df, str(tmp_path / "uno"))
    assert plan == [("ESTADO", "estado"), ("GRUPO_CATASTRO", "grupo_cata")] and "NOMBRE" in missing
    assert spark.read.parquet(str(tmp_path / "uno")).count() == 4
    with pytest.raises(RegistryError, match="no rows"):
        E.write_single_export(df.where("ESTADO = 'ARCHIVADO'"), str(tmp_path / "nada"))
    with pytest.raises(RegistryError, match="ESTADO"):
        E.single_export(df.drop("ESTADO"))


def test_first_available_and_folder(spark, tmp_path):
    one = put(tmp_path / "in" / "a.csv", "Fecha,Usuario,Asunto\n5/3/2026,Ana,Caso 2026-CAN-PRI-008\n1/4/2026,Ana,x\n")
    put(tmp_path / "in" / "b.csv", "Fecha (inicio),Usuario,Consectivo\n2026-03-06,ana,77\n2026-03-07,Luis,78\n")
    put(tmp_path / "in" / "c.csv", "Fecha,Usuario,Asunto\n9/3/2026,ANA,y\n")
    put(tmp_path / "in" / "Reporte Teletrabajo_x.csv", "Fecha,Usuario\n1/3/2026,Ana\n")
    put(tmp_path / "in" / "sinfecha.csv", "a,b\n1,2\n")
    df, used = sheets.read_first_available(spark, [str(tmp_path / "no.csv"), one])
    assert used == one and df.count() == 2
    with pytest.raises(RegistryError, match="no.csv"):
        sheets.read_first_available(spark, [str(tmp_path / "no.csv")])
    found, rejects = sheets.read_folder(spark, str(tmp_path / "in"), skip_containing=["reporte teletrabajo"])
    assert len(found) == 3  # a and c share a layout
    assert rejects.count() == 0
    report, _ = MR.task_report(spark, str(tmp_path / "in"), 2026, 3, "Ana", str(tmp_path / "out"))
    day = lambda d: datetime(2026, 3, d)
    assert [tuple(r) for r in report.collect()] == [
        (day(5), "Caso 2026-CAN-PRI-008", "2026-CAN-PRI-008", ""), (day(6), "", "", "77"), (day(9), "y", "", ""),
    ]
    assert (tmp_path / "out" / "Reporte Teletrabajo_MARCH-2026_Ana").exists()
    mail = put(tmp_path / "mail.csv", "Fecha de Envío,Asunto,Destinatarios\n9/3/2026,y,p1\n10/3/2026,z,p2\n")
    joined, _ = MR.task_report(spark, str(tmp_path / "in"), 2026, 3, "Ana", str(tmp_path / "out2"), mail_path=mail)
    assert [(r.FECHA, r.DESTINATARIOS) for r in joined.collect()] == [(day(5), None), (day(6), None), (day(9), "p1"), (day(10), "p2")]
    out, _ = MR.consolidation_report(spark, str(tmp_path / "in"), "ana", 2026, str(tmp_path / "cons"), "Informe")
    assert out["TITULO"].first()[0] == "Informe March 2026" and out["DATOS"].count() == 5
    with pytest.raises(RegistryError, match="FECHA_DE_ENVIO"):
        A.month_mail(df, 2026, 3)


def test_damaged_sheet_is_rejected(spark, tmp_path):
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "good"))
    part = next((tmp_path / "good").glob("part-*.parquet"))
    put(tmp_path / "in" / "bad.parquet", "not a table")
    (tmp_path / "in" / "good.parquet").write_bytes(part.read_bytes())
    found, rejects = sheets.read_folder(spark, str(tmp_path / "in"), fmt="parquet")
    assert [df.count() for df in found] == [2]
    assert [r.path.rsplit("/", 1)[1] for r in rejects.collect()] == ["bad.parquet"]


def test_empty_tasks(spark):
    empty = A.task_table([None], spark)
    mail = spark.createDataFrame([(NOW, "a", "p")], "FECHA timestamp_ntz, ASUNTO string, DESTINATARIOS string")
    assert rows(A.tasks_with_mail(empty, mail)) == [(NOW, "a", "", "", "p")]
    assert A.task_report(empty, mail.limit(0)).columns[-1] == "DESTINATARIOS"


def test_null_subjects_and_times(spark):
    tasks = spark.createDataFrame([(NOW, None, "e", "c"), (None, "a", "e", "c"), (NOW, "a", "e", "c")], "FECHA timestamp_ntz, ASUNTO string, EXPEDIENTE string, CONSECUTIVO string")
    mail = spark.createDataFrame([(NOW, None, "p"), (None, "a", "q"), (NOW, "a", "r")], "FECHA timestamp_ntz, ASUNTO string, DESTINATARIOS string")
    pairs = lambda df: sorted((r.EXPEDIENTE, r.DESTINATARIOS or "-") for r in df.collect())
    assert pairs(A.tasks_with_mail(tasks, mail)) == [("", "p"), ("", "q"), ("e", "-"), ("e", "-"), ("e", "r")]
    assert pairs(A.tasks_with_mail(tasks, mail, null_subjects_match=True)) == [("", "q"), ("e", "-"), ("e", "p"), ("e", "r")]


def test_busy_pair_is_dealt_to_many_tasks(spark):
    """One (time, subject) pair with 600 tasks and 500 mails, equal rows among them, and a light one: same rows, even work."""
    tasks = [(NOW, "hot", f"e{i % 40}", "c") for i in range(600)] + [(NOW, f"s{i}", "e", "c") for i in range(50)] + [(NOW, None, "n", "c"), (None, "hot", "n", "c")]
    mail = [(NOW, "hot", f"p{i % 30}") for i in range(500)] + [(NOW, f"s{i}", "q") for i in range(0, 80, 2)] + [(NOW, None, "r")]
    t = spark.createDataFrame(tasks, "FECHA timestamp_ntz, ASUNTO string, EXPEDIENTE string, CONSECUTIVO string").repartition(3)
    m = spark.createDataFrame(mail, "FECHA timestamp_ntz, ASUNTO string, DESTINATARIOS string").repartition(3)
    for nulls in (False, True):
        plain, dealt = (A.tasks_with_mail(t, m, nulls, piece=p) for p in (10**6, 50))
        count = lambda df: rows(df.groupBy(*df.columns).count())
        assert count(plain) == count(dealt)
    heavy = A._heavy_pairs(t, m, False, 50)
    assert rows(heavy, "_ha", "_parts_t", "_parts_m") == [("hot", 12, 10)]
    keys = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        made = A._heavy_matches(t, m, heavy).groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in made)
        assert sum(sizes) == 600 * 500 and sizes[-1] <= 5 * sizes[len(sizes) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_months(spark):
    df = spark.createDataFrame([(1, None), (2, "2026-02-01"), (3, "2026-02-02"), (4, "2026-01-01"), (5, "2026-01-02")], "row_seq int, t string")
    df = df.withColumn("FECHA", D.parse_lenient("t"))
    assert A.most_frequent_month(df).first()[0] == 1
    assert A.first_month(df).first()[0] == 2
    assert A.title_from_month(A.first_month(df.limit(1)), "Informe", 2026).first()[0] == "Informe Sin datos 2026"
    assert A.title_from_month(A.most_frequent_month(df.limit(1)), "Informe", 2026, "").first()[0] == "Informe  2026"


def test_listing_leaves_nothing_out(spark, tmp_path):
    base = tmp_path / "todo"
    for name in ("_nota.txt", ".oculto.txt", "vacio.txt", "a b/ñ #1.txt", "a b/c/.d/x.csv"):
        put(base / name, "" if name == "vacio.txt" else "x")
    found = {r.path: r.length for r in files.list_files(spark, str(base)).collect()}
    assert found == {str(base / n): 0 if n == "vacio.txt" else 1 for n in ("_nota.txt", ".oculto.txt", "vacio.txt", "a b/ñ #1.txt", "a b/c/.d/x.csv")}
    assert [r.path for r in files.list_files(spark, str(base), "*.csv").collect()] == [str(base / "a b/c/.d/x.csv")]
    assert files.list_files(spark, str(base), recursive=False).count() == 3
    (tmp_path / "nada").mkdir()
    assert files.list_files(spark, str(tmp_path / "nada")).count() == 0
    with pytest.raises(RegistryError, match="no such folder"):
        files.list_files(spark, str(tmp_path / "falta"))


def test_large_folders_are_listed_in_pages(tmp_path, monkeypatch):
    """No page is larger than the limit, and the folder is not read ahead of the pages."""
    for i in range(95):
        put(tmp_path / "many" / f"f{i}", "x" * i)
    (tmp_path / "many" / "sub").mkdir()
    (tmp_path / "many" / "loop").symlink_to(tmp_path / "many", target_is_directory=True)
    (tmp_path / "many" / "lost").symlink_to(tmp_path / "nothing")
    monkeypatch.setattr(files, "PAGE", 10)
    taken, scandir = [], os.scandir

    class Counted:
        def __init__(self, path):
            self.it = scandir(path)
        def __enter__(self):
            return self
        def __exit__(self, *_):
            self.it.close()
        def __iter__(self):
            for e in self.it:
                taken.append(e.name)
                yield e

    monkeypatch.setattr(os, "scandir", Counted)
    pages = files._children([pa.RecordBatch.from_pydict({"path": [str(tmp_path / "many")]})])
    first = next(pages)
    assert first.num_rows == 10 and len(taken) <= 12
    rest = list(pages)
    assert max(p.num_rows for p in rest) <= 10 and 10 + sum(p.num_rows for p in rest) == 97
    found = {r["path"].rsplit("/", 1)[1]: r for p in [first, *rest] for r in p.to_pylist()}
    assert found["f7"]["length"] == 7 and found["sub"]["folder"] and "loop" not in found and found["lost"]["length"] is None


def test_cells_with_line_breaks(spark, tmp_path):
    put(tmp_path / "s.csv", 'A,B\n"uno\ndos",1\ntres,2\n')
    assert rows(sheets.read_sheet(spark, str(tmp_path / "s.csv")), "A", "B") == [("tres", "2"), ("uno\ndos", "1")]


def test_large_quoted_csv_is_split(spark, tmp_path):
    """Many splits in the middle of cells give what one whole-file reader gives, in file order, with damaged rows apart."""
    import csv
    import random

    r = random.Random(7)
    cell = lambda: "".join(r.choice(["a", "ñ", ",", '"', "\n", "\r\n", " ", "x", ""]) for _ in range(r.randint(0, 14)))
    table = [(cell(), cell(), str(i)) for i in range(400)]
    path = tmp_path / "in" / "a b+c #1.csv"
    path.parent.mkdir()
    with path.open("w", newline="", encoding="utf8") as f:
        f.write("\ufeff\n")
        writer = csv.writer(f, lineterminator="\r\n")
        writer.writerows([("A", "B\nzwei", "N"), *table])
    put(tmp_path / "in" / "long.csv", "A,N\n1,2\n1,2,3\n\n4\n5,6\n\"7,8\n9,10\n")
    put(tmp_path / "in" / "empty.csv", "")
    small = {"spark.sql.files.maxPartitionBytes": "150", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 30
        sheet = sheets.read_sheet(spark, str(path), order="place")
        want = [tuple(v or None for v in t) for t in table]
        assert [tuple(x)[:3] for x in sheet.orderBy("place").collect()] == want and sheet.columns == ["A", "B\nzwei", "N", "place"]
        plain = tmp_path / "plain.csv"
        with plain.open("w", newline="", encoding="utf8") as f:
            csv.writer(f, lineterminator="\n").writerows([("A", "B", "N"), *[tuple(v.replace("\r", "") for v in t) for t in table]])
        whole = spark.read.options(header=True, multiLine=True, escape='"').csv(str(plain))
        assert rows(sheets.read_sheet(spark, str(plain))) == rows(whole)
        good, bad = sheets.read_sheet_with_rejects(spark, str(tmp_path / "in" / "long.csv"))
        assert rows(good) == sorted([("1", "2"), ("4", None), ("5", "6")], key=str)
        assert sorted(x.reason.split(": ")[1] for x in bad.collect()) == ["3 cells, 2 columns", "a quote is not closed", "a quote is not closed"]
        found, rejects = sheets.read_folder(spark, str(tmp_path / "in"))
        assert sorted((tuple(df.columns), df.count()) for df in found) == [(("A", "B\nzwei", "N", "_source_file", "_source_row"), 400), (("A", "N", "_source_file", "_source_row"), 3)]
        names = sorted((x.path.rsplit("/", 1)[1], x.reason.split(": ")[-1]) for x in rejects.collect())
        assert names == [("empty.csv", "no header"), ("long.csv", "3 cells, 2 columns"), ("long.csv", "a quote is not closed"), ("long.csv", "a quote is not closed")]
        assert {x[0] for x in found[0].select("_source_file").distinct().collect()} <= {"a b+c #1.csv", "long.csv"}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_folder_is_read_without_a_job_per_file(spark, tmp_path):
    """The jobs of reading a folder do not grow with its files."""
    def jobs(n):
        folder = tmp_path / f"d{n}"
        for i in range(n):
            put(folder / f"f{i}.csv", f"A,B\n{i},x\n" if i % 2 else f"A,C\n{i},y\n")
        group = f"folder-{n}"
        spark.sparkContext.setJobGroup(group, group)
        found, _ = sheets.read_folder(spark, str(folder))
        total = sum(df.count() for df in found)
        spark.sparkContext.setJobGroup("", "")
        assert total == n and len(found) == 2
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(60) <= jobs(6) + 2


def test_publication_survives_a_failed_write(spark, tmp_path):
    """Readers keep the old report while a new one is written and when it fails; then the new one shows as a whole."""
    folder = str(tmp_path / "rep")
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v int")
    reports.write_report({"A": frame(1, 2), "B": frame(3)}, folder, overwrite=True)
    broken = frame(7).select(F.when(F.col("v") == 7, F.raise_error(F.lit("boom"))).cast("int").alias("v"))
    with pytest.raises(Exception, match="boom"):
        reports.write_report({"A": frame(9), "B": broken}, folder, overwrite=True)
    assert rows(reports.read_table(spark, f"{folder}/A")) == [(1,), (2,)] and rows(reports.read_table(spark, f"{folder}/B")) == [(3,)]
    half = publish.Publication(spark, folder, replace=True)  # dies before its commit
    half.write("A", frame(8))
    assert rows(reports.read_table(spark, f"{folder}/A")) == [(1,), (2,)]
    out = reports.write_report({"A": frame(5), "B": frame()}, folder, overwrite=True, skip_empty=("B",))
    assert list(out) == ["A"] and set(publish.published(spark, folder)) == {"A"}
    assert rows(reports.read_table(spark, f"{folder}/A")) == [(5,)]
    with pytest.raises(RegistryError, match="already exists"):
        publish.Publication(spark, folder)
    reports.write_table(frame(1), str(tmp_path / "one"), overwrite=True)
    reports.write_table(frame(2), str(tmp_path / "one"), overwrite=True)
    assert rows(reports.read_table(spark, str(tmp_path / "one"))) == [(2,)]


def test_frames_are_evaluated_once(spark, tmp_path):
    """Rows that pass a frame are counted by an accumulator: one pass each, whether sheets may be left out or not."""
    seen = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(10).mapInArrow(passed, "id long")
    reports.write_report({"A": df}, str(tmp_path / "a"), overwrite=True, skip_empty=("A",))
    reports.write_report({"A": df}, str(tmp_path / "b"), skip_empty=("A",))
    export = df.selectExpr("CAST(id AS STRING) EXPEDIENTE", "'Vigente' ESTADO")
    plan, _ = E.write_single_export(export, str(tmp_path / "c"), run_ts=NOW)
    assert seen.value == 30
    names = spark.read.option("header", True).csv(str(tmp_path / "c_CAMPOS_20260301_120000"))
    assert [tuple(r) for r in names.where("NOMBRE_CORTO IS NOT NULL").select("CAMPO", "NOMBRE_CORTO").collect()] == plan


def test_files_and_inventory(spark, tmp_path):
    base = tmp_path / "docs"
    put(base / "x" / "N-1_tema_2026-CAN-PRI-1.pdf", "a")
    put(base / "x" / "solo.TXT", "b")
    put(base / "otro.exe", "c")
    put(base / "nb" / "Libro.IPYNB", "{}")
    put(base / "log_1.csv", "a\n1\n")
    put(base / "nb" / "log_2.csv", "a\n1\n")
    listing = files.list_files(spark, str(base))
    assert listing.columns == ["path", "modificationTime", "length"] and listing.count() == 6
    year, month = datetime.now().year, datetime.now().month
    out = MR.document_report(spark, str(base), year, month, str(tmp_path / "rep"))
    assert rows(out["RESUMEN_CARPETA"]) == [(".", 1), ("nb", 1), ("x", 2)]
    assert rows(out["REVISAR_NOMBRES"], "ARCHIVO") == [("log_1.csv",), ("log_2.csv",), ("solo.TXT",)]
    with pytest.raises(RegistryError, match="no documents"):
        MR.document_report(spark, str(base), 1999, 1, str(tmp_path / "rep2"))
    assert rows(files.notebooks(spark, str(base)), "NOTEBOOK") == [("Libro.IPYNB",)]
    assert rows(files.run_logs(spark, str(base)), "ARCHIVO_LOG") == [("log_1.csv",)]
    spark.sql("create or replace temp view parcelas as select 1 xmin, 1 ymin, 2 xmax, 2 ymax")
    spark.sql("create or replace temp view atributos as select 1 a")
    categories = inventory.inventory(spark, project_dir=str(base), log_dir=str(base))
    assert ("parcelas", "FeatureClass", "Polygon", "parcelas") in rows(categories["FEATURE_CLASSES"])
    assert ("atributos", "Table", "atributos") in rows(categories["TABLAS"])
    counts = dict(rows(inventory.category_counts(categories)))
    assert counts["NOTEBOOKS"] == 1 and counts["LOGS_AUTOMATICOS"] == 1
    categories["VACIA"] = categories["TABLAS"].limit(0)
    assert "VACIA" not in inventory.write_inventory(categories, str(tmp_path / "inv"))
    for v in ("parcelas", "atributos"):
        spark.catalog.dropTempView(v)


def test_meetings(spark, tmp_path):
    start = datetime(2026, 2, 1)
    data = [
        ("c", 26, 1, start, 50, "Comité", ["a", "b"]), ("c", 26, 1, datetime(2026, 3, 1), 60, "fuera", ["a"]),
        ("c", 26, 0, start, 60, "personal", ["a"]), ("c", 26, 1, start, 60, "Cancelled: x", ["a"]),
        ("c", 26, 1, start, 60, None, ["a"]), ("c", 26, 1, start, 60, "sin gente", []), ("c", 43, 1, start, 60, "x", ["a"]),
    ]
    df = spark.createDataFrame(data, "calendar string, class int, meeting_status int, start timestamp_ntz, duration_min int, subject string, recipients array<string>")
    df = df.withColumn("end", F.expr("start + make_dt_interval(0, 0, duration_min)")).withColumn("organizer", F.lit("o"))
    path = str(tmp_path / "m")
    df.write.parquet(path)
    out = MR.meeting_report(sheets.read_meetings(spark, path), 2026, 2, str(tmp_path / "out"))
    assert out["Resumen"].first() == (1, 0.83)
    with pytest.raises(RegistryError, match="no meetings"):
        MR.meeting_report(df, 2020, 2, str(tmp_path / "out2"))
    calendars = spark.createDataFrame([("c",), ("d",)], "calendar string")
    got = rows(M.calendar_inventory(calendars, df, "2026-02-01", "2026-03-01"))
    assert got == [("c", 7, 5, False), ("d", 0, 0, True)]
    assert M.first_events(df.withColumn("event_id", F.monotonically_increasing_id()), "2026-02-01", "2026-03-01", shown=2).count() == 2


def test_lines_and_row_seq(spark, tmp_path):
    reports.write_lines(spark.createDataFrame([("a",), ("b",)], "line string"), str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).count() == 2
    with pytest.raises(RegistryError):
        reports.write_lines(spark.range(1).select("id", "id"), str(tmp_path / "u"))
    seq = sheets.with_row_seq(spark.createDataFrame([("b",), ("a",)], "v string"), ["v"])
    assert [r.v for r in seq.orderBy("row_seq").collect()] == ["a", "b"]

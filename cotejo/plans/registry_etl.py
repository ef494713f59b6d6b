"""The registry run: staged rows against the attribute and polygon tables, with a nine-sheet report."""

from dataclasses import dataclass, field, replace
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.errors import RegistryError
from cotejo.functions.dates import iso_second
from cotejo.functions.text import is_blank
from cotejo.operators import quality as Q
from cotejo.operators import reconcile as R
from cotejo.operators import schema as S
from cotejo.sources.publish import Publication
from cotejo.sources.reports import run_folder
from cotejo.sources.snapshots import keep_snapshot

# Texts of log and problem rows (fixed values).
MESSAGES = {
    "UPDATE": "Registro actualizado",
    "UPDATE_BASE": "Registro espacial actualizado",
    "NOCHANGE": "Sin cambios de atributos",
    "INSERT": "Registro insertado",
    "DELETE_DUP": "OID=%d duplicado eliminado",
    "SET_SIN_DATOS": "No vino en Excel",
    "SET_SIN_DATOS_BASE": "Existe en CM_BASE pero no vino en Excel",
    "SKIP_NO_GEOMETRY": "No existe registro espacial en CM_BASE. Estado Excel='%s'",
    "DUPLICADO_ORIGEN": "Cantidad=%d",
    "ESTADO_VACIO": "Estado nulo o vacío en Excel",
    "LLAVE_VACIA": "No se pudo construir EXPEDIENTE_KEY en staging",
    "NUEVO_ARCHIVADO": "Antes='%s' Ahora='%s'",
    "EXCEL_SIN_CM_BASE": "Existe en Excel pero no en CM_BASE. Estado Excel='%s'",
    "ATRIBUTO_SIN_DATOS": "No vino en Excel actual",
    "CM_BASE_SIN_EXCEL": "Existe en CM_BASE pero no vino en Excel actual",
    "VALOR_NO_VALIDO": "Tabla=%s Campo=%s Valor='%s'",
}

# Metric -> what it counts: a problem kind, an action of the attribute (A) or polygon (B) log, or polygon rows (R).
COUNTED_METRICS = {
    "DUPLICADOS_ORIGEN": "P:DUPLICADO_ORIGEN",
    "ESTADOS_VACIOS": "P:ESTADO_VACIO",
    "NUEVOS_ARCHIVADO": "P:NUEVO_ARCHIVADO",
    "CM_BASE_SIN_EXCEL": "P:CM_BASE_SIN_EXCEL",
    "EXCEL_SIN_CM_BASE": "P:EXCEL_SIN_CM_BASE",
    "SKIPS_STAGING_SIN_LLAVE": "P:LLAVE_VACIA",
    "VALORES_NO_VALIDOS": "P:VALOR_NO_VALIDO",
    "CM_ATRIBUTOS_DUPLICADOS_ELIMINADOS": "A:DELETE_DUP",
    "CM_BASE_DUPLICADOS_ELIMINADOS": "B:DELETE_DUP",
    "CM_ATRIBUTOS_UPDATES": "A:UPDATE",
    "CM_ATRIBUTOS_INSERTS": "A:INSERT",
    "CM_ATRIBUTOS_NOCHANGE": "A:NOCHANGE",
    "CM_ATRIBUTOS_SET_SIN_DATOS": "A:SET_SIN_DATOS",
    "CM_BASE_UPDATES": "B:UPDATE",
    "CM_BASE_INSERTS": "B:INSERT",
    "CM_BASE_NOCHANGE": "B:NOCHANGE",
    "CM_BASE_SET_SIN_DATOS": "R:SET_SIN_DATOS",
}


@dataclass(frozen=True)
class RunInfo:
    """What a run is told from outside: its time and the labels its report prints."""

    run_ts: datetime
    attr_table: str = "CM_ATRIBUTOS"
    base_table: str = "CM_BASE"
    excel_path: str | None = None
    gdb_path: str | None = None
    report_path: str | None = None  # a run that writes its report fills it in
    labels: dict = field(default_factory=dict)  # further RESUMEN rows, e.g. HOJA_USADA


class RegistryRun:
    """All frames of one run, each planned when first asked for.

    ``materialize(name, frame)`` may replace a frame that several outputs read by one read back from storage.
    """

    def __init__(self, stage, attr, base, info: RunInfo, row_id="oid", materialize=lambda name, df: df):
        self.info, self.row_id, self._materialize = info, row_id, materialize
        S.case_column(stage, "stage")
        self._base, self._base_case = base, S.case_column(base, info.base_table)
        self.stage = materialize("stage", R.with_key(stage))
        self._attr = S.empty_target(self.stage, row_id) if attr is None else attr

    def _evolved(self, target):
        """A target with the staged and the managed columns it lacked."""
        return S.add_sync_columns(S.evolve_to(target, self.stage, exclude=(S.KEY, "row_seq")))

    @cached_property
    def attr_before(self) -> DataFrame:
        return self._evolved(self._attr)

    @cached_property
    def base_before(self) -> DataFrame:
        return R.with_key(self._evolved(self._base), self._base_case)

    @cached_property
    def winners(self) -> DataFrame:
        return self._materialize("stage_winners", R.stage_winners(self.stage))

    @cached_property
    def base_kept(self) -> DataFrame:
        return R.drop_duplicates(self.base_before, self.row_id)

    @cached_property
    def attr_rows(self) -> DataFrame:
        after = R.last_row_id(self._attr, self.row_id)
        rows = R.upsert(self.attr_before, self.winners, self.info.run_ts, self.row_id, after, deduplicate=True)
        return self._materialize(self.info.attr_table, rows.drop(R.ROW_KEY))

    @cached_property
    def base_rows(self) -> DataFrame:
        rows = R.sync(self.base_before, self.winners, self.info.run_ts, self.row_id, deduplicate=True)
        return self._materialize(self.info.base_table, rows.drop(R.ROW_KEY))

    # Detectors

    def duplicates(self) -> DataFrame:
        return Q.duplicate_keys(self.stage)

    def blank_statuses(self) -> DataFrame:
        return Q.blank_status(self.stage, S.find_status(self.stage))

    def archived(self) -> DataFrame:
        return R.newly_archived(self.winners, self.base_kept, self.row_id)

    def without_polygon(self) -> DataFrame:
        return R.staged_without_polygon(self.winners, self.base_before)

    def not_staged(self) -> DataFrame:
        lapsed = self.base_rows.where(F.col("ACCION") == "SET_SIN_DATOS")
        return R.one_row_per_missing_key(lapsed, self.row_id)

    # Report sheets

    def _deleted(self, target, name):
        losers = R.duplicate_losers(target, self.row_id)
        return Q.log_rows(
            losers, iso_second(self.info.run_ts), F.lit("DELETE_DUP"), name, F.col(S.KEY),
            F.format_string(MESSAGES["DELETE_DUP"], self.row_id),
        )

    def log_attributes(self) -> DataFrame:
        acted = self.attr_rows.where(F.col("ACCION").isNotNull())
        texts = F.create_map(*[F.lit(x) for a in ("UPDATE", "NOCHANGE", "INSERT", "SET_SIN_DATOS") for x in (a, MESSAGES[a])])
        actions = Q.log_rows(
            acted, iso_second(self.info.run_ts), F.col("ACCION"), self.info.attr_table, F.col(S.KEY),
            F.element_at(texts, F.col("ACCION")),
        )
        return Q.union_all([self._deleted(self.attr_before, self.info.attr_table), actions])

    def log_polygons(self) -> DataFrame:
        info = self.info
        when = iso_second(info.run_ts)
        touched = self.base_rows.where(F.col("ACCION").isin("UPDATE", "NOCHANGE"))
        text = F.when(F.col("ACCION") == "UPDATE", MESSAGES["UPDATE_BASE"]).otherwise(MESSAGES["NOCHANGE"])
        skipped = F.format_string(MESSAGES["SKIP_NO_GEOMETRY"], F.coalesce(F.col("ESTADO_EXCEL"), F.lit("None")))
        key = F.col(S.KEY)
        return Q.union_all(
            [
                self._deleted(self.base_before, info.base_table),
                Q.log_rows(touched, when, F.col("ACCION"), info.base_table, key, text),
                Q.log_rows(self.without_polygon(), when, F.lit("SKIP_NO_GEOMETRY"), info.base_table, key, skipped),
                Q.log_rows(
                    self.not_staged(), when, F.lit("SET_SIN_DATOS"), info.base_table, key,
                    F.lit(MESSAGES["SET_SIN_DATOS_BASE"]),
                ),
            ]
        )

    @cached_property
    def key_facts(self) -> DataFrame:
        """One row per staged key, for the checks that need more than the row itself."""
        return R.staged_key_facts(self.stage, self.base_before, {"_A": self.attr_before, "_B": self.base_before}, self.row_id)

    def _key_problems(self):
        """Array of problem structs over ``key_facts``."""
        key, has_polygon = F.col(S.KEY), F.col("ESTADO_GIS_ACTUAL").isNotNull()
        archived = (F.col("ESTADO_EXCEL_NUEVO") == R.ARCHIVED) & (F.col("ESTADO_GIS_ACTUAL") != R.ARCHIVED)
        single = [
            (F.col("CANTIDAD") > 1, "DUPLICADO_ORIGEN", F.lit(""), F.format_string(MESSAGES["DUPLICADO_ORIGEN"], "CANTIDAD")),
            (archived, "NUEVO_ARCHIVADO", F.col(S.CASE), F.format_string(MESSAGES["NUEVO_ARCHIVADO"], "ESTADO_GIS_ACTUAL", "ESTADO_EXCEL_NUEVO")),
            (
                ~has_polygon, "EXCEL_SIN_CM_BASE", F.col(S.CASE),
                F.format_string(MESSAGES["EXCEL_SIN_CM_BASE"], F.coalesce(F.col("ESTADO_EXCEL"), F.lit("None"))),
            ),
        ]
        one = [F.when(test, Q.problem(case, key, kind, detail)) for test, kind, case, detail in single]

        def unfit(name, table, cells):
            text = lambda x: F.format_string(MESSAGES["VALOR_NO_VALIDO"], F.lit(table), x["CAMPO"], x["VALOR"])
            return F.transform(cells, lambda x: Q.problem(F.col(S.CASE), key, "VALOR_NO_VALIDO", text(x)))

        # Only rows with a polygon are written to the polygon table.
        in_base = F.when(has_polygon, F.col("_B")).otherwise(F.slice("_B", 1, 0))
        more = [unfit("_A", self.info.attr_table, F.col("_A")), unfit("_B", self.info.base_table, in_base)]
        return F.concat(F.array_compact(F.array(*one)), *more)

    def problems(self) -> DataFrame:
        """One list of all problems: what a staged row shows, what a staged key shows, and what is no longer staged."""
        nothing, key = F.lit(""), F.col(S.KEY)
        case, status = F.col(S.case_column(self.stage)), S.find_status(self.stage)
        blank = F.lit(False) if status is None else is_blank(status)
        of_row = [
            F.when(blank, Q.problem(case, key, "ESTADO_VACIO", F.lit(MESSAGES["ESTADO_VACIO"]))),
            F.when(key == "", Q.problem(case, nothing, "LLAVE_VACIA", F.lit(MESSAGES["LLAVE_VACIA"]))),
        ]
        lapsed = self.attr_rows.where(F.col("ACCION") == "SET_SIN_DATOS")
        return Q.union_all([
            self.stage.select(F.inline(F.array_compact(F.array(*of_row)))),
            self.key_facts.select(F.inline(self._key_problems())),
            Q.problems(lapsed, nothing, F.coalesce(key, nothing), "ATRIBUTO_SIN_DATOS", F.lit(MESSAGES["ATRIBUTO_SIN_DATOS"])),
            Q.problems(self.not_staged(), F.col("EXPEDIENTE_CM_BASE"), key, "CM_BASE_SIN_EXCEL", F.lit(MESSAGES["CM_BASE_SIN_EXCEL"])),
        ])

    def _counts(self) -> DataFrame:
        """_what, _n as in COUNTED_METRICS. Every frame is reduced to counts where it is read; no list is built."""
        key, has_key = F.col(S.KEY), F.coalesce(F.col(S.KEY) != "", F.lit(False))
        status = S.find_status(self.stage)
        blank = F.lit(False) if status is None else is_blank(status)
        staged = self.stage.agg(F.count_if(blank).alias("P:ESTADO_VACIO"), F.count_if(key == "").alias("P:LLAVE_VACIA"))
        has_polygon = F.col("ESTADO_GIS_ACTUAL").isNotNull()
        keyed = self.key_facts.agg(
            F.count_if(F.col("CANTIDAD") > 1).alias("P:DUPLICADO_ORIGEN"), F.count_if(~has_polygon).alias("P:EXCEL_SIN_CM_BASE"),
            F.count_if((F.col("ESTADO_EXCEL_NUEVO") == R.ARCHIVED) & (F.col("ESTADO_GIS_ACTUAL") != R.ARCHIVED)).alias("P:NUEVO_ARCHIVADO"),
            F.sum(F.size("_A") + F.when(has_polygon, F.size("_B")).otherwise(0)).alias("P:VALOR_NO_VALIDO"),
        )
        parts = [staged, keyed]
        for mark, target in (("A", self.attr_before), ("B", self.base_before)):
            copies = target.where(has_key).groupBy(S.KEY).agg((F.count("*") - 1).alias("n"))
            parts.append(copies.agg(F.sum("n").alias(f"{mark}:DELETE_DUP")))
        acted = lambda action: F.count_if(F.col("ACCION") == action)
        parts.append(self.attr_rows.agg(*[acted(a).alias(f"A:{a}") for a in ("UPDATE", "INSERT", "NOCHANGE", "SET_SIN_DATOS")]))
        parts.append(self.base_rows.agg(
            acted("UPDATE").alias("B:UPDATE"), acted("NOCHANGE").alias("B:NOCHANGE"), acted("SET_SIN_DATOS").alias("R:SET_SIN_DATOS"),
            F.count_distinct(F.when(F.col("ACCION") == "SET_SIN_DATOS", key)).alias("P:CM_BASE_SIN_EXCEL"),
        ))
        pairs = [F.array(*[F.struct(F.lit(c).alias("_what"), F.col(f"`{c}`").alias("_n")) for c in df.columns]) for df in parts]
        return Q.union_all([df.select(F.inline(p)) for df, p in zip(parts, pairs)])

    def summary(self) -> DataFrame:
        """METRICA/VALOR rows."""
        counts = self._counts()
        rows = [(m, None, v) for m, v in self.info.labels.items()]
        paths = [("EXCEL_PATH", None, self.info.excel_path), ("GDB_PATH", None, self.info.gdb_path)]
        rows += [r for r in paths if r[2] is not None]
        rows += [("CM_ATRIBUTOS", None, self.info.attr_table), ("CM_BASE", None, self.info.base_table)]
        rows += [(m, what, None) for m, what in COUNTED_METRICS.items()]
        rows += [("REPORTE_XLSX", None, self.info.report_path)] if self.info.report_path is not None else []
        lines = [
            F.struct(*[F.lit(v).cast("string").alias(n) for v, n in zip(r, ("METRICA", "_what", "_label"))]) for r in rows
        ]
        metrics = self.stage.sparkSession.range(1).select(F.inline(F.array(*lines)))
        return metrics.join(counts, "_what", "left").select(
            "METRICA", F.coalesce("_label", F.coalesce("_n", F.lit(0)).cast("string")).alias("VALOR")
        )

    def sheets(self) -> dict:
        """The nine report sheets by name."""
        return {
            "RESUMEN": self.summary(),
            "PROBLEMAS_EXPEDIENTE": self.problems(),
            "DUPLICADOS_ORIGEN": self.duplicates(),
            "ESTADOS_VACIOS": self.blank_statuses(),
            "NUEVOS_ARCHIVADO": self.archived(),
            "CM_BASE_SIN_EXCEL": self.not_staged(),
            "EXCEL_SIN_CM_BASE": self.without_polygon(),
            "LOG_CM_ATRIBUTOS": self.log_attributes(),
            "LOG_CM_BASE": self.log_polygons(),
        }


def gate_summary(stage, attr, info: RunInfo) -> DataFrame:
    """The short report of the stricter mode, which stops on duplicate keys before any update."""
    keyed = R.with_key(stage)
    facts = (
        keyed.agg(F.count("*").alias("TOTAL_ORIGEN"), F.count_if(F.col(S.KEY) == "").alias("SKIPS"))
        .withColumn("TOTAL_PREVIO", attr.agg(F.count("*")).scalar())
        .withColumn("DUPLICADOS", Q.repeated_keys(keyed).agg(F.count("*")).scalar())
    )
    return facts.select(
        F.lit(iso_second(info.run_ts)).alias("FECHA_EJECUCION"),
        F.when(F.col("DUPLICADOS") > 0, "DETENIDO_POR_DUPLICADOS").otherwise("OK").alias("ESTADO_ETL"),
        "TOTAL_ORIGEN", "TOTAL_PREVIO", "DUPLICADOS", "SKIPS",
    )


def run_registry_etl(stage, attr, base, info: RunInfo, out_dir, row_id="oid", on_duplicates="last_wins", snapshots=None, buckets=200):
    """Run and write: new snapshots of both tables and the report, published together under one folder for the run.

    Winners and both classified snapshots are written first and every sheet is derived from the files, so that
    nothing is computed twice and the sheets agree. Readers see the run when all of it is there; one that died half-way may be
    run again with the same time. With ``on_duplicates="fail"`` duplicate keys stop the run: only the duplicates and the
    summary are written, and the tables stay as they are.

    ``snapshots`` maps ``info.attr_table`` and ``info.base_table`` to names of catalog tables to save the new states under,
    bucketed by key: the next run that takes them as its tables moves only the staged rows.
    """
    if on_duplicates not in ("last_wins", "fail"):
        raise RegistryError(f"on_duplicates must be last_wins or fail, got {on_duplicates}")
    folder = run_folder(out_dir, info.run_ts)
    info = replace(info, report_path=info.report_path or folder)
    report = Publication(stage.sparkSession, folder)
    if on_duplicates == "fail":
        keyed = R.with_key(stage)
        report.write("DUPLICADOS_ORIGEN", Q.duplicate_keys(keyed))
        if report.rows("DUPLICADOS_ORIGEN"):
            report.write("RESUMEN", gate_summary(stage, S.empty_target(keyed, row_id) if attr is None else attr, info))
            report.commit()
            raise RegistryError(f"duplicate keys in the source; see {folder}/DUPLICADOS_ORIGEN")
    run = RegistryRun(stage, attr, base, info, row_id, materialize=lambda name, df: report.write(f"tables/{name}", df))
    for name, sheet in run.sheets().items():
        report.write(name, sheet)
    report.commit()
    for name, table in (snapshots or {}).items():
        keep_snapshot({info.attr_table: run.attr_rows, info.base_table: run.base_rows}[name], table, buckets, row_id)
    return run

"""Bring an attribute table and a polygon table in step with the staged rows.

Inputs are snapshots and so are the results: the new table plus an ``ACCION`` column saying what happened to each
row. Inserted rows get their key, and null never equals a value, so a second run with the same input changes
nothing.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.functions.text import fold_key, strip
from cotejo.operators import schema as S
from cotejo.operators.keyed import in_keys, keys_of, lookup_join, not_in_keys, one_per_key

NO_DATA = "SIN_DATOS"
ARCHIVED = "ARCHIVADO"

_STAGED = "_staged_"
ROW_KEY = "_row_key"


def with_key(df: DataFrame, case=None) -> DataFrame:
    """Compute the matching key from the case column."""
    return df.withColumn(S.KEY, fold_key(case or S.case_column(df)))


def stage_winners(stage: DataFrame) -> DataFrame:
    """The last staged row of every non-blank key, in sheet order."""
    return one_per_key(stage.where(F.col(S.KEY) != ""), S.KEY, F.desc("row_seq"))


def _has_key():
    return F.coalesce(F.col(S.KEY) != "", F.lit(False))


def with_row_key(target: DataFrame, row_id="oid") -> DataFrame:
    """The key to group and join by: rows without one get a value of their own instead of meeting in one group.

    A snapshot that holds the column keeps it, and with it the buckets it lies in.
    """
    if ROW_KEY in target.columns:
        return target
    own = F.concat(F.lit("\x00"), F.col(row_id).cast("string"))
    return target.withColumn(ROW_KEY, F.when(_has_key(), F.col(S.KEY)).otherwise(own))


def _survivor_order(target, row_id):
    date = S.preferred_date(target)
    newest = [F.col(date).desc_nulls_last()] if date else []
    return [*newest, F.col(row_id).asc()]


def _unique_rows(target, row_id):
    return one_per_key(with_row_key(target, row_id), ROW_KEY, *_survivor_order(target, row_id))


def drop_duplicates(target: DataFrame, row_id="oid") -> DataFrame:
    """One row per key: latest preferred date, then lowest row id. Rows without a key all stay."""
    rows = _unique_rows(target, row_id)
    return rows if ROW_KEY in target.columns else rows.drop(ROW_KEY)


def duplicate_losers(target: DataFrame, row_id="oid") -> DataFrame:
    """(row id, key) of the rows ``drop_duplicates`` leaves out, found by row id and not by key."""
    date = S.preferred_date(target)
    keyed = target.where(_has_key()).select(*dict.fromkeys([row_id, S.KEY, *([date] if date else [])]))
    kept = one_per_key(keyed, S.KEY, *_survivor_order(target, row_id)).select(row_id)
    return keyed.select(row_id, S.KEY).join(kept, row_id, "left_anti")


def _staged(winners, pairs):
    """Winners under prefixed names: the key, the sheet order and the columns to transfer."""
    columns = dict.fromkeys(["row_seq", *[s for _, s in pairs]])
    return winners.select(
        F.col(S.KEY).alias(ROW_KEY), F.col(S.KEY).alias(_STAGED + S.KEY),
        *[F.col(c).alias(_STAGED + c) for c in columns],
    )


def _fitting(raw, old, kind):
    """The staged value in the target's type; the old value stays where a staged one does not fit."""
    value = raw.try_cast(kind)
    return F.when(raw.isNotNull() & value.isNull(), old).otherwise(value)


def _may_not_fit(source, target):
    """Casting ``source`` to ``target`` can fail; text and equal types always fit."""
    return source != target and target.simpleString() != "string"


def unfit_cells(target: DataFrame, winners: DataFrame, row_id="oid"):
    """Column expression over ``winners``: array of (CAMPO, VALOR), the staged values the target's types cannot hold."""
    types = {f.name: f.dataType for f in target.schema.fields}
    staged = {f.name: f.dataType for f in winners.schema.fields}
    cells = [
        F.when(F.col(s).isNotNull() & F.col(s).try_cast(types[t]).isNull(), F.struct(F.lit(t).alias("CAMPO"), F.col(s).cast("string").alias("VALOR")))
        for t, s in S.transfer_pairs(target, winners, row_id)
        if _may_not_fit(staged[s], types[t])
    ]
    return F.array_compact(F.array(*cells)) if cells else F.array().cast("array<struct<CAMPO:string,VALOR:string>>")


def values_not_valid(target: DataFrame, winners: DataFrame, row_id="oid") -> DataFrame:
    """EXPEDIENTE_KEY, CAMPO, VALOR: staged values that do not fit their target column and so were not taken over."""
    return winners.select(S.KEY, F.inline(unfit_cells(target, winners, row_id)))


def _changes(target, pairs, types):
    """(new value per target column, whether any differs); text and numbers compare in the target's type."""
    new = {t: _fitting(F.col(_STAGED + s), F.col(t), types[t]) for t, s in pairs}
    differs = F.lit(False)
    for t, value in new.items():
        differs = differs | ~value.eqNullSafe(F.col(t))
    return new, differs


def _apply(joined, target, pairs, run_ts, is_missing, row_id, insert_id=None):
    """Project the joined rows to the new snapshot. ``is_missing``: which unmatched rows lose their status."""
    types = {f.name: f.dataType for f in target.schema.fields}
    new, differs = _changes(target, pairs, types)
    staged = F.col(_STAGED + S.KEY).isNotNull()
    inserted = staged & F.col(row_id).isNull()
    changed = inserted | (staged & differs)
    now = F.lit(run_ts).cast("timestamp_ntz")
    status = S.find_status(target)
    if status is None:
        lapses = F.lit(False)
    else:
        lapses = ~staged & is_missing(F.coalesce(strip(status) == NO_DATA, F.lit(False)))
    action = (
        F.when(inserted, "INSERT")
        .when(changed, "UPDATE")
        .when(staged, "NOCHANGE")
        .when(lapses, "SET_SIN_DATOS")
    )
    out = []
    for c in target.columns:
        value = F.when(staged, new[c]).otherwise(F.col(c)) if c in new else F.col(c)
        if c == row_id and insert_id is not None:
            value = F.coalesce(F.col(c), insert_id)
        elif c == S.KEY:
            value = F.coalesce(F.col(_STAGED + S.KEY), F.col(c))
        elif c == S.UPDATED:
            value = F.when(changed, now).otherwise(F.col(c))
        elif c == S.REPORTED:
            value = staged.cast("short")
        elif c == S.REPORT_DATE:
            value = F.when(staged, now).otherwise(F.col(c))
        if c == status:
            value = F.when(lapses, F.lit(NO_DATA)).otherwise(value)
        out.append(value.cast(types[c]).alias(c))
    return joined.select(*out, action.alias("ACCION"))


def last_row_id(target: DataFrame, row_id="oid"):
    """Highest row id of a table, as a scalar subquery."""
    return target.agg(F.coalesce(F.max(row_id), F.lit(0))).scalar()


def upsert(target: DataFrame, winners: DataFrame, run_ts, row_id="oid", after=None, deduplicate=False) -> DataFrame:
    """Insert, update or keep attribute rows; those not staged turn SIN_DATOS.

    Every non-blank key must occur once in ``target``, or ``deduplicate`` leaves one row of each; the join then reuses
    that shuffle. Inserted rows get ids above ``after`` (default: the target's highest).
    """
    pairs = S.transfer_pairs(target, winners, row_id)
    rows = _unique_rows(target, row_id) if deduplicate else with_row_key(target, row_id)
    joined = rows.join(_staged(winners, pairs), ROW_KEY, "full_outer")
    after = last_row_id(target, row_id) if after is None else after
    new_id = after + 1 + F.col(_STAGED + "row_seq")
    return _apply(joined, target, pairs, run_ts, lambda is_set: ~is_set, row_id, new_id)


def sync(target: DataFrame, winners: DataFrame, run_ts, row_id="oid", deduplicate=False) -> DataFrame:
    """Update every polygon row of a staged key, insert nothing; keys that are not staged turn SIN_DATOS.

    Unlike in ``upsert``, rows that already are SIN_DATOS count again. A key may occur in many rows; with
    ``deduplicate`` one of each is left first, and the join reuses that shuffle.
    """
    pairs = S.transfer_pairs(target, winners, row_id)
    staged = _staged(winners, pairs)
    if deduplicate:
        joined = _unique_rows(target, row_id).join(staged, ROW_KEY, "left")
    else:
        joined = lookup_join(with_row_key(target, row_id), staged, ROW_KEY)
    return _apply(joined, target, pairs, run_ts, lambda is_set: _has_key(), row_id)


def _archive_states(winners, base, row_id):
    """(staged case id, key and folded status; polygon key and folded status before this run)."""
    case, status = S.case_column(winners), S.find_status(winners)
    base_status = S.find_status(base)
    before = F.lit("") if base_status is None else fold_key(base_status)
    state = one_per_key(
        base.where(_has_key()).select(S.KEY, row_id, before.alias("ESTADO_GIS_ACTUAL")), S.KEY, F.desc(row_id)
    )
    staged = F.lit("") if status is None else fold_key(status)
    return winners.select(F.col(case).alias(S.CASE), S.KEY, staged.alias("ESTADO_EXCEL_NUEVO")), state


def newly_archived(winners: DataFrame, base: DataFrame, row_id="oid") -> DataFrame:
    """Staged as archived while the polygon, before this run, is not."""
    staged, state = _archive_states(winners, base, row_id)
    return (
        staged.where(F.col("ESTADO_EXCEL_NUEVO") == ARCHIVED)
        .join(state, S.KEY)
        .where(F.col("ESTADO_GIS_ACTUAL") != ARCHIVED)
        .select(S.CASE, S.KEY, "ESTADO_GIS_ACTUAL", "ESTADO_EXCEL_NUEVO")
    )


def staged_without_polygon(winners: DataFrame, base: DataFrame) -> DataFrame:
    case, status = S.case_column(winners), S.find_status(winners)
    shown = F.lit(None).cast("string") if status is None else F.col(status)
    return winners.join(keys_of(base, S.KEY), S.KEY, "left_anti").select(
        F.col(case).alias("EXPEDIENTE_EXCEL"), S.KEY, shown.alias("ESTADO_EXCEL")
    )


def staged_key_facts(stage: DataFrame, base: DataFrame, targets: dict, row_id="oid") -> DataFrame:
    """What the checks ask of every staged key, from one aggregate of the sheet and one join.

    EXPEDIENTE_KEY, CANTIDAD (staged rows), the winner's EXPEDIENTE, ESTADO_EXCEL and ESTADO_EXCEL_NUEVO (folded), ESTADO_GIS_ACTUAL
    (folded status of the polygon before the run; null without a polygon) and per name in ``targets`` an array of unfit cells.
    The last staged row is found by the aggregate itself, task by task first, so a hot key does not meet in one task.
    """
    case, status = S.case_column(stage), S.find_status(stage)
    shown = F.lit(None).cast("string") if status is None else F.col(status).cast("string")
    unfit = {name: unfit_cells(target, stage, row_id) for name, target in targets.items()}
    last = F.struct(F.col(case).alias("case"), shown.alias("status"), *[c.alias(name) for name, c in unfit.items()])
    keys = stage.where(_has_key()).groupBy(S.KEY).agg(F.count("*").alias("CANTIDAD"), F.max_by(last, "row_seq").alias("_last"))
    base_status = S.find_status(base)
    before = F.lit("") if base_status is None else fold_key(base_status)
    polygons = drop_duplicates(base.where(_has_key()), row_id).select(S.KEY, before.alias("ESTADO_GIS_ACTUAL"))
    return keys.join(polygons, S.KEY, "left").select(
        S.KEY, "CANTIDAD", F.col("_last.case").alias(S.CASE), F.col("_last.status").alias("ESTADO_EXCEL"),
        (F.lit("") if status is None else fold_key("_last.status")).alias("ESTADO_EXCEL_NUEVO"), "ESTADO_GIS_ACTUAL",
        *[F.col("_last")[name].alias(name) for name in unfit],
    )


def polygons_not_staged(base: DataFrame, stage: DataFrame) -> DataFrame:
    """Every polygon row whose key is not staged; blank keys are left out."""
    return not_in_keys(base.where(_has_key()), keys_of(stage, S.KEY), S.KEY)


def one_row_per_missing_key(rows: DataFrame, row_id="oid") -> DataFrame:
    """The report names each missing key once, by its first row."""
    case = S.case_column(rows)
    first = one_per_key(rows.select(row_id, F.col(case).alias("EXPEDIENTE_CM_BASE"), S.KEY), S.KEY, F.asc(row_id))
    return first.select("EXPEDIENTE_CM_BASE", S.KEY)


def staged_with_polygon(winners: DataFrame, base: DataFrame) -> DataFrame:
    return in_keys(winners, keys_of(base, S.KEY), S.KEY)


def keep_most_complete(df: DataFrame, case="EXPEDIENTE") -> DataFrame:
    """Per case id the row with the most non-blank cells; the earliest on a tie. Rows without an id all stay."""
    cells = [c for c in df.columns if c != "row_seq"]
    filled = sum((F.when(F.coalesce(strip(c) != "", F.lit(False)), 1).otherwise(0) for c in cells), F.lit(0))
    scored = df.withColumn("_filled", filled)
    known = F.coalesce(strip(case) != "", F.lit(False))
    kept = one_per_key(scored.where(known), case, F.desc("_filled"), F.asc("row_seq"))
    return kept.unionByName(scored.where(~known)).drop("_filled")


def fill_blank_status(df: DataFrame, status="ESTADO", value="PENDIENTE") -> DataFrame:
    return df.withColumn(status, F.when(F.coalesce(strip(status) != "", F.lit(False)), F.col(status)).otherwise(value))

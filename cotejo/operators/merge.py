"""Auditable merge of two sheets: rows of B take A's values, and every changed cell is reported.

Cells compare as trimmed upper-case text, so a change of case alone is none. Null ids match nothing.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.errors import RegistryError, require_columns
from cotejo.functions.text import strip, trim_upper
from cotejo.operators.keyed import lookup_join, one_per_key
from cotejo.operators.schema import common_columns, upper_headers

FLAG = "VALIDACION_CAMBIO"
UPDATED, SAME, ABSENT = "ACTUALIZADO", "SIN_CAMBIO", "NO_EN_ORIGEN"

_SOURCE = "_source_"
_IN_SOURCE = "_in_source"
_CHANGED = "_changed"


def _unique_source(source, key, columns, on_duplicates):
    """Columns of A under prefixed names, one row per id."""
    rows = source.where(F.col(key).isNotNull())
    renamed = [F.col(c).alias(_SOURCE + c) for c in columns]
    if on_duplicates == "last":
        return one_per_key(rows, key, F.desc("row_seq")).select(key, F.lit(True).alias(_IN_SOURCE), *renamed)
    # Grouping by the id is the shuffle the join needs anyway; a second row of an id fails the job.
    grouped = rows.groupBy(key).agg(F.count("*").alias("_n"), F.any_value(F.struct(*renamed, F.lit(0))).alias("_row"))
    unique = F.when(F.col("_n") == 1, F.lit(True)).otherwise(
        F.raise_error(F.format_string("duplicate id in the source sheet: %s", key)).cast("boolean")
    )
    return grouped.select(key, unique.alias(_IN_SOURCE), *[F.col(f"_row.{_SOURCE + c}") for c in columns])


def compare(source: DataFrame, target: DataFrame, key="EXPEDIENTE", on_duplicates="error") -> DataFrame:
    """Rows of B next to A's values, with the list of columns that differ (``_changed``, null if not in A)."""
    if on_duplicates not in ("error", "last"):
        raise RegistryError(f"on_duplicates must be error or last, got {on_duplicates}")
    source, target = upper_headers(source), upper_headers(target)
    for df, what in ((source, "source sheet"), (target, "target sheet")):
        require_columns(df.columns, [key], what)
    if on_duplicates == "last":
        require_columns([c.lower() for c in source.columns], ["row_seq"], "source sheet")
        source = source.withColumnRenamed("ROW_SEQ", "row_seq")
    columns = common_columns(source, target, exclude=(key, "ROW_SEQ"))
    source, target = (df.withColumn(key, strip(key)) for df in (source, target))
    joined = lookup_join(target, _unique_source(source, key, columns, on_duplicates), key)
    differing = [F.when(trim_upper(_SOURCE + c) != trim_upper(c), F.lit(c)) for c in columns]
    changed = F.array_compact(F.array(*differing)) if columns else F.array().cast("array<string>")
    return joined.withColumn(_CHANGED, F.when(F.col(_IN_SOURCE), changed))


def merged(compared: DataFrame) -> DataFrame:
    """B with A's raw value in every differing cell, and a flag per row. A column whose types differ comes out as text."""
    out = []
    for c in compared.columns:
        if c in (_IN_SOURCE, _CHANGED) or c.startswith(_SOURCE):
            continue
        if _SOURCE + c in compared.columns:
            take = F.coalesce(F.array_contains(_CHANGED, c), F.lit(False))
            raw, kind = F.col(_SOURCE + c), compared.schema[c].dataType
            if compared.schema[_SOURCE + c].dataType != kind:
                out.append(F.when(take, raw.cast("string")).otherwise(F.col(c).cast("string")).alias(c))  # nothing is lost
            else:
                out.append(F.when(take, raw).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    flag = F.when(F.col(_CHANGED).isNull(), ABSENT).when(F.size(_CHANGED) > 0, UPDATED).otherwise(SAME)
    return compared.select(*out, flag.alias(FLAG))


def cell_changes(compared: DataFrame, key="EXPEDIENTE") -> DataFrame:
    """One row per changed cell."""
    columns = [c for c in compared.columns if _SOURCE + c in compared.columns]
    schema = "array<struct<CAMPO:string,VALOR_ANTERIOR:string,VALOR_NUEVO:string>>"
    cells = [
        F.when(
            F.array_contains(_CHANGED, c),
            F.struct(
                F.lit(c).alias("CAMPO"),
                F.col(c).cast("string").alias("VALOR_ANTERIOR"),
                F.col(_SOURCE + c).cast("string").alias("VALOR_NUEVO"),
            ),
        )
        for c in columns
    ]
    listed = F.array_compact(F.array(*cells)) if cells else F.array().cast(schema)
    return compared.where(F.size(_CHANGED) > 0).select(key, F.inline(listed))


def outcome_counts(compared: DataFrame) -> DataFrame:
    """Rows updated, unchanged and not in the source."""
    n = F.size(_CHANGED)
    return compared.agg(
        F.count_if(F.col(_CHANGED).isNotNull() & (n > 0)).alias("ACTUALIZADOS"),
        F.count_if(F.col(_CHANGED).isNotNull() & (n == 0)).alias("SIN_CAMBIO"),
        F.count_if(F.col(_CHANGED).isNull()).alias("NO_EN_ORIGEN"),
    )

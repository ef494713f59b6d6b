"""Ordered rules that sort registry records into groups. Each rule set keeps its own labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.errors import require_columns
from cotejo.functions.dates import case_year
from cotejo.functions.text import fold_ascii, fold_key, upper_keep_null
from cotejo.functions.units import area_km2
from cotejo.operators.schema import ascii_headers, clean_text_columns

GROUP = "GRUPO_CATASTRO"

# Words and columns the rule sets test for (fixed values).
AGE_RULES_METALS = "ORO|PLATA"
AGE_RULES_CLASSES = ("EXPLORACIÓN", "SUBTERRÁNEO")
AGE_RULES_YEARS = 4
CLEAN_RULES_METALS = "ORO|PLATA|COBRE|HIERRO"
CLEAN_RULES_COLUMNS = ("ESTADO", "MATERIALES", "REGIMEN_JURIDICO", "SUBCLASE", "FINALIDAD", "EXPEDIENTE")
STEM_RULES_CLOSED = "ARCHIV|CANCEL|DENEG|CADUC|RENUNC|DESIST"
STEM_RULES_OWNERS = "MUNICIPALIDAD|CONCEJO|ICE|CNE"
STEM_RULES_CLASSES = "EXPLOR|EXPLOT|SUB"


def _holds(c, pattern):
    return F.coalesce(F.col(c).rlike(pattern), F.lit(False))


def by_age(df: DataFrame, run_year: int) -> DataFrame:
    """Plural labels; municipal permits count as special once they are older than four years."""
    require_columns(df.columns, ["ESTADO", "CLASE", "MATERIALES", "EXPEDIENTE"], "by_age")
    df = clean_text_columns(df, upper_keep_null, ["ESTADO", "CLASE", "MATERIALES", "EXPEDIENTE"])
    df = df.withColumn("ANIO_EXP", case_year("EXPEDIENTE"))
    df = df.withColumn("ANTIGUEDAD", F.lit(run_year) - F.col("ANIO_EXP"))
    metal = _holds("EXPEDIENTE", "EXP|SUB") | F.col("CLASE").isin(*AGE_RULES_CLASSES) | _holds("MATERIALES", AGE_RULES_METALS)
    special = _holds("EXPEDIENTE", "CNE|CAN-MUN") | (
        _holds("EXPEDIENTE", "MUN") & (F.col("ANTIGUEDAD") > AGE_RULES_YEARS)
    )
    return df.withColumn(
        GROUP,
        F.when(F.col("ESTADO") == "ARCHIVADO", "ARCHIVADOS")
        .when(metal, "METALICOS")
        .when(special, "PERMISOS_ESPECIALES")
        .otherwise("NO_METALICOS"),
    )


def by_clean_text(df: DataFrame) -> DataFrame:
    """All headers and texts reduced to ASCII first; special permits by regime, subclass, purpose or id."""
    df = clean_text_columns(ascii_headers(df), fold_ascii)
    require_columns(df.columns, CLEAN_RULES_COLUMNS, "by_clean_text")
    special = (
        (F.col("REGIMEN_JURIDICO") == "PERMISO_ESPECIAL")
        | ~F.col("SUBCLASE").isin("PRIVADO", "")
        | (F.col("FINALIDAD") == "EMERGENCIA")
        | _holds("EXPEDIENTE", "MUN|CNE")
    )
    return df.withColumn(
        GROUP,
        F.when(F.col("ESTADO") == "ARCHIVADO", "ARCHIVADOS")
        .when(_holds("MATERIALES", CLEAN_RULES_METALS), "METALICOS")
        .when(special, "PERMISO_ESPECIAL")
        .otherwise("NO_METALICOS"),
    )


def by_word_stems(df: DataFrame) -> DataFrame:
    """Singular labels, word stems; also adds the area in square kilometres."""
    require_columns(df.columns, ["ESTADO", "EXPEDIENTE", "NOMBRE", "CLASE", "SUBCLASE"], "by_word_stems")

    def holds(c, pattern):
        return fold_key(c).rlike(pattern)

    metal = holds("EXPEDIENTE", "EXP|SUB") & (holds("CLASE", STEM_RULES_CLASSES) | holds("SUBCLASE", STEM_RULES_CLASSES))
    df = df.withColumn(
        GROUP,
        F.when(holds("ESTADO", STEM_RULES_CLOSED), "ARCHIVADO")
        .when(holds("EXPEDIENTE", "CDP") | holds("NOMBRE", STEM_RULES_OWNERS), "PERMISO_ESPECIAL")
        .when(metal, "METALICO")
        .otherwise("NO_METALICO"),
    )
    if "AREA" in df.columns and "UNIDAD" in df.columns:
        df = df.withColumn("AREA_KM2", area_km2("AREA", "UNIDAD"))
    return df


def group_counts(df: DataFrame, group=GROUP) -> DataFrame:
    """Rows per group, most frequent first; null groups do not count."""
    counts = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("CANTIDAD"))
    return counts.orderBy(F.desc("CANTIDAD"), F.asc(group))


def ungrouped_count(df: DataFrame, group=GROUP) -> DataFrame:
    """Control figure: rows without a group, which must be 0."""
    return df.agg(F.count_if(F.coalesce(F.col(group), F.lit("")) == "").alias("SIN_GRUPO"))

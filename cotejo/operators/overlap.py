"""Which parcels overlap or touch which, for any number of subjects at once.

Candidate pairs come from an equi-join on grid cells. A parcel's own level is the smallest power-of-two cell size
that is at least its extent, so it covers at most four cells however large it is, and a pair meets at the level of
its larger member. The finer member is looked up there by its ancestor cells. A pair is kept only in the cell of
the lower left corner of its common box, so no duplicate removal is needed. Candidates thus grow with the true
neighbours and not with the square of the rows in a cell; AQE splits a crowded cell on either side of the join.

Grid entries, rings and ids are many times larger than the files they come from, and Spark plans by the files' size. So
these joins are sorted by hint: else a table of a few megabytes is broadcast, and its rows pass whole through the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.functions import predicates as P
from cotejo.functions.geometry import box_area, box_overlap_area, boxes_meet, polygon_area, polygon_overlap
from cotejo.functions.text import is_blank, status_label, strip
from cotejo.operators.keyed import lookup_join, one_per_key

OVERLAPS, TOUCHES = "TRASLAPA", "TOCA"
_FINEST = -30  # level of boxes without extent, and of those a billion times smaller than the unit
BOX = ("xmin", "ymin", "xmax", "ymax")
RING = ("xs", "ys", "ring_sizes")
RESULT = ("EXPEDIENTE_BASE", "EXPEDIENTE", "ESTADO", "TIPO", "AREA_TRASLAPE", "PORCENTAJE_TRASLAPE")


def _level(cell):
    """Power-of-two level whose cell is at least as large as the row's box."""
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    level = F.ceil(F.log2(extent / cell)).cast("int")
    # Rounding in the logarithm may leave the cell a trifle too small.
    level = F.when(F.pow(F.lit(2.0), level) * cell < extent, level + 1).otherwise(level)
    return F.when(extent > 0, F.greatest(level, F.lit(_FINEST))).otherwise(F.lit(_FINEST))


def _size(level, cell):
    return F.pow(F.lit(2.0), level) * cell


def _cells(df, cell):
    """One row per grid cell the box covers at column ``level``."""
    size = _size(F.col("level"), cell)

    def span(lo, hi):
        return F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size))

    return df.withColumn("cx", F.explode(span("xmin", "xmax"))).withColumn("cy", F.explode(span("ymin", "ymax")))


def _levels_of(df):
    """The levels in use (a handful of small integers) as a scalar subquery."""
    return df.agg(F.array_sort(F.collect_set("own"))).scalar()


def _grid_entries(df, own_as, above_as, other_levels, cell):
    """Grid entries of one side: at the own level under the tags ``own_as``, above it under ``above_as``."""
    df = df.withColumn("_levels", other_levels)
    above = F.filter("_levels", lambda x: x > F.col("own"))
    tagged = F.concat(
        F.array(*[F.struct(F.lit(t).alias("tag"), F.col("own").alias("level")) for t in own_as]),
        F.transform(above, lambda x: F.struct(F.lit(above_as).alias("tag"), x.alias("level"))),
    )
    return _cells(df.withColumn("_e", F.explode(tagged)).select("*", "_e.tag", "_e.level").drop("_e", "_levels", "own"), cell)


def candidate_pairs(subjects: DataFrame, parcels: DataFrame, cell=1.0, keep_s=(), keep_p=()) -> DataFrame:
    """All pairs whose closed boxes meet.

    Inputs hold ``oid`` and the box. Both and the further columns asked for come back as s_* and p_*.
    """
    subjects = subjects.select("oid", *BOX, *keep_s, _level(cell).alias("own"))
    parcels = parcels.select("oid", *BOX, *keep_p, _level(cell).alias("own"))
    # Tag A: the subject is the larger or equal member. Tag B: the parcel is strictly larger.
    left = _grid_entries(subjects, "A", "B", _levels_of(parcels), cell)
    right = _grid_entries(parcels, "AB", "A", _levels_of(subjects), cell)
    meet = ("tag", "level", "cx", "cy")
    left = left.select(*meet, *[F.col(c).alias(f"s_{c}") for c in ("oid", *BOX, *keep_s)])
    right = right.select(*meet, *[F.col(c).alias(f"p_{c}") for c in ("oid", *BOX, *keep_p)])
    size = _size(F.col("level"), cell)
    corner = (F.floor(F.greatest("s_xmin", "p_xmin") / size) == F.col("cx")) & (
        F.floor(F.greatest("s_ymin", "p_ymin") / size) == F.col("cy")
    )
    return left.join(right.hint("merge"), list(meet)).where(boxes_meet("s_", "p_") & corner)


def first_polygons(parcels: DataFrame, ids: DataFrame, id_col="EXPEDIENTE") -> DataFrame:
    """The first parcel (lowest oid) of every wanted id."""
    wanted = ids.select(id_col).distinct()
    # Both sides hold an id once and lie by id already, so they meet without a further shuffle.
    return one_per_key(parcels, id_col, F.asc("oid")).join(wanted.hint("merge"), id_col, "left_semi")


def subject_problems(parcels: DataFrame, ids: DataFrame, shape="box", id_col="EXPEDIENTE") -> DataFrame:
    """Wanted ids that cannot be analysed: blank, no parcel, or a first parcel without area."""
    parcels, ids = (df.withColumn(id_col, strip(id_col)) for df in (parcels, ids))
    blank = is_blank(id_col)
    missing = ids.where(blank).select(F.lit("").alias(id_col), F.lit("EXPEDIENTE_VACIO").alias("PROBLEMA")).distinct()
    wanted = ids.where(~blank).select(id_col).distinct()
    area = F.when(_has_shape(shape), F.struct("oid", "area"))
    firsts = _with_area(parcels, shape).groupBy(id_col).agg(F.min(area)["area"].alias("_area"), F.lit(True).alias("_found"))
    problem = F.when(F.col("_found").isNull(), "EXPEDIENTE_NO_ENCONTRADO").when(
        F.coalesce(F.col("_area"), F.lit(0.0)) == 0, "AREA_CERO"
    )
    found = wanted.join(firsts.hint("merge"), id_col, "left").select(id_col, problem.alias("PROBLEMA"))
    return found.where("PROBLEMA IS NOT NULL").unionByName(missing)


def _measured(pairs, subjects, parcels, shape, xy_tol, area_tol):
    """Add ``shared`` to the pairs and drop those that turn out to be apart."""
    if shape == "box":
        return pairs.withColumn("shared", box_overlap_area("s_", "p_"))
    # Rings are fetched by row id for the surviving pairs only, not carried through the grid.
    for side, df in (("s_", subjects), ("p_", parcels)):
        rings = df.select(F.col("oid").alias(f"{side}oid"), *[F.col(c).alias(side + c) for c in RING])
        pairs = pairs.join(rings.hint("merge"), f"{side}oid")
    # Measuring costs far more than moving a pair, so the pairs are spread evenly first.
    pairs = pairs.repartition("s_oid", "p_oid")
    measure = polygon_overlap(xy_tol, area_tol)
    out = pairs.withColumn("_m", measure(*[F.col(side + c) for side in ("s_", "p_") for c in RING]))
    return out.where((F.col("_m.area") > 0) | F.col("_m.touches")).withColumn("shared", F.col("_m.area"))


def _report(subjects, parcels, shape, cell, xy_tol, area_tol, only_area=False, only_earlier=False):
    """Measured pairs with ids and status. ``parcels`` holds oid, id, status and shape; ``subjects`` also area.

    With ``only_earlier`` both are one batch, and a parcel is compared with those of smaller oid.
    """
    subjects = subjects.where(F.col("area") > 0)
    near = subjects
    if shape == "ring":  # what lies within the tolerance is a candidate too
        near = subjects.withColumns({c: F.col(c) + (xy_tol if c.endswith("max") else -xy_tol) for c in BOX})
    pairs = candidate_pairs(near, parcels, cell, ("id", "area"), ("id", "status"))
    # The parcel itself and other parcels of the same id are not compared.
    pairs = pairs.where(~F.col("p_id").eqNullSafe(F.col("s_id")))
    if only_earlier:
        pairs = pairs.where(F.col("p_oid") < F.col("s_oid"))
    pairs = _measured(pairs, subjects, parcels, shape, xy_tol, area_tol)
    if only_area:
        pairs = pairs.where(F.col("shared") > 0)
    return pairs.select(
        F.col("s_id").alias("EXPEDIENTE_BASE"), F.col("p_id").alias("EXPEDIENTE"), F.col("p_status").alias("ESTADO"),
        F.when(F.col("shared") > 0, OVERLAPS).otherwise(TOUCHES).alias("TIPO"),
        _shown("shared", shape).alias("AREA_TRASLAPE"),
        _shown(F.col("shared") / F.col("s_area") * 100, shape).alias("PORCENTAJE_TRASLAPE"),
        F.col("p_oid").alias("oid"),
    )


def _shown(value, shape):
    """Two decimals. The last digits of clipped polygons are noise; without them a tie rounds as the exact value would."""
    return F.round(F.round(value, 8) if shape == "ring" else value, 2)


def _has_shape(shape):
    test = F.col(BOX[0]).isNotNull()
    return test & F.col(RING[0]).isNotNull() if shape == "ring" else test


def _with_area(df, shape):
    if "area" in df.columns:
        return df
    return df.withColumn("area", polygon_area(*[F.col(c) for c in RING]) if shape == "ring" else box_area())


def _shaped(df, shape):
    """Parcels that have a geometry, with their area."""
    return _with_area(df, shape).where(_has_shape(shape))


def _shape_columns(shape):
    return (*BOX, *RING) if shape == "ring" else BOX


def _wanted(ids, id_col):
    """The trimmed ids; a blank one names no parcel."""
    return ids.where(~is_blank(id_col)).select(strip(id_col).alias("id"))


def overlaps(parcels, ids, status="ESTADO", shape="box", cell=1.0, xy_tol=1e-9, area_tol=1e-9, id_col="EXPEDIENTE"):
    """Overlaps and contacts of the wanted ids. Ids and statuses are trimmed; closed and unlocated parcels skipped.

    ``parcels`` needs ``oid``, the id, the status and the shape: a box (``shape="box"``: parcels are upright
    rectangles) or also rings (``shape="ring"``). ``cell`` is the grid's unit; levels below and above it follow the parcels'
    extents.
    """
    rows = _shaped(parcels, shape).withColumn("id", F.coalesce(strip(id_col), F.lit("")))
    wanted = _wanted(ids, id_col)
    kept = rows.where(P.status_overlap_trimmed(status)).withColumn("status", status_label(strip(status)))
    columns = ("oid", "id", *_shape_columns(shape))
    subjects = first_polygons(rows.select(*columns, "area"), wanted, "id")
    return _report(subjects, kept.select(*columns, "status"), shape, cell, xy_tol, area_tol)


def overlaps_joined_status(
    parcels, attributes, ids, status="ESTADO", shape="box", cell=1.0, xy_tol=1e-9, area_tol=1e-9, id_col="EXPEDIENTE"
):
    """The same with exact ids and the status taken, untrimmed, from the attribute table (one row per id)."""
    rows = _shaped(parcels, shape).withColumn("id", F.col(id_col))
    columns = ("oid", "id", *_shape_columns(shape))
    states = one_per_key(
        attributes.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(status).alias("_st"), "oid"),
        "id", F.desc("oid"),
    ).drop("oid")
    joined = lookup_join(rows.select(*columns), states, "id")
    kept = joined.where(P.status_overlap_untrimmed("_st")).withColumn("status", status_label("_st")).drop("_st")
    subjects = first_polygons(rows.select(*columns, "area"), ids.select(F.col(id_col).alias("id")), "id")
    return _report(subjects, kept, shape, cell, xy_tol, area_tol)


def overlaps_of_new(
    new_parcels, parcels, attributes, status="ESTADO", shape="box", cell=1.0, xy_tol=1e-9, area_tol=1e-9,
    id_col="EXPEDIENTE",
):
    """Overlaps with area of newly added parcels, with what is there and with the new ones before them (smaller oid).

    Status by exact id: NO_DEFINIDO without an attribute row.
    """
    columns = ("oid", "id", *_shape_columns(shape))
    states = one_per_key(
        attributes.where(F.coalesce(F.col(id_col) != "", F.lit(False))).select(
            F.col(id_col).alias("id"), F.col(status).alias("status"), "oid", F.lit(1).alias("_hit")
        ),
        "id", F.desc("oid"),
    ).drop("oid")

    def kept(df):
        rows = _shaped(df, shape).withColumn("id", F.col(id_col)).select(*columns)
        joined = lookup_join(rows, states, "id").withColumn(
            "status", F.when(F.col("_hit").isNull(), "NO_DEFINIDO").otherwise(F.col("status"))
        )
        return joined.where(P.status_overlap_exact("status")).drop("_hit")

    subjects = _shaped(new_parcels, shape).withColumn("id", F.col(id_col)).select(*columns, "area")
    sizes = (shape, cell, xy_tol, area_tol)
    found = _report(subjects, kept(parcels), *sizes, only_area=True).unionByName(
        _report(subjects, kept(new_parcels), *sizes, only_area=True, only_earlier=True)
    )
    return found.select(
        F.col("EXPEDIENTE_BASE").alias("EXPEDIENTE_NUEVO"), "EXPEDIENTE", "ESTADO", "AREA_TRASLAPE",
        "PORCENTAJE_TRASLAPE", "oid",
    )


def acceptable(candidates, id_col="EXPEDIENTE"):
    """Candidates with an acceptable id; of several with one id the first."""
    return one_per_key(candidates.where(P.new_id_problem(id_col).isNull()), id_col, F.asc("oid"))


def add_parcels(base, candidates, id_col="EXPEDIENTE"):
    """Append the acceptable candidates."""
    return base.unionByName(acceptable(candidates, id_col), allowMissingColumns=True)


def analysed_subjects(parcels, ids, shape="box", id_col="EXPEDIENTE"):
    """(id, area) of the wanted parcels that ``overlaps`` analyses."""
    rows = _shaped(parcels, shape).select("oid", F.coalesce(strip(id_col), F.lit("")).alias("id"), "area")
    wanted = _wanted(ids, id_col)
    return first_polygons(rows, wanted, "id").where(F.col("area") > 0).select("id", "area")


def ranked(found: DataFrame) -> DataFrame:
    """Report order: per subject by share, largest first; ties in table order."""
    return found.orderBy("EXPEDIENTE_BASE", F.desc("PORCENTAJE_TRASLAPE"), "oid")


def _plain(c):
    """A number with one or two decimals, as the report prints it."""
    return F.call_function("format_number", c, F.lit("0.0#"))


def report_lines(found: DataFrame, subjects: DataFrame) -> DataFrame:
    """Text report: a header line per subject (``id``, ``area``), then its overlaps or a line saying there are none.

    The order comes from one range sort over subject and share, which splits a subject with many lines.
    """
    header = subjects.select(
        F.col("id").alias("EXPEDIENTE_BASE"), F.lit(0).alias("part"), F.lit(0.0).alias("share"),
        F.lit(0).cast("long").alias("oid"),
        F.format_string("Expediente base: %s | Área base: %s m²", "id", _plain(F.round("area", 2))).alias("line"),
    )
    body = found.select(
        "EXPEDIENTE_BASE", F.lit(1).alias("part"), (-F.col("PORCENTAJE_TRASLAPE")).alias("share"), "oid",
        F.format_string(
            "Expediente: %s | Estado: %s | Tipo: %s | Área traslapada: %s m² | %% respecto al base: %s %%",
            "EXPEDIENTE", "ESTADO", "TIPO", _plain(F.col("AREA_TRASLAPE")),
            F.when(F.col("TIPO") == TOUCHES, "0").otherwise(_plain(F.col("PORCENTAJE_TRASLAPE"))),
        ).alias("line"),
    )
    with_hits = found.select(F.col("EXPEDIENTE_BASE").alias("id")).distinct()
    empty = subjects.join(with_hits.hint("merge"), "id", "left_anti").select(
        F.col("id").alias("EXPEDIENTE_BASE"), F.lit(2).alias("part"), F.lit(0.0).alias("share"),
        F.lit(0).cast("long").alias("oid"),
        F.lit("No se detectaron traslapes válidos.").alias("line"),
    )
    lines = header.unionByName(body).unionByName(empty)
    return lines.orderBy("EXPEDIENTE_BASE", "part", "share", "oid").select("line")

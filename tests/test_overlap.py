import math
import random
import time
from datetime import datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from cotejo import RegistryError
from cotejo.functions import geometry as G
from cotejo.operators import overlap as O
from cotejo.plans.overlap_report import add_and_report, report_overlaps
from tests.conftest import rows

NOW = datetime(2026, 3, 1, 12)
BOXES = "oid long, EXPEDIENTE string, ESTADO string, xmin double, ymin double, xmax double, ymax double"

SQUARE = ([0, 4, 4, 0], [0, 0, 4, 4], [4])
RING = ([0, 10, 10, 0, 2, 2, 8, 8], [0, 0, 10, 10, 2, 8, 8, 2], [4, 4])  # hole clockwise
U_SHAPE = ([0, 6, 6, 4, 4, 2, 2, 0], [0, 0, 6, 6, 2, 2, 6, 6], [8])


def measure(spark, pairs, shift=0.0):
    data = [tuple([[float(v) + shift for v in p[0]], [float(v) + shift for v in p[1]], p[2]][i] for p in pair for i in range(3)) for pair in pairs]
    ddl = ", ".join(f"{s}{c} array<{t}>" for s in "ab" for c, t in (("x", "double"), ("y", "double"), ("n", "int")))
    df = spark.createDataFrame(data, ddl).coalesce(1)
    udf = G.polygon_overlap()
    return [(r[0].area, r[0].touches) for r in df.select(udf("ax", "ay", "an", "bx", "by", "bn")).collect()]


@pytest.mark.parametrize("shift", [0.0, 1_000_000.0])
def test_hand_computed_areas(spark, shift):
    triangle = ([0, 4, 0], [0, 0, 4], [3])
    inner = ([3, 5, 5, 3], [3, 3, 5, 5], [4])
    beside = ([4, 8, 8, 4], [1, 1, 3, 3], [4])
    corner = ([4, 5, 5], [4, 4, 5], [3])
    far = ([9, 10, 10], [9, 9, 10], [3])
    clockwise = ([0, 0, 4, 4], [0, 4, 4, 0], [4])
    slot = ([2.5, 3.5, 3.5, 2.5], [3, 3, 5, 5], [4])
    got = measure(
        spark,
        [(SQUARE, triangle), (RING, inner), (RING, SQUARE), (SQUARE, beside), (SQUARE, corner), (SQUARE, far), (clockwise, SQUARE), (U_SHAPE, slot), (U_SHAPE, SQUARE)],
        shift,
    )
    areas = [a for a, _ in got]
    assert areas == pytest.approx([8, 0, 12, 0, 0, 0, 16, 0, 12], abs=1e-6)
    assert [t for a, t in got if a == 0] == [False, True, True, False, False]


def test_polygon_area(spark):
    df = spark.createDataFrame(
        [([float(v) for v in x], [float(v) for v in y], n) for x, y, n in (SQUARE, RING, U_SHAPE)],
        "xs array<double>, ys array<double>, ring_sizes array<int>",
    )
    assert [r[0] for r in df.select(G.polygon_area("xs", "ys", "ring_sizes")).collect()] == [16.0, 64.0, 28.0]


def test_rectangles_equal_closed_form(spark):
    rnd = random.Random(3)
    box = lambda: (lambda x, y, w, h: (x, y, x + w, y + h))(rnd.randint(0, 8), rnd.randint(0, 8), rnd.randint(1, 6), rnd.randint(1, 6))
    boxes = [(box(), box()) for _ in range(400)]
    ring = lambda b: ([b[0], b[2], b[2], b[0]], [b[1], b[1], b[3], b[3]], [4])
    got = measure(spark, [(ring(a), ring(b)) for a, b in boxes])
    for (a, b), (area, touches) in zip(boxes, got):
        w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
        assert area == pytest.approx(max(w, 0) * max(h, 0), abs=1e-9)
        if area == 0:
            assert touches == (w >= 0 and h >= 0)


def test_symmetry_and_bound(spark):
    rnd = random.Random(5)

    def star():
        n, cx, cy = rnd.randint(3, 9), rnd.uniform(0, 5), rnd.uniform(0, 5)
        angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
        r = [rnd.uniform(1, 3) for _ in angles]
        return [cx + q * math.cos(a) for q, a in zip(r, angles)], [cy + q * math.sin(a) for q, a in zip(r, angles)], [n]

    pairs = [(star(), star()) for _ in range(200)]
    there, back = measure(spark, pairs), measure(spark, [(b, a) for a, b in pairs])
    shoelace = lambda p: abs(sum(p[0][i - 1] * p[1][i] - p[0][i] * p[1][i - 1] for i in range(len(p[0])))) / 2
    for (a, b), (x, _), (y, _) in zip(pairs, there, back):
        assert x == pytest.approx(y, abs=1e-9)
        assert x <= min(shoelace(a), shoelace(b)) + 1e-9
    assert measure(spark, [(a, a) for a, _ in pairs])[0][0] == pytest.approx(shoelace(pairs[0][0]))


def test_grid_finds_every_pair_once(spark):
    """Sizes over six orders of magnitude, many copies of one box, boxes on cell borders, negative coordinates."""
    rnd = random.Random(11)
    data = []
    for i in range(700):
        size = 2.0 ** rnd.randint(-3, 17) if i % 3 else rnd.choice([0.0, 1.0, 8.0, 16.0])
        x, y = rnd.choice([rnd.uniform(-500, 500), float(rnd.randint(-60, 60) * 8)]), rnd.uniform(-500, 500)
        data.append((i, x, y, x + size, y + size * rnd.choice([1, 0.3])))
    data += [(1000 + i, 7.0, 7.0, 9.0, 9.0) for i in range(300)]
    df = spark.createDataFrame(data, "oid long, xmin double, ymin double, xmax double, ymax double")
    got = [tuple(r) for r in O.candidate_pairs(df.where("oid % 2 = 0"), df, cell=2.0).select("s_oid", "p_oid").collect()]
    p = pd.DataFrame(data, columns=["oid", "x0", "y0", "x1", "y1"])
    want = set()
    for s in data:
        if s[0] % 2 == 0:
            hit = p[(p.x0 <= s[3]) & (p.x1 >= s[1]) & (p.y0 <= s[4]) & (p.y1 >= s[2])]
            want.update((s[0], o) for o in hit.oid)
    assert len(got) == len(set(got)) and set(got) == want


def test_no_nested_loop_join(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], "oid long, xmin double, ymin double, xmax double, ymax double")
    plan = O.candidate_pairs(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def parcels(spark):
    return spark.createDataFrame(
        [
            (1, "A", "Vigente", 0.0, 0.0, 4.0, 4.0), (2, "A", "Vigente", 1.0, 1.0, 2.0, 2.0), (3, " B ", None, 2.0, 2.0, 6.0, 6.0),
            (4, "C", " archivado ", 0.0, 0.0, 9.0, 9.0), (5, "D", "x", 4.0, 4.0, 5.0, 5.0), (6, "E", "x", 50.0, 50.0, 51.0, 51.0),
            (7, "Z", "x", 1.0, 1.0, 1.0, 3.0), (8, "N", "x", None, None, None, None), (9, "F", "NO_UBICADO", 0.0, 0.0, 1.0, 1.0),
        ],
        BOXES,
    )


def test_overlap_rules(spark):
    ids = spark.createDataFrame([("A",), ("E",), ("Z",), ("N",), ("Q",)], "EXPEDIENTE string")
    found = O.overlaps(parcels(spark), ids)
    assert rows(found.drop("oid")) == [
        ("A", "B", "SIN_ESTADO", "TRASLAPA", 4.0, 25.0), ("A", "D", "x", "TOCA", 0.0, 0.0), ("A", "Z", "x", "TOCA", 0.0, 0.0),
    ]
    assert rows(O.subject_problems(parcels(spark), ids)) == [("N", "AREA_CERO"), ("Q", "EXPEDIENTE_NO_ENCONTRADO"), ("Z", "AREA_CERO")]
    attributes = spark.createDataFrame([(1, "B", "x"), (2, " B ", "Extinto"), (3, "D", "  "), (4, "C", "archivado ")], "oid long, EXPEDIENTE string, ESTADO string")
    joined = O.overlaps_joined_status(parcels(spark), attributes, ids)
    assert rows(joined.where("EXPEDIENTE_BASE = 'A'"), "EXPEDIENTE", "ESTADO", "TIPO") == [
        ("C", "archivado ", "TRASLAPA"), ("D", "SIN_ESTADO", "TOCA"), ("F", "SIN_ESTADO", "TRASLAPA"), ("Z", "SIN_ESTADO", "TOCA"),
    ]


def test_report_plan(spark, tmp_path):
    ids = spark.createDataFrame([("A",), ("E",)], "EXPEDIENTE string")
    report_overlaps(parcels(spark), ids, str(tmp_path), NOW)
    text = spark.read.text(str(tmp_path / "Reporte_Traslapes_20260301_120000" / "LINEAS"))
    assert [r[0] for r in text.collect()] == [
        "Expediente base: A | Área base: 16.0 m²",
        "Expediente: B | Estado: SIN_ESTADO | Tipo: TRASLAPA | Área traslapada: 4.0 m² | % respecto al base: 25.0 %",
        "Expediente: D | Estado: x | Tipo: TOCA | Área traslapada: 0.0 m² | % respecto al base: 0 %",
        "Expediente: Z | Estado: x | Tipo: TOCA | Área traslapada: 0.0 m² | % respecto al base: 0 %",
        "Expediente base: E | Área base: 1.0 m²",
        "No se detectaron traslapes válidos.",
    ]
    head = spark.read.text(str(tmp_path / "Reporte_Traslapes_20260301_120000" / "ENCABEZADO"))
    assert [r[0] for r in head.collect()] == [
        "REPORTE DE TRASLAPES - CM_BASE", "Campo expediente usado: EXPEDIENTE", "Campo estado usado: ESTADO",
        "Fecha: 2026-03-01 12:00:00",
    ]


def test_new_parcels(spark, tmp_path):
    new = spark.createDataFrame([(1, "NUEVO-1", None, 0.0, 0.0, 3.0, 3.0), (2, "malo 1", None, 0.0, 0.0, 1.0, 1.0), (3, "NUEVO-1", None, 7.0, 7.0, 8.0, 8.0)], BOXES)
    attributes = spark.createDataFrame([(1, "A", "Vigente"), (2, "C", "ARCHIVADO"), (3, "F", None)], "oid long, EXPEDIENTE string, ESTADO string")
    out = add_and_report(parcels(spark), new, attributes, str(tmp_path), NOW)
    assert out.count() == 10
    got = rows(spark.read.parquet(str(tmp_path / "TRASLAPES_20260301_120000" / "TRASLAPES")))
    assert got == sorted(
        [("NUEVO-1", "A", "Vigente", 9.0, 100.0), ("NUEVO-1", "A", "Vigente", 1.0, 11.11), ("NUEVO-1", " B ", "NO_DEFINIDO", 1.0, 11.11),
         ("NUEVO-1", "F", None, 1.0, 11.11)], key=str,
    )


@pytest.mark.parametrize("shape", ["box", "ring"])
def test_new_parcels_of_one_batch(spark, shape):
    """Each new parcel is compared with the base and with the new ones before it, whatever oids the base uses."""
    data = [(1, "N1", None, 0.0, 0.0, 2.0, 2.0), (2, "N2", None, 1.0, 0.0, 3.0, 2.0), (3, "N3", None, 9.0, 9.0, 10.0, 10.0)]
    new = spark.createDataFrame(data, BOXES)
    base = spark.createDataFrame([(1, "B", None, 9.0, 9.0, 9.5, 10.0)], BOXES)
    if shape == "ring":
        corners = dict(xs=F.array("xmin", "xmax", "xmax", "xmin"), ys=F.array("ymin", "ymin", "ymax", "ymax"), ring_sizes=F.array(F.lit(4)))
        new, base = new.withColumns(corners), base.withColumns(corners)
    states = spark.createDataFrame([(1, "N2", "x"), (2, "N1", "ARCHIVADO")], "oid long, EXPEDIENTE string, ESTADO string")
    found = O.overlaps_of_new(new, base, states.where("oid = 1"), shape=shape)
    assert rows(found.drop("oid")) == [("N2", "N1", "NO_DEFINIDO", 2.0, 50.0), ("N3", "B", "NO_DEFINIDO", 0.5, 50.0)]
    found = O.overlaps_of_new(new, base, states, shape=shape)  # a closed one is not compared with
    assert rows(found.drop("oid")) == [("N3", "B", "NO_DEFINIDO", 0.5, 50.0)]


def test_ring_parcels(spark):
    data = [(1, "U", "x", *[[float(v) for v in c] for c in U_SHAPE[:2]], U_SHAPE[2]), (2, "S", None, [2.0, 4.0, 4.0, 2.0], [2.0, 2.0, 6.0, 6.0], [4]),
            (3, "I", "x", [2.5, 3.5, 3.0], [3.0, 3.0, 5.0], [3]), (4, "G", "x", None, None, None)]
    df = G.with_box(spark.createDataFrame(data, "oid long, EXPEDIENTE string, ESTADO string, xs array<double>, ys array<double>, ring_sizes array<int>"))
    df = df.withColumn("area", G.polygon_area("xs", "ys", "ring_sizes"))
    found = O.overlaps(df, df, shape="ring")
    assert rows(found.drop("oid")) == [
        ("I", "S", "SIN_ESTADO", "TRASLAPA", 1.0, 100.0), ("S", "I", "x", "TRASLAPA", 1.0, 12.5), ("S", "U", "x", "TOCA", 0.0, 0.0),
        ("U", "S", "SIN_ESTADO", "TOCA", 0.0, 0.0),
    ]


def test_blank_ids_and_qualified_columns(spark, tmp_path):
    """A blank wanted id is a problem and no subject; qualified names are found, a missing status column is an error."""
    ids = spark.createDataFrame([("A",), (" ",), (None,), ("",)], "EXPEDIENTE string")
    blanks = parcels(spark).withColumn("EXPEDIENTE", F.when(F.col("EXPEDIENTE") == "E", F.lit(None)).otherwise(F.col("EXPEDIENTE")))
    assert {r[0] for r in rows(O.overlaps(blanks, ids), "EXPEDIENTE_BASE")} == {"A"}
    assert rows(O.analysed_subjects(blanks, ids), "id") == [("A",)]
    assert rows(O.subject_problems(blanks, ids)) == [("", "EXPEDIENTE_VACIO")]
    named = parcels(spark).withColumnRenamed("EXPEDIENTE", "CM_BASE.Expediente").withColumnRenamed("ESTADO", "CM_BASE.Estado")
    plain = report_overlaps(parcels(spark), ids, str(tmp_path / "a"), NOW)
    assert rows(report_overlaps(named, ids.withColumnRenamed("EXPEDIENTE", "expediente"), str(tmp_path / "b"), NOW)) == rows(plain)
    head = spark.read.text(str(tmp_path / "b" / "Reporte_Traslapes_20260301_120000" / "ENCABEZADO"))
    assert [r[0] for r in head.collect()][1:3] == ["Campo expediente usado: Expediente", "Campo estado usado: Estado"]
    with pytest.raises(RegistryError, match="status"):
        report_overlaps(parcels(spark).drop("ESTADO"), ids, str(tmp_path / "c"), NOW)


def star(rnd, n, x, y, size):
    """A non-convex ring around (x, y), counter-clockwise."""
    angles = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    radius = [size * rnd.uniform(0.2, 1) for _ in range(n)]
    return [x + r * math.cos(a) for a, r in zip(angles, radius)], [y + r * math.sin(a) for a, r in zip(angles, radius)], [n]


def clipped_area(ring, convex):
    """Shoelace area of a ring cut to the left of every edge of a convex counter-clockwise ring."""
    points, cut = list(zip(*ring[:2])), list(zip(*convex[:2]))
    for a, b in zip(cut, cut[1:] + cut[:1]):
        side = lambda p: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])  # noqa: B023, E731
        out = []
        for p, q in zip(points, points[1:] + points[:1]):
            if side(p) >= 0:
                out.append(p)
            if (side(p) >= 0) != (side(q) >= 0):
                t = side(p) / (side(p) - side(q))
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        points = out
    return abs(sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(points, points[1:] + points[:1]))) / 2


def circle(n, x, r=1.0):
    return [x + r * math.cos(2 * math.pi * i / n) for i in range(n)], [r * math.sin(2 * math.pi * i / n) for i in range(n)], [n]


def test_stars_against_clipping(spark, monkeypatch):
    """Whatever the cuts of a batch and of the meeting edges: areas equal those of plain clipping, either way round."""
    rnd = random.Random(11)
    pairs = [(star(rnd, rnd.randint(5, 40), 0, 0, 3), circle(rnd.randint(3, 12), rnd.uniform(-3, 3), 2)) for _ in range(60)]
    want = [clipped_area(a, b) for a, b in pairs]
    assert [a for a, _ in measure(spark, pairs)] == pytest.approx(want, abs=1e-9)
    assert [a for a, _ in measure(spark, [(b, a) for a, b in pairs])] == pytest.approx(want, abs=1e-9)
    monkeypatch.setattr(G, "_CHUNK", 7)
    monkeypatch.setattr(G, "_POINTS", 50)
    batches = [G._Batch(*[pd.Series([p[k][c] for p in pairs]) for c in range(3)]) for k in (0, 1)]
    assert G._shared_area(*batches).tolist() == pytest.approx(want, abs=1e-9)
    cuts = list(G._cuts([40, 20, 70, 10]))
    assert cuts == [(0, 1), (1, 2), (2, 3), (3, 4)] and list(G._cuts([10, 20, 30])) == [(0, 2), (2, 3)]


def test_large_rings_in_seconds(spark):
    """Two rings of 20,000 points that overlap, and two that only touch: no work for edges that do not meet."""
    n = 20_000
    start = time.perf_counter()
    (area, _), (nothing, touches), (none, apart) = measure(spark, [(circle(n, 0), circle(n, 1)), (circle(n, 0), circle(n, 2)), (circle(n, 0), circle(n, 2.001))])
    assert area == pytest.approx(2 * math.pi / 3 - math.sqrt(3) / 2, abs=1e-6)
    assert (nothing, touches, none, apart) == (0, True, 0, False)
    assert time.perf_counter() - start < 60  # most of it is building the frame; all combinations would be 1.2e9 edges
    left, right = (G._Batch(*[pd.Series([c]) for c in circle(n, x)]) for x in (0, 1))
    assert G._Sweep(left, right).cost()[0] < 20 * n


def boxes(spark, n=40):
    return spark.sql(
        f"SELECT id AS oid, concat('E', id) AS EXPEDIENTE, 'VIGENTE' AS ESTADO, id * 0.75D AS xmin, 0D AS ymin, id * 0.75D + 1 AS xmax, 1D AS ymax FROM range({n})"
    )


def planned_broadcasts(df):
    """Broadcasts that the planner takes from the size of the files, except for look-ups by key, whose sides are shuffled and measured first."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Broadcast" in line and "Join" in line and "_key_hash#" not in line]


def test_grid_entries_are_not_broadcast(spark):
    df = boxes(spark)
    found = O.overlaps(df, df)
    assert planned_broadcasts(found) == []
    assert found.count() == 2 * 39


def test_entries_of_new_parcels_are_not_broadcast(spark):
    base = boxes(spark)
    new = base.selectExpr("oid", "concat('N', oid) AS EXPEDIENTE", "xmin + 0.25D AS xmin", "ymin", "xmax + 0.25D AS xmax", "ymax")
    found = O.overlaps_of_new(new, base, base)
    assert planned_broadcasts(found) == []
    assert found.count() == 40 + 39 + 39  # its own place, the next one there and the new one before it


def test_report_lines_broadcast_no_entries(spark):
    df = boxes(spark)
    lines = O.report_lines(O.overlaps(df, df), O.analysed_subjects(df, df))
    assert planned_broadcasts(lines) == []
    assert lines.count() == 40 + 2 * 39


def test_rings_are_not_broadcast(spark):
    df = boxes(spark).selectExpr("*", "array(xmin, xmax, xmax, xmin) AS xs", "array(ymin, ymin, ymax, ymax) AS ys", "array(4) AS ring_sizes")
    found = O.overlaps(df, df, shape="ring")
    assert planned_broadcasts(found) == []
    assert found.count() == 2 * 39


def broadcasts(df):
    """All broadcasts of the plan, look-ups by key included: these are planned by the size of the files as well."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastExchange" in line]


def test_wanted_ids_are_not_broadcast(spark):
    df = boxes(spark)
    found, subjects = O.overlaps(df, df), O.analysed_subjects(df, df)
    assert [broadcasts(x) for x in (found, subjects, O.report_lines(found, subjects), O.subject_problems(df, df))] == [[]] * 4


def test_report_of_stored_overlaps_broadcasts_nothing(spark, tmp_path):
    df = boxes(spark)
    O.overlaps(df, df.where("oid < 3")).write.parquet(str(tmp_path / "found"))
    lines = O.report_lines(spark.read.parquet(str(tmp_path / "found")), O.analysed_subjects(df, df.where("oid < 3 OR oid = 20")))
    assert broadcasts(lines) == []
    assert [r[0][:17] for r in lines.collect()].count("No se detectaron ") == 1  # 20 is not among those found


def test_first_polygon_of_wanted_ids_only(spark):
    df = spark.createDataFrame([(3, "A"), (1, None), (2, "A"), (4, "B"), (5, ""), (6, "C")], "oid long, EXPEDIENTE string")
    ids = spark.createDataFrame([("A",), ("A",), (None,), ("C",), ("Q",)], "EXPEDIENTE string")
    assert rows(O.first_polygons(df, ids), "EXPEDIENTE", "oid") == [("A", 2), ("C", 6)]


def test_states_by_id_are_not_broadcast(spark):
    base = boxes(spark)
    new = base.selectExpr("oid", "concat('N', oid) AS EXPEDIENTE", "xmin + 0.25D AS xmin", "ymin", "xmax + 0.25D AS xmax", "ymax")
    found = O.overlaps_of_new(new, base, base.where("oid < 30"))
    assert broadcasts(found) == [] and broadcasts(O.overlaps_joined_status(base, base, base)) == []
    assert rows(found.groupBy("ESTADO").count()) == [("NO_DEFINIDO", 10 + 10 + 39), ("VIGENTE", 30 + 29)]

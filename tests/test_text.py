import re
import time
import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cotejo.functions import text as X
from cotejo.operators import schema as S
from tests.conftest import rows

# All but 28 letters whose capitals this JVM's Unicode tables do not know yet (compared over all code points).
NO_CAPITAL = [chr(c) for c in (0x19B, 0x264, 0x1C8A, 0xA7CD, 0xA7DB, 0x10791, *range(0x10D70, 0x10D86))]
LETTERS = st.characters(exclude_categories=("Cs",), exclude_characters=NO_CAPITAL)
TEXTS = st.lists(
    st.one_of(st.none(), st.text(LETTERS, max_size=12), st.text(" \t\xa0aÉßñ한글𝐎½ﬁ  ́Ⅷ…-2", max_size=12)),
    min_size=60, max_size=60,
)


def key(v):
    s = unicodedata.normalize("NFKD", " ".join(("" if v is None else v).split()))
    return "".join(c for c in s if not unicodedata.combining(c)).upper()


def ascii_text(v):
    s = unicodedata.normalize("NFKD", ("" if v is None else v).strip())
    return s.encode("ascii", "ignore").decode().upper()


def bare(v):
    return None if v is None else "".join(c for c in unicodedata.normalize("NFD", v) if unicodedata.category(c) != "Mn")


def upper_differs(s):
    # Python and the JVM may ship different Unicode versions; skip letters whose case they might disagree on.
    return any(len(c.upper()) > 1 or ord(c) > 0x24F for c in s)


@settings(max_examples=12, deadline=None)
@given(TEXTS)
def test_folds_equal_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    got = df.select("i", X.fold_key("v"), X.fold_ascii("v"), X.drop_accents("v"), X.strip("v"), X.trim_upper("v")).collect()
    for i, k, a, b, s, t in got:
        v = values[i]
        if k != key(v):
            assert upper_differs(key(v)) and k.lower() == key(v).lower(), (v, k, key(v))
        assert a == ascii_text(v), v
        assert b == bare(v), v
        assert s == (None if v is None else v.strip()), v
        if not upper_differs(v or ""):
            assert t == (v or "").strip().upper()


def test_key_examples(spark):
    df = spark.createDataFrame([("  exploración\t\xa0 minera ",), ("Straße ½ ﬁn…",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(X.fold_key("v")).collect()] == ["EXPLORACION MINERA", "STRASSE 1⁄2 FIN...", "", ""]
    assert df.select(X.fold_ascii("v")).collect()[1][0] == "STRAE 12 FIN..."


def test_tidy_and_file_names(spark):
    names = ["N-1_Reserva  de área_2026-CAN-PRI-008.pdf", "a_b_c_d.PDF", "a_b.txt", "solo", ".oculto", "_-_ .x", "v1.2_x.tar.gz"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    number, subject, case_id = X.split_file_name("name")
    got = df.select(number, subject, case_id, X.file_suffix("name"), X.file_stem("name")).collect()
    assert [tuple(r) for r in got] == [
        ("N-1", "Reserva de área", "2026-CAN-PRI-008", ".pdf", "N-1_Reserva  de área_2026-CAN-PRI-008"),
        ("a", "b - c", "d", ".pdf", "a_b_c_d"),
        ("a", "b", "", ".txt", "a_b"),
        ("solo", "", "", "", "solo"),
        (".oculto", "", "", "", ".oculto"),
        ("", "", "", ".x", "_-_ "),
        ("v1.2", "x.tar", "", ".gz", "v1.2_x.tar"),
    ]


def test_labels(spark):
    df = spark.createDataFrame([(1,), (9,), (13,)], "m int")
    assert [r[0] for r in df.select(X.month_label("m")).collect()] == ["ENERO", "SETIEMBRE", "MES_13"]
    ids = spark.createDataFrame([("ver 2026-can-pri-008.",), ("nada",), (None,)], "t string")
    assert [r[0] for r in ids.select(X.extract_case_id("t")).collect()] == ["2026-CAN-PRI-008", "", ""]
    paths = spark.createDataFrame([("/b/x/a.pdf",), ("/b/a.pdf",), ("/c/a.pdf",)], "p string")
    assert [r[0] for r in paths.select(X.relative_folder("p", "/b/")).collect()] == ["x", ".", "/c"]


def test_header_rules(spark):
    df = spark.createDataFrame([], "` Fecha de Envío (UTC) ` string, b string")
    assert S.clean_headers(df).columns == ["FECHA_DE_ENVIO_UTC", "B"]
    assert S.upper_headers(df).columns == ["FECHA DE ENVÍO (UTC)", "B"]
    assert S.ascii_headers(df).columns == ["FECHA DE ENVIO (UTC)", "B"]


def test_case_id_pattern_is_plain():
    assert re.fullmatch(X.CASE_ID_PATTERN, "2026-CAN-PRI-008")


def test_status_and_blank(spark):
    df = spark.createDataFrame([(None,), (" \t",), (" x",)], "e string")
    assert [r[0] for r in df.select(X.status_label("e")).collect()] == ["SIN_ESTADO", "SIN_ESTADO", " x"]
    assert rows(df.select(F.count_if(X.is_blank("e")))) == [(2,)]


def test_every_character_with_a_page_or_a_syllable(spark):
    """Each character by itself, over all blocks that hold decompositions."""
    spans = (range(0x80, 0x3400), range(0xA600, 0xAC00), range(0xAC00, 0xD7A4, 5), range(0xF900, 0x10000), range(0x11000, 0x11A00), range(0x1D000, 0x1F300), range(0x2F800, 0x2FA20))
    values = [chr(c) for span in spans for c in span]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    folded = X._fold(F.col("v"), "NFKD", "marks").alias("k")
    for v, k, a, b in df.select("v", folded, X.fold_ascii("v"), X.drop_accents("v")).collect():
        assert k == "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)), hex(ord(v))
        assert (a, b) == (ascii_text(v), bare(v)), hex(ord(v))


def test_folds_cost_the_same_in_every_script(spark):
    """0.4 M characters a script; the Latin time decides, with slack for a busy machine."""
    def seconds(first, fold):
        texts = [("".join(chr(first + (i * 7 + j) % 20) for j in range(2000)),) for i in range(200)]
        df = spark.createDataFrame(texts, "v string").repartition(4).cache()
        df.count()
        taken = []
        for _ in range(3):
            start = time.perf_counter()
            df.select(F.sum(F.length(fold("v")))).collect()
            taken.append(time.perf_counter() - start)
        df.unpersist()
        return min(taken)

    for fold in (X.fold_key, X.drop_accents):
        latin = seconds(0xE0, fold)
        for first in (0x430, 0x3041, 0x4E00, 0xAC00):
            assert seconds(first, fold) < 3 * latin + 1.0, hex(first)

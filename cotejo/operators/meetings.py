"""Meetings of a month and what each calendar holds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.functions.dates import clock, hours, in_month
from cotejo.functions.predicates import is_held_meeting
from cotejo.functions.text import join_names
from cotejo.operators.keyed import lookup_join

MEETING_CLASS = 26
EVENTS_SHOWN = 20


def held_meetings(meetings: DataFrame, year: int, month: int) -> DataFrame:
    """Detail rows of the month's meetings, in order of their start."""
    rows = meetings.where(in_month("start", year, month) & is_held_meeting()).orderBy("start", "end", "subject", "organizer")
    return rows.select(
        F.to_date("start").alias("FECHA"), clock("start").alias("HORA_INICIO"), clock("end").alias("HORA_FIN"),
        hours("duration_min").alias("DURACION_HORAS"), F.col("subject").alias("ASUNTO"),
        F.col("organizer").alias("ORGANIZADOR"), join_names("recipients").alias("PARTICIPANTES"),
    )


def meeting_totals(detail: DataFrame) -> DataFrame:
    """Number of meetings and the sum of their rounded hours, added exactly as decimals."""
    total = F.sum(F.col("DURACION_HORAS").cast("decimal(18,2)")).cast("double")
    return detail.agg(
        F.count("*").alias("TOTAL_REUNIONES"), F.coalesce(F.round(total, 2), F.lit(0.0)).alias("TOTAL_HORAS")
    )


def _in_range(meetings, first, until):
    lower, upper = (F.lit(d).cast("timestamp_ntz") for d in (first, until))
    return meetings.where((F.col("class") == MEETING_CLASS) & (F.col("start") >= lower) & (F.col("start") < upper))


def first_events(meetings: DataFrame, first, until, tie="event_id", shown=EVENTS_SHOWN) -> DataFrame:
    """The first events of every calendar inside the range; each task forwards at most ``shown`` per calendar."""
    from pyspark.sql import Window

    w = Window.partitionBy("calendar").orderBy("start", tie)
    return _in_range(meetings, first, until).withColumn("n", F.row_number().over(w)).where(F.col("n") <= shown)


def calendar_inventory(calendars: DataFrame, meetings: DataFrame, first, until) -> DataFrame:
    """Every calendar with all its items, those inside the range, and a mark if there are none."""
    lower, upper = (F.lit(d).cast("timestamp_ntz") for d in (first, until))
    inside = (F.col("class") == MEETING_CLASS) & (F.col("start") >= lower) & (F.col("start") < upper)
    counts = meetings.groupBy("calendar").agg(
        F.count("*").alias("_all"), F.count_if(inside).alias("_in")
    )
    all_, in_ = F.coalesce("_all", F.lit(0)), F.coalesce("_in", F.lit(0))
    return lookup_join(calendars, counts, "calendar").select(
        "calendar", all_.alias("TOTAL_ELEMENTOS"), in_.alias("EN_RANGO"), (in_ == 0).alias("SIN_EVENTOS")
    )

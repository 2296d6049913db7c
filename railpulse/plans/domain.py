"""The domain tables derived from one folder of shared test tables.

Every frame is derived from the given tables, so its work grows with them. The
station dimension's dense ids take a checkpointed range pass, which runs when
the frame is built; a ``Domain`` builds it once and every query makes its own
``Domain``, so each query pays for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from railpulse.operators import delays as D
from railpulse.operators import stations as S
from railpulse.sources import testmap as TM


class Domain:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._stations: DataFrame | None = None

    # -- raw inputs --------------------------------------------------------
    def records(self) -> DataFrame:
        return TM.train_records(self.spark, self.sf_dir)

    def coords(self) -> DataFrame:
        return TM.station_coords(self.spark, self.sf_dir)

    def weather(self) -> DataFrame:
        return TM.weather_all(self.spark, self.sf_dir)

    def weather_measures(self) -> DataFrame:
        return TM.weather_measures(self.spark, self.sf_dir)

    # -- stations ------------------------------------------------------------
    def stations(self) -> DataFrame:
        if self._stations is None:
            self._stations = S.stations_regions(self.coords())
        return self._stations

    def lookup(self) -> DataFrame:
        return S.station_lookup(self.stations())

    # -- delays ----------------------------------------------------------------
    def named(self, start=None, end=None) -> DataFrame:
        return D.with_station_name(D.in_date_range(self.records(), start, end))

    def clean(self, start=None, end=None) -> DataFrame:
        return D.clean_records(self.named(start, end))

    def kept(self, start=None, end=None) -> DataFrame:
        return D.non_early(self.clean(start, end))

    def daily(self, start=None, end=None) -> DataFrame:
        return D.daily_station_delays_from_named(self.named(start, end))

    def delays(self, start=None, end=None) -> DataFrame:
        return D.attach_station_id(self.daily(start, end), self.lookup())

    # -- unified -----------------------------------------------------------------
    def unified(self) -> DataFrame:
        from railpulse.operators.unified import unified_all
        return unified_all(self.delays(), self.stations(), self.weather())


def in_load(a: str | None, b: str | None, date_col: str = "service_date") -> F.Column:
    """Whether a date lies in a load's window; None leaves that end open."""
    c = F.col(date_col)
    cond = c.isNotNull()
    if a:
        cond = cond & (c >= F.lit(a).cast("date"))
    if b:
        cond = cond & (c <= F.lit(b).cast("date"))
    return cond


def load_label(date_col: str = "service_date") -> F.Column:
    """Which of the three loads a date belongs to."""
    expr = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, a, b in TM.LOADS:
        expr = expr.when(in_load(a, b, date_col), F.lit(name))
    return expr

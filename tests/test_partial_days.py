"""A partial day costs no other day or file of its batch."""
import os

import pytest

from railpulse.constants import DELAYS_ALL
from railpulse.sources import sinks as SK
from railpulse.streaming import refresh as RF
from test_streaming import write_week


@pytest.mark.parametrize("max_files", [None, 1])
def test_other_days_of_the_batch_are_stored(spark, tmp, max_files):
    landing, table, ck = (os.path.join(tmp, x) for x in ("landing", "table", "ck"))
    os.makedirs(landing)
    write_week(landing, "2025-11-24", ["2025-11-24,30,Abaliget,2,10,0.2\n", "2025-11-24,31,Abasar,3,10,0.3\n"])
    RF.load_delays(spark, landing, table, ck)
    write_week(landing, "2025-11-18", ["2025-11-24,30,Abaliget,5,10,0.5\n", "2025-11-20,30,Abaliget,6,10,0.6\n"])
    write_week(landing, "2025-12-01", ["2025-12-01,30,Abaliget,4,10,0.4\n"])
    with pytest.raises(RF.LoadError, match="lacks Abasar on 2025-11-24"):
        RF.load_delays(spark, landing, table, ck, max_files=max_files)
    rows = {(str(r.date), r.station_name): r.total_delay_minutes for r in SK.read_table(spark, table, DELAYS_ALL).collect()}
    assert rows == {("2025-11-24", "Abaliget"): 2.0, ("2025-11-24", "Abasar"): 3.0, ("2025-11-20", "Abaliget"): 6.0, ("2025-12-01", "Abaliget"): 4.0}
    rejects = spark.read.json(f"{table}_rejects/partial_*")
    assert [(r["date"], r["reason"]) for r in rejects.collect()] == [("2025-11-24", "partial day")]

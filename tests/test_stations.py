"""Station dimension: boxes, regions, dense ids."""
import random

from pyspark.sql import functions as F

from railpulse.constants import COUNTY_BOXES
from railpulse.operators import stations as S
from railpulse.operators.ordering import dense_row_ids


def first_box(lat, lon):
    for name, a, b, c, d in COUNTY_BOXES:
        if a <= lat <= b and c <= lon <= d:
            return name
    return None


def test_boxes_and_regions(spark):
    rows = [("Bp", 47.5, 19.0), ("PestOnly", 47.7, 19.5), ("Edge", 47.37, 18.92),
            ("Out", 44.0, 14.0), ('"Q"', 46.0, 18.0)]
    df = S.assign_region(S.assign_county(S.clean_coords(spark.createDataFrame(rows, "station_name STRING, lat DOUBLE, lon DOUBLE"))))
    got = {r.station_name: (r.county, r.region, r.region_id) for r in df.collect()}
    assert got["Bp"] == ("Budapest", "Budapest", 6)  # Budapest wins over Pest
    assert got["PestOnly"][0] in ("Nógrád", "Pest") and got["PestOnly"][0] == first_box(47.7, 19.5)
    assert got["Edge"] == ("Budapest", "Budapest", 6)  # closed bounds
    assert got["Out"] == (None, None, None)
    assert got["Q"] == ("Baranya", "Dél-Dunántúl", 5)


def test_case_chain_equals_join_and_python(spark):
    rnd = random.Random(7)
    pts = [(f"s{i}", round(rnd.uniform(45.5, 49.0), 2), round(rnd.uniform(15.5, 23.2), 2)) for i in range(400)]
    pts += [(f"e{i}", b[1], b[3]) for i, b in enumerate(COUNTY_BOXES)]  # exact corners
    df = spark.createDataFrame(pts, "station_name STRING, lat DOUBLE, lon DOUBLE")
    case = {r.station_name: r.county for r in S.assign_county(df).collect()}
    join = {r.station_name: r.county for r in S.assign_county_by_join(df).collect()}
    py = {n: first_box(a, b) for n, a, b in pts}
    assert case == py == join


def test_dense_ids_byte_order_and_many_partitions(spark):
    names = ["Ábrahám", "Abaliget", "Aba-Sárkeresztúr", "Zala", "abc", "Öreg"] + [f"n{i:04d}" for i in range(300)]
    df = spark.createDataFrame([(n, 47.0, 19.0) for n in names], "station_name STRING, lat DOUBLE, lon DOUBLE")
    out = dense_row_ids(df, ["station_name", "lat", "lon"], "station_id", num_partitions=7).collect()
    got = sorted((r.station_id, r.station_name) for r in out)
    expect = sorted(names, key=lambda s: s.encode("utf-8"))
    assert [n for _, n in got] == expect
    assert [i for i, _ in got] == list(range(1, len(names) + 1))


def test_stations_regions_schema(spark):
    df = spark.createDataFrame([("Abaliget", 46.152688, 18.0753148), ("Aba-Sárkeresztúr", 47.023785, 18.5425663)],
                               "station_name STRING, lat DOUBLE, lon DOUBLE")
    st = S.stations_regions(df)
    assert st.columns == ["station_name", "latitude", "longitude", "county", "region", "region_id", "station_id"]
    got = {r.station_name: (r.county, r.region, r.region_id, r.station_id) for r in st.collect()}
    assert got["Abaliget"] == ("Baranya", "Dél-Dunántúl", 5, 2)
    assert got["Aba-Sárkeresztúr"] == ("Fejér", "Közép-Dunántúl", 3, 1)

"""Spark SQL over the registered views equals the DataFrame operators."""
from conftest import SF
from railpulse.operators import kpis as K
from railpulse.plans.domain import Domain
from railpulse.plans.views import register_views


def test_sql_over_views_matches_dataframe_kpis(spark):
    dom = Domain(spark, SF)
    unified = register_views(dom.delays(), dom.stations(), dom.weather(), prefix="t_")
    by_sql = spark.sql("""
        SELECT region,
               ROUND(APPROX_PERCENTILE(IF(avg_delay_minutes > 5, avg_delay_minutes, NULL), 0.5), 2) AS median_delay,
               COUNT(DISTINCT date) AS days_tracked
        FROM t_unified_all GROUP BY region""")
    by_df = K.kpi_median(unified).select("region", "median_delay", "days_tracked")
    assert sorted(map(tuple, by_sql.collect()), key=str) == sorted(map(tuple, by_df.collect()), key=str)
    calm = spark.sql("""SELECT AVG(avg_delay_minutes) AS m FROM t_unified_all
                        WHERE high_temp = 0 AND high_wind = 0 AND high_precip = 0""").collect()[0].m
    assert abs(calm - K.calm_mean(unified).collect()[0].calm_avg_delay) < 1e-9
    assert spark.sql("SELECT COUNT(*) AS n FROM t_delays_all").collect()[0].n == dom.delays().count()

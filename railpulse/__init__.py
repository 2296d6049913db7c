"""railpulse: railway punctuality and weather analytics on Spark.

Raw train records -> daily station delays; station coordinates -> county ->
region; weather -> extreme flags; one unified table; three punctuality KPIs.
Everything is a DataFrame -> DataFrame function over Spark's built-in
operators."""

__version__ = "0.1.0"

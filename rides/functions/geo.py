"""Great-circle distance."""

from pyspark.sql import Column

from rides.functions._util import as_sql, expr

# Fixed value: mean Earth radius in kilometres used by the distance rule.
EARTH_RADIUS_KM = 6371


def haversine_sql(lat1, lon1, lat2, lon2) -> str:
    """Haversine distance in km as SQL text; any NULL input gives NULL.

    The half-angle is taken in degrees before conversion to radians. An
    argument just above 1 (rounding) yields NaN from ASIN, as in other SQL
    engines.
    """
    a1, o1, a2, o2 = (f"({as_sql(c)})" for c in (lat1, lon1, lat2, lon2))
    return (f"2 * {EARTH_RADIUS_KM} * asin(sqrt("
            f"power(sin(radians(({a2} - {a1}) / 2)), 2)"
            f" + cos(radians({a1})) * cos(radians({a2}))"
            f" * power(sin(radians(({o2} - {o1}) / 2)), 2)))")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    return expr(haversine_sql(lat1, lon1, lat2, lon2))


def haversine_sql_function(spark, name: str = "haversine_km") -> None:
    """Register the same formula as a temporary SQL function for SQL users."""
    body = haversine_sql("lat1", "lon1", "lat2", "lon2")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(
            lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE)
        RETURNS DOUBLE
        RETURN {body}
    """)

"""JSON payloads and GeoJSON features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HALF_HOURLY = (
    "dataset string, psrType string, bmUnit string, nationalGridBmUnitId string, "
    "settlementDate date, settlementPeriod int, halfHourEndTime timestamp_ntz, quantity double"
)


def payload_schema(record: str, key: str = "data") -> T.StructType:
    return T.StructType([T.StructField(key, T.ArrayType(T.StructType.fromDDL(record)))])


def read_payloads(
    spark: SparkSession, path: str, record: str, key: str = "data", multi_line: bool = False
) -> DataFrame:
    """Payload files to one row for each record of the array under ``key``."""
    reader = spark.read.schema(payload_schema(record, key)).option("multiLine", multi_line)
    return reader.json(path).select(F.inline(key))


#: What the coordinates of each geometry type are.
# Fixed values of the feature format.
_LINES = "array<array<array<double>>>"
COORDINATES = {
    "Point": "array<double>",
    "LineString": "array<array<double>>",
    "MultiPoint": "array<array<double>>",
    "Polygon": _LINES,
    "MultiLineString": _LINES,
    "MultiPolygon": f"array<{_LINES}>",
}


def feature_schema(properties: str) -> T.StructType:
    """Coordinates as a variant: their depth hangs on the type, row by row."""
    geometry = T.StructType().add("type", T.StringType()).add("coordinates", T.VariantType())
    properties = T.StructType.fromDDL(properties)
    return T.StructType().add("type", T.StringType()).add("properties", properties).add("geometry", geometry)


def _features(spark: SparkSession, path: str, properties: str, collection: bool) -> DataFrame:
    feature = feature_schema(properties)
    if not collection:
        return spark.read.schema(feature).json(path)
    whole = T.StructType([T.StructField("features", T.ArrayType(feature))])
    return spark.read.schema(whole).option("multiLine", True).json(path).select(F.inline("features"))


def read_features(
    spark: SparkSession,
    path: str,
    properties: str,
    geometry: str = "Polygon",
    collection: bool = True,
) -> DataFrame:
    """One row for each feature: its properties, and ``coordinates`` of the one type named.

    A feature of another type is an error; a feature without geometry has NULL
    coordinates. A collection file is one JSON document, which a single task must
    parse; large feature sets should be landed one feature to a line
    (``collection=False``), which splits.
    """
    kind = F.col("geometry.type")
    other = F.raise_error(F.concat(F.lit(f"not a {geometry}: "), kind)).cast(COORDINATES[geometry])
    found = F.variant_get("geometry.coordinates", "$", COORDINATES[geometry])
    coordinates = F.when(kind.isNull() | (kind == geometry), found).otherwise(other)
    return _features(spark, path, properties, collection).select("properties.*", coordinates.alias("coordinates"))


def read_areas(spark: SparkSession, path: str, properties: str, collection: bool = True) -> DataFrame:
    """One row for each feature: its properties, and ``parts``, an array of polygons as arrays of rings.

    Polygons and multipolygons may stand in one file. A feature of any other type
    is an error; one without geometry has NULL parts.
    """
    kind, raw = F.col("geometry.type"), F.col("geometry.coordinates")
    other = F.raise_error(F.concat(F.lit("not an area: "), kind)).cast(COORDINATES["MultiPolygon"])
    parts = (
        F.when(kind == "MultiPolygon", F.variant_get(raw, "$", COORDINATES["MultiPolygon"]))
        .when(kind == "Polygon", F.array(F.variant_get(raw, "$", COORDINATES["Polygon"])))
        .when(kind.isNotNull(), other)
    )
    return _features(spark, path, properties, collection).select("properties.*", parts.alias("parts"))


def rings_of(areas: DataFrame, keys: list[str], parts: str = "parts") -> DataFrame:
    """The keys and one row for each ring: ``part`` and ``ring`` from 0, where ring 0 is the shell, and ``points``.

    A row generated before the parts holds them as they are. Without it Spark would
    filter on what they are worked out from, and so work them out three times.
    """
    held = areas.select(*keys, F.inline(F.array(F.struct(F.col(parts).alias("_parts")))))
    each = held.select(*keys, F.posexplode("_parts").alias("part", "_rings"))
    return each.select(*keys, "part", F.posexplode("_rings").alias("ring", "points"))


def to_area_features(df: DataFrame, parts: str = "parts") -> DataFrame:
    """Each row as one feature, as a line of JSON in ``value``: a polygon if it has one part, else a multipolygon.

    A row whose parts are NULL is a feature without geometry.
    """
    single = F.to_json(F.struct(F.lit("Polygon").alias("type"), F.col(parts)[0].alias("coordinates")))
    several = F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.col(parts).alias("coordinates")))
    geometry = F.when(F.col(parts).isNull(), "null").when(F.size(parts) == 1, single).otherwise(several)
    properties = F.to_json(F.struct(*[c for c in df.columns if c != parts]), {"ignoreNullFields": "false"})
    line = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    return df.select(line.alias("value"))


def to_features(df: DataFrame, x: str, y: str) -> DataFrame:
    """Each row as one point feature, as a line of JSON in ``value``."""
    others = [c for c in df.columns if c not in (x, y)]
    return df.select(
        F.to_json(
            F.struct(
                F.lit("Feature").alias("type"),
                F.struct(
                    F.lit("Point").alias("type"), F.array(F.col(x), F.col(y)).alias("coordinates")
                ).alias("geometry"),
                F.struct(*others).alias("properties"),
            )
        ).alias("value")
    )

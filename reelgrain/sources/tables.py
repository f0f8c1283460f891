"""Typed readers for sidecar JSON, catalogue tables, feature tables and topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Schemas of the metadata files and tables.
VIDEO_METADATA = """camera_id STRING, timestamp STRING, duration INT, resolution ARRAY<INT>, fps INT, codec STRING,
    position STRUCT<lat: DOUBLE, lon: DOUBLE, elevation: DOUBLE>"""
VENUE_CONFIG = """venue_id STRING, description STRING,
    cameras ARRAY<STRUCT<id: STRING, position: STRING, type: STRING>>, use_cases ARRAY<STRING>"""
EVENT_CONFIG = """event_id STRING, venue_id STRING, date DATE, description STRING, pipeline_config STRUCT<
    frame_extraction: STRUCT<fps: INT, quality: INT>,
    `3d_reconstruction`: STRUCT<enabled: BOOLEAN, method: STRING, settings: MAP<STRING, STRING>>,
    object_detection: STRUCT<enabled: BOOLEAN, model: STRING, confidence: DOUBLE>,
    nerf: STRUCT<enabled: BOOLEAN>>"""
DETECTIONS = "bbox ARRAY<FLOAT>, confidence FLOAT, class_id INT, class_name STRING"
SUMMARY = "frame_id STRING, detections_count INT"
FEATURES = "frame_id STRING, extractor STRING, embedding ARRAY<FLOAT>"
JOBS = """job_id STRING, input_path STRING, output_path STRING, processing_time INTERVAL DAY TO SECOND,
    mesh_quality FLOAT, polygon_count BIGINT, state STRING"""
FRAMES = """frame_id BIGINT, timestamp TIMESTAMP, image_data BINARY,
    exif STRUCT<focal_length: FLOAT, iso: INT>"""


def read_sidecars(spark: SparkSession, path: str | list[str], schema: str, multi_line: bool = True) -> DataFrame:
    """JSON metadata with a given schema.

    `multi_line` takes one object or one array per file, as cameras write them. Bulk tables with
    an object per line need it off, which also lets Spark split big files and use folder columns.
    """
    reader = spark.read.schema(schema)
    if multi_line:
        reader = reader.option("multiLine", "true").option("recursiveFileLookup", "true")
    return reader.json(path)


def read_catalog(spark: SparkSession, table: str | None = None, path: str | None = None,
                 jdbc: dict[str, str] | None = None) -> DataFrame:
    """A catalogue table by name, by path, or over JDBC.

    For a big JDBC table pass partitionColumn, lowerBound, upperBound and numPartitions.
    """
    if jdbc:
        return spark.read.format("jdbc").options(**jdbc).load()
    return spark.read.parquet(path) if path else spark.table(table)


def read_features(spark: SparkSession, path: str, schema: str = FEATURES) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def read_topic(spark: SparkSession, options: dict[str, str], schema: str, fmt: str = "kafka") -> DataFrame:
    """A live stream of JSON messages, or of files of `fmt` where no broker is at hand."""
    from pyspark.sql import functions as F

    if fmt != "kafka":
        options = dict(options)
        path = options.pop("path", None)
        return spark.readStream.format(fmt).schema(schema).options(**options).load(path)
    stream = spark.readStream.format("kafka").options(**options).load()
    body = F.from_json(F.col("value").cast("string"), schema).alias("m")
    return stream.select(body, F.col("timestamp").alias("arrived")).select("m.*", "arrived")

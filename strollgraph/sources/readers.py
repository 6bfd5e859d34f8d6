"""Reading feature layers, side tables and tagged map data."""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strollgraph.functions import geometry as G
from strollgraph.functions import projection as R

METRIC_CRS = "EPSG:27700"
LONLAT_CRS = "EPSG:4326"

# Fixed schemas of the side tables.
SIDE_TABLES = {
    "membership": "site_id string, component_id string",
    "lineage": "previous_site_id string, site_id string, relationship string, overlap_m2 double",
    "review": (
        "site_id string, geometry_sha256 string, review_outcome string, review_notes string, "
        "review_source string, review_date string"
    ),
    "ledger": "site_id string, geometry_sha256 string, review_group string, review_date string, review_outcome string",
}


def read_features(
    spark: SparkSession, path: str, fmt: str = "parquet", crs: str | None = METRIC_CRS, required: bool = True
) -> DataFrame:
    """A feature layer with ``polygons``, ``lines`` and ``points`` in the metric system.

    Parquet layers hold those columns already.  GeoJSON (one feature per line, or a whole
    FeatureCollection per file) also gives ``attributes`` as a map.  A layer without coordinate
    system or without rows is an error.
    """
    if crs not in (METRIC_CRS, LONLAT_CRS):
        raise ValueError(f"{path} has no usable coordinate system; supply one of {METRIC_CRS}, {LONLAT_CRS}")
    if fmt == "parquet":
        frame = spark.read.parquet(path)
    elif fmt in ("geojson", "geojson_collection"):
        frame = _geojson(feature_texts(spark, path, fmt))
    else:
        raise ValueError(f"Unknown layer format {fmt}")
    if crs == LONLAT_CRS:
        frame = reproject(frame)
    if required and frame.isEmpty():
        raise ValueError(f"Required layer {path} is empty")
    return frame


def feature_texts(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The JSON text of every feature: ``value``.

    ``geojson`` has one feature on a line, with or without the lines of a collection around them.  ``geojson_collection`` is one collection a file, however it
    is laid out: Spark splits its bytes at the type of each feature, so a file of one long line is read by many tasks.  The type must be the
    first member of a feature, as writers put it; anything else, and every feature that is cut short, stays as broken text for the parser to report.
    """
    if fmt == "geojson":
        # Lines of the collection itself: its head, its other members and its end.
        lines = spark.read.text(path).select(F.regexp_replace(F.trim("value"), ",$", "").alias("value"))
        return lines.where(~F.col("value").rlike(r'^$|^\{$|^[\]\}]+$|^"|^\{?\s*"type"\s*:\s*"FeatureCollection"'))
    pieces = spark.read.option("lineSep", '"Feature"').text(path)
    head = r'^\s*\{[\s\S]*"FeatureCollection"|^\s*$'
    body = F.regexp_replace("value", r'\s*,?\s*\{\s*"type"\s*:\s*$', "")  # the opening of the next feature
    last = F.regexp_replace(body, r'\}\s*\][^\]\}]*(?:"[^"]*"\s*:[^\]]*)?\}\s*$', "}")  # the end of the collection
    is_last = ~F.col("value").rlike(r'\{\s*"type"\s*:\s*$')
    return pieces.where(~F.col("value").rlike(head)).select(F.concat(F.lit('{"type":"Feature"'), F.when(is_last, last).otherwise(body)).alias("value"))


def feature_rejects(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """One row: ``features`` that can be read and ``broken`` ones."""
    parsed = F.from_json("value", "type string, geometry struct<type:string>, _broken string", {"columnNameOfCorruptRecord": "_broken"})
    broken = F.col("p").isNull() | F.col("p._broken").isNotNull()
    return feature_texts(spark, path, fmt).select(parsed.alias("p")).agg(
        F.count_if(~broken).alias("features"), F.count_if(broken).alias("broken")
    )


def _geojson(features: DataFrame) -> DataFrame:
    """Features from JSON text; coordinates nest differently per geometry type."""
    shape = "id string, properties map<string,string>, geometry struct<type:string,coordinates:string>"
    head = F.from_json("value", shape, {"mode": "FAILFAST"})
    rows = features.select(head.alias("f")).select(
        F.col("f.id").alias("feature_id"), F.col("f.properties").alias("attributes"),
        F.col("f.geometry.type").alias("kind"), F.col("f.geometry.coordinates").alias("text"),
    )

    def parsed(depth: int) -> str:
        return f"from_json(text, '{'array<' * depth}double{'>' * depth}')"

    xy = "p -> " + G.point("p[0]", "p[1]")
    rings = f"transform(%s, ring -> transform(ring, {xy}))"
    polygons = (
        f"case kind when 'Polygon' then array({rings % parsed(3)}) "
        f"when 'MultiPolygon' then transform({parsed(4)}, poly -> {rings % 'poly'}) end"
    )
    lines = (
        f"case kind when 'LineString' then array(transform({parsed(2)}, {xy})) "
        f"when 'MultiLineString' then transform({parsed(3)}, ln -> transform(ln, {xy})) end"
    )
    points = (
        f"case kind when 'Point' then transform(array({parsed(1)}), {xy}) "
        f"when 'MultiPoint' then transform({parsed(2)}, {xy}) end"
    )
    return rows.select(
        "feature_id", "attributes", "kind", F.expr(polygons).alias("polygons"), F.expr(lines).alias("lines"),
        F.expr(points).alias("points"),
    )


def reproject(frame: DataFrame) -> DataFrame:
    """Longitude/latitude geometry columns to the metric grid."""
    move = "v -> " + R.lonlat_to_grid("v.x", "v.y")
    depth = {"points": 1, "path": 1, "lines": 2, "rings": 2, "polygons": 3}

    def nested(text: str, level: int) -> str:
        return f"transform({text}, {move})" if level == 1 else f"transform({text}, d{level} -> {nested(f'd{level}', level - 1)})"

    return frame.withColumns({c: F.expr(nested(c, n)) for c, n in depth.items() if c in frame.columns})


def read_side_table(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A CSV side table under its fixed schema."""
    return spark.read.csv(path, header=True, schema=T.StructType.fromDDL(SIDE_TABLES[kind]), mode="FAILFAST")


def tagged(nodes_or_ways: DataFrame, *keys: str) -> DataFrame:
    """Rows that carry any of the tag keys."""
    test = " or ".join(f"tags['{k}'] is not null" for k in keys)
    return nodes_or_ways.where(test)


def locate_nodes(nodes: DataFrame) -> DataFrame:
    """``node_id, lon, lat, tags`` with grid coordinates ``x, y``."""
    at = nodes.withColumn("_p", F.expr(R.lonlat_to_grid("lon", "lat")))
    return at.select("node_id", F.col("_p.x").alias("x"), F.col("_p.y").alias("y"), "tags")


def id_completeness(expected: DataFrame, received: DataFrame, key: str) -> DataFrame:
    """Ids asked for but not received, and received without being asked: ``key, problem``."""
    asked, got = expected.select(key).distinct(), received.select(key).distinct()
    missing = asked.join(got, key, "left_anti").withColumn("problem", F.lit("missing"))
    extra = got.join(asked, key, "left_anti").withColumn("problem", F.lit("unexpected"))
    return missing.unionByName(extra)


#: Bytes of a file in memory at once.
DIGEST_CHUNK = 8 << 20


def file_digests(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """SHA-256 of every file below a folder: ``path, length, sha256``.

    Spark lists the files (it passes over empty ones); each is read as a stream of chunks, so its size does not matter.  The store must be one that
    Arrow opens by its URI.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select("path", "length")
    chunk = DIGEST_CHUNK

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column("path").to_pylist():
                store, name = pa.fs.FileSystem.from_uri(quote(uri, safe=":/"))
                own = hashlib.sha256()
                with store.open_input_stream(name) as stream:
                    while data := stream.read(chunk):
                        own.update(data)
                found.append(own.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=["path", "length", "sha256"])

    return files.repartition("path").mapInArrow(digests, "path string, length bigint, sha256 string")


def folder_digest(digests: DataFrame) -> DataFrame:
    """One digest of a folder from the sorted file digests: ``{"path": "sha", ...}`` hashed."""
    pair = F.concat(F.lit('"'), "path", F.lit('": "'), "sha256", F.lit('"'))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", pair.alias("t")))), lambda e: e["t"]), ", ")
    return digests.agg(F.sha2(F.concat(F.lit("{"), listed, F.lit("}")), 256).alias("sha256"))


def source_versions(sources: DataFrame) -> DataFrame:
    """One JSON text of role to version: ``sources`` has ``role, version, last_modified, sha256``."""
    version = F.coalesce("version", "last_modified", "sha256")
    entries = F.array_sort(F.collect_list(F.struct("role", version.alias("v"))))
    return sources.agg(F.to_json(F.map_from_entries(entries)).alias("source_versions"))

"""Collections of any layout, digests of large files, ordered sinks."""

import glob
import hashlib
import json
import os

import pytest

from strollgraph.sources import readers, writers

FEATURES = [
    {"type": "Feature", "id": str(i), "properties": {"name": f"n{i}", "note": 'a "quoted" }, {"type": word' if i % 5 == 0 else "x"},
     "geometry": {"type": "LineString", "coordinates": [[i, 0], [i + 3, 4]]}} for i in range(300)
]


def layouts():
    whole = {"type": "FeatureCollection", "features": FEATURES}
    yield "one line", json.dumps(whole)
    yield "indented", json.dumps(whole, indent=2)
    yield "compact", json.dumps(whole, separators=(",", ":"))
    yield "named", json.dumps({"type": "FeatureCollection", "name": "l", "crs": {"type": "name", "properties": {"name": "urn"}}, "features": FEATURES})
    yield "members after", json.dumps({"type": "FeatureCollection", "features": FEATURES, "crs": {"type": "name", "properties": {"name": "urn"}}})
    yield "line each", '{"type": "FeatureCollection", "features": [\n' + ",\n".join(map(json.dumps, FEATURES)) + "\n]}\n"


@pytest.mark.parametrize("name, text", list(layouts()), ids=[n for n, _ in layouts()])
def test_collections_of_every_layout(spark, tmp_path, name, text):
    path = str(tmp_path / "layer.json")
    with open(path, "w") as out:
        out.write(text)
    rows = readers.read_features(spark, path, "geojson_collection").collect()
    assert sorted(int(r.feature_id) for r in rows) == list(range(300))
    assert all(r.attributes["name"] == f"n{r.feature_id}" and r.lines[0][1].x == int(r.feature_id) + 3 for r in rows)
    assert tuple(readers.feature_rejects(spark, path, "geojson_collection").first()) == (300, 0)


def test_a_file_of_one_line_is_read_by_many_tasks(spark, tmp_path):
    path = str(tmp_path / "layer.json")
    with open(path, "w") as out:
        out.write(json.dumps({"type": "FeatureCollection", "features": FEATURES * 20}))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        texts = readers.feature_texts(spark, path, "geojson_collection")
        assert texts.rdd.getNumPartitions() >= os.path.getsize(path) // 100000
        assert texts.count() == 6000 and readers.feature_rejects(spark, path, "geojson_collection").first()["broken"] == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("fmt", ["geojson", "geojson_collection"])
def test_a_cut_file_is_no_silent_loss(spark, tmp_path, fmt):
    path = str(tmp_path / "layer.json")
    text = '{"type": "FeatureCollection", "features": [\n' + ",\n".join(map(json.dumps, FEATURES[:10]))
    with open(path, "w") as out:
        out.write(text[:-40])
    assert tuple(readers.feature_rejects(spark, path, fmt).first()) == (9, 1)
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        readers.read_features(spark, path, fmt).collect()


def test_digests_read_files_in_chunks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(readers, "DIGEST_CHUNK", 1000)
    sizes = {"a b.bin": 1, "c%20.bin": 2, "d.bin": 999, "e.bin": 1000, "f.bin": 3_000_001}
    for name, size in sizes.items():
        (tmp_path / name).write_bytes(os.urandom(size))
    got = {os.path.basename(r.path): (r.length, r.sha256) for r in readers.file_digests(spark, str(tmp_path)).collect()}
    plain = {n: (s, hashlib.sha256((tmp_path / n).read_bytes()).hexdigest()) for n, s in sizes.items()}
    assert sorted(got.values()) == sorted(plain.values())


def test_files_read_by_name_are_in_order(spark, tmp_path):
    rows = spark.range(5000).selectExpr("concat('s', lpad(cast(pmod(hash(id), 100000) as string), 6, '0')) as site_id", "id").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_layers({"sites": rows, "empty": rows.limit(0)}, str(tmp_path))
        writers.write_table(rows, str(tmp_path / "csv"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = sorted(glob.glob(str(tmp_path / "csv" / "part-*.csv")))
    lines = [line for f in files for line in open(f).read().splitlines()[1:]]
    assert len(files) > 1 and len(lines) == 5000 and lines == sorted(lines, key=lambda x: x.split(",")[0])
    import pyarrow.parquet as pq

    ids = [i for f in sorted(glob.glob(str(tmp_path / "sites" / "part-*.parquet"))) for i in pq.read_table(f).column("site_id").to_pylist()]
    assert ids == sorted(ids) and spark.read.parquet(str(tmp_path / "empty")).columns == ["site_id", "id"]

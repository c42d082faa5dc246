import json

from pyspark.sql import functions as F

from routeloom.sources import readers, writers


def test_geojson(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"page_no": 61}, "geometry": {"type": "LineString", "coordinates": [[1, 2], [3.5, 4]]}}, {"type": "Feature", "properties": {}, "geometry": {"type": "MultiLineString", "coordinates": [[[0, 0], [1, 1]], [[2, 2], [3, 3]]]}}]}
    (tmp_path / "a.geojson").write_text(json.dumps(doc))
    rows = readers.read_geojson(spark, str(tmp_path / "a.geojson")).collect()
    assert [len(r.lines) for r in rows] == [1, 2] and rows[0].lines[0][1].x == 3.5 and rows[0].properties["page_no"] == "61"
    d = spark.createDataFrame([(1, [[(1.0, 2.0), (3.0, 4.0)]])], "id int, lines array<array<struct<x:double,y:double>>>")
    writers.write_features(d, str(tmp_path / "out"), "lines", ["id"])
    text = spark.read.text(str(tmp_path / "out")).first()[0]
    assert json.loads(text)["geometry"] == {"type": "LineString", "coordinates": [[1.0, 2.0], [3.0, 4.0]]}


def test_anchor_files(spark, tmp_path):
    g = [{"index": 1, "role": "frame_anchor", "pdf_x": 1, "pdf_y": 2.5, "longitude": 133, "latitude": 34.0}]
    full = {"page_no": 61, "frame_id": "061_f06", "page_height_pt": 700, "gcps": g}
    for name, body in (("page_061_061_f06.json", full), ("page_061_061_f06_drop5.json", full), ("page_061_061_f07.json", {**full, "frame_id": "061_f07", "gcps": []}), ("page_061_061_f06.template.json", {**full, "gcps": []})):
        (tmp_path / name).write_text(json.dumps(body))
    (tmp_path / "page_001_001_f01.json").write_text("{oops")
    files = readers.read_anchor_files(spark, str(tmp_path))
    assert {r.path.rsplit("/")[-1]: r.status for r in files.collect()} == {"page_061_061_f06.json": "imported", "page_061_061_f06_drop5.json": "skipped_variant", "page_061_061_f07.json": "skipped_no_frame_anchor", "page_061_061_f06.template.json": "skipped_variant", "page_001_001_f01.json": "invalid_json"}
    best = {r.frame_id: r.path.rsplit("/")[-1] for r in readers.best_anchor_files(files).collect()}
    assert best == {"061_f06": "page_061_061_f06.json", "061_f07": "page_061_061_f07.json"}


def test_other_files(spark, tmp_path):
    (tmp_path / "t.csv").write_bytes("番号,名前\r\n1,\"霊山,\n寺\"\r\n\r\n2,極楽寺\r\n".encode("cp932"))
    assert [list(r.cells) for r in readers.read_encoded_rows(spark, str(tmp_path / "t.csv")).orderBy("row_no").collect()] == [["1", "霊山,\n寺"], ["2", "極楽寺"]]
    (tmp_path / "p.html").write_text("<li>1 <b>A &amp; B</b></li><li>2 <b>C</b></li>")
    assert [tuple(r) for r in readers.read_matches(spark, str(tmp_path / "p.html"), r"<li>(\d+) <b>([^<]*)</b>", ["no", "name"]).collect()] == [("1", "A & B"), ("2", "C")]
    (tmp_path / "r.json").write_text(json.dumps({"elements": [{"type": "way", "id": 5, "tags": {"highway": "path"}, "geometry": [{"lat": 1, "lon": 2}, {"lat": 3, "lon": 4}]}, {"type": "way", "id": 6, "geometry": [{"lat": 1, "lon": 2}]}]}))
    assert [(r.way_id, r.highway, r.points[1].x) for r in readers.read_roads(spark, str(tmp_path / "r.json")).collect()] == [(5, "path", 4.0)]
    writers.write_rows(spark.range(0).select(F.col("id").alias("a"), F.lit("x").alias("b")), str(tmp_path / "csv"), ["b", "a"])
    rows = readers.read_rows(spark, str(tmp_path / "csv"), "b string, a bigint")
    assert rows.columns == ["b", "a"] and rows.count() == 0

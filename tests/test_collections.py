"""Features of whole GeoJSON collections against Python's JSON parser, with splits far smaller than a feature."""

import json
import random

import pytest
from pyspark.sql import types as T

from fathomline.sources import features, files

NAMES = ["", "a", '{"', "}", 'q"}', "\\", "\\\\\"}", "]},{", "ä}ö", "line\nbreak", '"type":"Feature"']


def feature(r: random.Random, n: int) -> dict:
    ring = [[round(r.random(), 3), round(r.random(), 3)] for _ in range(r.randrange(4, 40))]
    shape = r.choice([{"type": "Polygon", "coordinates": [ring]}, {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}, None,
                      {"type": "GeometryCollection", "geometries": [{"type": "Point", "coordinates": [1, 2]}, {"type": "Polygon", "coordinates": [ring]}]}])
    return {"type": "Feature", "id": n, "properties": {"n": n, "name": r.choice(NAMES)}, "geometry": shape}


def document(r: random.Random, first: int) -> tuple[dict, list[dict]]:
    found = [feature(r, first + i) for i in range(r.randrange(0, 12))]
    doc = {"type": "FeatureCollection"}
    if r.random() < 0.5:
        doc |= {"crs": {"type": "name", "properties": {"name": r.choice(NAMES)}}, r.choice(NAMES): {"a": {"b": [{"c": {}}]}}}
    if r.random() < 0.5:
        doc |= {"bbox": [0, 1, 2, 3], "links": [{"type": "text", "href": r.choice(NAMES)}, {}]}
    doc["features"] = found
    if r.random() < 0.5:
        doc |= {"more": [[{"type": "Feature"}]], "note": r.choice(NAMES)}
    return doc, found


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


PROPERTIES = T.StructType([T.StructField("n", T.LongType()), T.StructField("name", T.StringType())])


def test_features_are_those_of_a_json_parser(small_splits, tmp_path):
    r = random.Random(5)
    want = {}
    for i in range(14):
        docs = [document(r, 1000 * i + 100 * j) for j in range(3 if i % 5 == 4 else 1)]
        text = "\n".join(json.dumps(d, indent=r.choice([None, 1]), ensure_ascii=bool(i % 2)) for d, _ in docs)
        (tmp_path / f"{i}.json").write_text(text + "\n" * (i % 3), encoding="utf-8")
        want |= {f["properties"]["n"]: f for _, found in docs for f in found}
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text('{"type":"FeatureCollection","features":[]}')
    texts = [json.loads(x["text"]) for x in features.collection_features(small_splits, str(tmp_path)).collect()]
    got = [x for x in texts if x.get("type") == "Feature"]
    assert len(got) == len(want) and {x["id"]: x for x in got} == want

    rows = files.read_geojson(small_splits, str(tmp_path), PROPERTIES).collect()
    assert {x["properties"]["n"]: x["properties"]["name"] for x in rows} == {n: f["properties"]["name"] for n, f in want.items()}
    assert len(rows) == len(want)
    for x in rows:
        shape = want[x["properties"]["n"]]["geometry"]
        assert (x["geometry"] is None) == (shape is None)
        if shape and "coordinates" in shape:
            assert json.loads(x["geometry"]["coordinates"]) == shape["coordinates"]


def test_one_document_is_read_by_many_tasks(small_splits, tmp_path):
    found = [feature(random.Random(i), i) for i in range(60)]
    (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "features": found}))
    pieces = features._pieces(small_splits, str(tmp_path))
    assert pieces.select("block").distinct().count() > 20
    assert pieces.rdd.getNumPartitions() > 8
    assert files.read_geojson(small_splits, str(tmp_path), PROPERTIES).count() == 60


@pytest.mark.parametrize("cut", [60, 333, 1500])
def test_a_document_cut_off_in_its_features_is_an_error(small_splits, tmp_path, cut):
    found = [feature(random.Random(i), i) for i in range(20)]
    (tmp_path / "one.json").write_text(json.dumps({"type": "FeatureCollection", "features": found})[:cut])
    with pytest.raises(features.NotJson):
        files.read_geojson(small_splits, str(tmp_path), PROPERTIES).count()

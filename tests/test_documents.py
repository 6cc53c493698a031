"""Large JSON documents cut into records by many tasks, against Python's parser."""

import json

import numpy as np
import pytest

from blotter.sources import documents as D
from blotter.sources import files as S

# texts that look like structure, and escapes on either side of a closing brace
TEXTS = ["plain", 'a "quoted" } word', "}{][", "back\\slash}", '\\"}', "é中\n}", "", "{\"features\": [{}]}", "\\\\"]


def record(rng, i):
    deep = {"k": [{"x": [1, {"y": TEXTS[int(rng.integers(len(TEXTS)))]}]}], "e": {}} if rng.random() < 0.4 else None
    return {"id": i, "t": TEXTS[int(rng.integers(len(TEXTS)))], "deep": deep, TEXTS[int(rng.integers(len(TEXTS)))] + "key": 1.5}


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set(k, str(n)) for k in old]
    for k, v in old.items():
        spark.conf.set(k, v)


def cut(spark, path, key=None):
    return sorted((json.loads(r.value) for r in D.document_records(spark, str(path), key).collect()), key=lambda r: r["id"])


@pytest.mark.parametrize("size, indent", [(40, None), (500, 2)])
def test_array(spark, tmp_path, small_splits, size, indent):
    small_splits(size)
    rng = np.random.default_rng(size)
    want = [record(rng, i) for i in range(20 if size < 100 else 120)]
    (tmp_path / "a.json").write_text(json.dumps(want, indent=indent, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps([record(rng, 1000)]))
    (tmp_path / "none.json").write_text("[]")
    got = cut(spark, tmp_path)
    assert got[:-1] == want and got[-1]["id"] == 1000


@pytest.mark.parametrize("size", [60, 700])
def test_features_among_other_members(spark, tmp_path, small_splits, size):
    small_splits(size)
    rng = np.random.default_rng(size)
    want = [record(rng, i) for i in range(20)]
    other = [{"id": -i, "features": [{"id": -1}]} for i in range(10)]
    doc = {"type": "FeatureCollection", "crs": {"type": "name", "properties": {"features": [{"id": -2}]}}, "links": other, "features": want, "more": other, "z": {"features": [{"id": 7}]}}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    (tmp_path / "b.json").write_text(json.dumps({"features": [], "x": [{"id": 5}]}))
    (tmp_path / "c.json").write_text(json.dumps({"x": [{"id": 5}] * 20}))
    assert cut(spark, tmp_path, "features") == want


def test_lines_and_single_object(spark, tmp_path, small_splits):
    small_splits(100)
    rng = np.random.default_rng(0)
    want = [record(rng, i) for i in range(20)]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in want[:-1]))
    (tmp_path / "one.json").write_text(json.dumps(want[-1], indent=1) + "\n")
    assert cut(spark, tmp_path) == want


def test_record_over_many_ranges_and_broken_file(spark, tmp_path, small_splits):
    small_splits(100)
    want = [{"id": 0, "t": "}" * 1000}, {"id": 1, "t": [{"a": "{" * 40}] * 30}, {"id": 2}]
    (tmp_path / "a.json").write_text(json.dumps(want))
    assert cut(spark, tmp_path) == want
    (tmp_path / "a.json").write_text(json.dumps(want)[:-60] + '}, {"id": 9, "t": {"u": 1}')
    got = [r.value for r in D.document_records(spark, str(tmp_path)).collect()]
    assert any(v.startswith('{"id": 9') or '"id": 9' in v for v in got)


def test_a_large_document_is_read_by_several_tasks(spark, tmp_path, small_splits):
    recs = [{"incident_datetime": "2017-01-01T00:00:00.000", "address_1": f"{i} Main {{}}", "city": "Ottawa", "latitude": "45.1", "longitude": "-75.1",
             "hour_of_day": str(i % 24), "parent_incident_type": "Theft"} for i in range(20000)]
    (tmp_path / "a.json").write_text(json.dumps(recs))
    small_splits(1 << 18)
    assert D.fragments(spark, str(tmp_path)).select("block").distinct().count() > 8
    df = S.read_json_array(spark, str(tmp_path / "a.json"), source=True)
    rows = df.select("address_1", "_source").collect()
    assert sorted(r[0] for r in rows) == sorted(r["address_1"] for r in recs)
    assert {r[1] for r in rows} == {f"file://{tmp_path}/a.json"} or all(r[1].endswith("/a.json") for r in rows)
    one = spark.read.schema(S.SOCRATA_INCIDENT_SCHEMA).json(str(tmp_path / "a.json"), multiLine=True)
    assert df.drop("_source").exceptAll(one).isEmpty() and one.exceptAll(df.drop("_source")).isEmpty()

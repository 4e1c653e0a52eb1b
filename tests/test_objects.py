"""JSON objects of files of any form, cut into many byte ranges."""

import json
import random

import pytest

from tagledger.schemas import BRONZE_COLUMNS, Slot
from tagledger.sources.bronze import file_forms, read_bronze
from tagledger.sources.objects import json_objects

SLOT = Slot.parse("2024-01-01", "06")


@pytest.fixture(params=[1 << 27, 300, 71])
def range_bytes(request, spark):
    """Size of the byte ranges that tasks read."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.openCostInBytes", cost)


def rows(n, draw):
    odd = ["plain", "a } b", "{", '"', '\\"}{', "}\\", "é𝒳}", "", "[{]}", "tab\tnew\nline }", "\\", "{}", '{"a": 1}']
    return [
        {
            "product_name": draw.choice(odd) + draw.choice(odd),
            "current_price": draw.choice([None, 1.5, "7"]),
            "extra": draw.choice([None, {"deep": [{"x": "}"}, {}]}, [], [{}]]),
            "category": str(i),
        }
        for i in range(n)
    ]


FORMS = {
    "pretty": lambda r: json.dumps(r, indent=2),
    "dense": lambda r: json.dumps(r, separators=(",", ":"), ensure_ascii=False),
    "lines": lambda r: "\n".join(map(json.dumps, r)) + "\n",
    "objects": lambda r: " ".join(json.dumps(x, indent=1) for x in r),
    "arrays": lambda r: "\n\n".join(json.dumps(r[i : i + 3]) for i in range(0, len(r), 3)),
}


@pytest.mark.parametrize("form", FORMS)
def test_objects_of_every_form(spark, tmp_path, range_bytes, form):
    draw = random.Random(form)
    want = []
    for k in range(2):
        made = rows(9, draw)
        want += made
        (tmp_path / f"{k}.json").write_text(FORMS[form](made), encoding="utf-8")
    (tmp_path / "none.json").write_text(" [ ] \n")
    got = [json.loads(r["text"]) for r in json_objects(spark, str(tmp_path)).collect()]
    assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want))


def test_an_object_that_is_cut_off_is_left_out(spark, tmp_path, range_bytes):
    text = json.dumps([{"category": "1"}, {"category": "2", "product_name": "x" * 50}])
    for k, end in enumerate((len(text) - 2, len(text) - 10, 12)):
        (tmp_path / f"{k}.json").write_text(text[:end])
    got = [json.loads(r["text"])["category"] for r in json_objects(spark, str(tmp_path)).collect()]
    assert sorted(got) == ["1", "1"]


def test_forms_are_told_by_the_first_bytes(spark, tmp_path, range_bytes):
    folder = tmp_path / "source=s" / "category=c" / SLOT.folder
    folder.mkdir(parents=True)
    made = [{c: f"{c} {i}" for c in BRONZE_COLUMNS} for i in range(60)]
    texts = {
        "a_lines": "﻿" + "\n".join(map(json.dumps, made)),
        "b_arrays": "\n" + "\n".join(json.dumps(made[i : i + 20]) for i in (0, 20, 40)),
        "c_pretty": json.dumps(made, indent=4),
        "d_one": json.dumps(made * 5),
        "e_empty": "",
    }
    for name, text in texts.items():
        (folder / f"{name}.json").write_text(text)
    (folder / "_SUCCESS").write_text("")
    lines, others = file_forms(spark, str(folder / "*"))
    assert [n.rsplit("/", 1)[-1][0] for n in lines] == ["a", "b", "e"] and len(others) == 2
    got = read_bronze(spark, str(tmp_path), "s", SLOT)
    assert got.count() == 60 * 8 and got.filter("product_name is null").count() == 0
    if range_bytes == 71:
        assert got.rdd.getNumPartitions() > 5


def test_one_large_array_is_read_by_many_tasks(spark, tmp_path, range_bytes):
    folder = tmp_path / "source=s" / "category=c" / SLOT.folder
    folder.mkdir(parents=True)
    made = [{c: f"{c} {i}" for c in BRONZE_COLUMNS} for i in range(200)]
    (folder / "one.json").write_text(json.dumps(made))
    read = spark.read.option("lineSep", "}").text(str(folder))
    if range_bytes < 1000:
        assert read.rdd.getNumPartitions() > 8
    got = read_bronze(spark, str(tmp_path), "s", SLOT, layout="array")
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r[c] for c in BRONZE_COLUMNS) for r in made)

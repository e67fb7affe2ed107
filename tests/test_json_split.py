"""Multi-line JSON in splits against the plain reader."""

import json
import random

import pytest

from tidewater.sources import json_split


def record(rng, depth=0):
    pieces = ['"', "\\", "{", "}", "[", "]", "\n", "é", "漢", "\\\"", "a", ",", ":", " ", "😀", "\t"]
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
    out = {"id": rng.randrange(10**6), "s": text(), text() + "k": text()}
    if depth < 2 and rng.random() < 0.5:
        out["o"] = record(rng, depth + 1)
        out["l"] = [record(rng, 2), text(), 1.5, None, []]
    return out


def landed(tmp, name, text):
    path = f"{tmp}/{name}"
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


@pytest.mark.parametrize("split", [211, 4000, 1 << 20])
def test_records_of_any_split(spark, tmp, split):
    rng = random.Random(split)
    rows = [record(rng) for _ in range(25)] + [{"id": 1, "s": "x" * 900 + "}" * 50}, {}, {"s": "\\"}]
    dump = lambda r, **k: json.dumps(r, ensure_ascii=rng.random() < 0.5, **k)
    texts = {"array.json": "[" + ",\n".join(dump(r) for r in rows) + "]\n",
             "pretty.json": "  " + dump(rows, indent=2) + " ",
             "many.json": "\n".join(dump(r) for r in rows), "one.json": dump(rows[0]), "none.json": "", "blank.json": " \n",
             "empty.json": "[]", "tight.json": json.dumps(rows, separators=(",", ":"))}
    paths = [landed(tmp, n, t) for n, t in texts.items()]
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = {}
        for r in json_split.json_records(spark, paths).collect():
            got.setdefault(r.path.rsplit("/", 1)[1], []).append(json.loads(r.value))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    key = lambda r: json.dumps(r, sort_keys=True)
    want = {n: rows for n in ("array.json", "pretty.json", "many.json", "tight.json")} | {"one.json": rows[:1]}
    assert set(got) == set(want)
    for name, records in want.items():
        assert sorted(map(key, got[name])) == sorted(map(key, records)), name


def test_one_file_is_read_by_many_tasks(spark, tmp):
    path = landed(tmp, "big.json", json.dumps([{"a": i, "t": "x" * 50} for i in range(20_000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        records = json_split.json_records(spark, [path])
        assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() >= 5
        assert records.count() == 20_000
        df = json_split.read_json_split(spark, [path], "a bigint, t string")
        assert df.agg({"a": "sum"}).first()[0] == sum(range(20_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_writer_holds_a_batch_and_files_are_whole_arrays(spark, tmp):
    """Every file is one array of the given number of records; the lines come
    record by record, not as one value of a whole file."""
    from tidewater.plans.bronze import write_json_arrays
    df = spark.range(0, 25, 1, 2).selectExpr("id", "'a\n]' || id AS t")
    write_json_arrays(df, f"{tmp}/j", rows_per_file=5)
    files = spark.read.text(f"{tmp}/j", wholetext=True).collect()
    assert sorted(len(json.loads(f.value)) for f in files) == [2, 3, 5, 5, 5, 5]
    lines = spark.read.text(f"{tmp}/j")
    assert lines.count() == 25 + 6 and lines.selectExpr("max(length(value))").first()[0] < 40
    got = sorted((r["id"], r["t"]) for f in files for r in json.loads(f.value))
    assert got == [(i, f"a\n]{i}") for i in range(25)]


def test_mixed_json_deliveries_are_read_in_splits(spark, tmp):
    """The delivery reader: several tasks a file, numbers as they are written,
    records' files, one that does not parse as nulls."""
    from tidewater.sources import files
    landed(tmp, "a.json", "[" + ",\n".join('{"id": %d, "n": 1.50, "o": {"x": 12345678901234567890.10}}' % i for i in range(4000)) + "]")
    landed(tmp, "b.json", '{"id": 7, "t": "é"} {"id": 8, "n": }')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = files.read_json(spark, [f"{tmp}/a.json", f"{tmp}/b.json"])
        assert df.where("id IS NOT NULL").select("id").rdd.getNumPartitions() >= 3
        rows = [r.asDict(True) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    a = [r for r in rows if r["_source_path"].endswith("a.json")]
    assert sorted(int(r["id"]) for r in a) == list(range(4000))
    assert {(r["n"], r["o"]["x"]) for r in a} == {("1.50", "12345678901234567890.10")}
    b = [r for r in rows if r["_source_path"].endswith("b.json")]
    assert len(b) == 2 and any(r["id"] == "7" and r["t"] == "é" for r in b)

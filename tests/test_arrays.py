"""Manifests are read as a strict parser of the whole file reads them, however they are split."""

import json
import random
import tempfile
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from presswork.sources import arrays

SPLIT = "spark.sql.files.maxPartitionBytes"


def split(spark, folder, size):
    """The files read in pieces of size bytes; what follows is read as ever."""
    conf = {SPLIT: size, "spark.sql.files.openCostInBytes": 0, "spark.sql.files.minPartitionNum": 1} if size else {}
    names = spark.createDataFrame([(f,) for f in spark.read.text(str(folder)).inputFiles()], "path string")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        rows = arrays.fragments(spark, str(folder))
        assert not size or rows.rdd.getNumPartitions() > names.count()
        rows.coalesce(4).write.parquet(held := f"{tempfile.mkdtemp(prefix='spark-')}/rows")
    finally:
        for k in conf:
            spark.conf.unset(k)
    return arrays.objects(spark.read.parquet(held), names)


splits = pytest.mark.parametrize("size", [None, 16])


def strict(data: bytes):
    """The objects of a manifest by the whole file, or None."""
    try:
        found = json.loads(data.decode())
    except ValueError:
        return None
    return found if isinstance(found, list) and all(isinstance(x, dict) for x in found) else None


def check(spark, folder, files: dict[str, bytes], size):
    for name, data in files.items():
        (folder / name).write_bytes(data)
    got: dict[str, list] = {}
    for r in (split(spark, folder, size) if size else arrays.manifests(spark, str(folder))).collect():
        got.setdefault(unquote(r["path"]).rsplit("/", 1)[1], []).append((r["n"], r["item"], r["error"]))
    for name, data in files.items():
        want, rows = strict(data), sorted(got.get(name, []), key=lambda r: r[0] or 0)
        if want is None:
            assert len(rows) == 1 and rows[0][:2] == (None, None) and rows[0][2], (name, data, rows)
        else:
            assert [(n, json.loads(item)) for n, item, e in rows if not e] == list(enumerate(want)), (name, data, rows)


GOOD = [
    "[]", " [ ] \n", '[{}]', '[{},{}]', '\n[ {"a":1} ,\t{"a":2} ]\n', '[{"a":{"b":[{"c":[{}]}]}},{"d":"}"}]', r'[{"a":"\"}{[,]\\"},{"b":"{{{"},{"}":"\\\\\""}]',
    '[{"a":"é}ü{"},{"日本":"}"}]', r'[{"a":"😀"}]', '[{"a":[[],[1,2,{"x":null}],true,-1.5e3]}]', '[{"a":"' + "}{" * 50 + '"},{"b":' + '{"c":' * 30 + "1" + "}" * 30 + "}]",
    '[{"a":"' + r"\\" * 100 + '"},{"b":"' + r"\"" * 101 + '"}]', '[{"a":1,"a":2}]',
]
BAD = [
    "", " ", "[", "]", "{}", '{"a":[{}]}', '[{"a":1},]', '[,{"a":1}]', '[{"a":1}] x', "[1]", '[{"a":1},1]', "[[{}]]", '[{"a":1}', '[{"a":1', '[{"a":1},{"b":2', '[{"a":1}]}', '[{"a":1}]]',
    '[{"a":1}{"b":2}]', '[{"a":1},,{"b":2}]', '[{"a":1}]{"b":2', '[{"a":1}}]', '[{"a":1}}}},{"b":2}]', '[{"a":"x}]', '[{"a":1,}]', "[{'a':1}]", '[{a:1}]', '[{"a":[1}]', '[{"a":"\\}"}]',
    '[{"a":1}] [{"b":2}]', '[] []', '"[{}]"', '[{"a":tru}]', '[{}]\n}\n', '[null]', '[{"a":1}],', '[{"a":"x\ny"}]', '}', '}[{}]', '[{}', '[}', '\\[{}]', '[{}\\]',
]


@splits
def test_forms(spark, tmp_path, size):
    files = {f"g{i}.json": t.encode() for i, t in enumerate(GOOD)} | {f"b{i}.json": t.encode() for i, t in enumerate(BAD)}
    files |= {"latin.json": '[{"a":"é"}]'.encode("latin-1"), "bom.json": b"\xef\xbb\xbf[{}]", "a b%20é.json": b'[{"a":1}]', "a b%20é.empty": b""}
    check(spark, tmp_path, files, size)


@splits
def test_every_cut_of_a_file_is_refused(spark, tmp_path, size):
    whole = r'[{"a":"}\"{","b":{"c":[{}]}},{"d":"é"}] '.encode()
    check(spark, tmp_path, {f"c{i:02}.json": whole[:i] for i in range(len(whole) + 1)}, size)


@splits
def test_random_edits(spark, tmp_path, size):
    rng = random.Random(5)
    files = {}
    for i in range(40):
        value = [{rng.choice('ab{}"\\,[]é'): rng.choice(["x", '"', "\\", "}{", [{"q": {}}], {"r": "]"}, None, 1.5]) for _ in range(rng.randint(0, 3))} for _ in range(rng.randint(0, 4))]
        text = json.dumps(value, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        if i % 2:
            at = rng.randrange(len(text) + 1)
            text = text[:at] + rng.choice(["", "{", "}", '"', "\\", ",", "[", "]", " "]) + text[at + rng.randint(0, 1):]
        files[f"r{i:03}.json"] = text.encode()
    check(spark, tmp_path, files, size)


def test_compressed_files_are_refused(spark, tmp_path):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(b'[{"a":1}]'))
    assert [(r["item"], r["error"] is not None) for r in arrays.manifests(spark, str(tmp_path)).collect()] == [(None, True)]


def test_large_file_is_read_in_many_tasks(spark, tmp_path):
    """A file of 40 MB, whose objects begin in one piece and end in another."""
    spark.range(40_000).select(F.col("id"), F.repeat(F.lit('a "quoted" {brace} \\ '), 45).alias("text")).write.parquet(str(tmp_path / "given"))
    given = spark.read.parquet(str(tmp_path / "given"))
    arrays.write_manifests(given, str(tmp_path / "m"), F.lit("one"), ["id"])
    found = split(spark, tmp_path / "m", 1 << 20)
    got = found.select("n", F.from_json("item", "id long, text string").alias("x"), "error").select("n", "x.*", "error")
    both = got.join(given.withColumnRenamed("text", "given"), "id")
    assert both.where("text = given and n = id and error is null").count() == 40_000 == got.count()


def test_written_arrays_come_back(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i % 3 == 0 else f"t}}{i}\n") for i in range(20)], "id long, t string")
    arrays.write_manifests(rows, str(tmp_path / "w"), F.col("id") % 3, ["id"])
    assert len(list((tmp_path / "w").glob("file=*"))) == 3 and all(strict(p.read_bytes()) for p in (tmp_path / "w").glob("file=*/*.txt"))
    got = arrays.manifests(spark, str(tmp_path / "w")).select(F.from_json("item", "id long, t string").alias("x")).select("x.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.collect()))
    assert [r["n"] for r in arrays.manifests(spark, str(tmp_path / "w" / "file=0")).orderBy("n").collect()] == list(range(7))

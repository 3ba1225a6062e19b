import gzip
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import IllegalArgumentException
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from quillforge.operators import contamination as C
from quillforge.operators import lot as L
from quillforge.operators import suite
from quillforge.sources import readers, writers

ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def test_json_lines_digests(spark, tmp_path):
    df = spark.range(20).coalesce(1)
    plain, packed = writers.write_jsonl(df, str(tmp_path / "a")), writers.write_jsonl(df, str(tmp_path / "b"), "gzip")
    assert plain["path"].endswith("a.jsonl") and packed["path"].endswith("b.jsonl.gz")
    assert plain["rows_sha256"] == packed["rows_sha256"] == plain["stored_sha256"] != packed["stored_sha256"]
    (part,) = [p for p in os.listdir(packed["path"]) if p.endswith(".gz") and not p.startswith(".")]
    assert gzip.open(os.path.join(packed["path"], part)).read().count(b"\n") == 20
    try:
        assert writers.write_jsonl(df, str(tmp_path / "c"), "zstd")["rows_sha256"] == plain["rows_sha256"]
    except IllegalArgumentException as e:  # Hadoop's zstd for text comes with its native library only
        assert "zstd is not available" in str(e)


def test_row_groups(spark, tmp_path):
    writers.write_parquet(spark.range(12000).coalesce(1), str(tmp_path / "p"))
    (part,) = [p for p in os.listdir(tmp_path / "p") if p.endswith(".parquet")]
    meta = pq.ParquetFile(tmp_path / "p" / part).metadata
    assert max(meta.row_group(i).num_rows for i in range(meta.num_row_groups)) <= 5000 and meta.num_rows == 12000


def test_arrow_with_a_schema(spark, tmp_path):
    df = spark.range(12001).select("id", F.create_map(F.lit("k"), F.col("id")).alias("m"), F.array(F.struct(F.lit("x").alias("y"))).alias("s"))
    writers.write_arrow(df, str(tmp_path / "a.arrow"))
    t = pa.ipc.open_file(str(tmp_path / "a.arrow")).read_all()
    assert t.num_rows == 12001 and t["m"][7].as_py() == [("k", 7)] and t["s"][0].as_py() == [{"y": "x"}]
    writers.write_arrow(df, str(tmp_path / "b.arrow"), "none", StructType([StructField("id", StringType()), StructField("id2", LongType())][:1]))
    assert pa.ipc.open_file(str(tmp_path / "b.arrow")).read_all().schema.field("id").type in (pa.string(), pa.large_string())


def test_install_replaces_nothing(tmp_path):
    for k in "ab":
        (tmp_path / k).mkdir()
        (tmp_path / k / "f").write_text(k)
    writers.install(str(tmp_path / "a"), str(tmp_path / "final"))
    assert (tmp_path / "final/f").read_text() == "a" and (tmp_path / "final/f").stat().st_mode & 0o777 == 0o600 and (tmp_path / "final").stat().st_mode & 0o777 == 0o700
    with pytest.raises(FileExistsError):
        writers.install(str(tmp_path / "b"), str(tmp_path / "final"))
    assert (tmp_path / "final/f").read_text() == "a" and (tmp_path / "b/f").exists()
    os.symlink("f", tmp_path / "b/link")
    with pytest.raises(ValueError):
        writers.install(str(tmp_path / "b"), str(tmp_path / "other"))


def test_lot_reader(spark, tmp_path):
    with pytest.raises(readers.SourceError):
        readers.lot(spark, str(tmp_path))
    (tmp_path / "dataset").mkdir()
    (tmp_path / "manifest.json").write_text('{"product":"p"}')
    (tmp_path / "dataset/train.jsonl").write_text('{"a":1}\n{"a":2}\n'.replace("\\\n", "\n"))
    (tmp_path / "dataset/validation.jsonl").write_text("")
    body, tables = readers.lot(spark, str(tmp_path))
    assert body == {"product": "p"} and set(tables) == {"train"} and tables["train"].count() == 2


def test_items_of_any_shape(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    items = {"text": f'"{ITEM}"', "list": f'[{{"content":"{ITEM}"}},{{"content":"fine"}},"{ITEM}"]', "messages": f'{{"messages":[{{"reasoning_content":"{ITEM}"}}]}}', "events": f'{{"events":[{{"payload":{{"content":"{ITEM}"}}}}]}}', "turn": f'{{"text":"{ITEM}"}}', "raw": ITEM, "number": "7", "empty": "[]", "null": None}
    got = {r.id: r for r in C.check_dataset(spark.createDataFrame(list(items.items()), "id string, json string"), bench, "id").collect()}
    assert {k: r.n_hits for k, r in got.items()} == {"text": 3, "list": 6, "messages": 3, "events": 3, "turn": 3, "raw": 3, "number": 0, "empty": 0, "null": 0}
    assert got["list"].scanned_turns == 3 and got["list"].flagged_turns == 2


def test_gaps(spark):
    df = spark.createDataFrame([(["b", "a", None], ["c", "a"], None)], "x array<string>, y array<string>, z array<string>")
    assert df.select(suite.gaps(F.col("x"), F.col("y"), F.col("z"))).first()[0] == ["a", "b", "c"]
    res = spark.createDataFrame([("a", True, ""), ("b", False, "")], suite.CHECK)
    assert L.lot_gaps(res, ("a", "c")) == ["b", "c"] and L.lot_gaps(res.limit(0), ("a",)) == ["a"]


def picky(source):
    if source["ingot_id"] == "i1":
        raise RuntimeError("down")
    return {"disposition": {"i2": "REJECT", "i3": "YES"}.get(source["ingot_id"], "ACCEPT"), "ingot_id": "other" if source["ingot_id"] == "i4" else None, "reviewer_type": "panel"}


def test_reviews(spark):
    sources = spark.createDataFrame([(f"i{k}", "x") for k in range(6)], "ingot_id string, ingot_sha256 string")
    assert [r.disposition for r in L.review(sources, picky).orderBy("ingot_id").collect()] == ["ACCEPT", "HOLD", "REJECT", "HOLD", "HOLD", "ACCEPT"]
    failed = lambda reviews, **kw: {r.check for r in suite.run(L.review_checks(spark, sources, reviews, **kw)).where("not ok").collect()}
    assert failed(L.review(sources)) == {"review_accepts"} == failed(L.review(sources, picky))
    fixture = L.review(sources, L.accept_fixtures)
    assert failed(fixture, fixture_only=True) == set() and failed(fixture) == {"reviewer_scope"}
    assert failed(fixture, fixture_only=True, production=True) == {"review_mode"}
    assert failed(fixture.where("ingot_id <> 'i0'"), fixture_only=True) == {"review_accepts", "review_attributed"}

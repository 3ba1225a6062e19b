import json
import os

import pytest
from pyspark.sql import functions as F

from quillforge.operators import chat as M
from quillforge.operators import datacard as D
from quillforge.sources import readers, writers

EVENTS = [
    (1, 0, "scenario.init", json.dumps({"instruction": "", "text": "Be kind"})),
    (1, 1, "task.start", json.dumps({"prompt": "Add 1 and 2", "text": "other"})),
    (1, 2, "model.response", json.dumps({"content": "", "provider_reasoning": "use a tool", "tool_calls": [{"id": "c1", "type": "function", "function": {"name": "a\"dd", "arguments": "{}"}}]})),
    (1, 3, "broker.result", json.dumps({"output": "", "result": "3", "tool_call_id": "c1"})),
    (1, 4, "turn.assistant", json.dumps({"content": "3"})),
    (1, 5, "heartbeat", "{}"),
]


@pytest.fixture
def trace(spark):
    e = spark.createDataFrame(EVENTS, "conv_id long, turn long, event_type string, payload string")
    m = M.messages_from_events(e)
    return m.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "message"))), lambda x: x["message"]).alias("messages"))


def test_events_become_masked_messages(trace):
    m = trace.first().messages
    assert [(x.role, x.loss_weight) for x in m] == [("system", 0.0), ("user", 0.0), ("assistant", 1.0), ("tool", 0.0), ("assistant", 1.0)]
    assert m[1].content == "Add 1 and 2" and m[2].tool_calls[0].name == 'a"dd' and m[3].tool_call_id == "c1"


def test_every_event_type(spark):
    types = ["scenario.init", "system.prompt", "user.input", "task.start", "model.response", "turn.assistant", "tool.result", "broker.result", "exec.result", "user_message", None]
    rows = [(i, t if i % 2 else None, t, json.dumps({"text": "t", "content": "c", "result": {"a": [1]}})) for i, t in enumerate(types)]
    got = M.messages_from_events(spark.createDataFrame(rows, "i int, type string, name string, data string")).orderBy("i").collect()
    assert [(r.message.role, r.message.content) for r in got] == [("system", "t")] * 2 + [("user", "t")] * 2 + [("assistant", "c")] * 2 + [("tool", '{"a":[1]}')] * 3


def test_turn_pairs(trace):
    c = M.formatted(trace, "sharegpt").first().conversations
    assert [x["from"] for x in c] == ["system", "human", "gpt", "tool", "gpt"]
    assert c[2].value == '<think>\nuse a tool\n</think>\n\n<tool_call>\n{"name":"a\\"dd","arguments":"{}"}\n</tool_call>'


def test_blocks(spark, trace):
    r = M.formatted(trace, "block").first().record
    assert r.system == "Be kind" and [m.role for m in r.messages] == ["user", "assistant", "user", "assistant"]
    assert [b.type for b in r.messages[1].content] == ["thinking", "tool_use"] and r.messages[2].content[0].type == "tool_result"
    two = spark.sql("select array(named_struct('role','user','content','q'), named_struct('role','tool','content','1'), named_struct('role','tool','content','2')) as t").select(F.transform("t", lambda x: M.message(x["role"], x["content"])).alias("messages"))
    out = M.formatted(two, "anthropic").first().record.messages
    assert len(out) == 1 and [b.type for b in out[0].content] == ["text", "tool_result", "tool_result"]


def test_unknown_format(trace):
    assert "data" in M.formatted(trace, "other").columns


def test_given_weight_stays(spark):
    r = spark.createDataFrame([("assistant", 0.5), ("assistant", None), ("user", 1.0)], "role string, w double").select(M.loss_weight(F.col("role"), F.col("w"))).collect()
    assert [x[0] for x in r] == [0.5, 1.0, 1.0]


def test_recipe_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert M.recipe_rows(df, ("b", "a")).columns == ["b", "a"]
    with pytest.raises(ValueError):
        M.recipe_rows(df, ("a",))


def test_shards_are_dense(spark):
    df = spark.range(103).select("id", F.when(F.col("id") % 3 == 0, "validation").otherwise("train").alias("split"))
    out = M.shards(df, ["id"], "split", 10)
    got = {s: sorted(r.row_index for r in out.where(F.col("split") == s).collect()) for s in ("train", "validation")}
    assert got == {"train": list(range(68)), "validation": list(range(35))}
    assert out.where("file = 'validation-00003'").count() == 5


def test_token_statistics(spark):
    turns = spark.createDataFrame([(1, "user", "a b c"), (1, "assistant", "<think>x y</think> done"), (1, "tool", "r"), (2, "user", None)], "conv_id long, role string, text string")
    r = D.token_statistics(D.record_counts(turns)).first()
    assert (r.n_records, r.prompt_tokens_total, r.prompt_tokens_mean, r.reasoning_tokens_max, r.tool_turns_total) == (2, 3, 1.5, 2, 1)
    none = D.token_statistics(D.record_counts(turns.limit(0))).first()
    assert none.n_records == 0 and none.prompt_tokens_mean == 0.0


def test_card(spark, tmp_path):
    turns = spark.createDataFrame([(1, "user", "a b c")], "conv_id long, role string, text string")
    tags = D.taxonomy(spark.createDataFrame([("x",), (None,)], "t string"), topic="t")
    card = D.build_card("demo", D.token_statistics(D.record_counts(turns)), tags, {"lot": "0" * 64})
    D.write_card(card, str(tmp_path))
    assert card["taxonomy"] == ["topic:x"] and "## Uses" in (tmp_path / "datacard.md").read_text()


def test_card_says_where_its_taxonomy_is_cut(spark, tmp_path):
    turns = spark.createDataFrame([(1, "user", "a b c")], "conv_id long, role string, text string")
    tags = D.taxonomy(spark.createDataFrame([(f"x{i}",) for i in range(1200)], "t string"), topic="t")
    card = D.build_card("demo", D.token_statistics(D.record_counts(turns)), tags)
    assert len(card["taxonomy"]) == 1000 and card["n_tags"] == 1200
    with pytest.raises(ValueError):
        D.write_card(card, str(tmp_path))
    D.write_card(card, str(tmp_path), tags, f"{tmp_path}/tags")
    assert spark.read.parquet(f"{tmp_path}/tags").count() == 1200 and "The first 1000 of 1200 tags." in (tmp_path / "datacard.md").read_text()


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip_and_tampering(spark, tmp_path, compression):
    df = spark.createDataFrame([(1, "a\nb"), (2, None)], "id long, t string")
    out = str(tmp_path / "out")
    writers.write_jsonl(df, f"{out}/rows", compression)
    writers.write_parquet(df, f"{out}/table")
    writers.write_arrow(df, f"{out}/one.arrow")
    body = writers.seal(spark, out, "2020-01-01T00:00:00Z")
    assert writers.verify(out) == [] and body["n_files"] >= 3
    assert sorted(map(tuple, readers.partition(spark, f"{out}/rows").select("id", "t").collect())) == [(1, "a\nb"), (2, None)]
    assert readers.partition(spark, f"{out}/one.arrow").count() == 2
    victim = os.path.join(out, body["entries"][0]["path"])
    with open(victim, "ab") as f:
        f.write(b"x")
    assert writers.verify(out) == [f"changed: {body['entries'][0]['path']}"]


def test_zstd_lines(spark, tmp_path):
    import zstandard

    p = tmp_path / "a.jsonl.zst"
    p.write_bytes(zstandard.compress(b'{"a": 1, "b": "x"}\n{"a": 2, "b": "y"}\n'))
    assert sorted(map(tuple, readers.partition(spark, str(p)).select("a", "b").collect())) == [(1, "x"), (2, "y")]


def test_readers(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text('{"a":1}\nplain\n\n')
    assert [(r.is_json, r.value) for r in readers.jsonl_or_text(spark, str(tmp_path / "s.jsonl")).collect()] == [(True, '{"a":1}'), (False, "plain"), (False, "")]
    (tmp_path / "l.json").write_text('["p", {"prompt": "q"}]')
    (tmp_path / "o.json").write_text('{"seeds": [{"prompt": "r"}]}')
    got = readers.seeds(spark, [str(tmp_path / x) for x in ("l.json", "gone.json", "o.json")]).orderBy("raw_index").collect()
    assert [json.loads(r.json)["prompt"] for r in got] == ["p", "q", "r"] and got[2].source == "o.json"
    with pytest.raises(readers.SourceError, match="line 2"):
        readers.events(spark, str(tmp_path / "s.jsonl"), "a int")
    assert readers.events(spark, str(tmp_path / "none"), "a int", strict=False).count() == 0
    (tmp_path / "c.jsonl").write_text('{"a":1,"b":2}\n')
    assert readers.canonical_jsonl(spark, str(tmp_path / "c.jsonl")).count() == 1
    (tmp_path / "d.jsonl").write_text('{"b":2,"a":1}\n')
    with pytest.raises(readers.SourceError):
        readers.canonical_jsonl(spark, str(tmp_path / "d.jsonl"))


def test_typed_rows_are_numbered_in_order(spark):
    df = spark.range(50).repartition(5).select("id", F.array(F.struct(F.lit("user").alias("role"), F.lit(None).cast("string").alias("content"), F.lit(None).cast("string").alias("reasoning"), F.lit(None).cast(M.TOOL_CALLS).alias("tool_calls"), F.lit(None).cast("string").alias("tool_call_id"), F.lit(None).cast("string").alias("name"), F.lit(0.0).alias("loss_weight"))).alias("messages"))
    got = {r.metadata_json: (r.id, r.split) for r in M.typed_rows(df, ["id"]).collect()}
    assert got == {f'{{"id":{k}}}': (f"row_{k:07d}", "train") for k in range(50)}

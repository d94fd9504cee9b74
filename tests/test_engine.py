"""Operators on hand-made rows: cases that the driver's tables don't hold."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark import queries, schemas
from loomspark.functions import jsonx, text
from loomspark.operators import asof, budget, glossary, index, linearize, pack, render, rollup, turns
from loomspark.plans import prompts, providers
from loomspark.plans.config import Config
from loomspark.plans.pipeline import Pipeline
from loomspark.sources import json_ranges, readers, writers

from .oracle import differ


def value(spark, column, *args):
    return spark.range(1).select(column.alias("v")).first().v


def message(role, parts=None, ct="text", **more):
    return {"author": {"role": role}, "content": {"content_type": ct, "parts": parts or [], **more.pop("content", {})}, "metadata": more.pop("metadata", {}), **more}


def conversation(cid, nodes, current=None, **more):
    mapping = {i: {"id": i, "parent": p, "children": c, "message": m} for i, p, c, m in nodes}
    return {"conversation_id": cid, "title": f"T {cid}", "create_time": 1707142860.0, "mapping": mapping, "current_node": current, **more}


def chain(cid, *messages):
    ids = [f"{cid}{i}" for i in range(len(messages))]
    return conversation(cid, [(x, ids[i - 1] if i else None, [ids[i + 1]] if i + 1 < len(ids) else [], m) for i, (x, m) in enumerate(zip(ids, messages, strict=True))], ids[-1])


@pytest.fixture
def archive(tmp_path):
    rows = [
        chain("c1", None, message("system", [""], metadata={"is_visually_hidden_from_conversation": True}), message("user", ["hi"]), message("assistant", ["hello", 5, {"a": 1}, "there remarkable"])),
        chain("dup", message("user", ["a"]), message("tool", ct="tether_quote", content={"text": "quoted", "title": " t ", "url": "http://x", "domain": "x"})),
        chain("dup", message("user", ["b"]), message("tool", [{"x": 1}], ct="image")),
        conversation("cyc", [("a", "b", ["b"], message("user", ["x"])), ("b", "a", ["a"], message("user", ["y"]))], "a"),
        conversation("gone", [("a", "nowhere", [], message("user", ["x"]))], "a"),
        conversation("leafless", [("r", None, ["p", "q"], None), ("p", "r", [], message("user", ["old"], create_time=5.0)), ("q", "r", [], message("user", ["new"], create_time=9.0))]),
        conversation("empty", []),
        {"title": "no id", "mapping": {}},
        chain("sys", message("system", [""], metadata={"is_visually_hidden_from_conversation": "true"}), message("user", ["z"], ct=7)),
    ]
    path = tmp_path / "conversations.json"
    path.write_text(json.dumps(rows))
    (tmp_path / "wrapped.json").write_text(json.dumps({"n": 1, "conversations": rows[:2], "later": [1]}, indent=1))
    return path


def test_threads_of_an_archive(spark, archive):
    found = linearize.threads(readers.archive(spark, str(archive)))
    rows = found.collect()
    by = {r.conversation_id: r for r in rows if r.err is None}
    assert [(m.role, m.text) for m in by["c1"].messages] == [("user", "hi"), ("assistant", "hello\nthere remarkable")]
    quoted = next(r for r in rows if r.conversation_id == "dup" and len(r.messages) == 2).messages[1]
    assert (quoted.role, quoted.text, quoted.title, quoted.url, quoted.domain, quoted.content_type) == ("tool", "quoted", "t", "http://x", "x", "tether_quote")
    assert sum(len(r.messages) for r in rows if r.conversation_id == "dup") == 3
    assert [m.text for m in by["leafless"].messages] == ["new"] and by["empty"].messages is None
    assert [m.content_type for m in by["sys"].messages] == ["text"]
    assert {(r.conversation_id, r.err) for r in linearize.quarantine(found).collect()} == {("cyc", "cycle"), ("gone", "missing node"), (None, "no id")}
    with pytest.raises(Exception, match="bad conversation"):
        linearize.good(found, strict=True).collect()


def test_wrapped_archives(spark, archive):
    path = str(archive.parent / "wrapped.json")
    assert {r.conversation_id for r in readers.archive(spark, path).collect()} == {"c1", "dup"}
    assert readers.archive(spark, path, "conversations").count() == 2
    (archive.parent / "none.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="no array"):
        readers.archive(spark, str(archive.parent / "none.json")).collect()


@pytest.mark.parametrize("size", [300, 1 << 20])
def test_ranges_of_a_document_give_its_elements(spark, tmp_path, size):
    """Wherever a range begins: in strings with brackets, behind escapes, between and inside elements."""
    odd = ['}', '{', '"', '\\\\', '\\\\"}', '}]', 'a}b{c', '\\n}', '\u00e9\U0001f642}', ' ]} , {"x": [1]} ']
    values = [{"id": str(i), "t": odd[i % len(odd)] * (i % 4), "n": [{"deep": [{}, [], {"}": odd[-i % len(odd)]}]}] * (i % 3)} for i in range(40)]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(values, indent=1), encoding="utf-8")
    (folder / "b.json").write_text(" \n" + json.dumps({"x": {"conversations": [{"no": 1}]}, "s": "[{", "q}": [[{}], 5, None, {"id": "q"}], "conversations": values[:9], "z": [{"z": 1}]}, ensure_ascii=False) + ' [{"behind": 1}]', encoding="utf-8")
    for field, want in ((None, [[], {"id": "q"}]), ("conversations", values[:9])):
        found = json_ranges.elements(spark, str(folder), field, size).collect()
        own = {n: [json.loads(r.value) for r in sorted(found, key=lambda r: r.place) if r.file.endswith(n)] for n in ("a.json", "b.json")}
        assert own["a.json"] == values
        assert own["b.json"] == ([[{}], {"id": "q"}] if field is None else want)
    with pytest.raises(ValueError, match="no array"):
        json_ranges.elements(spark, str(folder), "absent", size)


def thread_rows(spark, *messages):
    names = schemas.names(schemas.MESSAGE)
    made = [tuple({"role": r, "text": t, "name": "", "content_type": "", "domain": "", "title": "", "url": "", "create_time": float(i)}[n] for n in names) for i, (r, t) in enumerate(messages)]
    return spark.createDataFrame([("c", "T", None, None, made)], schemas.THREAD)


def test_turns_without_user_and_before_the_first(spark):
    t = turns.turns(linearize.messages(thread_rows(spark, ("system", "s"), ("assistant", "x")))).collect()
    assert [(r.turn_index, r.start_message_idx, r.end_message_idx, r.user_text, r.assistant_text) for r in t] == [(0, 0, 1, "", "s\nx")]
    t = turns.turns(linearize.messages(thread_rows(spark, ("system", "s"), ("user", " u "), ("assistant", " "), ("user", "v")))).orderBy("turn_index").collect()
    assert [(r.turn_index, r.start_message_idx, r.end_message_idx, r.user_text, r.assistant_text) for r in t] == [(0, 1, 2, "u", ""), (1, 3, 3, "v", "")]
    assert turns.chunks(thread_rows(spark), 2).count() == 0


def test_chunks_and_their_paths(spark):
    rows = thread_rows(spark, *[(r, str(i)) for i in range(3) for r in ("user", "assistant")])
    decided = spark.createDataFrame([("c", [2, 2, 0, 9])], "conversation_id string, breakpoints array<int>")
    made = turns.chunks(rows, 20, decided).withColumn("p", turns.chunk_path(F.lit("x"))).orderBy("chunk_number").collect()
    assert [(r.turn_start, r.turn_end, len(r.messages), r.p) for r in made] == [(0, 2, 4, "x/thread_1.json"), (2, 3, 2, "x/thread_2.json")]
    assert [r.turn_end for r in turns.chunks(rows, 2).orderBy("chunk_number").collect()] == [2, 3]


def test_text_functions(spark):
    v = lambda c: value(spark, c)
    assert v(text.truncate_bytes(F.lit(" aé€x "), 3)) == "aé…" and v(text.truncate_bytes(F.lit("aé€x"), 5)) == "aé…" and v(text.truncate_bytes(F.lit("ab"), 0)) == "ab"
    assert v(text.iso8601(F.lit(1735689600.0))) == "2025-01-01T00:00:00Z" and v(text.iso8601(F.lit(0.0))) == "" and v(text.iso8601(F.lit(None).cast("double"))) == ""
    assert v(text.fixed3(F.lit(1735689600.0))) == "1735689600.000" and v(text.fixed3(F.lit(1.9996))) == "2.000" and v(text.fixed3(F.lit(-0.25))) == "-0.250"
    assert v(text.unix_stamp(F.lit(1707142860.9))) == "1707142860" and v(text.unix_stamp(F.lit(-1.0))) == ""
    assert v(text.file_component(F.lit("  ../weird id: 123  "))) == "weird_id__123" and v(text.file_component(F.lit(" .. "))) == ""
    assert v(text.anchor(F.lit(" \t"))) == "thread" and v(text.anchor(F.lit("A b/É!"))) == "a-b"
    assert v(text.distinct_strings(F.array(F.lit("Foo"), F.lit("foo"), F.lit("  "), F.lit(" Bar")))) == ["Foo", "Bar"]


def test_json_decoding(spark):
    ok, st = (lambda s: value(spark, jsonx.lenient_object(F.lit(s)))), (lambda s: value(spark, jsonx.decode_status(F.lit(s))))
    assert json.loads(ok('here you go:\n\n{"a": 2}\n')) == {"a": 2} and ok("no") is None
    assert (st('{"a": 1'), st(""), st("x"), st('{"a":1}')) == ("truncated", "empty", "invalid", "ok")
    assert json.loads(value(spark, jsonx.lenient_array(F.lit("prefix [1,2,3] suffix")))) == [1, 2, 3]
    assert value(spark, jsonx.error_class(F.lit("HTTP 429"))) == "rate_limit" and value(spark, jsonx.error_class(F.lit("503 Service Unavailable"))) == "server"
    closed = schemas.response_schema("a string, b array<struct<c:int>>")
    assert closed["required"] == ["a", "b"] and closed["properties"]["b"]["items"]["additionalProperties"] is False


def test_glossary_merge_with_prior(spark):
    prior = spark.createDataFrame([("Vix", "short", 2, None, None)], schemas.GLOSSARY_ENTRY)
    new = spark.createDataFrame([(1, 123.0, 0, " vix ", "a longer one"), (1, 123.0, 1, "Sparky", ""), (1, 123.0, 2, "sparky", "dup"), (1, 123.0, 3, " ", "x"), (2, None, 0, "VIX", "same length")], schemas.GLOSSARY_ADDITION)
    got = {r.term: tuple(r)[1:] for r in glossary.merge(new, prior).collect()}
    assert got == {"Vix": ("a longer one", 4, 123.0, None), "Sparky": ("", 1, 123.0, 123.0)}
    assert [r.term for r in glossary.cull(glossary.merge(new, prior), 2).collect()] == ["Vix"]
    assert glossary.excerpt(glossary.merge(new, prior), 0).first()[0] == "" and glossary.excerpt(glossary.merge(new, prior), 5).first()[0] == "- Vix: a longer one\n"


@pytest.mark.parametrize("most", [50, 300, 5000])
def test_next_fit_equals_a_fold(spark, most):
    rng = random.Random(most)
    sizes = [(i, rng.choice((0, 1, 20, 90, 400))) for i in range(300)]
    rows = spark.createDataFrame(sizes, "i int, b int").repartition(7)
    got = {r.i: r.shard_no for r in pack.next_fit(rows, "b", ["i"], most, 21).collect()}
    assert [got[i] for i in range(300)] == pack.fold_pack((b for _, b in sizes), most, 21)
    assert pack.next_fit(rows.limit(0), "b", ["i"], most, 21).count() == 0


@pytest.mark.parametrize("header", [0, 21])
def test_exit_tables_compose(header):
    rng = random.Random(header)
    for most in (30, 100, 1000):
        sizes = [rng.choice((0, 0, 1, 7, 20, 45, 120)) for _ in range(600)]
        cuts = [0, *sorted(rng.sample(range(1, 600), 40)), 600]
        tables = []
        for i, j in zip(cuts, cuts[1:]):
            own = np.array(sizes[i:j])
            tables.append(pack._exits(own, most, header) | {"total": np.full(j - i, own.sum())})
        while len(tables) > 1:
            tables = [pack._then(*tables[i : i + 2], most) if i + 1 < len(tables) else tables[i] for i in range(0, len(tables), 2)]
        own, n = tables[0], len(tables[0]["upto"])
        assert (np.diff(own["upto"]) > 0).all() and n <= most + 2
        for state in (pack.NONE, 0, 1, most // 2, most - 1, most, most + 5):
            now, number = state, 0
            for b in sizes:
                if now == pack.NONE or now + b > most:
                    now, number = header, number + 1
                now += b
            assert pack._after(own, most, state, 0) == (now, number)


def test_next_fit_by_a_tree_of_tasks(spark, monkeypatch):
    monkeypatch.setattr(pack, "ROWS", 7)
    rng = random.Random(5)
    sizes = [(i, rng.choice((0, 1, 20, 90, 400)), "text" * i) for i in range(2000)]
    rows = spark.createDataFrame(sizes, "i int, b int, task string").repartition(3)
    packed = pack.next_fit(rows, "b", ["i"], 500, 21)
    got = {r.i: (r.shard_no, r.task) for r in packed.collect()}
    want = pack.fold_pack((b for _, b, _ in sizes), 500, 21)
    assert got == {i: (want[i], t) for i, _, t in sizes}
    plan = packed.select("i", "shard_no")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<i:int,__row:bigint>" in plan and "task:string" not in plan


def test_as_of_equals_a_search(spark, monkeypatch):
    """One key with half of the rows, over ranges of few rows: the last value is carried across them."""
    monkeypatch.setattr(asof, "ROWS", 40)
    rng = random.Random(3)
    key = lambda: rng.choice(("hot", "hot", "a", "b", "c", None))
    left = [(i, key(), rng.choice((None, *range(60)))) for i in range(400)] + [(i, "hot", 1000 + i) for i in range(400, 700)]
    right = [(key(), rng.choice((None, *range(60))), rng.choice((None, "x", "y", "z"))) for _ in range(60)] + [("late", 0, "q")]
    l, r = spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, t int, v string")
    for strict in (False, True):
        got = {x.i: (x.k, x.t, x.found_t, x.v) for x in asof.as_of(l, r, ["k"], "t", "t", ["v"], strict, found="found_t").collect()}
        for i, k, t in left:
            own = [(b, v or "", v) for a, b, v in right if None not in (a, b, k, t) and a == k and (b < t or b == t and not strict)]
            assert got[i] == (k, t, *((max(own)[0], max(own)[2]) if own else (None, None)))
        assert len(got) == 700
    assert [tuple(x) for x in asof.as_of(l.limit(3), r.limit(0), ["k"], "t", "t", ["v"]).select("v").collect()] == [(None,)] * 3
    assert asof.as_of(l.limit(0), r, ["k"], "t", "t", ["v"]).columns == ["i", "k", "t", "v"] and asof.as_of(l.limit(0), r, ["k"], "t", "t", ["v"]).count() == 0


def test_rendered_head(spark):
    rows = spark.createDataFrame([("c 1", " ", 1735689600.0, " s ", [" "], ["Foo", "foo"], [])], schemas.THREAD_SUMMARY)
    want = '<a id="thread-c-1"></a>\n## c 1\n\n- conversation_id: `c 1`\n- thread_start_time: `1735689600.000` (`2025-01-01T00:00:00Z`)\n\ns\n\n### Key points\n\n**tags**: Foo\n\n\n---\n\n'
    assert rows.select(render.thread_section().alias("s")).first().s == want


def test_budget_marks_what_is_cut(spark):
    rows = spark.createDataFrame([("a", 0, "xx"), ("a", 1, "yy"), ("a", 2, "z"), ("b", 0, "xx")], "c string, i int, t string")
    got = {r.c: r.p for r in budget.prefix_text(rows, ["c"], ["i"], F.col("t"), 3, "...", "p").collect()}
    assert got == {"a": "xx...", "b": "xx"}


def test_transcript_without_tool_text(spark):
    m = spark.createDataFrame([("tool", "web", None, "quote", "long text", "", "T", "u"), ("", "", None, "code", " ", "", "", "")], schemas.MESSAGE)
    assert sorted(r.s for r in m.select(prompts.transcript_line(False).alias("s")).collect()) == ["- tool:web: [tool web quote T u\n", "- unknown: [code]\n"]


def test_large_breakpoint_requests_drop_texts(spark):
    rows = thread_rows(spark, *[("user", "text")] * 251)
    r = prompts.breakpoint_requests(turns.turns(linearize.messages(rows)), rows, 20).first().request
    assert "text" not in r and json.loads(r)["total_turns"] == 251


def test_providers_retry_and_fall_back(spark):
    tries, waits = [], []

    def call(_, prompt):
        tries.append(prompt)
        if len(tries) < 3:
            raise RuntimeError("429 slow down")
        return "{}"

    assert providers.scheduled([lambda: call("", "p")], 1, (providers.RATE_LIMIT_WAITS, providers.SERVER_WAITS), waits.append) == [("{}", None)] and [round(w) for w in waits] == [65, 100]
    bad = lambda *_: (_ for _ in ()).throw(ValueError("no"))
    assert providers.scheduled([bad], 1, ((1, 2), (3, 4)), waits.append) == [(None, "no")] and len(waits) == 2
    asked = spark.createDataFrame([("a", "long"), ("b", "short")], "conversation_id string, prompt string")
    small = asked.withColumn("prompt", F.lit("small"))
    got = providers.ask_with_fallback(providers.CallableProvider(lambda i, p: '{"k": 1' if p == "long" else f'{{"k": {len(p)}}}', 2), asked, small, ["conversation_id"], "k int", "x").collect()
    assert {(r.conversation_id, r.k, r.status) for r in got} == {("a", 5, "ok"), ("b", 5, "ok")}


def test_sentiment_index_keeps_repeats(spark):
    chunks = spark.createDataFrame([("p", "cp", "c", None, 1, 0, 2)], "rel_path string, chunk_path string, " + schemas.CHUNK_KEYS)
    s = spark.createDataFrame([("p", "sp", " e ", ["Joy", "joy"], None, [], [], " r ", "", ["a"] * 9, [], "", [])], "rel_path string, sentiment_summary_path string, " + schemas.SENTIMENT_PAYLOAD)
    r = index.chunk_sentiment_index(chunks, s).first()
    assert (r.emotional_summary, r.dominant_emotions, r.remembered_emotions, r.themes, r.relational_shift) == ("e", ["Joy", "joy"], None, ["a"] * 5, "r")


def test_group_orders_and_drops_nameless(spark):
    rows = spark.createDataFrame([("c1", 100.0, 2, 0, 1, "b"), ("c1", 50.0, 1, 0, 1, "a"), ("", 1.0, 1, 0, 1, "x"), ("c2", None, 1, 0, 1, "z")], schemas.CHUNK_KEYS + ", summary string")
    got = {r.conversation_id: ([c.summary for c in r.chunks], r.thread_start_time) for r in rollup.grouped(rows).collect()}
    assert got == {"c1": (["a", "b"], 50.0), "c2": (["z"], None)}


def test_config():
    for bad in ({"archive": ""}, {"target_turns": 0}, {"max_shard_bytes": -1}, {"batch_size": -1}, {"only_stage": "x"}, {"only_stage": "pack", "from_stage": "pack"}):
        with pytest.raises(ValueError):
            Config(**({"archive": "a", "base_dir": "b"} | bad)).validate()
    assert Config("a", "b", from_stage="rollup").stages() == ["rollup", "pack"] and len(Config("a", "b", from_stage="?").stages()) == 5


def test_pipeline_end_to_end_and_resume(spark, archive, tmp_path):
    c = Config(str(archive), str(tmp_path / "out"), target_turns=1, glossary_min_count=1, batch_size=2, max_chunks_per_thread=1, max_shard_bytes=600)
    p = Pipeline(spark, c)
    assert p.run() == ["split", "chunk", "summarize", "rollup", "pack"]
    assert p.table("quarantine").count() == 3
    names = sorted(r.file_name for r in p.table("threads").collect())
    assert names == ["c1", "dup", "dup-2", "empty", "leafless", "sys"]
    chunks = p.table("chunks").count()
    assert p.table("summaries").count() == p.table("sentiments").count() == chunks
    ids = {r.conversation_id for r in p.table("thread_summaries").collect()}
    assert ids == {"c1", "dup", "leafless", "sys"} == {r.conversation_id for r in p.table("packed").collect()}
    lines = [json.loads(r.value) for r in spark.read.text(p.path("index/memory")).collect()]
    assert {x["conversation_id"] for x in lines} == ids and all(x["anchor"] == "thread-" + x["conversation_id"] for x in lines)
    shards = spark.read.text(p.path("memory"), wholetext=True).collect()
    assert all(r.value.startswith("# Memory Shard 0") for r in shards) and sum(r.value.count("<a id=") for r in shards) == len(ids)
    assert readers.glossary(spark, p.path("glossary.json")).count() > 0 and readers.glossary(spark, p.path("nothing")).count() == 0
    assert Pipeline(spark, c).run() == []
    assert p.stats()["threads"] == 6 and p.stats()["text_bytes"] > 0
    p.export(str(tmp_path / "files"))
    back = readers.chunks(spark, str(tmp_path / "files" / "chunks"))
    assert back.count() == chunks and {r.conversation_id for r in back.collect()} == ids


def test_command_line():
    from loomspark.__main__ import parse

    c = parse(["--archive", "a", "--base-dir", "b", "--target-turns", "7", "--no-resume", "--only-stage", "pack"])
    assert (c.target_turns, c.resume, c.stages()) == (7, False, ["pack"])
    with pytest.raises(SystemExit) as e:
        parse(["--archive", "a", "--base-dir", "b", "--only-stage", "nothing"])
    assert e.value.code == 2


def test_file_readers_by_suffix(spark, tmp_path):
    for name in ("a/x.summary.json", "a/x.sentiment.summary.json", "a/x.json", "summaries/y.json", "a/y.json"):
        f = tmp_path / name
        f.parent.mkdir(exist_ok=True)
        f.write_text(json.dumps({"conversation_id": "c" if name != "a/y.json" else "", "chunk_number": 1, "summary": name}))
    assert [r.summary for r in readers.summaries(spark, str(tmp_path)).collect()] == ["a/x.summary.json"]
    assert readers.sentiments(spark, str(tmp_path)).count() == 1
    assert [r.rel_path for r in readers.chunks(spark, str(tmp_path)).collect()] == ["a/x.json"]
    assert writers.copy_if_exists(spark, str(tmp_path / "a/x.json"), str(tmp_path / "z.json")) and not writers.copy_if_exists(spark, str(tmp_path / "a/x.json"), str(tmp_path / "z.json"))
    assert not writers.copy_if_exists(spark, str(tmp_path / "missing"), str(tmp_path / "q"))
    (tmp_path / "h.txt").write_text("  \n")
    with pytest.raises(ValueError):
        readers.prompt_header(spark, str(tmp_path / "h.txt"))


def test_glossary_stream(spark, tmp_path):
    from loomspark.streaming import incremental

    folder = tmp_path / "in"
    for i in range(2):
        spark.createDataFrame([(i, float(i), 0, "Term", "d" * (i + 1))], incremental.ADDITIONS).coalesce(1).write.mode("append").parquet(str(folder))
        q = incremental.glossary_stream(incremental.additions_stream(spark, str(folder)), str(tmp_path / "g"), str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(60)
    r = spark.read.parquet(str(tmp_path / "g/v=1")).collect()
    assert [tuple(x) for x in r] == [("Term", "dd", 2, 0.0, 1.0)]


def test_activity_stream(spark, tmp_path):
    from loomspark.streaming import incremental

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "e"))
    live = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    q = incremental.activity_stream(live).writeStream.format("memory").queryName("activity").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("activity").agg(F.sum("n")).first()[0] == events.count()


class Scripted:
    """A provider that answers by a function of the request, and counts how often it is asked."""

    def __init__(self, answer, log):
        self.answer, self.log = answer, log

    def complete(self, requests):
        rows = [(r.request_id, *self.answer(r)) for r in requests.collect()]
        self.log.extend(r.asDict() for r in requests.collect())
        return requests.sparkSession.createDataFrame(rows, providers.ANSWER)


SUMMARY = json.dumps({"summary": "s", "key_points": ["k"], "tags": ["t"], "terms": ["m"], "emotional_summary": "e", "dominant_emotions": ["joy"], "remembered_emotions": [], "present_emotions": [], "emotional_tensions": [], "relational_shift": "", "emotional_arc": "", "themes": ["x"], "symbols_or_metaphors": [], "resonance_notes": "", "tone_markers": []})


@pytest.fixture
def talks(tmp_path):
    rows = [chain(c, *(message(r, [f"{c} {i} {r}"]) for i in range(n) for r in ("user", "assistant"))) for c, n in (("a", 4), ("b", 1), ("long", 6))]
    path = tmp_path / "talks.json"
    path.write_text(json.dumps(rows))
    return path


def test_breakpoint_models(spark, talks, tmp_path):
    from loomspark.plans import deciders

    def answer(r):
        assert json.loads(r.schema)["properties"]["breakpoints"]["items"]["type"] == "integer" and r.max_tokens == 1500
        asked = json.loads(r.prompt)
        if asked["conversation_id"] == "long":
            return None, "HTTP 500"
        return ('{"breakpoints": [1, 9, 1]}' if asked["conversation_id"] == "a" else '{"breakpo'), None

    log = []
    p = Pipeline(spark, Config(str(talks), str(tmp_path / "m"), target_turns=3), decider=deciders.ModelDecider(Scripted(answer, log)))
    assert p.split() and p.chunk() and len(log) == 3
    made = {}
    for r in p.table("chunks").orderBy("conversation_id", "chunk_number").collect():
        made.setdefault(r.conversation_id, []).append((r.turn_start, r.turn_end))
    assert made == {"a": [(0, 1), (1, 4)], "b": [(0, 1)]}
    assert [(r.stage, r.status) for r in p.table("errors").collect()] == [("chunk", "error: HTTP 500")]
    # the thread without a decision is asked for again
    p = Pipeline(spark, p.c, decider=deciders.FunctionDecider(lambda t, n: t.groupBy("conversation_id").agg(F.array(F.lit(2), F.max("turn_index")).alias("breakpoints"))))
    assert p.chunk() and not p.chunk()
    assert [(r.turn_start, r.turn_end) for r in p.table("chunks").filter("conversation_id = 'long'").orderBy("chunk_number").collect()] == [(0, 2), (2, 5), (5, 6)]


def test_second_tries_errors_and_partial_resume(spark, talks, tmp_path):
    """A thread of which a part fails isn't merged; the next run asks for that part alone."""
    log, broken = [], {"on": True}

    def answer(r):
        if "part=" in r.prompt and "partial_rollups=" in r.prompt:
            return (SUMMARY if r.max_tokens == 4500 else SUMMARY[:-9]), None
        if broken["on"] and "chunks=1" in r.prompt and "conversation_id=long" in r.prompt and "turn_range=4..6" in r.prompt:
            return None, "HTTP 400 no"
        return SUMMARY, None

    c = Config(str(talks), str(tmp_path / "r"), target_turns=2, max_chunks_per_thread=1, glossary_min_count=1)
    p = Pipeline(spark, c, Scripted(answer, log))
    for stage in ("split", "chunk", "summarize"):
        assert getattr(p, stage)()
    log.clear()
    assert p.rollup()
    assert {r.conversation_id for r in p.table("thread_summaries").collect()} == {"a", "b"}
    merges = [r for r in log if "partial_rollups=" in r["prompt"]]
    assert sorted(r["max_tokens"] for r in merges) == [2600, 2600, 4500, 4500]
    assert all('title=T a' in r["prompt"] for r in merges)
    failed = p.table("errors").collect()
    assert {(r.stage, r.status) for r in failed} == {("thread_summaries_parts", "error: HTTP 400 no"), ("thread_sentiments_parts", "error: HTTP 400 no")}
    broken["on"] = False
    log.clear()
    assert p.rollup() and {r.conversation_id for r in p.table("thread_summaries").collect()} == {"a", "b", "long"}
    assert len([r for r in log if "chunks=1" in r["prompt"]]) == 2  # one part of either kind
    assert p.table("thread_summaries").count() == 3 and not p.rollup()
    assert p.stats()["errors"] == 2
    strict = Pipeline(spark, Config(str(talks), str(tmp_path / "s"), strict=True), Scripted(lambda r: (None, "HTTP 400"), []))
    with pytest.raises(RuntimeError, match="HTTP 400"):
        strict.run()


def test_pack_modes_and_own_folders(spark, talks, tmp_path):
    c = Config(str(talks), str(tmp_path / "base"), mode="sentiment", memory_dir=str(tmp_path / "memory"), chunks_dir=str(tmp_path / "cut"), max_shard_bytes=300)
    p = Pipeline(spark, c)
    assert p.run() == ["split", "chunk", "summarize", "rollup", "pack"]
    assert (tmp_path / "memory" / "sentiment_memory" / "sentiment_memories_0001.md").exists() and not (tmp_path / "memory" / "memory").exists()
    assert (tmp_path / "cut" / "chunks" / "_SUCCESS").exists() and not (tmp_path / "base" / "chunks").exists()
    both = Pipeline(spark, Config(str(talks), str(tmp_path / "base"), memory_dir=str(tmp_path / "memory"), chunks_dir=str(tmp_path / "cut")))
    assert both.pack() and (tmp_path / "memory" / "memory" / "memories_0001.md").read_text().startswith("# Memory Shard 0001\n\n<a id=")
    with pytest.raises(ValueError, match="mode"):
        Config("a", "b", mode="x").validate()


def test_one_file_for_each_row(spark, tmp_path):
    rows = spark.createDataFrame([("a/x 1.json", "one"), ("b=é.json", "two\nlines"), ("c.json", None)], "n string, t string")
    path = tmp_path / "out"
    writers.documents(rows, str(path), "n", "t")
    assert (path / "a" / "x 1.json").read_text() == "one\n" and (path / "b=é.json").read_text() == "two\nlines\n" and [x.name for x in tmp_path.iterdir()] == ["out"]
    with pytest.raises(FileExistsError):
        writers.documents(rows.limit(1), str(path), "n", "t")
    writers.documents(rows.withColumn("t", F.lit("new")), str(path), "n", "t", overwrite=True)
    assert (path / "c.json").read_text() == "new\n"
    with pytest.raises(ValueError, match="one file name"):
        writers.documents(rows.withColumn("n", F.lit("same")), str(path), "n", "t")


def test_http_provider(spark):
    """Requests as the service sees them, its errors, and the key from the environment."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((body, self.headers.get("Authorization")))
            busy = body["input"] == "busy" and sum(b["input"] == "busy" for b, _ in seen) < 3
            self.send_response(429 if busy else 400 if body["input"] == "bad" else 200)
            self.end_headers()
            said = {"output": [{"type": "reasoning"}, {"content": [{"type": "output_text", "text": '{"k": '}, {"text": "7}"}]}]}
            self.wfile.write(json.dumps(said).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        rows = spark.createDataFrame([("a", "fine"), ("b", "busy"), ("c", "bad")], "conversation_id string, prompt string")
        provider = providers.HttpProvider(f"http://127.0.0.1:{server.server_port}/", "m", "HOME", tasks=1, waits=((0, 0), (0, 0)))
        got = {r.conversation_id: (r.k, r.status[:10]) for r in providers.ask(provider, rows, ["conversation_id"], "k int", "do it", 99).collect()}
    finally:
        server.shutdown()
    assert got == {"a": (7, "ok"), "b": (7, "ok"), "c": (None, "error: HTT")}
    assert len(seen) == 5 and all(key.startswith("Bearer ") for _, key in seen)
    body = next(b for b, _ in seen if b["input"] == "fine")
    assert (body["model"], body["instructions"], body["max_output_tokens"]) == ("m", "do it", 99) and body["text"]["format"]["schema"]["required"] == ["k"]


def test_places_without_a_single_task(spark):
    from loomspark.operators import order

    rows = spark.createDataFrame([(i % 3 if i % 5 else None, i % 7) for i in range(500)], "g int, v int").repartition(6)
    got = order.numbered(rows, [F.coalesce("g", F.lit(-1)), F.col("v")], "pos").orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 501)) and [(r.g if r.g is not None else -1, r.v) for r in got] == sorted((r.g if r.g is not None else -1, r.v) for r in got)
    nth = order.nth_of(rows, F.col("g"), [F.col("v")]).collect()
    for g in (None, 0, 1, 2):
        own = sorted((r.nth, r.v) for r in nth if r.g == g)
        assert [n for n, _ in own] == list(range(1, len(own) + 1)) and [v for _, v in own] == sorted(v for _, v in own)
    assert order.numbered(rows.limit(0), [F.col("v")]).count() == 0


def test_next_fit_of_null_and_empty_sections(spark):
    sizes = [(i, None if i % 9 == 0 else 0 if i % 4 else 120) for i in range(400)]
    rows = spark.createDataFrame(sizes, "i int, b int").repartition(5)
    got = {r.i: (r.shard_no, r.b) for r in pack.next_fit(rows, "b", ["i"], 300, 21).collect()}
    assert [got[i][0] for i in range(400)] == pack.fold_pack((b or 0 for _, b in sizes), 300, 21) and {i: b for i, (_, b) in got.items()} == dict(sizes)


def test_long_graphs_walk_in_linear_time(spark):
    import time

    n = 20_000
    value = lambda i: F.struct(i.cast("string").alias("id"), F.struct(F.struct(F.lit("user").alias("role"), F.lit("").alias("name")).alias("author"), i.cast("double").alias("create_time"), F.lit('{"parts": ["x"]}').alias("content"), F.lit("{}").alias("metadata")).alias("message"), F.when(i > 0, (i - 1).cast("string")).alias("parent"), F.array().cast("array<string>").alias("children"))
    ids = F.sequence(F.lit(0), F.lit(n - 1))
    raw = spark.range(1).select(F.lit("c").alias("conversation_id"), F.lit("").alias("id"), F.lit("").alias("title"), F.lit(1.0).alias("create_time"), F.lit(1.0).alias("update_time"), F.lit(str(n - 1)).alias("current_node"), F.map_from_arrays(F.transform(ids, lambda i: i.cast("string")), F.transform(ids, value)).alias("mapping"))
    began = time.time()
    r = linearize.threads(raw).select(F.size("messages").alias("n"), "err").first()
    assert (r.n, r.err) == (n, None) and time.time() - began < 40


class Killed(Exception):
    pass


def test_batches_are_entered_and_never_asked_for_twice(spark, talks, tmp_path):
    """A run that ends in the midst goes on behind its last batch; one that overwrites leaves one row a chunk and no old files."""
    log, left = [], {"calls": 99}

    def answer(r):
        return json.dumps({**json.loads(SUMMARY), "terms": ["m", f"t{len(r.prompt) % 7}"]}), None

    class Mortal(Scripted):
        def complete(self, requests):
            left["calls"] -= 1
            if left["calls"] < 0:
                raise Killed
            return super().complete(requests)

    def pipeline(**settings):
        return Pipeline(spark, Config(str(talks), str(tmp_path / "j"), target_turns=2, glossary_min_count=1, **settings), Mortal(answer, log))

    p = pipeline(batch_size=1)
    p.split(), p.chunk()
    n = p.table("chunks").count()
    left["calls"] = 4 + 2  # a request and its empty second try for each kind; the second batch ends after its summaries
    with pytest.raises(Killed):
        p.summarize()
    assert p.table("summaries").count() == 0 and not p.journal.finished() and len(log) == 3
    left["calls"] = 999
    assert pipeline(batch_size=1).summarize() and len(log) == 2 * n
    p = pipeline(batch_size=1)
    assert not p.summarize() and p.table("summaries").count() == p.table("sentiments").count() == n
    whole = {(r.term, r["count"]) for r in p._glossary().collect()}
    assert dict(whole)["m"] == n
    p = pipeline(batch_size=25, overwrite=True)
    left["calls"] = 2
    with pytest.raises(Killed):
        p.summarize()
    assert p.table("sentiments").count() == n, "what is there stays until the run is through"
    left["calls"] = 999
    assert pipeline(batch_size=25).summarize() and len(log) == 4 * n
    p = pipeline()
    for name in ("summaries", "sentiments"):
        rows = p.table(name).collect()
        assert len(rows) == n == len({r.rel_path for r in rows})
        assert len([x for x in (tmp_path / "j" / "answers" / name).iterdir() if x.is_dir()]) == 1
    assert {(r.term, r["count"]) for r in p._glossary().collect()} == whole and not p.summarize()
    p = pipeline()
    assert p.rollup() and {r.conversation_id for r in p.table("thread_summaries").collect()} == {"a", "b", "long"}


@pytest.mark.parametrize("seed", range(2))
def test_parts_of_a_glossary_combine_to_the_whole(spark, seed):
    rng = random.Random(seed)
    rows = [(s, rng.choice([None, float(s)]), i, rng.choice([" Vix", "vix", "Ox ", "ox", "Élan", ""]), rng.choice(["", "x", "longer", "équal", None])) for s in range(12) for i in range(4)]
    kind = "seq bigint, seen_at double, pos bigint, term string, definition string"
    prior = spark.createDataFrame([("Vix", "old", 4, 1.0, 2.0), ("vix", "newer", 2, None, 3.0), ("lone", "", 1, None, None)], schemas.GLOSSARY_ENTRY)
    whole = glossary.merge(spark.createDataFrame(rows, kind), prior)
    cuts = [(0, 5), (5, 6), (6, 12)]
    states = [prior, *(glossary.merge(spark.createDataFrame([r for r in rows if a <= r[0] < b], kind)) for a, b in cuts)]
    last_two = glossary.combine(states[2:])
    assert sorted(map(repr, glossary.combine([*states[:2], last_two]).collect())) == sorted(map(repr, whole.collect()))


def test_sentiments_have_instructions_and_a_model_of_their_own(spark, talks, tmp_path):
    seen, sentiments = [], []

    def answer(r):
        seen.append((r.instructions, r.max_tokens))
        return (SUMMARY if r.max_tokens != 2600 else SUMMARY[:-9]), None

    def feel(r):
        sentiments.append((r.instructions, r.max_tokens))
        return SUMMARY, None

    p = Pipeline(spark, Config(str(talks), str(tmp_path / "s"), target_turns=2, max_chunks_per_thread=2), Scripted(answer, []), sentiment_provider=Scripted(feel, []))
    assert p.run() == ["split", "chunk", "summarize", "rollup", "pack"]
    words = {w for w, _ in sentiments}
    assert not words & {w for w, _ in seen} and len(words) == 3  # of chunks, of threads, of threads from parts
    assert all("feelings" in w for w, n in sentiments if n == 2600)
    assert any("brief" in w for w, n in seen if n == 4500) and not any("brief" in w for w, n in seen if n == 2600)


def test_a_waiting_request_holds_up_no_other():
    import threading

    waited, seen, lock = [], {}, threading.Lock()

    def call(i):
        with lock:
            seen[i] = seen.get(i, 0) + 1
        if i % 10 == 3 and seen[i] == 1:
            raise RuntimeError("HTTP 429 Too Many Requests")
        if i == 50:
            raise RuntimeError("HTTP 400 no")
        return str(i)

    calls = [lambda i=i: call(i) for i in range(100)]
    found = providers.scheduled(calls, 4, (providers.RATE_LIMIT_WAITS, providers.SERVER_WAITS), waited.append)
    assert [a for a, _ in found] == [None if i == 50 else str(i) for i in range(100)] and found[50][1] == "HTTP 400 no"
    assert sum(waited) < 66 and sum(seen.values()) == 110, "ten requests wait together"
    found = providers.scheduled([lambda: 1 / 0, *calls], 1, ((), ()), waited.append, strict=True)
    assert found[0][1] == "division by zero" and {e for _, e in found[1:]} == {"cancelled"}
    busy = [lambda: (_ for _ in ()).throw(RuntimeError("HTTP 503 busy"))] * 3
    waited.clear()
    assert [e for _, e in providers.scheduled(busy, 2, (providers.RATE_LIMIT_WAITS, providers.SERVER_WAITS), waited.append)] == ["HTTP 503 busy"] * 3
    assert 34 < sum(waited) < 36


def test_a_run_from_the_command_line_reaches_a_service(spark, talks, tmp_path, monkeypatch):
    """Flags alone: the service's address, models for summaries, sentiments and breakpoints, calls at a time."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

    from loomspark import __main__ as command

    models = []

    class Service(BaseHTTPRequestHandler):
        def do_POST(self):
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            models.append(body["model"])
            self.send_response(200)
            self.end_headers()
            said = '{"breakpoints": [1]}' if "breakpoints" in json.dumps(body["text"]) else SUMMARY
            self.wfile.write(json.dumps({"output_text": said}).encode())

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Service)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        flags = ["--archive", str(talks), "--base-dir", str(tmp_path / "c"), "--provider", "http", "--provider-url", f"http://127.0.0.1:{server.server_port}/", "--model", "m1", "--sentiment-model", "m2", "--decider", "model", "--breakpoint-model", "m3", "--concurrency", "2", "--calls-per-task", "3"]
        monkeypatch.setattr(type(spark), "stop", lambda *_: None)
        assert command.main(flags) == 0
        assert set(models) == {"m1", "m2", "m3"} and models.count("m3") == 3
        n = len(models)
        assert command.main([*flags, "--only-stage", "summarize", "--reindex"]) == 0 and len(models) == n
    finally:
        server.shutdown()
    with pytest.raises(SystemExit):
        command.parse(["--archive", "a", "--base-dir", "b", "--provider", "http"])


def test_a_failed_move_takes_all_back(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([(f"{i}.txt", "old") for i in range(4)], "n string, t string")
    path = tmp_path / "out"
    writers.documents(rows, str(path), "n", "t")
    move = writers._move

    def failing(store, source, target, aside, made):
        if target.getName() == "3.txt":
            raise OSError("lost")
        move(store, source, target, aside, made)

    monkeypatch.setattr(writers, "_move", failing)
    with pytest.raises(OSError, match="lost"):
        writers.documents(rows.withColumn("t", F.lit("new")).unionByName(spark.createDataFrame([("5.txt", "new")], "n string, t string")), str(path), "n", "t", overwrite=True)
    assert {f.name: f.read_text() for f in path.iterdir() if f.suffix == ".txt"} == {f"{i}.txt": "old\n" for i in range(4)} and [x.name for x in tmp_path.iterdir()] == ["out"]


def test_bundles_hold_what_files_hold(spark, tmp_path):
    """Many documents in few files, read as files are; a name is there once, and a set of documents is replaced as a whole."""
    made = {"a/x.summary.json": "c", "a/x.sentiment.summary.json": "c", "a/x.json": "c", "summaries/y.json": "c", "a/y.json": "", "t.JSON": "c", "s/xjson": "c"}
    rows = spark.createDataFrame([(n, json.dumps({"conversation_id": c, "chunk_number": 1, "summary": n, "title": n}, indent=2)) for n, c in made.items()], "n string, t string")
    files, packed = str(tmp_path / "files"), str(tmp_path / "packed")
    writers.documents(rows, files, "n", "t")
    writers.bundle(rows, packed, "n", "t")
    for read in (readers.summaries, readers.sentiments, readers.chunks, readers.threads, readers.thread_summaries):
        a, b = (sorted(tuple(r) for r in read(spark, p, *more).drop("path").collect()) for p, more in ((files, ()), (packed, (True,))))
        assert a == b and (a or read is readers.thread_summaries), read
    with pytest.raises(FileExistsError):
        writers.bundle(rows, packed, "n", "t")
    with pytest.raises(ValueError, match="one file name"):
        writers.bundle(rows.withColumn("n", F.lit("same")), packed, "n", "t", overwrite=True)
    assert readers.bundle(spark, packed).count() == len(made)
    writers.bundle(rows.limit(1).withColumn("t", F.lit("new")), packed, "n", "t", overwrite=True)
    assert [r.content for r in readers.bundle(spark, packed).collect()] == ["new"] and {x.name for x in tmp_path.iterdir()} == {"files", "packed"}


@pytest.mark.parametrize("name", ["chunk_files", "thread_files", "summary_files", "sentiment_files", "thread_summary_files"])
def test_files_are_fewer_than_documents(spark, name):
    """A file a document took a folder, a file, a checksum and a rename each."""
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    n = queries.QUERIES[name](spark, "/root/testdata/sf0.001").count()
    left = [f for d in set(os.listdir(shared)) - before for _, _, fs in os.walk(os.path.join(shared, d)) for f in fs if f.startswith("part-")]
    assert len(left) <= 24 and len(left) < n


def test_prompts_of_whole_texts_equal_their_sql(spark, tmp_path):
    """Messages and transcripts beyond the budgets of a model's prompt, which the SQL doesn't cut at."""
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}\n" + "wörd " * (5 if t % 5 else 6000 * c)) for c in (1, 2, 3) for t in range(9)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").toPandas().to_parquet(tmp_path / "conversations.parquet")
    assert differ(queries.render_prompt(spark, str(tmp_path)), str(tmp_path), queries.SQL["render_prompt"])[:600] == ""


def test_glossary_shuffles_whole_texts_and_not_each_word(spark, tmp_path):
    """Repeats within a merge go where its text lies, also of rows that share their seq; the words are dealt out once, by key."""
    rows = [(i % 40, f"a B b w{i} A   end{i % 7} a", "s") for i in range(60)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    plan = queries.glossary_merge(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2 and "hashpartitioning(doc_id" in plan and "seq" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    got = {r.term: r["count"] for r in queries.glossary_merge(spark, str(tmp_path)).collect()}
    assert got["a"] == got["B"] == 40 and got["w3"] == 1 and sum(c for t, c in got.items() if t.startswith("end")) == len({(i % 40, i % 7) for i in range(60)})


def test_entries_that_share_a_key_stay_and_the_last_goes_on(spark):
    prior = spark.createDataFrame([("A", "first", 2, 1.0, 1.0), ("a", None, 3, None, 2.0), ("b", "x", 1, None, None)], schemas.GLOSSARY_ENTRY).coalesce(1)
    new = spark.createDataFrame([(5, 9.0, 0, "a ", "new"), (5, 9.0, 1, "A", "again")], "seq bigint, seen_at double, pos int, term string, definition string")
    assert sorted(map(tuple, glossary.merge(new, prior).collect())) == [("A", "first", 2, 1.0, 1.0), ("a", "new", 4, 9.0, 9.0), ("b", "x", 1, None, None)]


def test_shards_are_documents_of_few_files(spark):
    shared = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    n = queries.memory_files(spark, "/root/testdata/sf0.01").count()
    left = [f for d in set(os.listdir(shared)) - before if d.startswith("memory-") for _, _, fs in os.walk(os.path.join(shared, d)) for f in fs if f.startswith("part-")]
    assert n > 50 and 0 < len(left) <= 8


def test_a_glossary_of_several_files_is_one_document_and_no_row_holds_it(spark, tmp_path, monkeypatch):
    """The document was one file from one task, and one row when it was read, which took all of an executor's memory."""
    monkeypatch.setattr(writers, "PART_BYTES", 3000, raising=False)
    rows = [(f"t{i:03}" + "\nä\"]}" * (i % 3), "" if i % 4 else "]}\r\n{,\\" + "x" * (i % 50), 1 + i % 7, None if i % 5 else i / 3, float(i)) for i in range(400)]
    path = str(tmp_path / "glossary.json")
    writers.glossary(spark.createDataFrame(rows, schemas.GLOSSARY_ENTRY).repartition(3), path)
    want = sorted(rows, key=lambda r: (-r[2], r[0].lower(), r[0]))
    files = sorted(tmp_path.glob("glossary.json/part-*"))
    document = json.loads(b"".join(f.read_bytes() for f in files))
    assert len(files) > 5 and document["version"] == 1 and [tuple(e.get(c) for c in glossary.ENTRY) for e in document["entries"]] == want
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # files are cut as well
        read = readers.glossary(spark, path, "pos")
        assert [tuple(r) for r in sorted(read.collect(), key=lambda r: r.pos)] == [(*r, i + 1) for i, r in enumerate(want)]
        plain = readers.glossary(spark, path)
        assert plain.rdd.getNumPartitions() > len(files) and sorted(map(repr, map(tuple, plain.collect()))) == sorted(map(repr, want))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("parsed", [1 << 26, 0])
def test_glossaries_in_other_forms_are_read(spark, tmp_path, monkeypatch, parsed):
    monkeypatch.setattr(readers, "PARSED_BYTES", parsed, raising=False)
    entries = [{"term": f"t{i}", "definition": "]} {", "count": i, "first_seen_at": None, "last_seen_at": 1.5} for i in range(9)]
    (tmp_path / "g.json").write_text(json.dumps({"version": 1, "entries": entries, "meta": {"a": "b"}}, indent=2))
    got = sorted(map(tuple, readers.glossary(spark, str(tmp_path / "g.json"), "pos").collect()), key=lambda r: r[-1])
    assert got == [(*e.values(), i + 1) for i, e in enumerate(entries)]


def test_an_empty_glossary_is_a_document(spark, tmp_path):
    path = str(tmp_path / "glossary.json")
    writers.glossary(spark.createDataFrame([], schemas.GLOSSARY_ENTRY), path)
    assert json.loads(b"".join(f.read_bytes() for f in tmp_path.glob("glossary.json/part-*"))) == {"version": 1, "entries": []}
    assert readers.glossary(spark, path).count() == readers.glossary(spark, path, "pos").count() == 0

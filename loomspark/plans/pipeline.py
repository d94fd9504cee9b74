"""The five stages from a chat archive to a memory pack, each resumable.

Results of a stage are Parquet tables under the base folder, so a later stage reads columns and not files;
JSON lines, markdown and the glossary are written beside. Answers about chunks count batch by batch, by
a journal: a run that is ended goes on behind the last batch that it has entered, and what an overwriting run
replaces stays until the run is through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import file_component
from ..operators import glossary as G
from ..operators import index, linearize, pack, rollup, turns
from ..operators.budget import fixed_windows
from ..operators.order import numbered
from ..operators.stats import thread_counters
from ..shared import mark, release, stored
from ..sources import readers, writers
from . import prompts
from .config import Config
from .deciders import Decider, ModelDecider
from .journal import Entry, Journal
from .providers import ExtractiveProvider, HttpProvider, Provider, ask_with_fallback, recoverable

SUMMARY_INSTRUCTIONS = "Summarise the chunk. " + prompts.SENTIMENT_TAIL
ROLLUP_INSTRUCTIONS = "Summarise the whole conversation from its parts. " + prompts.SENTIMENT_TAIL
#: Rows of the tables that the journal keeps.
JOURNALED = {
    "summaries": f"{schemas.CHUNK_KEYS}, rel_path string, {schemas.SUMMARY_PAYLOAD}, glossary_additions array<struct<term:string,definition:string>>",
    "sentiments": f"{schemas.CHUNK_KEYS}, rel_path string, {schemas.SENTIMENT_PAYLOAD}",
}
KEYS = ["conversation_id", "chunk_number", "turn_start", "turn_end", "rel_path"]
SENTIMENT_ROLLUP_INSTRUCTIONS = "Describe how feelings run through the whole conversation, from what its parts say of them; add none that no part has. " + prompts.SENTIMENT_TAIL
#: Further instructions where partial results of one conversation are merged, and for a second try.
MERGE_WORDS = " The parts are results for stretches of one conversation, in order: make one of them, without repeats."
AGAIN_WORDS = " The answer before was cut off or wasn't JSON: keep all fields, but be brief."
#: Output tokens of the first and the second try (fixed values).
CHUNK_TOKENS, ROLLUP_TOKENS = (2500, 2500), (2600, 4500)


class Pipeline:
    """decider: what splits a thread into chunks; without one every target_turns-th turn does. sentiment_provider: where sentiments have a model of their own.

    What a model doesn't answer is listed in ``errors`` and left undone, so the next run asks for it again;
    with ``strict`` it ends the run. Nothing is made from a part of its input.
    """

    def __init__(self, spark: SparkSession, config: Config, provider: Provider | None = None, decider: Decider | None = None, sentiment_provider: Provider | None = None):
        config.validate()
        self.sentiment_provider = sentiment_provider
        self.spark, self.c, self.provider, self.decider = spark, config, provider or ExtractiveProvider(), decider
        self.journal = Journal(spark, self.path("answers"))

    def provider_of(self, payload: str) -> Provider:
        """What answers about sentiments may be another model."""
        return self.sentiment_provider or self.provider if payload == schemas.SENTIMENT_PAYLOAD else self.provider

    def path(self, name: str) -> str:
        return self.c.path(name)

    def table(self, name: str) -> DataFrame:
        if name in JOURNALED and not readers.exists(self.spark, self.path(name)):
            return self.journal.read(name, JOURNALED[name])
        return self.spark.read.parquet(self.path(name))

    def _there(self, name: str) -> bool:
        return readers.exists(self.spark, self.path(name)) or name in JOURNALED and self.journal.finished() > 0

    def _save(self, df: DataFrame, name: str, append: bool = False) -> None:
        df.write.mode("append" if append else "overwrite").parquet(self.path(name))

    def _answered(self, answers: DataFrame, stage: str, keys: list[str]) -> DataFrame:
        """Rows with a payload; the others go to the errors table."""
        failed = answers.filter("status != 'ok'").select(F.lit(stage).alias("stage"), F.to_json(F.struct(*keys)).alias("request"), "status")
        if failed.limit(1).count():
            self._save(failed, "errors", append=True)
            if self.c.strict:
                raise RuntimeError(f"{stage}: {failed.first().status}")
        return answers.filter("status = 'ok'").drop("status")

    def _done(self, *names: str) -> bool:
        return not self.c.overwrite and all(readers.exists(self.spark, self.path(f"{n}/_SUCCESS")) for n in names)

    def run(self) -> list[str]:
        """Names of the stages that did something."""
        did = []
        for stage in self.c.stages():
            point = mark()
            try:
                if getattr(self, stage)():
                    did.append(stage)
            finally:
                release(self.spark, point)
        return did

    def split(self) -> bool:
        if self._done("threads", "quarantine"):
            return False
        found = linearize.threads(readers.archive(self.spark, self.c.archive, self.c.array_field))
        self._save(linearize.quarantine(found), "quarantine")
        named = linearize.numbered_names(linearize.good(found, self.c.strict).withColumn("_order", F.struct("_file", "_place")), "conversation_id", "_order")
        self._save(named.drop("_order", "_file", "_place"), "threads")
        return True

    def chunk(self) -> bool:
        threads = self.table("threads")
        if self._done("chunks"):
            threads = threads.join(self.table("chunks").select("file_name"), "file_name", "left_anti")
            if not threads.filter("size(messages) > 0").limit(1).count():
                return False
        # conversations may share an id; their file names are their own
        names = threads.select("file_name", F.col("conversation_id").alias("_id"))
        own, decided = threads.withColumn("conversation_id", F.col("file_name")), None
        if self.decider is not None:
            decided = stored(self.decider.decide(own, self.c.target_turns), "breakpoints")
            decided = self._answered(decided, "chunk", ["conversation_id"])
            own = own.join(decided.select("conversation_id"), "conversation_id", "left_semi")
        made = turns.chunks(own, self.c.target_turns, decided)
        made = made.withColumnRenamed("conversation_id", "file_name").join(names, "file_name").withColumnRenamed("_id", "conversation_id")
        self._save(made.withColumn("rel_path", turns.chunk_path(F.col("file_name"))), "chunks", append=self._done("chunks"))
        return True

    def summarize(self) -> bool:
        """Batches of chunks in the order of their paths; each sees the glossary that the one before left."""
        chunks, journal, c = self.table("chunks"), self.journal, self.c
        if c.max_chunks:
            chunks = chunks.orderBy("rel_path").limit(c.max_chunks)
        generation = journal.begin(c.overwrite or not c.resume)
        done = {name: stored(journal.read(name, schema, generation).select("rel_path"), "done") for name, schema in JOURNALED.items()}
        todo = rollup.pending_chunks(chunks, done["summaries"], done["sentiments"])
        left = todo.limit(1).count() > 0
        if not left and journal.finished() == generation:
            if c.reindex:
                self._chunk_indexes()
            return c.reindex
        if left:
            self._batches(todo, done, generation)
        glossary = journal.entries("glossary", generation)
        kept = G.cull(self._glossary(generation), c.glossary_min_count)
        path = journal.fresh("glossary")
        kept.write.parquet(path)
        journal.add(generation, "glossary", path, weight=0, replaces=glossary)
        for name, schema in JOURNALED.items():
            journal.fold(generation, name, schema)
        journal.finish(generation)
        writers.glossary(self._glossary(), self.path("glossary.json"))
        self._chunk_indexes()
        return True

    def _batches(self, todo: DataFrame, done: dict[str, DataFrame], generation: int) -> None:
        """Ask about the chunks that are left, and enter each batch's answers once they are written."""
        journal, size = self.journal, self.c.batch_size or 25
        # each round reads its own batch alone
        batched = numbered(todo, [F.col("rel_path")], "_place", "bigint").withColumn("batch", F.floor((F.col("_place") - 1) / size).cast("int")).drop("_place")
        path = self.path("chunks_todo")
        batched.repartition("batch").write.mode("overwrite").partitionBy("batch").parquet(path)
        batches = [r.batch for r in self.spark.read.parquet(path).select("batch").distinct().orderBy("batch").collect()]
        header = readers.prompt_header(self.spark, self.c.sentiment_header_file) if self.c.sentiment_header_file else ""
        for i in batches:
            point = mark()
            said = G.excerpt(self._glossary(generation), self.c.glossary_max_terms).first()[0] if self.c.glossary_max_terms > 0 else ""
            own = self.spark.read.schema(todo.schema).parquet(f"{path}/batch={i}")
            print_ = str(own.agg(F.sum(F.xxhash64("rel_path", F.to_json("messages")).cast("decimal(38,0)"))).first()[0])
            keyed = own.select(*KEYS, "thread_start_time")
            for name, words in (("summaries", SUMMARY_INSTRUCTIONS), ("sentiments", prompts.sentiment_instructions(header))):
                lacking = own.join(done[name], "rel_path", "left_anti")  # a chunk that lacks one of the two isn't asked about for the other
                full, short = (prompts.chunk_prompts(lacking, said, most, tools, ("rel_path",)) for most, tools in ((prompts.CHUNK_BYTES, True), (prompts.CHUNK_RETRY_BYTES, False)))
                payload = schemas.SUMMARY_PAYLOAD + ", glossary_additions array<struct<term:string,definition:string>>" if name == "summaries" else schemas.SENTIMENT_PAYLOAD
                good = self._answered(ask_with_fallback(self.provider_of(payload), full, short, KEYS, payload, words, CHUNK_TOKENS), name, KEYS)
                rows = keyed.join(good, KEYS).select(*schemas.names(JOURNALED[name]))
                made = journal.fresh(name)
                rows.write.parquet(made)
                if name == "summaries":
                    self._enter_terms(generation, made, print_)
                else:
                    journal.add(generation, name, made, print_)
            release(self.spark, point)

    def _enter_terms(self, generation: int, made: str, print_: str) -> None:
        """Enter a batch's summaries and, before them, what they add to the glossary.

        Additions are kept as deltas; two of the same weight are merged, so few are ever there and an entry is
        written as often as the logarithm of the number of batches says.
        """
        journal = self.journal
        new = self.spark.read.schema(JOURNALED["summaries"]).parquet(made).withColumn("seq", F.dense_rank().over(_by_path()))
        path = journal.fresh("glossary")
        G.merge(G.additions_of(new)).write.parquet(path)
        known = self._deltas(generation)
        latest = journal.add(generation, "glossary", path, print_, replaces=[e for e in journal.entries("glossary", generation) if e not in known])
        journal.add(generation, "summaries", made, print_)
        while True:
            deltas = [e for e in journal.entries("glossary", generation) if e.weight]
            if len(deltas) < 2 or deltas[-2].weight != deltas[-1].weight:
                return
            path = journal.fresh("glossary")
            G.combine([self.spark.read.schema(schemas.GLOSSARY_ENTRY).parquet(e.path) for e in deltas[-2:]]).write.parquet(path)
            latest = journal.add(generation, "glossary", path, f"{deltas[-2].inputs} {deltas[-1].inputs}", latest.weight + deltas[-2].weight, deltas[-2:])

    def _deltas(self, generation: int | None = None) -> list[Entry]:
        """Parts of the glossary; one whose summaries aren't entered is from a run that ended between the two, and doesn't count."""
        entered = {e.inputs for e in self.journal.entries("summaries", generation)}
        return [e for e in self.journal.entries("glossary", generation) if not e.weight or set(e.inputs.split()) <= entered]

    def _glossary(self, generation: int | None = None) -> DataFrame:
        states = [self.spark.read.schema(schemas.GLOSSARY_ENTRY).parquet(e.path) for e in self._deltas(generation)]
        return G.combine(states) if states else self.spark.createDataFrame([], schemas.GLOSSARY_ENTRY)

    def _chunk_indexes(self) -> None:
        c, chunks = self.c, self.table("chunks").withColumn("chunk_path", F.concat(F.lit("chunks/"), F.col("rel_path")))
        stem = F.regexp_replace("rel_path", r"\.json$", "")
        a = self.table("summaries").withColumn("summary_path", F.concat(F.lit("summaries/"), stem, F.lit(readers.SUMMARY)))
        b = self.table("sentiments").withColumn("sentiment_summary_path", F.concat(F.lit("summaries/"), stem, F.lit(readers.SENTIMENT)))
        writers.index_lines(writers.without_empty(index.chunk_index(chunks, a, c.index_summary_bytes, c.index_tags_max, c.index_terms_max), ("summary",)), self.path("index/chunks"), "summary_path")
        writers.index_lines(index.chunk_sentiment_index(chunks, b, c.index_summary_bytes, c.index_tags_max), self.path("index/chunk_sentiments"), "sentiment_summary_path", ignore_nulls=False)

    def rollup(self) -> bool:
        said = G.excerpt(self._glossary(), self.c.glossary_max_terms).first()[0]
        semantic = self.table("summaries")
        sentiment = rollup.driven_by(semantic, self.table("sentiments"))
        did = False
        for name, rows, payload, makers in (
            ("thread_summaries", semantic, schemas.SUMMARY_PAYLOAD, (prompts.rollup_prompts, prompts.merge_prompts)),
            ("thread_sentiments", sentiment, schemas.SENTIMENT_PAYLOAD, (prompts.sentiment_rollup_prompts, prompts.sentiment_merge_prompts)),
        ):
            there = self._done(name) and self.c.resume
            if there:
                rows = rows.join(self.table(name).select("conversation_id"), "conversation_id", "left_anti")
            if not rows.limit(1).count():
                continue
            did = True
            made = self._rollup(rows.select(*schemas.names(schemas.CHUNK_KEYS), *schemas.names(payload)), name, payload, makers, said)
            self._save(made.select(*schemas.names(schemas.THREAD_KEYS), *schemas.names(payload)), name, append=there)
        if did or self.c.reindex and readers.exists(self.spark, self.path("thread_summaries")):
            self._thread_indexes()
        return did or self.c.reindex

    def _ask_twice(self, asked: DataFrame, keys: list[str], payload: str, stage: str, merge: bool = False) -> DataFrame:
        """Answers cut off or without JSON are asked for once more, with more room and a word about it."""
        words = (SENTIMENT_ROLLUP_INSTRUCTIONS if payload == schemas.SENTIMENT_PAYLOAD else ROLLUP_INSTRUCTIONS) + MERGE_WORDS * merge
        answers = ask_with_fallback(self.provider_of(payload), asked, asked, keys, payload, (words, words + AGAIN_WORDS), ROLLUP_TOKENS, recoverable())
        return self._answered(answers, stage, keys)

    def _rollup(self, rows: DataFrame, name: str, payload: str, makers: tuple, said: str) -> DataFrame:
        """Threads of up to max_chunks_per_thread chunks at once, longer ones through written parts.

        Parts that an earlier run wrote from the same chunks are read again; a thread is merged when all
        its parts are there.
        """
        fields = schemas.names(payload)
        named = rows.filter(F.coalesce("conversation_id", F.lit("")) != "")
        cut = fixed_windows(named, ["conversation_id"], rollup.ORDER, self.c.max_chunks_per_thread, "part")
        of = ["conversation_id", "part"]
        print_ = F.xxhash64(F.array_sort(F.collect_list(F.struct(*rollup.ORDER, F.xxhash64(*fields)))))
        plan = stored(cut.groupBy(*of).agg(F.min("thread_start_time").alias("thread_start_time"), print_.alias("inputs")), "rollup-plan")
        parts_path = f"{name}_parts"
        known = self.c.resume and readers.exists(self.spark, self.path(f"{parts_path}/_SUCCESS"))
        todo = plan.join(self.table(parts_path).select(*of, "inputs"), [*of, "inputs"], "left_anti") if known else plan
        todo = stored(todo, "rollup-todo")
        if todo.limit(1).count():
            joined = F.concat_ws("\x1f", "conversation_id", F.col("part").cast("string"))
            keyed = cut.join(todo.select(*of), of, "left_semi").withColumn("conversation_id", joined)
            answers = self._ask_twice(makers[0](keyed, said), ["conversation_id"], payload, parts_path)
            split = F.split("conversation_id", "\x1f")
            back = answers.withColumns({"part": F.element_at(split, -1).cast("int"), "conversation_id": F.regexp_replace("conversation_id", "\x1f[0-9]+$", "")})
            self._save(back.join(todo, of).select(*of, "thread_start_time", "inputs", *fields), parts_path, append=known)
        if not readers.exists(self.spark, self.path(f"{parts_path}/_SUCCESS")):
            return self.spark.createDataFrame([], f"{schemas.THREAD_KEYS}, {payload}")
        titles = self.table("threads").groupBy("conversation_id").agg(F.min_by("title", "file_name").alias("title"))
        sizes = plan.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n_parts"), F.min("thread_start_time").alias("_start")).join(titles, "conversation_id", "left").withColumn("title", F.coalesce("title", F.lit("")))
        there = self.table(parts_path).join(plan.select(*of, "inputs"), [*of, "inputs"], "left_semi").dropDuplicates([*of, "inputs"]).drop("inputs")
        whole = there.groupBy("conversation_id").agg(F.count(F.lit(1)).alias("n_parts"))
        parts = there.join(sizes.join(whole, ["conversation_id", "n_parts"]), "conversation_id")
        columns = ["conversation_id", "title", "thread_start_time", *fields]
        many = parts.filter("n_parts > 1")
        merged = self._ask_twice(makers[1](many, said), ["conversation_id"], payload, name, merge=True)
        merged = merged.join(sizes.withColumnRenamed("_start", "thread_start_time"), "conversation_id")
        return parts.filter("n_parts = 1").select(*columns).unionByName(merged.select(*columns))

    def _thread_indexes(self) -> None:
        c, stem = self.c, file_component("conversation_id")
        a = self.table("thread_summaries").withColumn("thread_summary_path", F.concat(F.lit("thread_summaries/"), stem, F.lit(readers.THREAD_SUMMARY)))
        writers.index_lines(writers.without_empty(index.thread_index(a, c.index_summary_bytes, c.index_tags_max, c.index_terms_max), ("summary",)), self.path("index/threads"), "thread_summary_path")
        if readers.exists(self.spark, self.path("thread_sentiments")):
            b = self.table("thread_sentiments").withColumn("thread_sentiment_summary_path", F.concat(F.lit("thread_sentiments/"), stem, F.lit(readers.THREAD_SENTIMENT)))
            writers.index_lines(writers.without_empty(index.thread_sentiment_index(b, c.index_summary_bytes, c.index_tags_max, c.index_terms_max), ("emotional_summary",)), self.path("index/thread_sentiments"), "thread_sentiment_summary_path")

    def pack(self) -> bool:
        """Shards and index of thread summaries, of sentiments, or of both."""
        did = False
        kinds = (
            ("semantic", "thread_summaries", "packed", "memory", "summary", lambda t: pack.memory_shards(t, self.c.max_shard_bytes, self.c.include_key_points, self.c.include_tags), pack.MEMORY_HEADER, pack.memory_index),
            ("sentiment", "thread_sentiments", "packed_sentiment", "sentiment_memory", "emotional_summary", lambda t: pack.sentiment_shards(t, self.c.max_shard_bytes), pack.SENTIMENT_HEADER, pack.sentiment_index),
        )
        for kind, source, table, folder, text, shards, header, rows in kinds:
            if self.c.mode not in (kind, "both") or self._done(table) or not readers.exists(self.spark, self.path(source)):
                continue
            did = True
            self._save(shards(self.table(source)), table)
            packed = self.table(table)
            writers.documents(pack.shard_files(packed, header), self.path(folder), "shard_file", "content", overwrite=True)
            writers.index_lines(writers.without_empty(rows(packed, self.c.index_summary_bytes), (text,)), self.path(f"index/{folder}"), "shard_file")
        if did:
            writers.copy_if_exists(self.spark, self.path("glossary.json"), self.path("memory_glossary.json"), self.c.overwrite)
        return did

    def stats(self) -> dict[str, int]:
        """Rows of each table that is there, and bytes of the threads' texts."""
        names = [n for n in ("quarantine", "threads", "chunks", "summaries", "sentiments", "thread_summaries", "thread_sentiments", "packed") if self._there(n)]
        out = {n: self.table(n).count() for n in names}
        if readers.exists(self.spark, self.path("errors")):
            out["errors"] = self.table("errors").count()
        if "threads" in names:
            out["text_bytes"] = thread_counters(self.table("threads")).first().n_bytes
        return out

    def export(self, path: str, pretty: bool = False, bundled: bool = False) -> None:
        """Threads, chunks and summaries as one JSON file each, named by thread and chunk as the tables' paths say.

        bundled: as documents of bundles, for more of them than a store and the driver bear as files.
        """
        write = writers.bundle if bundled else writers.documents
        stem = F.regexp_replace("rel_path", r"\.json$", "")
        thread = file_component("conversation_id")
        for name, schema, file in (
            ("threads", schemas.THREAD, F.concat("file_name", F.lit(".json"))), ("chunks", schemas.CHUNK, F.col("rel_path")),
            ("summaries", schemas.CHUNK_SUMMARY, F.concat(stem, F.lit(readers.SUMMARY))), ("sentiments", schemas.CHUNK_SENTIMENT, F.concat(stem, F.lit(readers.SENTIMENT))),
            ("thread_summaries", schemas.THREAD_SUMMARY, F.concat(thread, F.lit(readers.THREAD_SUMMARY))), ("thread_sentiments", schemas.THREAD_SENTIMENT, F.concat(thread, F.lit(readers.THREAD_SENTIMENT))),
        ):
            if self._there(name):
                rows = self.table(name).withColumns({"_file": file, "_json": writers.pretty_json(self.table(name), schemas.names(schema), pretty)})
                write(rows, f"{path.rstrip('/')}/{name}", "_file", "_json", self.c.overwrite)


def _by_path():
    from pyspark.sql import Window as W

    return W.orderBy("rel_path")


def pipeline_of(spark: SparkSession, c: Config) -> Pipeline:
    """A pipeline with the provider, models and decider that the settings name."""
    c.validate()

    def of(model: str) -> Provider:
        if c.provider == "offline":
            return ExtractiveProvider()
        return HttpProvider(c.provider_url, model or c.model, c.key_env, c.concurrency, calls=c.calls_per_task, strict=c.strict)

    decider = ModelDecider(of(c.breakpoint_model)) if c.decider == "model" else None
    return Pipeline(spark, c, of(c.model), decider, of(c.sentiment_model) if c.sentiment_model else None)

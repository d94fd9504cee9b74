"""Settings of a run, checked before anything is read."""

from __future__ import annotations

from dataclasses import dataclass

STAGES = ("split", "chunk", "summarize", "rollup", "pack")
MODES = ("semantic", "sentiment", "both")
#: Which setting says where a table lies, by the first part of its name.
FOLDERS = {
    "threads": "threads_dir", "quarantine": "threads_dir", "chunks": "chunks_dir", "summaries": "summaries_dir", "sentiments": "summaries_dir", "answers": "summaries_dir", "glossary": "summaries_dir", "glossary.json": "summaries_dir",
    "thread_summaries": "thread_summaries_dir", "thread_sentiments": "thread_summaries_dir", "thread_summaries_parts": "thread_summaries_dir", "thread_sentiments_parts": "thread_summaries_dir",
    "packed": "memory_dir", "packed_sentiment": "memory_dir", "memory": "memory_dir", "sentiment_memory": "memory_dir", "memory_glossary.json": "memory_dir",
}


@dataclass
class Config:
    """Defaults are fixed values of the workflow."""

    archive: str = ""
    base_dir: str = ""
    array_field: str | None = None
    target_turns: int = 20
    batch_size: int = 25
    max_chunks: int = 0
    max_chunks_per_thread: int = 5
    glossary_max_terms: int = 60
    glossary_min_count: int = 2
    max_shard_bytes: int = 102_400
    index_summary_bytes: int = 600
    index_tags_max: int = 5
    index_terms_max: int = 15
    include_key_points: bool = True
    include_tags: bool = True
    sentiment_header_file: str = ""
    strict: bool = False
    resume: bool = True
    overwrite: bool = False
    from_stage: str = ""
    only_stage: str = ""
    #: What pack packs: semantic, sentiment, or both.
    mode: str = "both"
    #: What answers: offline, or a service that takes requests by HTTP, with its models; a sentiment_model of its own if given.
    provider: str = "offline"
    provider_url: str = ""
    model: str = ""
    sentiment_model: str = ""
    #: What cuts threads into chunks: stride, or model (breakpoint_model if given).
    decider: str = "stride"
    breakpoint_model: str = ""
    #: Environment variable of the executors that holds the service's key.
    key_env: str = "MODEL_API_KEY"
    #: Tasks that call, and calls of each that are under way at a time.
    concurrency: int = 6
    calls_per_task: int = 1
    #: Write the indexes anew from what is there.
    reindex: bool = False
    #: Folders of single stages; below base_dir where not given.
    threads_dir: str = ""
    chunks_dir: str = ""
    summaries_dir: str = ""
    thread_summaries_dir: str = ""
    memory_dir: str = ""

    def validate(self) -> None:
        for name in ("archive", "base_dir"):
            if not getattr(self, name):
                raise ValueError(f"missing {name}")
        for name in ("target_turns", "max_shard_bytes", "concurrency", "calls_per_task"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be > 0")
        for name in ("batch_size", "max_chunks", "max_chunks_per_thread", "glossary_max_terms", "glossary_min_count", "index_summary_bytes", "index_tags_max", "index_terms_max"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must be >= 0")
        if self.from_stage and self.only_stage:
            raise ValueError("use only one of from_stage and only_stage")
        if self.provider not in ("offline", "http") or self.decider not in ("stride", "model"):
            raise ValueError(f"unknown provider {self.provider} or decider {self.decider}")
        if self.provider == "http" and not (self.provider_url and self.model):
            raise ValueError("provider http needs provider_url and model")
        if self.mode not in MODES:
            raise ValueError(f"unknown mode {self.mode}")
        if self.only_stage and self.only_stage not in STAGES:
            raise ValueError(f"unknown stage {self.only_stage}")

    def path(self, name: str) -> str:
        """Where a table or file of the run lies."""
        return f"{(getattr(self, FOLDERS.get(name.split('/')[0], ''), '') or self.base_dir).rstrip('/')}/{name}"

    def stages(self) -> list[str]:
        """The stages to run; an unknown from_stage means all."""
        if self.only_stage:
            return [self.only_stage]
        return list(STAGES[STAGES.index(self.from_stage) :] if self.from_stage in STAGES else STAGES)

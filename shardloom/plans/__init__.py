"""Queries over the given tables, each with its SQL twin where SQL can say it."""

from importlib import import_module

MODULES = (
    "corpus_queries",
    "vocabulary_queries",
    "chat_queries",
    "mixture_queries",
    "evaluation_queries",
    "report_queries",
    "stream_queries",
)


def load_all() -> None:
    for name in MODULES:
        import_module(f"shardloom.plans.{name}")

"""Tokenizer files in the Python workers: loaded once a process, one thread."""

from __future__ import annotations

import ctypes
import gc
import os
import sys
import types

#: Where a worker keeps what it has loaded; functions that are shipped by value have no module of their own there.
_STORE = "_skyweft_worker_store"


def once(key, make):
    """make() the first time this process asks for key."""
    store = sys.modules.setdefault(_STORE, types.ModuleType(_STORE)).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


def release() -> None:
    """Gives back to the system what a task has freed: workers outlive tasks, and a few idle ones would hold on to it together."""
    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tokenizer_path(name: str) -> str:
    """The path of a public vocabulary file; any other path may be given to the operators as well."""
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    def make():
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        found = Tokenizer.from_file(path)
        found.no_truncation()
        found.no_padding()
        return found

    return once(("tokenizers", path), make)


def load_pieces(path: str):
    def make():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)

    return once(("sentencepiece", path), make)

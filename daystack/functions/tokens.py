"""Token counts and cuts by a tokenizer, for columns of text.

A tokenizer is named by the path of its JSON file, which every machine must have, or as ``tiktoken:`` and
a model's name.  Without a name, or where the driver cannot load the one named, counts follow the rule of
four characters a token (``text.token_count``), which stays in the JVM.  With one, texts go to Python in
Arrow batches and are encoded a batch at a time; a worker loads it once.
"""

from __future__ import annotations

import sys
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that stand for a token where nothing else is known.
PER_TOKEN = 4


class _File:
    """A tokenizer of a JSON file; cuts end where the last token's text ends, so that what is left is as it was."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        self.own.no_truncation()
        self.own.no_padding()

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.own.encode_batch(texts, add_special_tokens=False)]

    def cuts(self, texts: list[str], most: int) -> list[str]:
        found = self.own.encode_batch(texts, add_special_tokens=False)
        return [t if len(e.ids) <= most else t[: e.offsets[most - 1][1] if most else 0] for t, e in zip(texts, found, strict=True)]


class _Model:
    """The encoding of a model; a text that it refuses (one that spells a special token) goes by the rule."""

    def __init__(self, model: str) -> None:
        import tiktoken

        self.own = tiktoken.encoding_for_model(model)

    def _ids(self, text: str) -> list[int] | None:
        try:
            return self.own.encode(text)
        except ValueError:
            return None

    def counts(self, texts: list[str]) -> list[int]:
        return [len(t) // PER_TOKEN if (ids := self._ids(t)) is None else len(ids) for t in texts]

    def cuts(self, texts: list[str], most: int) -> list[str]:
        out = []
        for t in texts:
            ids = self._ids(t)
            out.append(t[: PER_TOKEN * most] if ids is None else t if len(ids) <= most else self.own.decode(ids[:most]))
        return out


@lru_cache(maxsize=8)
def loaded(name: str) -> _File | _Model:
    return _Model(name.removeprefix("tiktoken:")) if name.startswith("tiktoken:") else _File(name)


@lru_cache(maxsize=8)
def usable(name: str) -> bool:
    """Whether the driver can load it; asked once a name, so that one plan never mixes two ways to count."""
    try:
        loaded(name)
    except Exception as e:  # a missing module, file or model, or a file that is no tokenizer
        print(f"tokens are counted by the rule, as {name} cannot be loaded: {e}", file=sys.stderr)
        return False
    return True


def count(text: Column, name: str) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(loaded(name).counts(texts.tolist()), dtype="int64")

    return run(F.coalesce(text, F.lit("")))


def cut(text: Column, most: int, name: str) -> Column:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(loaded(name).cuts(texts.tolist(), most), dtype=object)

    return run(F.coalesce(text, F.lit("")))

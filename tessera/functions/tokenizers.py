"""Tokenizers as job parameters: how text becomes tokens and tokens text.

A tokenizer is a regular expression whose matches, left to right, are the
tokens, and a rule that joins them again.  Both are column expressions, so
every job that takes a tokenizer stays inside the JVM, and the same split is
there for SQL after ``register_sql``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tessera.functions import text as T


def _sql_string(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class Tokenizer:
    """``pattern`` finds the tokens, ``joined`` turns an array of tokens into
    text.  ``name`` (letters, digits, underscores) is its name in SQL."""
    name: str
    pattern: str
    joined: Callable[[Column], Column]

    def __post_init__(self):
        if not self.name.isidentifier():
            raise ValueError(f"not a name for SQL: {self.name!r}")

    def tokens(self, text: Column | str) -> Column:
        """ARRAY<STRING>; null for null text."""
        return F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(self.pattern), 0)

    def text(self, tokens: Column | str) -> Column:
        return self.joined(F.col(tokens) if isinstance(tokens, str) else tokens)


def _by(glue: str) -> Callable[[Column], Column]:
    return lambda tokens: F.array_join(tokens, glue)


#: Words and punctuation marks, marks glued to the word before them.
WORDS = Tokenizer("words", T.WORD_TOKEN_PATTERN, T.decode_tokens)
#: Runs of anything but white space, joined by one space.
SPACED = Tokenizer("spaced", f"[^{T.JAVA_SPACE[1:-1]}]+", _by(" "))
#: Code points; decoding gives back the very text.
CHARACTERS = Tokenizer("characters", "(?s).", _by(""))


def register_sql(spark: SparkSession, *tokenizers: Tokenizer) -> None:
    """Temporary SQL functions ``tokens_<name>(text) -> ARRAY<STRING>``, replaced by their
    body at analysis (no Python).  All three of this module by default."""
    for t in tokenizers or (WORDS, SPACED, CHARACTERS):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION tokens_{t.name}(txt STRING) RETURNS ARRAY<STRING> "
                  f"RETURN regexp_extract_all(txt, {_sql_string(t.pattern)}, 0)")

"""Column expressions for word tokens and id sequences (all JVM-side)."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def _space_class() -> str:
    """Regex class of every code point Python's ``str.isspace`` accepts.

    Java's and RE2's ``\\s`` are ASCII-only, so the set is spelled out; it is
    derived from the rule, not typed in.  ``\\x{h}`` escapes work in both Java
    and RE2 (DuckDB) patterns.
    """
    points = [c for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    ranges, start, prev = [], points[0], points[0]
    for c in points[1:]:
        if c == prev + 1:
            prev = c
            continue
        ranges.append((start, prev))
        start = prev = c
    ranges.append((start, prev))
    parts = [f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges]
    return "[" + "".join(parts) + "]"


SPACE = _space_class()
# The same set for Java regex: Character.isWhitespace plus the four code
# points Python also counts (next line, no-break space, figure space, narrow
# no-break space).  Equal to SPACE on every code point (tested), and unlike the
# long explicit class it lets the regex scale across executor threads.
JAVA_SPACE = r"[\p{javaWhitespace}\x{85}\x{a0}\x{2007}\x{202f}]"

# Fixed values that must equal the studied tokenizer: the punctuation set that
# splits words (kept as tokens), and the two-character dash that does too.
PUNCT_CHARS = ",.:;?_!\"()'"
DOUBLE_DASH = "--"
# Characters that decode glues to the preceding word (no space before them).
DECODE_GLUE_CHARS = ",.?!\"()'"
# Special tokens appended after the sorted vocabulary, in this order.
END_OF_TEXT = "<|endoftext|>"
UNKNOWN = "<|unk|>"
# Padding id of the byte-pair vocabulary (also its end-of-text id).
PAD_ID = 50256


def _cls(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\]^-[" else c for c in chars) + "]"


PUNCT = _cls(PUNCT_CHARS)
_WORD_CHAR = _cls(PUNCT_CHARS)[:-1].replace("[", "[^", 1) + JAVA_SPACE[1:-1] + "\\-]"

# One regex pass yields the tokens in order: a punctuation mark, a double dash,
# or a maximal run of other non-space characters in which a single '-' may occur
# only when it does not start a '--'.  Equals split-on-delimiters-and-keep-them,
# strip, drop blanks.
WORD_TOKEN_PATTERN = f"{PUNCT}|--|(?:{_WORD_CHAR}|-(?!-))+"

# Same split in a form RE2 can run (no look-ahead): wrap every delimiter in \x01.
SPLIT_PATTERN = f"({PUNCT}|--|{SPACE})"


def word_tokens(text: Column | str) -> Column:
    """ARRAY<STRING> of word/punctuation tokens of ``text``."""
    if isinstance(text, str):
        text = F.col(text)
    return F.regexp_extract_all(text, F.lit(WORD_TOKEN_PATTERN), 0)


def decode_tokens(tokens: Column) -> Column:
    """Join tokens with one space, then remove the space before , . ? ! " ( ) '."""
    joined = F.array_join(tokens, " ")
    return F.regexp_replace(joined, F.lit(f"{JAVA_SPACE}+({_cls(DECODE_GLUE_CHARS)})"), F.lit("$1"))


def truncate(ids: Column, length: int | Column) -> Column:
    length = F.lit(length) if isinstance(length, int) else length
    return F.slice(ids, F.lit(1), length)


def pad_right(ids: Column, length: int | Column, pad_id: int = PAD_ID) -> Column:
    """Pad to ``length``; never cuts (a negative pad count adds nothing)."""
    length = F.lit(length) if isinstance(length, int) else length
    missing = F.greatest(length - F.size(ids), F.lit(0))
    return F.concat(ids, F.array_repeat(F.lit(pad_id), missing))


def pad_truncate(ids: Column, length: int | Column, pad_id: int = PAD_ID) -> Column:
    return pad_right(truncate(ids, length), length, pad_id)


def left_crop(ids: Column, context: int) -> Column:
    """Keep the last ``context`` ids."""
    start = F.greatest(F.size(ids) - F.lit(context), F.lit(0)) + F.lit(1)
    return F.slice(ids, start, F.lit(context))


def sliding_windows(ids: Column, length: int, stride: int) -> Column:
    """ARRAY<STRUCT<start, input_ids, target_ids>>: full windows only, starts
    0, S, 2S, ... < n-L; the target is the input shifted by one."""
    n = F.size(ids)
    starts = F.when(n > F.lit(length),
                    F.sequence(F.lit(0), n - F.lit(length + 1), F.lit(stride))
                    ).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(
        i.alias("start"),
        F.slice(ids, i + 1, F.lit(length)).alias("input_ids"),
        F.slice(ids, i + 2, F.lit(length)).alias("target_ids")))


def growing_contexts(ids: Column, skip: int, context: int) -> Column:
    """ARRAY<STRUCT<i, context_ids, target>> for i in 1..context after skipping
    ``skip`` ids: ids[skip:skip+i] -> ids[skip+i]. Pairs past the end are absent."""
    n = F.size(ids)
    avail = F.least(F.lit(context), n - F.lit(skip) - F.lit(1))
    steps = F.when(avail >= 1, F.sequence(F.lit(1), avail)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: F.struct(
        i.alias("i"),
        F.slice(ids, F.lit(skip + 1), i).alias("context_ids"),
        F.element_at(ids, i + F.lit(skip + 1)).alias("target")))


def ids_text(ids: Column) -> Column:
    """Arrays leave the engine as space-separated text (oracle-comparable)."""
    return F.array_join(F.transform(ids, lambda x: x.cast("string")), " ")

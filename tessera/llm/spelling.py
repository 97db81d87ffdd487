"""Spelling variants: words one edit apart, found by pivotal bigrams.

A word's bigrams (each with its place) are ordered by how many words hold the
bigram, rarest first.  Its prefix is the first three; its pivots are two of
them that do not overlap, chosen by dynamic programming for the least number
of words they lead to.  One edit destroys at most one of the two pivots, and
the surviving one stands in the prefix of the other word, unless that word's
prefix ends earlier in the order, in which case the roles swap.  So it is
enough to look up every word's pivots among the prefixes of words whose prefix
ends no earlier.

Position limits: the one edit is wholly behind a surviving pivot, which then
has the same place and the same letters before it, or wholly before it, and
then place and letters count from the end.  A pivot is therefore looked up
together with what is before it, and with what is behind it, for words of at
most one code point more or less.  What is found is verified by the edit distance,
after a look at the parities of its letters' numbers (one word of bits): one edit
changes two of them at most.

The result is the same whatever the order of rows and partitions.  Null texts
have no words; a null doc_id counts as the empty text; repeated rows count
again; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import batches_of, id_text, released, spread, stored

#: Letters of a word, in UTF-8 after A-Z are lower-cased: a-z and U+00C0 to U+00FF.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: One run in so many loses a code point.
SLIP = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3
#: A form occurs at least so many times as often as its variant.
MORE = 2
#: Distinct words a task holds before it passes their counts on.
HELD = 200_000
#: Edits, and the bigrams of a prefix: each edit touches at most two.
EDITS = 1
PREFIX = 2 * EDITS + 1


# ---------------------------------------------------------------- words
def slip(run: bytes, crc: int) -> bytes:
    """The run without its code point at ``crc`` modulo its length."""
    text = run.decode()
    at = crc % len(text)
    return (text[:at] + text[at + 1:]).encode()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all documents: counted per document and per task, then by word."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    @released
    def run(batches):
        def rows() -> Iterator[tuple[str, int]]:
            held: Counter[bytes] = Counter()
            for b in batches:
                ids, texts = b.column(0), b.column(1)
                for i in range(b.num_rows):
                    doc = ids[i].as_py()
                    seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for w, n in Counter(_RUN.findall(texts[i].as_py().encode().lower())).items():
                        crc = zlib.crc32(w, seed)  # of "<doc_id>:<run>"
                        held[w if crc % SLIP else slip(w, crc)] += n
                    if len(held) >= HELD:
                        yield from ((w.decode(), n) for w, n in held.items())
                        held.clear()
            yield from ((w.decode(), n) for w, n in held.items())
        return batches_of(rows(), schema)

    counted = spread(id_text(docs, id_col, text_col)).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- pivots
def bigram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """bigram -> (place in the order, words that hold it).  At most 90 squared
    entries: the letters are 26 and 64."""
    grams = words.select(F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2))))).alias("gram"))
    rows = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).collect()
    return {g: (i, df) for i, (df, g) in enumerate(sorted((r["df"], r["gram"]) for r in rows))}


def prefix_of(word: str, ranks: dict[str, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(rank, place, df) of the word's first bigrams in the order."""
    grams = ((*ranks[word[p:p + 2]], p) for p in range(len(word) - 1))
    return [(rank, p, df) for rank, df, p in sorted(grams, key=lambda g: (g[0], g[2]))[:PREFIX]]


def pivots_of(prefix: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """EDITS + 1 bigrams of the prefix, no two overlapping, with the least sum
    of words that hold them: best[j] = cheapest choice of j bigrams so far, by place."""
    by_place = sorted(prefix, key=lambda g: g[1])
    # choices[i][j]: cheapest j of the first i bigrams
    choices: list[list] = [[(0, ())] + [None] * (EDITS + 1)]
    for i, g in enumerate(by_place):
        clear = i  # bigrams before this one that do not overlap it
        while clear and by_place[clear - 1][1] > g[1] - 2:
            clear -= 1
        row = list(choices[-1])
        for j in range(1, EDITS + 2):
            before = choices[clear][j - 1]
            if before is not None:
                taken = (before[0] + g[2], (*before[1], g))
                if row[j] is None or taken < row[j]:
                    row[j] = taken
        choices.append(row)
    best = choices[-1][EDITS + 1]
    assert best is not None  # 2 * EDITS + 1 places always hold EDITS + 1 that do not overlap
    return list(best[1])


def parities(word: str) -> int:
    """Bit k: whether the word holds the letters of slot k an odd number of times."""
    bits = 0
    for c in word:
        bits ^= 1 << ord(c) % 63  # a-z have a slot each; the sign bit is not used
    return bits


_KEYS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("size", pa.int32()), ("last", pa.int32()),
                   ("odd", pa.int64()), ("key", pa.string()), ("pivot", pa.bool_())])


def keys(words: DataFrame, ranks: dict[str, tuple[int, int]]) -> DataFrame:
    """(word, n, size, last, odd, key, pivot): a word's prefix bigrams, each with the
    letters before it and with the letters behind it; ``odd``: the word's
    parities; ``pivot`` marks pivots."""
    @released
    def run(batches):
        def rows():
            for b in batches:
                for word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    prefix = prefix_of(word, ranks)
                    pivots = pivots_of(prefix)
                    odd = parities(word)
                    for g in prefix:
                        p = g[1]
                        for key in ("<" + word[:p + 2], ">" + word[p:]):
                            yield word, n, len(word), prefix[-1][0], odd, key, g in pivots
        return batches_of(rows(), _KEYS)

    return words.select("word", "n").mapInArrow(
        run, "word string, n long, size int, last int, odd long, key string, pivot boolean")


def near_pairs(words: DataFrame, ranks: dict[str, tuple[int, int]]) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words one edit apart."""
    index = stored(keys(words, ranks).withColumn("h", F.xxhash64("key")).drop("key"), "prefixes")
    probes = index.where("pivot").select("word", "n", "h", F.col("last").alias("ends"), F.col("odd").alias("odds"),
                                         F.explode(F.array(*[F.col("size") + d for d in (-1, 0, 1)])).alias("size"))
    lists = index.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "last", "odd", "h", "size")
    met = probes.join(lists, ["h", "size"]).where(
        (F.bit_count(F.col("odds").bitwiseXOR(F.col("odd"))) <= 2 * EDITS)
        & (F.col("ends") <= F.col("last")) & (F.col("word") != F.col("near"))
        & (F.levenshtein("word", "near", EDITS) == EDITS))
    one = met.select(F.when(F.col("word") < F.col("near"), F.struct("word", "n", "near", "near_n")).otherwise(
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                 F.col("n").alias("near_n"))).alias("p")).select("p.*").distinct()
    return one.select(F.explode(F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"),
                 F.col("n").alias("near_n")))).alias("p")).select("p.*")


# ---------------------------------------------------------------- groups
def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form.  A form occurs at least MORE
    times as often, so a way to a root has fewer than 64 steps, and pointers
    that double each round reach its end in six."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(6):
        nxt = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stored(at.join(nxt, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                        F.col("further").isNotNull().alias("moved")), "roots")
        if at.where("moved").isEmpty():
            break
        at = at.drop("moved")
    return at.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row per word."""
    words = stored(word_counts(docs, id_col, text_col).where(
        (F.col("n") >= LEAST_COUNT) & (F.length("word") >= LEAST_LENGTH)), "words")
    pairs = near_pairs(words, bigram_ranks(words))
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("n").alias("n"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    often = -F.col("top.less") >= MORE * F.col("n")
    near = stored(best.select("word", "n_near", F.when(often, F.col("top.near")).alias("form"),
                              F.when(often, -F.col("top.less")).alias("form_n")), "near")
    return (words.join(near, "word", "left").join(roots(near.where(F.col("form").isNotNull())), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))

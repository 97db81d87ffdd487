"""Word tokens, vocabulary, encode and decode as distributed jobs.

Long form ``(id, pos, token)`` is the distributed representation; arrays are
only built per document (bounded by that document's own text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.tokenizers import WORDS, Tokenizer
from tessera.operators import blocks as BL
from tessera.operators.lookup import salted_lookup
from tessera.operators.ranking import global_rank
from tessera.session import materialize


def tokenize(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             tokens_col: str = "tokens", tokenizer: Tokenizer = WORDS) -> DataFrame:
    """(id, tokens ARRAY<STRING>) — map-only, no shuffle."""
    return docs.select(id_col, tokenizer.tokens(text_col).alias(tokens_col))


def word_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                tokenizer: Tokenizer = WORDS) -> DataFrame:
    """(id, pos BIGINT, token): one row per token, positions from 0.

    ``posexplode_outer`` + a filter on the generated position: a plain
    ``posexplode`` makes the optimizer infer ``size(tokens) > 0`` and push it
    (the whole regex) below any repartition, i.e. evaluate it twice, the first
    time before the input is spread over the cores."""
    return (tokenize(docs, id_col, text_col, tokenizer=tokenizer)
            .select(id_col, F.posexplode_outer("tokens").alias("pos", "token"))
            .where(F.col("pos").isNotNull())
            .withColumn("pos", F.col("pos").cast("bigint")))


def corpus_stats(docs: DataFrame, text_col: str = "text", tokenizer: Tokenizer = WORDS) -> DataFrame:
    """n_docs, n_chars, n_tokens, vocab_size (exact distinct count) in one
    aggregate: per-document values are counted on the document's first token
    row (``posexplode_outer`` keeps documents without tokens)."""
    rows = docs.select(F.length(text_col).cast("bigint").alias("c"),
                       F.posexplode_outer(tokenizer.tokens(text_col)).alias("pos", "token"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    return rows.agg(
        F.count(F.when(first, 1)).cast("bigint").alias("n_docs"),
        F.coalesce(F.sum(F.when(first, F.col("c"))), F.lit(0)).cast("bigint").alias("n_chars"),
        F.count("token").cast("bigint").alias("n_tokens"),
        F.countDistinct("token").cast("bigint").alias("vocab_size"))


def token_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counted: bool = False,
                 tokenizer: Tokenizer = WORDS) -> BL.Blocks:
    """The tokens of ``docs``, tokenized once and stored in blocks."""
    return BL.pack(tokenize(docs, id_col, text_col, tokenizer=tokenizer), id_col, counted=counted)


def vocabulary(tokens: DataFrame | BL.Blocks, token_col: str = "token") -> DataFrame:
    """(token, token_id, freq): distinct tokens in code-point order, dense ids
    from 0.  Distinct is a partial/final aggregate (hot tokens collapse
    map-side); ids come from the distributed rank."""
    if isinstance(tokens, BL.Blocks):
        counts = tokens.words().groupBy("token").agg(F.sum("freq").alias("freq"))
    else:
        counts = (tokens.groupBy(F.col(token_col).alias("token"))
                  .agg(F.count(F.lit(1)).alias("freq")))
    return global_rank(counts, ["token"], "token_id").select("token", "token_id", "freq")


def with_specials(vocab: DataFrame) -> DataFrame:
    """Append end-of-text and unknown after the sorted tokens: ids |V|, |V|+1.
    The two rows are derived from one aggregate over the vocabulary."""
    n = vocab.agg(F.coalesce(F.max("token_id") + 1, F.lit(0).cast("bigint")).alias("n"))
    specials = n.select(F.explode(F.array(
        F.struct(F.lit(T.END_OF_TEXT).alias("token"), F.col("n").alias("token_id")),
        F.struct(F.lit(T.UNKNOWN).alias("token"), (F.col("n") + 1).alias("token_id")))).alias("s"))
    specials = specials.select("s.token", "s.token_id", F.lit(0).cast("bigint").alias("freq"))
    return vocab.select("token", "token_id", "freq").unionByName(specials)


def encode_long(tokens: DataFrame, vocab: DataFrame, row_cols: list[str],
                unknown: str = "keep") -> DataFrame:
    """Long-form encode: the token rows (identified by ``row_cols``) with token_id.

    unknown = "keep"  -> token_id null for tokens missing from the vocabulary
              "unk"   -> id of <|unk|> (vocabulary must hold the specials)
    """
    out = salted_lookup(tokens, vocab.select("token", "token_id", "freq"), "token",
                        row_cols, how="left")
    if unknown == "unk":
        # one scalar read on the driver (a number, not data)
        unk = vocab.where(F.col("token") == T.UNKNOWN).agg(F.max("token_id")).first()[0]
        out = out.withColumn("token_id", F.when(F.col("token").isNotNull(),
                                                F.coalesce("token_id", F.lit(unk).cast("bigint"))))
    return out


def encode_counts(blocks: BL.Blocks, vocab: DataFrame) -> DataFrame:
    """(id, token_id, c) of the distinct tokens of each document; ``vocab`` has one row a token."""
    return BL.counted_rows(blocks, vocab.select("token", "token_id"), F.col("token_id"), "token_id").withColumnRenamed("_c", "c")


def unknown_tokens(tokens: DataFrame, vocab: DataFrame) -> DataFrame:
    """Strict-mode report: (token, n) of tokens that have no id (left anti join
    after a map-side pre-aggregation of the stream)."""
    counted = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(vocab.select("token"), "token", "left_anti")


def gather(long_df: DataFrame, id_col: str, pos_col: str, value_col: str,
           out_col: str, ids: DataFrame | None = None) -> DataFrame:
    """Ordered gather of one document's values into an array (the group is
    bounded by the document's own length).  ``ids`` keeps documents with no
    values (empty array)."""
    g = (long_df.groupBy(id_col)
         .agg(F.sort_array(F.collect_list(F.struct(F.col(pos_col).alias("p"),
                                                    F.col(value_col).alias("v")))).alias("_s"))
         .select(id_col, F.transform("_s", lambda x: x["v"]).alias(out_col)))
    if ids is not None:
        g = (ids.select(id_col).join(g, id_col, "left")
             .withColumn(out_col, F.coalesce(F.col(out_col), F.array().cast(g.schema[out_col].dataType))))
    return g


def encode(docs: DataFrame | BL.Blocks, vocab: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           unknown: str = "unk", tokens_col: str | None = None, tokenizer: Tokenizer = WORDS) -> DataFrame:
    """(id, ids ARRAY<BIGINT>), a row per id.  unknown="strict" fails the job when a token is
    missing (like the strict tokenizer); "unk" maps it to <|unk|>; "keep" gives
    null.  ``tokens_col`` names token arrays that are already there; ``docs``
    may be their blocks.  A document without tokens has no ids.  Rows that
    share an id are one: their ids by place, then by id; so are the ids of a
    token that the vocabulary holds twice."""
    if isinstance(docs, BL.Blocks):
        blocks = docs
    else:
        tokens = docs if tokens_col else tokenize(docs, id_col, text_col, tokenizer=tokenizer)
        blocks = BL.pack(tokens, id_col, tokens_col or "tokens")
    table = vocab.groupBy("token").agg(F.sort_array(F.collect_list("token_id")).alias("_all"))
    missing = F.lit(None).cast("bigint")
    if unknown == "unk":
        # one scalar read on the driver (a number, not data)
        missing = F.lit(vocab.where(F.col("token") == T.UNKNOWN).agg(F.max("token_id")).first()[0]).cast("bigint")
    elif unknown == "strict":
        missing = F.raise_error(F.concat(F.lit("unknown token: "), F.col("token"))).cast("bigint")
    first = F.when(F.col("_all").isNull(), missing).otherwise(F.get("_all", F.lit(0)))
    value = F.struct(first.alias("id"), F.when(F.size("_all") > 1, F.col("_all")).alias("all"))
    several = F.exists("codes", lambda c: c["all"].isNotNull())
    answers = BL.answered(blocks, table, value).select(
        "ids", "slots", F.transform("codes", lambda c: c["id"]).alias("one"),
        F.when(several, F.transform("codes", lambda c: F.coalesce(c["all"], F.array(c["id"])))).alias("many"))
    kind = blocks.table.schema["ids"].dataType.elementType.simpleString()
    return _one_row_per_id(BL.encoded(answers, blocks.id_col, kind), blocks)


def _one_row_per_id(encoded: DataFrame, blocks: BL.Blocks) -> DataFrame:
    """Rows of an id that occurs more than once become one, by (place, id)."""
    id_col = blocks.id_col
    again = blocks.ids().groupBy(id_col).count().where("count > 1").select(F.col(id_col).alias("_again"))
    alone = encoded.select(id_col, "ids")
    if again.isEmpty():
        return alone
    same = F.col(id_col).eqNullSafe(F.col("_again"))
    rows = encoded.join(again, same, "left_semi").select(id_col, "at", F.posexplode_outer("ids").alias("pos", "token_id"))
    place = F.coalesce(F.get("at", F.col("pos")), "pos")
    here = F.when(F.col("pos").isNotNull(), F.struct(place.alias("p"), F.col("token_id").alias("v")))
    merged = (rows.groupBy(id_col).agg(F.sort_array(F.collect_list(here)).alias("_s"))
              .select(id_col, F.transform("_s", lambda x: x["v"]).alias("ids")))
    return alone.join(again, same, "left_anti").unionByName(merged)


def decode(encoded: DataFrame, vocab: DataFrame, id_col: str = "item_id",
           ids_col: str = "ids", one_line: bool = False, tokenizer: Tokenizer = WORDS) -> DataFrame:
    """(id, text): ids -> tokens (salted join on token_id) -> ordered join;
    ``one_line`` turns line breaks of the decoded text into spaces.  Hot
    ids are those of the stream itself (the corpus counts of the vocabulary
    say nothing about its special tokens)."""
    long_ = materialize(encoded.select(id_col, F.posexplode_outer(ids_col).alias("pos", "token_id")))
    seen = long_.where("token_id is not null").groupBy("token_id").agg(F.count(F.lit(1)).alias("freq"))
    dic = materialize(seen.join(vocab.select("token_id", "token"), "token_id"))  # the stream's own part of it
    looked = salted_lookup(long_, dic, "token_id", [id_col, "pos"], how="left")
    here = F.when(F.col("pos").isNotNull(), F.struct(F.col("pos").alias("p"), F.col("token").alias("v")))
    toks = (looked.groupBy(id_col).agg(F.sort_array(F.collect_list(here)).alias("_s"))
            .select(id_col, F.transform("_s", lambda x: x["v"]).alias("_toks")))
    text = tokenizer.text("_toks")
    return toks.select(id_col, (F.replace(text, F.lit("\n"), F.lit(" ")) if one_line else text).alias("text"))

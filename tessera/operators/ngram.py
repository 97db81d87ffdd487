"""Bigram counts language model: counts, held-out loss / perplexity, greedy
and sampled generation.

The studied code trains a network on next-token prediction; the data-side
equivalent that a Spark job can state exactly is a counts model:
P(x | c) = (n(c, x) + k) / (n(c) + k |V|)  (add-k smoothing, V = training
vocabulary plus <|unk|>).  Generation uses the unsmoothed counts:
greedy = the most frequent continuation (ties -> lowest token in code-point
order = lowest vocabulary id), sampled = top-k (ties kept) then temperature
then an inverse-CDF draw with a seeded uniform.  An unseen context falls back
to vocabulary id 0 (all logits equal -> argmax index 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import text as T
from tessera.operators.lookup import hot_key_hashes, salted_lookup
from tessera.operators.ranking import rank_within_groups
from tessera.session import materialize, store


def bigrams(token_arrays: DataFrame, id_col: str, tokens_col: str = "tokens") -> DataFrame:
    """(id, pos, context, next) for consecutive tokens inside one document."""
    m = F.greatest(F.size(tokens_col) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(tokens_col, F.lit(1), m).alias("context"),
                         F.slice(tokens_col, F.lit(2), m).alias("next"))
    # outer generator + filter on its output: no inferred filter is pushed
    # below the input spreading (see tokens.word_tokens)
    return (token_arrays.select(id_col, F.posexplode_outer(pairs).alias("pos", "p"))
            .where(F.col("pos").isNotNull())
            .select(id_col, F.col("pos").cast("bigint").alias("pos"),
                    F.col("p.context").alias("context"), F.col("p.next").alias("next")))


def bigram_counts(pairs: DataFrame) -> DataFrame:
    """(context, next, n): partial/final aggregation (hot pairs combine map-side)."""
    return pairs.groupBy("context", "next").agg(F.count(F.lit(1)).alias("n"))


def context_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("context").agg(F.sum("n").alias("n_ctx"))


def nll_per_target(eval_pairs: DataFrame, counts: DataFrame, vocab_size: int, id_col: str,
                   k: float = 1.0) -> DataFrame:
    """-ln P(next | context) for every held-out pair.  Unknown tokens behave as
    <|unk|>: a pair or context never seen in training has count 0."""
    pair_tab = counts.select("context", "next", "n", F.col("n").alias("freq"))
    ctx_tab = store(context_totals(counts)).withColumn("freq", F.col("n_ctx"))
    x = salted_lookup(eval_pairs, pair_tab, ["context", "next"], [id_col, "pos"], how="left", unique=True)
    x = salted_lookup(x, ctx_tab, "context", [id_col, "pos"], how="left", unique=True)
    p = (F.coalesce(F.col("n"), F.lit(0)) + F.lit(k)) / (F.coalesce(F.col("n_ctx"), F.lit(0)) + F.lit(k * vocab_size))
    return x.select(id_col, "pos", (-F.log(p)).alias("nll"))


def per_document_loss(nll: DataFrame, id_col: str) -> DataFrame:
    """(id, n_targets, loss, perplexity): one document = one batch."""
    return (nll.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_targets"), F.avg("nll").alias("loss"))
            .withColumn("perplexity", F.exp("loss")))


def corpus_loss(per_doc: DataFrame) -> DataFrame:
    """Mean over batches (documents) of the in-batch mean: n_docs, n_targets,
    loss, perplexity."""
    return (per_doc.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_targets").alias("n_targets"),
                        F.avg("loss").alias("loss"))
            .withColumn("perplexity", F.exp("loss")))


def greedy_table(counts: DataFrame) -> DataFrame:
    """(context, best, freq): the most frequent continuation, ties -> lowest
    token.  ``min(struct(-n, next))`` is a partial/final aggregate."""
    best = counts.groupBy("context").agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col("next"))).alias("b"),
                                         F.sum("n").alias("freq"))
    return best.select("context", F.col("b.next").alias("best"), "freq")


def generate_greedy(prompts: DataFrame, counts: DataFrame, fallback: str, steps: int,
                    id_col: str = "item_id", tokens_col: str = "tokens",
                    stop_token: str | None = None) -> DataFrame:
    """(id, new_tokens ARRAY<STRING>): ``steps`` greedy steps from the last
    prompt token, up to (without) ``stop_token``.  Each step is one salted
    lookup of (id, last token)."""
    table = materialize(greedy_table(counts))
    hot = hot_key_hashes(table, ["context"], "freq", 256, unique=True)
    state = prompts.select(id_col, F.try_element_at(F.col(tokens_col), F.lit(-1)).alias("context"),
                           F.array().cast("array<string>").alias("new_tokens"))
    for _ in range(steps):
        looked = salted_lookup(state, table, "context", [id_col], how="left", hot=hot)
        nxt = F.coalesce(F.col("best"), F.lit(fallback))
        state = looked.select(id_col, nxt.alias("context"),
                              F.concat(F.col("new_tokens"), F.array(nxt)).alias("new_tokens"))
    if stop_token is not None:  # what follows the stop token was never generated
        at = F.array_position("new_tokens", stop_token)
        state = state.withColumn("new_tokens", F.when(at > 0, F.slice("new_tokens", F.lit(1), (at - 1).cast("int")))
                                 .otherwise(F.col("new_tokens")))
    return state.select(id_col, "new_tokens")


def sampling_levels(counts: DataFrame, top_k: int, temperature: float) -> DataFrame:
    """Per context, the count levels a draw can land on.

    All continuations with the same count have the same probability, so the
    distribution is described by (context, n, m = #continuations with count n).
    The number of distinct counts of a context is at most sqrt(2 * n(context)),
    so windows per context over this table are bounded even for a hot context.
    Top-k with ties kept: keep levels n >= the k-th largest count.
    Weight of one continuation at level n: exp(ln(n) / T) (softmax of the log
    counts divided by T; the normaliser cancels)."""
    hist = counts.groupBy("context", "n").agg(F.count(F.lit(1)).alias("m"))
    desc = Window.partitionBy("context").orderBy(F.desc("n"))
    hist = hist.withColumn("_at_least", F.sum("m").over(desc.rowsBetween(Window.unboundedPreceding, 0)))
    # threshold: largest n whose "at least n" count reaches k; else the smallest n
    thr = hist.groupBy("context").agg(
        F.max(F.when(F.col("_at_least") >= top_k, F.col("n"))).alias("_t"), F.min("n").alias("_lo"))
    kept = (hist.join(thr, "context")
            .where(F.col("n") >= F.coalesce(F.col("_t"), F.col("_lo")))
            .withColumn("w", F.exp(F.log(F.col("n").cast("double")) / F.lit(float(temperature)))))
    level_w = F.col("m") * F.col("w")
    kept = kept.withColumn("_end", F.sum(level_w).over(desc.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("context")
    return (kept.withColumn("_before", F.coalesce(F.lag("_end").over(desc), F.lit(0.0)))
                .withColumn("_total", F.max("_end").over(whole))
                .withColumn("freq", F.sum(F.col("m") * F.col("n")).over(whole))
                .select("context", "n", "m", "w", "_before", "_end", "_total", "freq"))


def ranked_continuations(counts: DataFrame) -> DataFrame:
    """(context, n, j, next): j = 0-based position of ``next`` among the
    continuations of ``context`` that have count n, in code-point order.
    Distributed in-group rank, so a huge tie group is not one task."""
    ranked = rank_within_groups(counts.select("context", "n", "next"), ["context", "n"], ["next"], "j")
    return ranked.withColumn("freq", F.col("n"))


def draw(state: DataFrame, levels: DataFrame, ranked: DataFrame, fallback: str, seed: int,
         step: int, id_col: str, hot_levels: list[int] | None = None,
         hot_ranked: list[int] | None = None) -> DataFrame:
    """One inverse-CDF draw per row of ``state`` (id, context, new_tokens,
    done): adds ``drawn``.  u = seeded uniform of (seed, id, step); the chosen
    level is the first whose cumulative weight reaches u * total; inside the
    level the continuation index is ceil((u*total - before) / w) - 1.

    The state is read once (left joins carry it forward), so chaining steps
    grows the plan linearly; a context without levels draws ``fallback``."""
    u = A.uniform_from_key(F.lit(seed), F.col(id_col), F.lit(step))
    s = state.withColumn("_u", u)
    cand = salted_lookup(s, levels, "context", [id_col], how="left", hot=hot_levels)
    reached = F.col("_end") >= F.col("_u") * F.col("_total")
    level = F.struct("_before", "n", "w", "m", "_u", "_total")
    chosen = cand.groupBy(id_col).agg(
        F.first("context").alias("context"), F.first("new_tokens").alias("new_tokens"),
        F.first("done").alias("done"), F.min(F.when(reached, level)).alias("c"))
    j = F.least(F.greatest(F.ceil((F.col("c._u") * F.col("c._total") - F.col("c._before")) / F.col("c.w")) - 1,
                           F.lit(0)), F.col("c.m") - 1).cast("bigint")
    pick = chosen.select(id_col, "context", "new_tokens", "done", F.col("c.n").alias("n"), j.alias("j"))
    got = salted_lookup(pick, ranked, ["context", "n", "j"], [id_col], how="left", hot=hot_ranked)
    return got.select(id_col, "context", "new_tokens", "done",
                      F.coalesce(F.col("next"), F.lit(fallback)).alias("drawn"))


#: Hashes of contexts that reach the driver to thin out a table before a join.
FEW_CONTEXTS = 4096


def _of_contexts(counts: DataFrame, contexts: DataFrame) -> DataFrame:
    """The rows of ``counts`` whose context is among the (distinct) ``contexts``.
    Where these are few, rows of other hashes do not enter the join's shuffle."""
    hashes = [r["h"] for r in contexts.select(F.xxhash64("context").alias("h")).limit(FEW_CONTEXTS + 1).collect()]
    if len(hashes) <= FEW_CONTEXTS:
        counts = counts.where(F.xxhash64("context").isin(hashes) if hashes else F.lit(False))
    return counts.join(contexts, "context", "left_semi")


def generate_sampled(prompts: DataFrame, counts: DataFrame, fallback: str, steps: int, top_k: int,
                     temperature: float, seed: int, id_col: str = "item_id",
                     tokens_col: str = "tokens", stop_token: str | None = None) -> DataFrame:
    """(id, new_tokens): ``steps`` sampled steps; a row stops (without
    appending) when it draws ``stop_token``.  ``temperature`` 0 takes the most
    frequent continuation instead of a draw."""
    if temperature < 0:
        raise ValueError("temperature must not be negative")
    if temperature == 0:
        return generate_greedy(prompts, counts, fallback, steps, id_col, tokens_col, stop_token)
    state = prompts.select(id_col, F.try_element_at(F.col(tokens_col), F.lit(-1)).alias("context"),
                           F.array().cast("array<string>").alias("new_tokens"), F.lit(False).alias("done"))
    for step in range(steps):
        state = materialize(state)
        # levels and ranks are per context: made for those that this step draws from
        own = materialize(_of_contexts(counts, state.where(~F.col("done")).select("context").distinct()))
        levels = materialize(sampling_levels(own, top_k, temperature))
        ranked = materialize(ranked_continuations(own))
        hot_levels = hot_key_hashes(levels, ["context"], "freq", 256)
        hot_ranked = hot_key_hashes(ranked, ["context", "n", "j"], "freq", 256, unique=True)
        d = draw(state, levels, ranked, fallback, seed, step, id_col, hot_levels, hot_ranked)
        stop = F.col("done") | (F.lit(stop_token).isNotNull() & (F.col("drawn") == F.lit(stop_token)))
        state = d.select(id_col,
                         F.when(stop, F.col("context")).otherwise(F.col("drawn")).alias("context"),
                         F.when(stop, F.col("new_tokens"))
                          .otherwise(F.concat(F.col("new_tokens"), F.array(F.col("drawn")))).alias("new_tokens"),
                         stop.alias("done"))
    return state.select(id_col, "new_tokens")


def decode_words(tokens_col: str) -> F.Column:
    return T.decode_tokens(F.col(tokens_col))

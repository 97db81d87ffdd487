"""Vector operators: standardization, scaled dot products, pooled token
embeddings and similarity-weighted history (causal soft attention without
learned projections)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.operators.lookup import salted_lookup
from tessera.operators.ranking import global_rank, rank_within_groups, running_total
from tessera.session import materialize, store


def standardize(df: DataFrame, vec_col: str, eps: float = 1e-5, scale: float = 1.0,
                shift: float = 0.0) -> DataFrame:
    """Row-wise (x - mean) / sqrt(var_pop + eps) * scale + shift."""
    return df.withColumn(vec_col, A.standardize(A.as_double(F.col(vec_col)), eps, scale, shift))


def consecutive_scaled_dot(df: DataFrame, group_col: str, order_col: str, vec_col: str) -> DataFrame:
    """(order_col, next_<order_col>, value): q.k/sqrt(d) of each vector with
    the next one in its group.  "Next" is an equi-join on (group, rank+1) of the
    distributed in-group rank, so a hot group does not land in one task."""
    ranked = rank_within_groups(df.select(group_col, order_col, vec_col), [group_col], [order_col], "_r")
    nxt = ranked.select(group_col, (F.col("_r") - 1).alias("_r"),
                        F.col(order_col).alias(f"next_{order_col}"), F.col(vec_col).alias("_v2"))
    return (ranked.join(nxt, [group_col, "_r"])
            .select(order_col, f"next_{order_col}",
                    A.scaled_dot(A.as_double(F.col(vec_col)), A.as_double(F.col("_v2"))).alias("value")))


#: Rows of a block of soft history: at least so many, and a window spans at most so many blocks.
HISTORY_BLOCK, HISTORY_SPAN = 64, 16


def soft_history(df: DataFrame, group_col: str, order_col: str, vec_col: str, window: int,
                 heads: int = 1, block: int | None = None) -> DataFrame:
    """For each row i: softmax over the last ``window`` rows j <= i of its group
    (by ``order_col``, which identifies a group's rows) of q_i.k_j/sqrt(d_head),
    times v_j, summed; with ``heads`` > 1 the vector is cut into equal slices
    handled independently and the outputs are concatenated.  Output (order_col,
    vec ARRAY<DOUBLE>).  Null groups are a group; rows without a vector are left out.

    Rows are dealt into blocks of consecutive ranks.  A block of rows meets each
    block of the rows it may look back on, one pair at a time, and leaves per row and pair
    an accumulator (largest score, sum of weights, weighted sum of vectors);
    accumulators of a row merge exactly, so no window is ever gathered.  The
    work of a pair is bounded by the block, a row has at most
    ``HISTORY_SPAN`` + 2 accumulators, and a hot group is spread over its blocks."""
    size = block or max(HISTORY_BLOCK, -(-window // HISTORY_SPAN))
    some = df.where(F.col(vec_col).isNotNull()).select(group_col, order_col, A.as_double(F.col(vec_col)).alias("_v"))
    ranked = rank_within_groups(some, [group_col], [order_col], "_r")
    blocks = (ranked.groupBy(F.struct(group_col).alias("_key"), F.floor(F.col("_r") / F.lit(size)).alias("_b"))
              .agg(F.sort_array(F.collect_list(F.struct(F.col("_r").alias("r"), F.col(order_col).alias("id"),
                                                        F.col("_v").alias("v")))).alias("_rows")))
    blocks = materialize(blocks.select("_key", "_b", F.monotonically_increasing_id().alias("_n"),
                                       F.transform("_rows", lambda x: x["id"]).alias("_ids"),
                                       F.flatten(F.transform("_rows", lambda x: x["v"])).alias("_vs")))
    back = -(-(window - 1) // size)
    asking = blocks.withColumn("_at", F.explode(F.sequence(F.greatest(F.col("_b") - back, F.lit(0)), F.col("_b"))))
    asked = blocks.select("_key", F.col("_b").alias("_at"), F.size("_ids").alias("_kn"), F.col("_vs").alias("_ks"))
    pairs = asking.join(asked, ["_key", "_at"]).select(
        "_n", "_ids", "_vs", "_kn", "_ks", ((F.col("_b") - F.col("_at")) * size).alias("_gap"))
    id_type = df.schema[order_col].dataType.simpleString()
    parts = pairs.mapInArrow(_history_parts(window, heads), f"_n bigint, _p int, _id {id_type}, "
                             "m array<double>, s array<double>, a array<double>")
    merged = parts.groupBy("_n", "_p").agg(F.first("_id").alias(order_col),
                                           F.collect_list(F.struct("m", "s", "a")).alias("_parts"))
    top = F.transform(F.sequence(F.lit(1), F.lit(heads)), lambda h: F.array_max(
        F.transform("_parts", lambda x: F.element_at(x["m"], h))))
    merged = merged.withColumn("_top", top).withColumn("_parts", F.transform("_parts", lambda x: F.struct(
        F.zip_with(x["m"], "_top", lambda m, t: F.exp(m - t)).alias("f"), x["s"].alias("s"), x["a"].alias("a"))))

    def total(values):
        """Sum over the parts of ``values(part)``, each times its factor."""
        first = F.transform(values(F.element_at("_parts", 1)), lambda x: F.lit(0.0))
        return F.aggregate("_parts", first, lambda acc, x: A.add(acc, values(x)))

    weight = total(lambda x: F.zip_with(x["s"], x["f"], lambda s, f: s * f))
    slices = total(lambda x: F.flatten(F.zip_with(A.heads(x["a"], heads), x["f"], lambda part, f: A.scale(part, f))))
    merged = merged.select(order_col, weight.alias("_w"), slices.alias("_a"))
    return merged.select(order_col, F.flatten(F.zip_with(A.heads(F.col("_a"), heads), "_w", lambda part, w: F.transform(
        part, lambda x: x / w))).alias("vec"))


def _history_parts(window: int, heads: int):
    """Accumulators of one pair of blocks a row: matrix products of bounded blocks."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                n, ids, vs, kn, ks, gap = (b.column(j)[i] for j in range(6))
                count, others, gap = len(ids.values), kn.as_py(), gap.as_py()
                q = np.asarray(vs.values, np.float64).reshape(count, -1)
                k = np.asarray(ks.values, np.float64).reshape(others, -1)
                if q.shape[1] % heads or q.shape[1] != k.shape[1]:
                    raise ValueError(f"{heads} heads do not divide a vector of {q.shape[1]}")
                width = q.shape[1] // heads
                ago = np.arange(count)[:, None] + gap - np.arange(others)[None, :]  # rows between them
                seen = (ago >= 0) & (ago < window)
                rows = np.flatnonzero(seen.any(axis=1))
                if not len(rows):
                    continue
                m, s, a = (np.empty((len(rows), w)) for w in (heads, heads, q.shape[1]))
                for h in range(heads):
                    at = slice(h * width, (h + 1) * width)
                    score = np.where(seen[rows], q[rows, at] @ k[:, at].T / np.sqrt(width), -np.inf)
                    m[:, h] = score.max(axis=1)
                    weight = np.exp(score - m[:, h:h + 1])
                    s[:, h] = weight.sum(axis=1)
                    a[:, at] = weight @ k[:, at]
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * x.shape[1]),
                                                  pa.array(x.ravel())) for x in (m, s, a)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rows), n.as_py())), pa.array(rows.astype(np.int32)),
                     ids.values.take(pa.array(rows)), *lists], names=["_n", "_p", "_id", "m", "s", "a"])
    return run


#: Vectors of a chunk, and rows of (doc, vector row, count) that meet it at a time.
VECTOR_CHUNK, CHUNK_PAIRS = 1 << 16, 1 << 22
#: Weighted vectors that are in memory at once.
HELD_VECTORS = 1 << 15


def _chunk_sums(tok: DataFrame, vecs: DataFrame, n_vec: int, id_col: str) -> DataFrame:
    """(id, _ts): the sum of ``_c`` times vector ``_row`` over a document's rows."""
    chunks = max(1, -(-n_vec // VECTOR_CHUNK))
    slices = max(1, -(-tok.count() // (chunks * CHUNK_PAIRS)))
    kind = tok.schema[id_col].dataType.simpleString()

    def chunk(row):
        return F.floor(row / F.lit(VECTOR_CHUNK)).cast("int").alias("_chunk")

    left = tok.select(F.col(id_col).alias("id"), F.col("_row").cast("long").alias("_row"), F.col("_c").cast("double").alias("_c"),
                      chunk(F.col("_row")), F.pmod(F.xxhash64(id_col), F.lit(slices)).cast("int").alias("_slice"))
    right = vecs.select("_row", "_v", chunk(F.col("_row")),
                        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("_slice"))

    def sums(rows: pa.Table, vectors: pa.Table) -> pa.Table:
        docs = rows.column("id").combine_chunks().dictionary_encode()
        codes = docs.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        at = vectors.column("_row").to_numpy()
        places = np.argsort(at, kind="stable")
        where = places[np.searchsorted(at, rows.column("_row").to_numpy()[order], sorter=places)]
        weight = rows.column("_c").to_numpy()[order]
        table = vectors.column("_v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
        total = np.zeros((len(docs.dictionary), table.shape[1]))
        for lo in range(0, len(codes), HELD_VECTORS):
            part = slice(lo, lo + HELD_VECTORS)
            first = np.flatnonzero(np.diff(codes[part], prepend=-1))
            total[codes[part][first]] += np.add.reduceat(table[where[part]] * weight[part, None], first, axis=0)
        ends = np.arange(len(total) + 1, dtype=np.int32) * table.shape[1]
        return pa.table({"id": docs.dictionary, "_ts": pa.ListArray.from_arrays(pa.array(ends), pa.array(total.ravel()))})

    keys = ["_chunk", "_slice"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda rows, vectors: sums(rows, vectors) if rows.num_rows else pa.table(
            {"id": rows.column("id"), "_ts": pa.array([], pa.list_(pa.float64()))}),
        f"id {kind}, _ts array<double>").withColumnRenamed("id", id_col)
    if chunks == 1:  # a document is in one group
        return found
    return found.groupBy(id_col).agg(Summarizer.sum(array_to_vector("_ts")).alias("_s")).select(
        id_col, vector_to_array("_s").alias("_ts"))


def pooled_token_embeddings(token_counts: DataFrame, vectors: DataFrame, id_col: str = "doc_id",
                            vec_id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Mean over a document's tokens of token vector + position vector, where
    the token vector is row ``token_id mod n`` and the position vector row
    ``pos mod n`` of the vector table: n rows, numbered from 0 in the order of
    their ids (which need not be dense).

    Input (doc, token_id, c): occurrences of each token id in a document; the
    document's length L is their sum.

    * token part: (doc, vector row, count) rows meet a chunk of VECTOR_CHUNK
      vectors in groups of about CHUNK_PAIRS rows, dealt by document; a group
      gives one sum per document, so vectors are never joined to rows;
    * position part: depends only on L.  With q = L div n and r = L mod n,
      sum over p < L of row (p mod n) = q * (sum of all rows) + prefix(r), where
      prefix(r) = sum of rows before r: one lookup per document into a table
      of n prefix vectors (a distributed running total per dimension)."""
    vecs = materialize(global_rank(vectors.select(vec_id_col, A.as_double(F.col(vec_col)).alias("_v")),
                                   [vec_id_col], "_row").select("_row", "_v"))
    n_vec = vecs.count()  # scalar
    # token part
    tok = store(token_counts.where(F.col(id_col).isNotNull()).select(
        id_col, F.pmod(F.col("token_id"), F.lit(n_vec)).alias("_row"), F.col("c").alias("_c")))
    tok_sums = _chunk_sums(tok, vecs, n_vec, id_col)
    # position part: per-dimension exclusive running sums over vector rows
    dims = A.rows_of(vecs, ["_row"], "_v", "_d", "_x")
    pref = running_total(dims, ["_d"], ["_row"], "_x", "_p")
    prefix = (pref.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_d", "_p"))).alias("_s"))
              .select(F.col("_row").alias("_r"), F.transform("_s", lambda x: x["_p"].cast("double")).alias("_pv")))
    total = [float(x) for x in  # one vector of the table's width (a model-sized value)
             dims.groupBy("_d").agg(F.sum("_x").alias("t")).orderBy("_d").select("t").toPandas()["t"]]
    docs = tok.groupBy(id_col).agg(F.sum("_c").alias("_len")).select(
        id_col, "_len", F.floor(F.col("_len") / F.lit(n_vec)).alias("_q"),
        F.pmod(F.col("_len"), F.lit(n_vec)).alias("_r"))
    r_weight = docs.groupBy("_r").agg(F.count(F.lit(1)).alias("freq"))
    prefix = prefix.join(r_weight, "_r", "left").fillna(0, ["freq"])
    pos = salted_lookup(docs, prefix, "_r", [id_col], how="inner")
    pos_sum = F.zip_with(F.col("_pv"), F.lit(total), lambda p, t: p + F.col("_q").cast("double") * t)
    both = pos.select(id_col, "_len", pos_sum.alias("_ps")).join(tok_sums, id_col)
    mean = F.zip_with(F.col("_ts"), F.col("_ps"), lambda a, b: (a + b) / F.col("_len").cast("double"))
    return both.select(id_col, mean.alias("vec"))

"""Registered queries: byte-pair token counts and the encode/decode round trip."""

from __future__ import annotations

from tessera.operators import bpe as B
from tessera.plans import common as C
from tessera.plans.registry import query
from tessera.session import materialize


def corpus_model(spark, d):
    return B.build_ranks(spark, C.docs(spark, d))


@query("bpe_token_counts")
def bpe_token_counts(spark, d):
    # one pass of the pre-token split feeds both the rank table and the counts
    counts = materialize(B.piece_counts(C.docs(spark, d)))
    return B.token_counts(None, B.build_ranks(spark, counts=counts), counts=counts)


@query("bpe_decode")
def bpe_decode(spark, d):
    # one pass of the pre-token split feeds the counts, the rank table and the encoding
    blocks = B.piece_blocks(C.docs(spark, d))
    counts = materialize(B.piece_counts(blocks))
    model = B.build_ranks(spark, counts=counts)
    return B.decode(B.encode(C.docs(spark, d), model, counts=counts, blocks=blocks), model)

"""Near-duplicate line removal by a segment-partition edit join (SQL functions only).

A line of length ``l`` may differ from its partner in ``t(l)`` edits: none below
20 characters, one below 40, two from there on (5 % of the length, two at most).
Cut into ``t + 1`` segments, one segment of the shorter line of a linked pair
occurs unchanged in the longer one.  Every distinct line puts its segments into
an index keyed by (length, segment number, content) and probes it with those
substrings of its own whose place fits the length difference (the multi-match
rule, which for each length and segment leaves a few starts).  The members of an index
list meet its head first; those linked to it need no look at each other.  Pairs that meet are
verified by a banded bit-parallel edit distance: the band of ``2 t + 1``
diagonals is one machine word per column.

Equal lines are one line by their hash, and only line hashes and segment hashes go
through the shuffles of the join; texts are fetched for the lines that meet others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach_by_key, connected_components, id_text, spread, stored
from tessera.session import shuffle_partitions

#: (least length, edits allowed from it on), longest first.
THRESHOLDS = ((40, 2), (20, 1))
MAX_EDITS = THRESHOLDS[0][1]
#: Hashes of lines in lists (8 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_LINES = 2_000_000
#: Characters whose counts are compared before texts are (any choice gives the same links).
COUNTED = "etaoinrshldcumfpgwybvk0123456789"


def allowed_edits(length: Column) -> Column:
    out = F.lit(0)
    for least, edits in reversed(THRESHOLDS):
        out = F.when(length >= least, F.lit(edits)).otherwise(out)
    return out


def _places(length: int, own: bool) -> list[tuple[int, int, int, int]]:
    """(edits, gap, segment, shift): where a line of ``length`` may hold a segment of a line shorter by
    ``gap``; ``own``: its own segments."""
    out = []
    for gap in [0] if own else range(MAX_EDITS + 1):
        edits = next((e for least, e in THRESHOLDS if length - gap >= least), 0)
        for i in range(1, edits + 2) if gap <= edits else ():
            left = edits + 1 - i
            shifts = [0] if own else range(max(-(i - 1), gap - left), min(i - 1, gap + left) + 1)
            out += [(edits, gap, i, s) for s in shifts if edits]
    return out


def line_keys(lines: DataFrame, own: bool) -> DataFrame:
    """(h1, key): the places where each line may meet another one, as rows: its own segments, or the
    substrings of it that may equal a segment of another line."""
    length = F.col("length")
    places = None  # the same for all lengths from one of these on to the next
    for least in sorted({least + gap for least, _ in THRESHOLDS for gap in range(MAX_EDITS + 1)}, reverse=True):
        here = F.array(*[F.struct(*[F.lit(x).alias(n) for x, n in zip(p, ("edits", "gap", "i", "shift"), strict=True)])
                         for p in _places(least, own)])
        places = F.when(length >= least, here) if places is None else places.when(length >= least, here)
    # a line of one byte a character is cut by bytes: no walk through its characters for every place
    plain_line = F.when(F.octet_length("line") == length, F.col("line").cast("binary"))
    rows = lines.where(length >= THRESHOLDS[-1][0]).select("h1", "line", "length", plain_line.alias("bytes")).select(
        "h1", "line", "bytes", "length", F.explode(places).alias("p")).select(
        "h1", "line", "bytes", "length", "p.*", (length - F.col("p.gap")).alias("other"))
    k = F.col("edits") + 1
    base = F.floor(F.col("other") / k).cast("int")
    plain = k - (F.col("other") - base * k)  # segments of the smaller size; the others are a character longer
    at = base * (F.col("i") - 1) + F.greatest(F.lit(0), F.col("i") - 1 - plain) + 1 + F.col("shift")
    rows = rows.select("h1", "line", "bytes", "length", "other", "edits", "i", at.alias("at"),
                       (base + F.when(F.col("i") > plain, 1).otherwise(0)).alias("size"))
    def key(cut: str) -> Column:  # the same for equal characters, whichever way they are cut
        return F.xxhash64("other", "edits", "i", F.substring(cut, F.col("at"), F.col("size")))

    return rows.where((F.col("at") >= 1) & (F.col("at") + F.col("size") - 1 <= F.col("length"))).select(
        "h1", F.when(F.col("bytes").isNotNull(), key("bytes")).otherwise(key("line")).alias("key"))


def within_edits(a: Column, b: Column, edits: int) -> Column:
    """Whether the edit distance of arrays of characters ``a`` and ``b``, where
    ``0 <= |a| - |b| <= edits``, is at most ``edits``: Hyyro's bit-vector
    recurrence on a diagonal band, one word of ``2 * edits + 2`` bits per column.

    The arrays are bound as a lambda's variable, so that what they come from is
    worked out once a pair and not at every access."""
    return F.element_at(F.transform(F.array(F.struct(a.alias("a"), b.alias("b"))),
                                    lambda p: _within(p["a"], p["b"], edits)), 1)


def _within(a: Column, b: Column, edits: int) -> Column:
    w = 2 * edits + 2
    full, diagonal, horizontal = (1 << w) - 1, 1 << (w - 1), 1 << (w - 2)
    start = edits + 1 - w
    n, m = F.size(a), F.size(b)

    def bits(i: Column) -> Column:
        """Bit k: character ``start + i + k`` of ``a`` (0-based) equals character i of ``b``."""
        c = F.element_at(b, i + 1)
        out = F.lit(0).cast("long")
        for k in range(w):
            at = i + (start + k)
            out = out + F.when((at >= 0) & (at < n), F.when(F.get(a, at) == c, F.lit(1 << k)).otherwise(F.lit(0))
                               ).otherwise(F.lit(0))
        return out

    def invert(x: Column) -> Column:
        return F.bitwise_not(x).bitwiseAND(F.lit(full))

    def column(state: Column, i: Column) -> Column:
        x, vp, vn = bits(i), state["vp"], state["vn"]
        d0 = (((x.bitwiseAND(vp) + vp).bitwiseXOR(vp)).bitwiseOR(x).bitwiseOR(vn)).bitwiseAND(F.lit(full))
        return F.struct(d0.alias("d0"), vp.alias("vp"), vn.alias("vn"), state["dist"].alias("dist"),
                        state["mask"].alias("mask"))

    def move(s: Column, i: Column) -> Column:
        d0, vp, vn = s["d0"], s["vp"], s["vn"]
        hp = vn.bitwiseOR(invert(d0.bitwiseOR(vp)))
        hn = d0.bitwiseAND(vp)
        down = F.shiftright(d0, 1)
        in_band = i < n - edits  # still on the last diagonal; then along the last row
        on_diagonal = F.when(d0.bitwiseAND(F.lit(diagonal)) == 0, 1).otherwise(0)
        on_row = (F.when(hp.bitwiseAND(s["mask"]) != 0, 1).otherwise(0)
                  - F.when(hn.bitwiseAND(s["mask"]) != 0, 1).otherwise(0))
        return F.struct(d0.alias("d0"), hn.bitwiseOR(invert(down.bitwiseOR(hp))).alias("vp"),
                        down.bitwiseAND(hp).alias("vn"),
                        (s["dist"] + F.when(in_band, on_diagonal).otherwise(on_row)).cast("int").alias("dist"),
                        F.when(in_band, s["mask"]).otherwise(F.shiftright(s["mask"], 1)).alias("mask"))

    zero = F.struct(F.lit(0).cast("long").alias("d0"),
                    F.lit((full << (w - edits - 1)) & full).cast("long").alias("vp"),
                    F.lit(0).cast("long").alias("vn"), F.lit(edits).alias("dist"),
                    F.lit(horizontal).cast("long").alias("mask"))
    end = F.aggregate(F.sequence(F.lit(0), m - 1), zero,
                      # one column at a time; the inner one-element fold names the state for `move`
                      lambda s, i: F.aggregate(F.array(column(s, i)), zero, lambda _, t: move(t, i)))
    return F.when(m == 0, n <= edits).otherwise(end["dist"] <= edits)


def letter_counts(line: Column) -> Column:
    """How often a line holds each of ``COUNTED``."""
    return F.struct(*[(F.length(line) - F.length(F.replace(line, F.lit(c), F.lit("")))).alias(f"c{i}")
                      for i, c in enumerate(COUNTED)])


def may_link(a_length: Column, a_counts: Column, b_length: Column, b_counts: Column) -> Column:
    """Whether lengths and letter counts let two lines be within their threshold: an edit changes
    the length by one at most, and the sum of the counts' differences by two at most."""
    allowed = allowed_edits(F.least(a_length, b_length))
    apart = sum((F.abs(a_counts[f"c{i}"] - b_counts[f"c{i}"]) for i in range(len(COUNTED))), F.lit(0))
    return (F.abs(a_length - b_length) <= allowed) & (apart <= 2 * allowed)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, length) of the lines that hold more than white space."""
    each = F.transform(F.split("text", "\n", -1),
                       lambda x: F.struct(x.alias("line"), F.char_length(x).alias("length")))
    return (docs.select("doc_id", F.posexplode_outer(each).alias("line_no", "l"))
            .select("doc_id", "line_no", F.col("l.line").alias("line"), F.col("l.length").alias("length"))
            .where(F.col("line").rlike(r"\S")))


def line_classes(docs: DataFrame) -> DataFrame:
    """Distinct lines: hashes ``h1``, ``h2``, ``n`` (occurrences) and ``first``
    (smallest (doc_id, line_no)).  The text itself is not shuffled."""
    return _lines(docs).select(*_hashes(), "doc_id", "line_no").groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "line_no")).alias("first"))


def _hashes() -> list[Column]:
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2")]


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(x, y, u, v) of the pairs of lines (hashes ``x``, ``y``; ``may_link`` holds) that are within
    their threshold."""
    one = texts.select(F.col("h1").alias("x"), F.struct("length", "line", "first").alias("one"))
    two = texts.select(F.col("h1").alias("y"), F.struct("length", "line", "first").alias("two"))
    both = pairs.join(one, "x").join(two, "y").select("x", "y", F.greatest("one", "two").alias("a"),
                                                      F.least("one", "two").alias("b"))
    both = both.select("x", "y", F.col("b.first").alias("u"), F.col("a.first").alias("v"), F.col("a.line").alias("a"),
                       F.col("b.line").alias("b"), F.col("b.length").alias("m"))
    both = stored(both.repartition(shuffle_partitions(pairs.sparkSession)), "line-pairs")
    linked = F.lit(False)
    a, b = F.split("a", ""), F.split("b", "")
    for _, e in THRESHOLDS:
        linked = F.when(allowed_edits(F.col("m")) == e, within_edits(a, b, e)).otherwise(linked)
    return both.where(linked).select("x", "y", "u", "v")


def _texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, first, line, length) of the lines whose hash is wanted, from their first occurrence."""
    if wanted.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)  # else: a shuffle join
    found = classes.join(wanted, "h1", "left_semi").select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), "first")
    lines = _lines(docs).select("doc_id", "line_no", *_hashes(), "line", "length").join(wanted, "h1", "left_semi")
    return lines.join(found, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")) & F.struct(
        "doc_id", "line_no").eqNullSafe(F.col("first"))).select("h1", "first", "line", "length").distinct()


def near_lines(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``u``, ``v`` (first occurrences) whose components are those of all pairs of distinct
    lines within their threshold (``classes``: a stored ``line_classes`` of ``docs``).

    A list is the lines that share a key.  Its head, one line whose own segment the key is, is
    compared with every other member.  Members linked to the head need no look at each other;
    any other pair of the list is compared."""
    lines = _lines(docs).select(F.xxhash64("line").alias("h1"), "line", "length")
    heads = line_keys(lines, True).groupBy("key").agg(F.min("h1").alias("head"))
    members = line_keys(lines, False).join(heads, "key").where("h1 != head").distinct()
    members = stored(members, "line-members")  # the lists of two lines and more
    inside = members.select("h1").union(members.select("head")).distinct()
    texts = stored(_texts(docs, classes, stored(inside, "line-wanted")), "line-texts")
    counts = stored(texts.select("h1", "length", letter_counts(F.col("line")).alias("counts")), "line-counts")
    segments = line_keys(texts, True).distinct()
    members = members.join(segments.withColumn("own", F.lit(True)), ["key", "h1"], "left").select(
        "key", "head", "h1", F.coalesce("own", F.lit(False)).alias("own"))

    def counted(side: str) -> DataFrame:
        return counts.select(F.col("h1").alias(side), F.col("length").alias(f"{side}_length"),
                             F.col("counts").alias(f"{side}_counts"))

    def likely(x: str, y: str) -> Column:
        return may_link(F.col(f"{x}_length"), F.col(f"{x}_counts"), F.col(f"{y}_length"), F.col(f"{y}_counts"))

    heads = members.select(F.col("head").alias("x"), F.col("h1").alias("y")).distinct()
    heads = heads.join(counted("x"), "x").join(counted("y"), "y").where(likely("x", "y")).select("x", "y")
    star = stored(_verified(heads, texts), "line-stars")
    tied = star.select(F.col("x").alias("head"), F.col("y").alias("h1"), F.lit(True).alias("tied"))
    flagged = stored(members.join(tied, ["head", "h1"], "left").select(
        "key", "h1", "own", F.coalesce("tied", F.lit(False)).alias("tied")), "line-flags")
    # lengths and counts are compared where the list's pairs are made, so unlike pairs never leave it
    own = flagged.where("own").select("key", F.col("h1").alias("x"), F.col("tied").alias("_t")).join(counted("x"), "x")
    other = flagged.select("key", F.col("h1").alias("y"), "tied").join(counted("y"), "y")
    rest = (own.join(other, "key").where((F.col("x") != F.col("y")) & ~(F.col("_t") & F.col("tied")) & likely("x", "y"))
            .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    return star.union(_verified(rest, texts)).select("u", "v")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_lines``, ``n_copies`` (its lines
    that equal an earlier line), ``n_near`` (further lines whose class, joined
    by edits, has an earlier line) and ``dropped`` (numbers, from 0, of all of
    these).  The first occurrence of a class, by (doc_id, line number), stays.

    Lines end at ``\\n``; lines of white space alone count but are never
    dropped.  Null and empty texts have no lines.  Rows that repeat an id are
    one document; null ids come first.  Other columns are not read; an empty
    table gives an empty result."""
    rows = spread(id_text(docs, id_col, text_col))
    classes = stored(line_classes(rows), "line-classes")
    links = stored(near_lines(rows, classes), "line-links")
    component = connected_components(links).withColumnsRenamed({"node": "first", "component": "keeper"})
    shared = classes.select("h1", "h2", "n", "first").join(component, "first", "left")
    lookup = shared.where("n > 1 or keeper is not null").select("h1", "h2", "n", "first", F.coalesce(
        "keeper", "first").alias("keeper"))
    lines = _lines(rows).select("doc_id", "line_no", *_hashes())
    here = F.struct("doc_id", "line_no")
    gone = (attach_by_key(lines, lookup, ["h1", "h2"], "n", F.xxhash64("doc_id", "line_no"))
            .where(~here.eqNullSafe(F.col("keeper")) & F.col("keeper").isNotNull())
            .groupBy("doc_id").agg(F.count_if(~here.eqNullSafe(F.col("first"))).alias("n_copies"),
                                   F.count_if(here.eqNullSafe(F.col("first"))).alias("n_near"),
                                   F.array_sort(F.collect_set("line_no")).alias("dropped")))
    every = (rows.groupBy("doc_id").agg(F.sum(F.when(F.col("text") == "", 0).otherwise(
        F.size(F.split("text", "\n", -1)))).cast("long").alias("n_lines")))
    out = every.alias("d").join(gone.alias("g"), F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")), "left")
    return out.select("d.doc_id", "n_lines", F.coalesce("n_copies", F.lit(0)).cast("long").alias("n_copies"),
                      F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


def without_dropped(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` (unique ids) with the lines that ``line_dedup`` names taken out of ``text``."""
    d = dropped.select(F.col("doc_id").alias("_id"), F.col("dropped").alias("_dropped"))
    kept = F.filter(F.split("text", "\n", -1), lambda x, i: ~F.array_contains("_dropped", i))
    return (docs.join(d, docs["doc_id"].eqNullSafe(d["_id"]), "left")
            .withColumn("text", F.when(F.size("_dropped") > 0, F.array_join(kept, "\n")).otherwise(F.col("text")))
            .select(*docs.columns))

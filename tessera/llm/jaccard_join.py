"""N-gram Jaccard self-join with set-relation skipping.

A document's set holds the hashes of its word shingles, laid out in hash order
and cut into position blocks (equal hash ranges).  Two sets that link differ in
at most ``d`` shingles, so of more than ``d`` blocks that hold anything one is
equal in both: an inverted list is kept per (size class, position block, block
content), and a set skips every list but those of its own blocks.  Lists of one
set drop out, and so does a set that shares fewer lists than its untouched
blocks with any linked set would be; the lists of the rest tie sets into
candidate groups (connected components of member-to-smallest-member edges, never
all pairs of a list; a set that dropped out passes a tie on, but is no member).

Inside a group (cut into size-ordered chunks when it is large; only chunk pairs
of compatible sizes meet) the join is exact.  Index lists hold (set, position),
rarest shingle first and sets by size; a probe skips the blocks of a list that
the size bound or the position bound rules out.  A set that is highly similar
to an earlier one takes over that set's computed overlaps and corrects them by
the lists of the few shingles in which the two differ, instead of counting
anew.  Equal sets are joined once, through their smallest id.

Shingles are compared by 64-bit hash: two different shingles of one pair of
documents collide with a probability of about ``n^2 / 2^64``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import (attach_by_key, batches_of, connected_components, id_text, released, spread, stored,
                                text_slices)
from tessera.llm.textkernel import SPACED, mix, shingles, word_hashes
from tessera.operators.ranking import running_total
from tessera.session import shuffle_partitions

#: Shingles that one local join holds; larger groups are cut into chunks of half of it.
GROUP_SHINGLES = 3_000_000
#: Sets whose computed overlaps a local join keeps to derive others from.
PIVOTS = 6
#: Candidate rows (about 60 bytes each) that are broadcast to the texts; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Digests remembered per task to send equal sets once, and list entries that a
#: task combines at a time (both only save work).
_SEEN, TASK_KEYS = 500_000, 1_000_000
_A, _B, _C = np.uint64(0x8CB92BA72F3D8DD7), np.uint64(0xC2B2AE3D27D4EB4F), 0x165667B19E3779F9


def size_classes(upto: int) -> list[int]:
    """Lower bounds of the size classes, each half as wide again as the last."""
    out = [1]
    while out[-1] <= upto:
        out.append(out[-1] * 3 // 2 + 1)
    return out


def difference_bound(a: int, b: int, percent: int) -> int:
    """Largest symmetric difference of linked sets of sizes a and b."""
    return (a + b) * (100 - percent) // (100 + percent)


def signatures(s: np.ndarray, percent: int) -> list[tuple[int, np.ndarray, int]]:
    """(size class, keys of the inverted lists, lists shared with any linked set
    at least) of a sorted set: its own class and every lower class that holds
    sets it may link with."""
    n = len(s)
    if not n:
        return []
    bounds = size_classes(n)
    own = int(np.searchsorted(bounds, n, side="right")) - 1
    least = int(np.searchsorted(bounds, -(-n * percent // 100), side="right")) - 1
    out = []
    for c in range(least, own + 1):
        top = (bounds[c + 1] if c + 1 < len(bounds) else bounds[c] * 3 // 2 + 1) - 1
        d = difference_bound(top, top * 100 // percent, percent)
        m = d + 1
        m += 2 + m // 16
        block = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        begin = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        content = np.add.reduceat(mix(s ^ _A), begin)
        salt = np.uint64((c + 1) * _C % (1 << 64))
        keys = mix(content + mix(block[begin] * _B + salt))
        mine = difference_bound(n, n * 100 // percent, percent) if c == own else difference_bound(top, n, percent)
        if len(begin) <= mine:
            # few full blocks: all of them may differ.  Such sets (rare) also meet each
            # other by the shingles of their prefix.
            prefix = s[:n - -(-n * percent // 100) + 1]
            keys = np.concatenate([keys, mix(prefix + (salt ^ _A))])
        out.append((c, keys, max(1, len(begin) - mine)))
    return out


def doc_sets(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    """The sorted shingle set of every text of a batch."""
    for buf, offsets, _, _ in text_slices(batch):
        h, at = word_hashes(buf, offsets, SPACED)
        for i in range(len(at) - 1):
            yield np.unique(shingles(h[at[i]:at[i + 1]], words))


def _digests(words: int) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary())])

    def run(batches):
        for b in batches:
            yield from batches_of(((i, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest()) for i, s in
                                   zip(b.column(0).to_pylist(), doc_sets(b, words), strict=True)), schema)
    return run


_POSTINGS = "key long, doc_id long, cls int, need int, head long, t int"


def _postings(words: int, percent: int) -> Callable:
    """Entries of the inverted lists, combined within the task: per key one
    entry with the smallest id (``head`` null; ``t`` 1 if it is the key's only
    one so far, else 0).  What a task has seen together goes out as finished
    (doc, head) rows with the number ``t`` of lists they share, so a key of very
    many sets leaves a task as one entry.  ``need``: shared lists without which
    the set links with nothing."""
    schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("cls", pa.int32()), ("need", pa.int32()),
                        ("head", pa.int64()), ("t", pa.int32())])

    def run(batches):
        seen: set[bytes] = set()
        keys: list[np.ndarray] = []
        of: list[tuple[int, int, int, int]] = []  # (doc_id, class, need, keys)
        held = 0
        for b in batches:
            for i, s in zip(b.column(0).to_pylist(), doc_sets(b, words), strict=True):
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                if i is None or digest in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(digest)
                for c, k, need in signatures(s, percent):
                    keys.append(k)
                    of.append((i, c, need, len(k)))
                    held += len(k)
                if held >= TASK_KEYS:
                    yield from combine(keys, of)
                    keys, of, held = [], [], 0
        if of:
            yield from combine(keys, of)

    def combine(keys, of):
        key = np.concatenate(keys)
        ids, cls, need, size = (np.array(x, np.int64) for x in zip(*of))
        row = np.repeat(np.arange(len(ids)), size)
        order = np.lexsort((ids[row], key))
        key, row = key[order], row[order]
        begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        head = row[begin]  # of each key the smallest id
        width = np.diff(np.append(begin, len(key)))
        yield from out(key[begin].view(np.int64), head, None, np.where(width > 1, 0, 1), ids, cls, need)
        shared = np.repeat(width > 1, width)
        if shared.any():
            pairs, t = np.unique(np.stack([row[shared], np.repeat(head, width)[shared]]), axis=1, return_counts=True)
            own = mix((ids[pairs[0]].astype(np.uint64) * _A) ^ (ids[pairs[1]].astype(np.uint64) * _B))
            yield from out(own.view(np.int64), pairs[0], ids[pairs[1]], t, ids, cls, need)

    def out(key, row, head, t, ids, cls, need):
        for lo in range(0, len(key), 50_000):
            cut = slice(lo, lo + 50_000)
            r = row[cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[cut]), pa.array(ids[r]), pa.array(cls[r].astype(np.int32)),
                 pa.array(need[r].astype(np.int32)), pa.nulls(len(r), pa.int64()) if head is None else
                 pa.array(head[cut]), pa.array(t[cut].astype(np.int32))], schema=schema)
    return run


_MEMBER = "doc_id long, cls int, copies long, chunk long, a long, b long, tokens binary, grp long, n long"


def _sets(words: int) -> Callable:
    """Members of blocks with their text: the text gives way to its shingle set."""
    def run(batches):
        for b in batches:
            plain = b.select(["doc_id", "cls", "copies", "chunk", "a", "b", "grp", "n"])
            lo, held, size = 0, [], 0
            for i, s in enumerate(doc_sets(b, words), 1):
                held.append(s.tobytes())
                size += len(held[-1])
                if size > 4 << 20 or i == b.num_rows:
                    c = plain.slice(lo, i - lo)
                    yield pa.RecordBatch.from_arrays(
                        [*c.columns[:6], pa.array(held, pa.binary()), *c.columns[6:]],
                        names=["doc_id", "cls", "copies", "chunk", "a", "b", "tokens", "grp", "n"])
                    lo, held, size = i, [], 0
    return run


class LocalJoin:
    """Exact self-join of the sets of one group, given in order of size."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent, self.g = percent, len(sets)
        self.n = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(self.g), self.n)
        _, token, df = np.unique(flat, return_inverse=True, return_counts=True)
        rarest = np.empty(len(df), np.int64)
        rarest[np.argsort(df, kind="stable")] = np.arange(len(df))
        token = rarest[token]
        order = np.lexsort((token, owner))
        self.start = np.concatenate([[0], np.cumsum(self.n)])
        self.tokens = token[order]  # of each set, rarest first
        place = np.arange(len(flat)) - np.repeat(self.start[:-1], self.n)
        lists = np.argsort(self.tokens, kind="stable")
        self.list_set, self.list_place = owner[lists], place[lists]  # owner is already in set order
        self.list_start = np.concatenate([[0], np.cumsum(np.bincount(self.tokens, minlength=len(df)))])
        self.pivots: list[tuple[int, np.ndarray]] = []
        self.derived = self.counted = self.skipped = 0

    def of(self, x: int) -> np.ndarray:
        return self.tokens[self.start[x]:self.start[x + 1]]

    def _gather(self, tokens: np.ndarray) -> np.ndarray:
        a, b = self.list_start[tokens], self.list_start[tokens + 1]
        size = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        return np.bincount(self.list_set[at], minlength=self.g)

    def has_candidate(self, x: int) -> bool:
        """Probe the lists of the prefix, skipping blocks by size and position."""
        n, p = int(self.n[x]), self.percent
        lo = int(np.searchsorted(self.n, -(-n * p // 100)))
        hi = int(np.searchsorted(self.n, n * 100 // p, side="right"))
        if hi - lo <= 1:
            return False
        for i, t in enumerate(self.of(x)[:n - -(-n * p // 100) + 1]):
            a, b = self.list_start[t], self.list_start[t + 1]
            if b - a < 2:
                continue
            sets = self.list_set[a:b]
            u, v = np.searchsorted(sets, (lo, hi))
            sets, place = sets[u:v], self.list_place[a + u:a + v]
            m = self.n[sets]
            most = 1 + np.minimum(n - i - 1, m - place - 1) + np.minimum(i, place)
            if np.any(((100 + p) * most >= p * (n + m)) & (sets != x)):
                return True
        return False

    def overlaps(self, x: int) -> np.ndarray:
        """|x and y| for every set y of the group."""
        mine = self.of(x)
        best = max(self.pivots, key=lambda v: v[1][x] * 2 - self.n[v[0]], default=None)
        if best is not None:
            p, known = best
            differ = self.n[x] + self.n[p] - 2 * known[x]
            if 2 * differ <= self.n[x]:
                theirs = self.of(p)
                out = (known - self._gather(np.setdiff1d(theirs, mine, assume_unique=True))
                       + self._gather(np.setdiff1d(mine, theirs, assume_unique=True)))
                self.derived += 1
                return out
        out = self._gather(mine)
        self.counted += 1
        self.pivots = [*self.pivots[-(PIVOTS - 1):], (x, out)]
        return out

    def links(self) -> Iterator[tuple[int, np.ndarray]]:
        """(set, sets linked with it) for every set that has any."""
        for x in range(self.g):
            if not self.has_candidate(x):
                self.skipped += 1
                continue
            o = self.overlaps(x)
            hit = 100 * o >= self.percent * (self.n[x] + self.n - o)
            hit[x] = False
            found = np.flatnonzero(hit)
            if len(found):
                yield x, found


_LINKS = "u long, v long, n_links long"


def _join_groups(percent: int) -> Callable:
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n_links", pa.int64())])

    def join(rows: list[tuple]) -> Iterator[tuple]:
        """rows: (doc_id, class, copies, chunk, other chunk, tokens) of one block, by size."""
        ids = [r[0] for r in rows]
        copies = np.array([r[2] for r in rows], np.int64)
        side = np.array([r[3] for r in rows])
        own, a, b = rows[0][1], rows[0][4], rows[0][5]
        sets = [np.frombuffer(r[6], np.uint64) for r in rows]
        bounds = size_classes(max(len(s) for s in sets))
        cls = np.searchsorted(bounds, [len(s) for s in sets], side="right") - 1
        root = list(range(len(ids)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        count = np.zeros(len(ids), np.int64)
        for x, found in LocalJoin(sets, percent).links():
            # a pair belongs to the class of its smaller set and to one block of chunks
            found = found[np.minimum(cls[found], cls[x]) == own]
            if a != b:
                found = found[side[found] != side[x]]
            count[x] += copies[found].sum()
            for y in found.tolist():
                i, j = find(x), find(y)
                if i != j:
                    root[max(i, j)] = min(i, j)
        heads: dict[int, int] = {}
        for i in range(len(ids)):
            heads[find(i)] = min(heads.get(find(i), ids[i]), ids[i])
        for i, doc in enumerate(ids):
            if count[i]:
                yield doc, heads[find(i)], int(count[i])

    def run(batches):
        def rows():
            key, held = None, []
            for b in batches:
                for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    # doc_id, cls, copies, chunk, a, b, tokens, group, n
                    if held and r[0] == held[-1][0] and (r[7], r[1], r[4], r[5]) == key:
                        continue  # a row that repeats an id
                    if (r[7], r[1], r[4], r[5]) != key:
                        if len(held) > 1:
                            yield from join(held)
                        key, held = (r[7], r[1], r[4], r[5]), []
                    held.append(r)
            if len(held) > 1:
                yield from join(held)
        yield from batches_of(rows(), schema)
    return run


def _blocks(members: DataFrame, percent: int) -> DataFrame:
    """Adds chunk, a, b: a group within the bound is one block (0, 0); a larger
    one is cut into size-ordered chunks and its rows go to the chunk pairs
    whose sizes may link."""
    total = members.groupBy("grp", "cls").agg(F.sum("n").alias("_t"))
    big = stored(total.where(F.col("_t") > GROUP_SHINGLES).select("grp", "cls"), "big")
    zero = F.lit(0).cast("long")
    small = members.join(big, ["grp", "cls"], "left_anti").withColumns({"chunk": zero, "a": zero, "b": zero})
    if big.isEmpty():
        return small
    cut = running_total(members.join(big, ["grp", "cls"], "left_semi"), ["grp", "cls"], ["n", "doc_id"], "n", "_sum")
    cut = stored(cut.withColumn("chunk", F.floor(F.col("_sum") / (GROUP_SHINGLES // 2))).drop("_sum"), "chunks")
    sizes = cut.groupBy("grp", "cls", "chunk").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    pairs = (sizes.select("grp", "cls", F.col("chunk").alias("a"), "most")
             .join(sizes.select("grp", "cls", F.col("chunk").alias("b"), "least"), ["grp", "cls"])
             .where((F.col("a") <= F.col("b")) & (F.col("least") * percent <= F.col("most") * 100))
             .select("grp", "cls", "a", "b"))
    pairs = (pairs.withColumn("chunk", F.explode(F.array_distinct(F.array("a", "b")))))
    return small.unionByName(cut.join(pairs, ["grp", "cls", "chunk"]))


def jaccard_join(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` (size of its set of
    distinct ``words``-word shingles), ``component_id`` (smallest id reachable
    by links, itself included) and ``n_links`` (rows it links with).

    Two rows link when their sets' Jaccard similarity is at least ``percent``
    %.  A text of fewer words is one shingle; a null, empty or blank text has
    an empty set, links with nothing and is its own component.  Words are runs
    of other than ASCII white space, A-Z folded.  Rows of a null id take the
    component of equal sets, if any, and link with nothing else; rows that
    repeat an id are counted each and should repeat its text (else one of the
    texts stands for the id).  Columns other than the two named are not read.  An empty table gives
    an empty result."""
    rows = spread(id_text(docs, id_col, text_col))
    n_parts = shuffle_partitions(docs.sparkSession)
    people = stored(rows.mapInArrow(released(_digests(words)), "doc_id long, n long, digest binary"), "sets")
    classes = stored(people.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"),
                                                                 F.count(F.lit(1)).alias("copies"),
                                                                 F.max("n").alias("n")), "classes")

    postings = rows.mapInArrow(released(_postings(words, percent)), _POSTINGS)
    # a list holds at most one entry per task (and bundle of its keys)
    w = Window.partitionBy("key")
    met = (postings.withColumns({"_n": F.count(F.lit(1)).over(w), "_head": F.min("doc_id").over(w)})
           .where("head is not null or _n > 1")
           .groupBy("cls", "doc_id", F.coalesce("head", "_head").alias("head"))
           .agg(F.sum("t").alias("t"), F.max("need").alias("need")))
    met = stored(met, "met")
    # a set that shares fewer lists than any link takes is done, but as the head of
    # its task's part of a list it still ties that part to the list's other parts
    able = stored(met.groupBy("cls", "doc_id").agg(F.sum("t").alias("t"), F.max("need").alias("need"))
                  .where("t >= need").select("cls", "doc_id"), "able")
    ties = met.where("doc_id != head").select("cls", "doc_id", "head")
    kept = stored(ties.join(able, ["cls", "doc_id"], "left_semi"), "kept")
    unable = (kept.select("cls", F.col("head").alias("doc_id")).distinct()
              .join(able, ["cls", "doc_id"], "left_anti"))
    meet = stored(kept.unionByName(ties.join(unable, ["cls", "doc_id"], "left_semi")), "meet")
    ids = meet.select("doc_id").union(meet.select("head")).distinct()
    rep_of = people.join(ids, "doc_id", "left_semi").join(classes, "digest").select("doc_id", "rep").distinct()
    edges = (meet.join(rep_of, "doc_id").select("cls", "head", F.col("rep").alias("x"))
             .join(rep_of.withColumnRenamed("doc_id", "head"), "head")
             .where("x != rep")
             .select(F.struct("cls", F.col("x").alias("id")).alias("u"),
                     F.struct("cls", F.col("rep").alias("id")).alias("v")))
    groups = connected_components(edges)
    able = able.join(rep_of, "doc_id").select("cls", F.col("rep").alias("doc_id")).distinct()
    members = stored(groups.select(F.col("node.cls").alias("cls"), F.col("node.id").alias("doc_id"),
                                   F.xxhash64("component").alias("grp")).join(able, ["cls", "doc_id"], "left_semi"),
                     "members")
    sized = members.join(classes.select(F.col("rep").alias("doc_id"), "copies", "n"), "doc_id")
    blocks = stored(_blocks(sized, percent), "blocks")
    if blocks.count() <= BROADCAST_ROWS:
        blocks = F.broadcast(blocks)  # else: a shuffle join on the id
    links = (rows.join(blocks, "doc_id").select("doc_id", "text", "cls", "copies", "chunk", "a", "b", "grp", "n")
             .mapInArrow(released(_sets(words)), _MEMBER)
             .repartition(n_parts, "grp", "cls", "a", "b")
             .sortWithinPartitions("grp", "cls", "a", "b", "n", "doc_id")
             .mapInArrow(released(_join_groups(percent)), _LINKS))
    links = stored(links, "links")
    component = connected_components(links.select("u", "v"))
    degree = links.groupBy(F.col("u").alias("rep")).agg(F.sum("n_links").alias("_links"))

    linked = (component.withColumnRenamed("node", "rep").join(degree, "rep", "left"))
    lookup = (classes.drop("n").join(linked, "rep", "left")
              .select("digest", "copies", F.coalesce("component", "rep").alias("_component"),
                      (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n_links")))
    out = attach_by_key(people.select("doc_id", "n", "digest"), lookup, ["digest"], "copies", F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.coalesce("_component", "doc_id").alias("component_id"),
                      F.coalesce("_n_links", F.lit(0)).cast("long").alias("n_links"))

"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds the hashes of its distinct shingles. Equal sets are joined first, so that copies cost nothing
later. In each of TREES independent trees a set starts in the node of one minwise token. Every node's members are compared
with its smallest id (the star; in large nodes also with two members picked by hash), and what may be similar is confirmed on
the full sets. A node is settled once all its sets are in one component. Small nodes that are not are compared exhaustively on
128 minwise values. From large ones those sets are left out first that too many own shingles keep from any partner: of two
similar sets each shares num / (num + den) of both sizes at least, so a set is alone if fewer of its shingles occur in
another set of a large node. What remains branches: each set goes on to BRANCH children, chosen by minwise tokens that the
node's path selects. In a large node that one component fills (half of it, or all but a few sets), and at DEPTH, those outside
are compared with all, block by block. No pairs are written, but the sets of a node or block that have a similar one in another
component; their full sets are compared there, in blocks of bounded bytes, and give the links that join components.

Recall: sets of similarity s share a first node with probability s, and a node's children hold both with probability
1-(1-s)^2. At s = 0.75 a tree keeps a pair together to any depth with probability 2/3 at least, so 12 trees miss it with
3^-12, about 2e-6.

Null and empty texts have empty sets and are linked with nothing; an empty table gives an empty result. Texts of any length
give whole sets. The join knows a row by a hash of its doc_id and text, so rows of null or equal doc_ids with different texts
are documents of their own, and repeated rows share their component. Of equally small partners any may give the link: the
component is the same. A component is named by its smallest doc_id; one of null doc_ids only has a null component and is kept.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._scratch import Scratch, lean, parts
from ._text import Block, blocks, mix, stream

SHINGLE, NUM, DEN = 5, 75, 100
WIDTH = 128  #: minwise values of a set
TREES, BRANCH, SMALL, DEPTH = 12, 2, 256, 4
ALL = 16  #: sets of a node that are all compared, whatever shingles they have of their own
MOST_WORDS = 1 << 19  #: 64-bit words of the Bloom filter over ids, at most
BLOCK, OUTER = 1024, 256  #: minwise values of sets of a component and sets outside it that are compared at once
BLOCK_TOKENS = 1 << 19  #: shingles of either side in a comparison of full sets
SHARE_TOKENS = 1 << 19  #: shingles that are counted in one task
_A = (stream(101, WIDTH) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (stream(102, WIDTH) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(b: Block, k: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; of fewer than k words, one hash of them all."""
    grams = b.grams(k)
    for i in range(b.n):
        lo, hi = b.bounds[i], b.bounds[i + 1]
        if hi - lo >= k:
            s = np.sort(grams[lo : hi - k + 1])
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif hi > lo:
            w = b.words[lo:hi]
            yield mix(np.sum(w * stream(31, len(w)), keepdims=True) + np.uint64(len(w)))
        else:
            yield grams[:0]


def minwise(s: np.ndarray) -> np.ndarray:
    out = np.full(WIDTH, 0xFFFFFFFF, np.uint32)
    x = (s >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(out, ((x[i : i + 512, None] ^ _B) * _A).min(axis=0), out=out)
    return out


def _key() -> Column:
    """What the join knows a row by; only repeated rows share it."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """key, doc_id, n, h1, h2 (a 128-bit hash of the set) and sig of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, b in blocks(batch.column(2), lower=True):
                n, h1, h2, sig = [], [], [], []
                for s in shingle_sets(b, k):
                    n.append(len(s))
                    h1.append(int(mix(s + np.uint64(0x51ED270B)).sum().astype(np.int64)))
                    h2.append(int(mix(s ^ np.uint64(0xB492B66FBE98F273)).sum().astype(np.int64)))
                    sig.append(minwise(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_pydict({"key": batch.column(0).slice(lo, hi - lo), "doc_id": batch.column(1).slice(lo, hi - lo), "n": pa.array(n, pa.int64()), "h1": pa.array(h1, pa.int64()), "h2": pa.array(h2, pa.int64()), "sig": pa.array(sig, pa.binary())})

    return docs.select(_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(lean(run), "key long, doc_id long, n long, h1 long, h2 long, sig binary")


def _full(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, s): the whole sets of some documents, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, b in blocks(batch.column(1), lower=True):
                yield pa.RecordBatch.from_pydict({"id": batch.column(0).slice(lo, hi - lo), "s": pa.array([s.tobytes() for s in shingle_sets(b, k)], pa.binary())})

    rows = docs.select(_key().alias("id"), F.col("text").alias("text"))
    # a Bloom filter of MOST_WORDS rows at most keeps other texts out of the exact join's shuffle
    words = min(MOST_WORDS, 1 << max(6, (ids.count() // 8).bit_length()))
    place = F.pmod(F.xxhash64(F.lit(77), "id"), F.lit(64 * words))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_h").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    word = F.shiftright("_h", 6).alias("_w")
    filt = ids.select(place.alias("_h")).select(word, bit.alias("_b")).groupBy("_w").agg(F.bit_or("_b").alias("_bits"))
    near = rows.withColumn("_h", place).withColumn("_w", word).join(F.broadcast(filt), "_w").where(F.col("_bits").bitwiseAND(bit) != 0)
    # an inner join with distinct ids: a semi join would be pushed below the filter
    return near.select("id", "text").join(ids.distinct(), "id").dropDuplicates(["id"]).mapInArrow(lean(run), "id long, s binary")


def _confirm(docs: DataFrame, pairs: DataFrame, k: int, num: int, den: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough, as a table with their intersection and union sizes."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    full = scratch.table(_full(docs, ids, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sa, sb = (batch.column(i) for i in range(4))
            both = []
            for x, y in zip(sa, sb, strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both.append((len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)))
            got = np.array(both, np.int64).reshape(-1, 2)
            inter, union = got[:, 0], got[:, 1] - got[:, 0]
            ok = pa.array((den * inter >= num * union) & (union > 0))
            yield pa.RecordBatch.from_pydict({"a": a.filter(ok), "b": b.filter(ok)})

    sided = pairs.join(full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    out = scratch.table(sided.select("a", "b", "sa", "sb").mapInArrow(lean(run), "a long, b long"))
    scratch.drop(full)
    scratch.tidy()
    return out


def _near(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets of these minwise values and sizes may be similar enough (4.5 standard deviations of the estimate: a pair
    at the bound is missed with a probability of 3e-6)."""
    t = num / den
    least = WIDTH * (t - 4.5 * np.sqrt(t * (1 - t) / WIDTH))
    return ((x == y).sum(axis=-1) >= least) & (den * np.minimum(nx, ny) >= num * np.maximum(nx, ny))


def _shared(full: DataFrame, tokens: int, p: int) -> DataFrame:
    """(id, lim) of the sets (id, s): how many of a set's shingles another of these sets has too.

    Shingles are dealt out by their hashes; those that come twice in a batch go on without owners, so one that a third of all
    sets has costs a place a batch."""
    buckets = max(1, -(-tokens // SHARE_TOKENS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
            every = np.concatenate(sets)
            token, first, times = np.unique(every, return_index=True, return_counts=True)
            own = np.repeat(ids, [len(x) for x in sets])[first]
            once, where = times == 1, token % np.uint64(buckets)
            for k in np.unique(where).tolist():
                a, b = once & (where == k), ~once & (where == k)
                yield pa.RecordBatch.from_pydict({"bucket": [k], "token": [token[a].tobytes()], "own": [own[a].tobytes()], "again": [token[b].tobytes()]})

    groups = -(-buckets // 4)  # of owners

    def grouped(batches: Iterator[pa.RecordBatch], done: Callable[[list], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """done of the rows of each first column's value, without it; the rows are sorted by it."""
        at, held = None, []
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at and held:
                    yield done(held)
                    held = []
                at = key
                held.append(row)
        if held:
            yield done(held)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held):
            token, own, again = (np.concatenate([np.frombuffer(r[j], np.uint64) for r in held]) for j in range(3))
            value, first, times = np.unique(np.concatenate([token, again, again]), return_index=True, return_counts=True)
            owner, n = np.unique(own[first[times == 1]].view(np.int64), return_counts=True)
            to = owner.view(np.uint64) % np.uint64(groups)
            parts_ = [(g, to == g) for g in np.unique(to).tolist()]
            return pa.RecordBatch.from_pydict({"group": pa.array([g for g, _ in parts_], pa.int64()), "owner": pa.array([owner[m].tobytes() for _, m in parts_], pa.binary()), "n": pa.array([n[m].astype(np.int64).tobytes() for _, m in parts_], pa.binary())})

        yield from grouped(batches, done)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held):
            owner, n = (np.concatenate([np.frombuffer(r[j], np.int64) for r in held]) for j in range(2))
            ids, where = np.unique(owner, return_inverse=True)
            out = np.zeros(len(ids), np.int64)
            np.add.at(out, where, n)
            return pa.RecordBatch.from_pydict({"id": pa.array(ids), "alone": pa.array(out)})

        yield from grouped(batches, done)

    dealt = full.mapInArrow(lean(deal), "bucket long, token binary, own binary, again binary")
    counted = dealt.repartition(min(buckets, 64 * p), "bucket").sortWithinPartitions("bucket").mapInArrow(lean(count), "group long, owner binary, n binary")
    alone = counted.repartition(min(groups, 64 * p), "group").sortWithinPartitions("group").mapInArrow(lean(total), "id long, alone long")
    n = (F.length("s") / 8).cast("long")
    return full.select("id", n.alias("n")).join(alone, "id", "left").select("id", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("lim"))


def _possible(at: DataFrame, num: int, den: int) -> DataFrame:
    """Those members (key, tree, id, n, lim, comp) of nodes that may have a partner there."""
    least = at.groupBy("key").agg(F.min("n").alias("least"))
    size = F.greatest("least", F.ceil(F.col("n") * num / den))
    return at.join(least, "key").where((num + den) * F.col("lim") >= num * (F.col("n") + size)).select("key", "tree", "id", "n", "lim", "comp")


def _opened(members: DataFrame) -> DataFrame:
    """Members (key, comp and more) of nodes with several components, with the node's size."""
    open_ = members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2")
    return members.join(open_.select("key", "size"), "key")


def _star(members: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a > b) of a member and a centre of its node that may be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, WIDTH) for i in (2, 3))
                nx, ny = (batch.column(i).to_numpy() for i in (4, 5))
                ok = pa.array(_near(x, y, nx, ny, num, den))
                yield pa.RecordBatch.from_pydict({"a": batch.column(0).filter(ok), "b": batch.column(1).filter(ok)})

    pairs = members.where("id <> lo").select(F.greatest("id", "lo").alias("a"), F.least("id", "lo").alias("b")).distinct()
    sided = pairs.join(reps.selectExpr("id a", "sig xa", "n na"), "a").join(reps.selectExpr("id b", "sig xb", "n nb"), "b")
    return sided.select("a", "b", "xa", "xb", "na", "nb").mapInArrow(lean(run), "a long, b long")


def _exhaustive(members: DataFrame, num: int, den: int, p: int) -> DataFrame:
    """(key, id, n, comp, outer): the sets that may be similar to one of another component, within the groups (key, tree, id, comp,
    n, lim, sig, mask, side, outer). Rows that aren't outer are compared with the outer ones only, each pair of outer ones
    once, and of a group with several sides only pairs of two sides. A pair that meets in several trees is compared in the first
    one (``mask`` has the trees whose nodes are compared as they are)."""
    bit = 1 << np.arange(TREES)

    def compare(ids, comp, size, lim, sig, outer, tree, mask, side):
        out = np.zeros(len(ids), bool)
        cross = len(np.unique(side)) > 1
        earlier = (mask[:, None] & bit[None, :tree]) != 0
        for i in np.flatnonzero(outer).tolist():
            fits = (num + den) * np.minimum(lim[i], lim) >= num * (size[i] + size)
            fits &= (comp != comp[i]) & (~outer | (np.arange(len(ids)) > i))
            if cross:
                fits &= side != side[i]
            other = np.flatnonzero(fits)
            other = other[~((sig[other, :tree] == sig[i, :tree]) & earlier[i]).any(axis=1)]
            if len(other):
                ok = _near(sig[i], sig[other], size[i], size[other], num, den)
                out[other[ok]] = True
                out[i] |= ok.any()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def done(t: pa.Table):
            if not t.num_rows:
                return
            key, tree, ids, comp, n, lim, mask, side, outer = (t[c].to_numpy() for c in ("key", "tree", "id", "comp", "n", "lim", "mask", "side", "outer"))
            sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint32).reshape(-1, WIDTH)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            got = [compare(*(x[lo:hi] for x in (ids, comp, n, lim, sig, outer)), int(tree[lo]), mask[lo:hi], side[lo:hi]) for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(ids)], strict=True)]
            at = np.flatnonzero(np.concatenate(got))
            if len(at):
                yield pa.RecordBatch.from_pydict({"key": pa.array(key[at]), "id": pa.array(ids[at]), "n": pa.array(n[at]), "comp": pa.array(comp[at]), "outer": pa.array(outer[at])})

        for batch in batches:  # sorted by key: the last key of a batch may go on in the next
            for lo in range(0, batch.num_rows, 2048):
                t = pa.Table.from_batches([batch.slice(lo, 2048)])
                held = pa.concat_tables([held, t]) if held is not None else t
                key = held["key"].to_numpy()
                cut = int(np.flatnonzero(key == key[-1])[0])
                yield from done(held.slice(0, cut))
                held = held.slice(cut)
        if held is not None:
            yield from done(held)

    rows = members.select("key", "tree", "id", "comp", "n", "lim", "sig", "mask", "side", "outer").repartition(p, "key").sortWithinPartitions("key")
    return rows.mapInArrow(lean(run), "key long, id long, n long, comp long, outer boolean")


def _in_blocks(large: DataFrame) -> DataFrame:
    """Large nodes (with outer and the counts n_out and size) cut into groups of BLOCK members and OUTER outer ones."""
    rows, cols = F.ceil(F.col("size") / BLOCK).cast("int"), F.ceil(F.col("n_out") / OUTER).cast("int")
    at = large.withColumn("r", F.pmod(F.xxhash64("id"), rows).cast("int")).withColumn("c", F.pmod(F.xxhash64(F.lit(3), "id"), cols).cast("int"))
    own = ["tree", "id", "comp", "n", "lim", "sig", "mask", "outer"]
    # every member is in one block of rows, with all columns; every outer one in one column, with all rows
    inner = at.where("not outer").select("key", *own, "r", F.explode(F.sequence(F.lit(0), cols - 1)).alias("c"))
    outer = at.where("outer").select("key", *own, F.explode(F.sequence(F.lit(0), rows - 1)).alias("r"), "c")
    out = inner.union(outer).select(F.xxhash64(F.lit("i"), "key", "r", "c").alias("key"), *own, F.lit(0).alias("side"))
    pairs = at.where("outer").select("key", *own, F.explode(F.sequence(F.lit(0), cols - 1)).alias("to"), "c")
    return out.union(pairs.select(F.xxhash64(F.lit("o"), "key", F.least("c", "to"), F.greatest("c", "to")).alias("key"), *own, F.col("c").alias("side")))


def _met(nodes: DataFrame, reps: DataFrame, num: int, den: int, p: int, scratch: Scratch) -> DataFrame:
    """(key, id, n, comp, outer): the sets of the nodes (key, tree, id, n, lim, comp) and their blocks that may be similar to one outside
    its component; outer are those outside the node's largest component."""
    sums = nodes.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.sum("m").alias("size"), F.max(F.struct("m", "comp")).alias("t"))
    at = nodes.join(sums.select("key", "size", F.col("t.comp").alias("top"), (F.col("size") - F.col("t.m")).alias("n_out")), "key")
    own = at.select("key", "tree", "id", "n", "lim", "comp", "size", "n_out", (F.col("comp") != F.col("top")).alias("outer"))
    mask = nodes.where(F.col("tree") < TREES).groupBy("id").agg(F.bit_or(F.expr("shiftleft(1, tree)")).alias("mask"))
    known = reps.select("id", "sig").join(mask, "id", "left").select("id", "sig", F.coalesce("mask", F.lit(0)).alias("mask"))
    at = scratch.table(own.join(known, "id"))
    small = _exhaustive(at.where(F.col("size") <= SMALL).withColumn("side", F.lit(0)), num, den, p)
    large = at.where(F.col("size") > SMALL)
    if not large.isEmpty():
        small = small.union(_exhaustive(_in_blocks(large), num, den, p))
    out = scratch.table(small.dropDuplicates(["key", "id"]))
    scratch.drop(at)
    return out


def _first_keys(reps: DataFrame) -> DataFrame:
    """A set's node in each tree: its minwise token."""
    return reps.select("id", "n", F.posexplode(F.expr(f"transform(sequence(0, {TREES - 1}), t -> xxhash64(t, substring(sig, 4 * t + 1, 4)))")).alias("tree", "key"))


def _child_keys(members: DataFrame) -> DataFrame:
    """The children that a large node's members go on to; the path picks which minwise tokens are taken."""
    at = f"{TREES} + cast(pmod(xxhash64(key, b), {WIDTH - TREES}) as int)"
    keys = F.expr(f"array_distinct(transform(sequence(1, {BRANCH}), b -> xxhash64(key, b, substring(sig, 4 * ({at}) + 1, 4))))")
    return members.select("id", "n", "lim", "comp", F.lit(TREES).alias("tree"), F.explode(keys).alias("key")).dropDuplicates(["key", "id"])


def similar_sets(docs: DataFrame, scratch: Scratch, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): every row's key, doc_id, n, h1, h2; and (id, component) of the class representatives that are linked."""
    p = parts(docs.sparkSession)
    rows = scratch.table(_sets(docs, k))
    ids = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("key").alias("id"))
    hashed = rows.where("n > 0").select(F.col("key").alias("id"), "h1", "h2", "n", "sig")
    reps = scratch.table(hashed.join(ids, ["id", "h1", "h2"], "left_semi").dropDuplicates(["id", "h1", "h2"]).select("id", "n", "sig"))
    level = _first_keys(reps)
    picked = [F.min(F.struct(F.xxhash64(F.lit(i), "id").alias("h"), "id")).alias(f"p{i}") for i in (1, 2)]
    nodes = level.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("lo"), *picked).where("size > 1")
    members = scratch.table(level.join(nodes.select("key", "size", "lo", F.col("p1.id").alias("p1"), F.col("p2.id").alias("p2")), "key"))
    large = members.where(F.col("size") > SMALL)
    star = scratch.table(_star(members.select("id", "lo").union(large.select("id", "p1")).union(large.select("id", "p2")), reps, num, den))
    links = _confirm(docs, star, k, num, den, scratch)
    comp = scratch.table(components(links, scratch))
    # the star has compared all of a node of two
    at = members.where("size > 2").select("key", "tree", "id", "n").join(comp, "id", "left")
    at = scratch.table(_opened(at.select("key", "tree", "id", "n", F.coalesce("component", "id").alias("comp"))))
    scratch.drop(members, star)
    columns = ["key", "tree", "id", "n", "lim", "comp"]
    found = [at.where(F.col("size") <= ALL).withColumn("lim", F.col("n")).select(columns)]
    at = at.where(F.col("size") > ALL)
    if not at.isEmpty():
        ids = at.select("id", "n").distinct()
        full = scratch.table(_full(docs, ids.select("id"), k))
        held = scratch.table(_shared(full, ids.agg(F.sum("n")).first()[0], p))
        scratch.drop(full)
        scratch.tidy()
        at = at.drop("size").join(held, "id")
        for depth in range(1, DEPTH + 1):
            at = scratch.table(_opened(_possible(at, num, den)))
            found.append(at.where(F.col("size") <= SMALL).select(columns))
            large = at.where(F.col("size") > SMALL)
            most = large.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(F.max("m").alias("m"))
            large = large.join(most, "key").withColumn("n_out", F.col("size") - F.col("m"))
            # minwise tokens don't part the copies of one text, so a node that one component fills is not branched further
            filled = F.lit(depth == DEPTH) | (F.col("n_out") <= OUTER) | (2 * F.col("n_out") <= F.col("size"))
            large = scratch.table(large.select(*columns, filled.alias("filled")))
            found.append(large.where("filled").select(columns))
            parted = large.where("not filled")
            if parted.isEmpty():
                break
            at = _child_keys(parted.select(columns).join(reps.select("id", "sig"), "id").repartition(p, "id"))
    nodes = scratch.table(_union(found))
    met = _met(nodes, reps, num, den, p, scratch)
    last = _link(docs, met, k, num, den, p, scratch)
    if not last.isEmpty():
        comp = scratch.table(components(links.union(last), scratch))
    return rows, comp


def _link(docs: DataFrame, met: DataFrame, k: int, num: int, den: int, p: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between the full sets of the groups (key, id, n, comp, outer) that join two components."""
    sums = met.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("outer"), F.col("n")).otherwise(0)).alias("m"))
    cuts = sums.select("key", F.ceil(F.col("n") / BLOCK_TOKENS).cast("int").alias("rows"), F.ceil(F.col("m") / BLOCK_TOKENS).cast("int").alias("cols"))
    at = met.select("key", "id", "comp", "outer").join(cuts, "key")
    r, c = F.pmod(F.xxhash64("id"), F.col("rows")).cast("int").alias("r"), F.pmod(F.xxhash64(F.lit(3), "id"), F.col("cols")).cast("int").alias("c")
    spread = lambda col: F.explode(F.sequence(F.lit(0), F.col(col) - 1))
    left = at.select("key", "id", "comp", r, spread("cols").alias("c"), F.lit(False).alias("outer"))
    right = at.where("outer").select("key", "id", "comp", c, spread("rows").alias("r"), "outer").select("key", "id", "comp", "r", "c", "outer")
    rows = scratch.table(left.union(right).select(F.xxhash64("key", "r", "c").alias("key"), "id", "comp", "outer"))
    full = scratch.table(_full(docs, rows.select("id").distinct(), k))
    scratch.tidy()

    def compare(ids: np.ndarray, comp: np.ndarray, outer: np.ndarray, sets: list[np.ndarray]):
        at = np.flatnonzero(~outer)
        size = np.array([len(sets[i]) for i in at.tolist()])
        if not len(at) or not outer.any():
            return
        owner = np.repeat(np.arange(len(at)), size)
        tokens = np.concatenate([sets[i] for i in at.tolist()])
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        for i in np.flatnonzero(outer).tolist():
            x = sets[i]
            lo, hi = np.searchsorted(tokens, x), np.searchsorted(tokens, x, side="right")
            span = hi - lo
            hit = np.repeat(lo - np.cumsum(span) + span, span) + np.arange(span.sum())
            inter = np.bincount(owner[hit], minlength=len(at))
            for j in at[(den * inter >= num * (size + len(x) - inter)) & (inter > 0)].tolist():
                if comp[i] != comp[j]:
                    yield ids[i], ids[j]
                    comp[comp == comp[j]] = comp[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, comp, outer, sets = None, [], [], [], []

        def done():
            got = list(compare(np.array(ids, np.int64), np.array(comp, np.int64), np.array(outer, bool), sets)) if ids else []
            return pa.RecordBatch.from_pydict({"a": pa.array([int(x) for x, _ in got], pa.int64()), "b": pa.array([int(y) for _, y in got], pa.int64())})

        for batch in batches:  # sorted by key; a group's sides have about BLOCK_TOKENS shingles each, or one longer set
            for g, i, of, o, raw in zip(*(batch.column(j).to_pylist() for j in range(5)), strict=True):
                if g != key:
                    yield done()
                    key, ids, comp, outer, sets = g, [], [], [], []
                ids.append(i)
                comp.append(of)
                outer.append(o)
                sets.append(np.frombuffer(raw, np.uint64))
        yield done()

    sided = rows.join(full, "id").select("key", "id", "comp", "outer", "s").repartition(p, "key").sortWithinPartitions("key")
    out = scratch.table(sided.mapInArrow(lean(run), "a long, b long"))
    scratch.drop(full)
    scratch.tidy()
    return out


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.union(t)
    return out


def _labelled(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """key, doc_id, n, node (of its component, any number) and component_id of every row."""
    scratch = Scratch(docs.sparkSession)
    rows, comp = similar_sets(docs, scratch, k, num, den)
    classes = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("key").alias("id"), F.min("doc_id").alias("first")).join(comp, "id", "left")
    names = classes.where("component is not null").groupBy("component").agg(F.min("first").alias("name"))
    classes = classes.join(names, "component", "left").select("h1", "h2", F.coalesce("component", "id").alias("node"), F.when(F.col("component").isNull(), F.col("first")).otherwise(F.col("name")).alias("component_id"))
    full = rows.where("n > 0").select("key", "doc_id", "n", "h1", "h2").join(classes, ["h1", "h2"])
    empty = rows.where("n = 0").select("key", "doc_id", "n", F.col("key").alias("node"), F.col("doc_id").alias("component_id"))
    return full.select("key", "doc_id", "n", "node", "component_id").union(empty)


def near_duplicates(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``."""
    out = _labelled(docs, k, num, den).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, k: int = SHINGLE, num: int = NUM, den: int = DEN) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each component does, that of its smallest doc_id; of repeated rows
    one stays. Rows that merely share a doc_id, or have none, all stay."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("f")
    stay = _labelled(docs, k, num, den).groupBy(F.col("n") == 0, "node").agg(first).select(F.col("f.key").alias("_stay")).distinct()
    rows = docs.withColumn("_stay", _key()).withColumn("_hash", F.hash("text"))
    return rows.join(stay, "_stay", "left_semi").dropDuplicates(["_stay", "doc_id", "_hash"]).select(docs.columns)

"""Cropped and edited copies of images, by local binary descriptors.

An image is read at several scales. Corners are local maxima of the Harris response; each gets a patch orientation (the
direction of its intensity centroid) and BITS binary tests, pairs of smoothed pixels turned by that orientation. The tests are
those of a seeded pool that are even and little correlated on seeded noise, so that unlike corners rarely agree by chance. A
descriptor enters TABLES Hamming tables, one for each part of its bits. Two images meet if two of their descriptors share an entry
and differ in MAX_DISTANCE bits at most, whatever the size of the bucket. Links are sought in three steps. In one of EARLY buckets
each image is compared with the smallest one that it meets, then, in all buckets with several components, one image of each
component, and then all that meet and are still in different components: pairs of buckets of up to SMALL images are written,
images of larger ones are dealt into groups of GROUP_BYTES, and each two groups are compared in one task, which finds anew what
meets in it and writes links only. So copies that share all their descriptors make a row for few of them, and a group that is one
component meets the images outside it, but not itself, again. A compared pair is a copy if MIN_INLIERS corners agree on one similarity transform (votes for
rotation, scale and shift). So no bucket makes more pairs than SMALL times its images, and no pair that meets is left out.

Recall: two descriptors that differ in MAX_DISTANCE random bits share a given part with probability (1 - MAX_DISTANCE / BITS) to
the part's length, 0.08, so the least pair that the consensus accepts, of MIN_INLIERS corners that all differ so much, shares an
entry with probability 1 - (1 - 0.08) ^ (MIN_INLIERS * TABLES) = 0.93; pairs with more or closer corners hardly miss. Copies
whose size changed by a factor far from all ratios of SCALES have no corners that agree, and are not found.

Equal images are one from the start, and so are repeated rows. Images that cannot be read, null or empty ones and those without
corners are alone. Images of any size are read whole; their corners are the CORNERS strongest of each scale and tile of TILE
pixels, so their number grows with the area. Equally strong corners go by place. An empty table gives an empty result. Extra
columns are ignored, whatever their names. Rows with null ids are left out.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._graph import components
from ._scratch import Scratch, lean, parts
from ._text import mix, stream

SCALES = (1.0, 0.8, 0.6)
CORNERS, TILE = 48, 112
RADIUS, BITS, TABLES = 9, 256, 4
MIN_INLIERS, MAX_DISTANCE, SMALL = 8, 10, 32
EARLY = 16  #: one of so many buckets is looked through before the others
BLOCK = 4096  #: descriptors of a bucket that are compared with as many at once
GROUP_BYTES = 16 << 20  #: descriptors of a group of images
MOST_WORDS = 1 << 19  #: 64-bit words of the Bloom filter over buckets, at most
_TURNS = 32
_y, _x = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
_DISC = (_x**2 + _y**2) <= RADIUS**2
_ANGLE = 2 * np.pi * np.arange(_TURNS) / _TURNS
#: one descriptor: x, y, log2 scale, angle (float32), then the bits
RECORD = np.dtype([("x", "<f4"), ("y", "<f4"), ("s", "<f4"), ("a", "<f4"), ("bits", "u1", BITS // 8)])


def read_image(raw: bytes | None) -> np.ndarray | None:
    """A binary netpbm image (P5 or P6, 8 bits) as grey values, or None."""
    m = re.match(rb"(P[56])\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s", raw or b"")
    if not m or not 0 < int(m[4]) < 256:
        return None
    w, h, c = int(m[2]), int(m[3]), 1 if m[1] == b"P5" else 3
    body = np.frombuffer(raw[m.end() :], np.uint8)
    if not w * h or len(body) < w * h * c:
        return None
    return body[: w * h * c].reshape(h, w, c).astype(np.float32).mean(axis=2)


def write_image(grey: np.ndarray) -> bytes:
    return b"P5 %d %d 255\n" % grey.shape[::-1] + np.clip(np.rint(grey), 0, 255).astype(np.uint8).tobytes()


def _blur(a: np.ndarray, n: int = 1) -> np.ndarray:
    for _ in range(n):
        p = np.pad(a, 1, mode="edge")
        p = (p[:-2] + 2 * p[1:-1] + p[2:]) / 4
        a = (p[:, :-2] + 2 * p[:, 1:-1] + p[:, 2:]) / 4
    return a


def _resize(a: np.ndarray, s: float) -> np.ndarray:
    if s == 1:
        return a
    a = _blur(a, 1)
    h, w = max(1, int(a.shape[0] * s)), max(1, int(a.shape[1] * s))
    y, x = np.minimum((np.arange(h) + 0.5) / s - 0.5, a.shape[0] - 1), np.minimum((np.arange(w) + 0.5) / s - 0.5, a.shape[1] - 1)
    y, x = np.maximum(y, 0), np.maximum(x, 0)
    y0, x0 = y.astype(int), x.astype(int)
    y1, x1 = np.minimum(y0 + 1, a.shape[0] - 1), np.minimum(x0 + 1, a.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None]
    return (a[y0][:, x0] * (1 - fy) + a[y1][:, x0] * fy) * (1 - fx) + (a[y0][:, x1] * (1 - fy) + a[y1][:, x1] * fy) * fx


def _corners(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (y, x) of a smoothed image's corners, and their orientations."""
    h, w = s.shape
    m = RADIUS + 1
    gy, gx = np.gradient(s)
    xx, yy, xy = _blur(gx * gx, 2), _blur(gy * gy, 2), _blur(gx * gy, 2)
    r = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
    core = r[m:-m, m:-m]
    around = np.maximum.reduce([r[m + dy : h - m + dy] for dy in (-2, -1, 0, 1, 2)])
    around = np.maximum.reduce([around[:, m + dx : w - m + dx] for dx in (-2, -1, 0, 1, 2)])
    ys, xs = np.nonzero((core >= around) & (core > max(1.0, 0.001 * float(r.max()))))
    tile = ys // TILE * (w // TILE + 1) + xs // TILE
    order = np.lexsort((xs, ys, -core[ys, xs], tile))
    ys, xs, tile = ys[order], xs[order], tile[order]
    best = np.arange(len(tile)) - np.searchsorted(tile, tile) < CORNERS
    ys, xs = ys[best] + m, xs[best] + m
    patch = s[ys[:, None, None] + _y, xs[:, None, None] + _x] * _DISC
    return ys, xs, np.arctan2((patch * _y).sum(axis=(1, 2)), (patch * _x).sum(axis=(1, 2))) % (2 * np.pi)


def _at(s: np.ndarray, ys: np.ndarray, xs: np.ndarray, dy: np.ndarray, dx: np.ndarray) -> np.ndarray:
    return s[np.clip(ys[:, None] + dy, 0, s.shape[0] - 1), np.clip(xs[:, None] + dx, 0, s.shape[1] - 1)]


@cache
def _turned() -> np.ndarray:
    """The tests' two places (x1, y1, x2, y2) for each of _TURNS orientations."""
    rng = np.random.default_rng(20)
    pool = np.clip(np.rint(rng.normal(0, RADIUS / 2, (6 * BITS, 4))), -RADIUS + 2, RADIUS - 2)
    pool = pool[(pool[:, :2] != pool[:, 2:]).any(axis=1)]
    seen = []
    for blur in (2, 3, 4, 6, 8):
        a = _blur(rng.normal(size=(128, 128)), blur)
        s = _blur(128 + 50 * (a - a.mean()) / a.std(), 2)
        ys, xs, angle = _corners(s)
        c, n = np.cos(angle)[:, None], np.sin(angle)[:, None]
        spots = [_at(s, ys, xs, np.rint(x * n + y * c).astype(int), np.rint(x * c - y * n).astype(int)) for x, y in (pool[:, :2].T, pool[:, 2:].T)]
        seen.append(spots[0] < spots[1])
    v = np.concatenate(seen).astype(np.float64)
    uneven = np.abs(v.mean(axis=0) - 0.5)
    order = np.argsort(uneven, kind="stable")
    alike = np.abs(np.corrcoef((v + 1e-6 * rng.normal(size=v.shape)).T))
    for most in np.arange(0.2, 1.05, 0.1):
        got: list[int] = []
        for i in order.tolist():
            if len(got) < BITS and (not got or alike[i, got].max() < most):
                got.append(i)
        if len(got) == BITS:
            break
    x1, y1, x2, y2 = pool[got].T
    turn = lambda x, y, a: (x * np.cos(a) - y * np.sin(a), x * np.sin(a) + y * np.cos(a))
    return np.array([np.rint(np.stack([*turn(x1, y1, a), *turn(x2, y2, a)])).astype(int) for a in _ANGLE])


def describe(grey: np.ndarray) -> np.ndarray:
    """The descriptors of an image, as RECORDs."""
    out = []
    for scale in SCALES:
        a = _resize(grey, scale)
        if min(a.shape) <= 2 * (RADIUS + 1):
            continue
        s = _blur(a, 2)
        ys, xs, angle = _corners(s)
        x1, y1, x2, y2 = _turned()[np.rint(angle / (2 * np.pi) * _TURNS).astype(int) % _TURNS].transpose(1, 0, 2)
        rec = np.zeros(len(ys), RECORD)
        rec["x"], rec["y"], rec["s"], rec["a"], rec["bits"] = xs / scale, ys / scale, -np.log2(scale), angle, np.packbits(_at(s, ys, xs, y1, x1) < _at(s, ys, xs, y2, x2), axis=1)
        out.append(rec)
    return np.concatenate(out) if out else np.zeros(0, RECORD)


def _words(rec: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(rec["bits"]).view("<u8")


def _distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int16)


def _keys(words: np.ndarray) -> np.ndarray:
    """The entries of descriptors, one in each table."""
    return mix(words + stream(41, TABLES)[None])


def inliers(a: np.ndarray, b: np.ndarray, enough: int | None = None) -> int:
    """How many corners of two images agree on one similarity transform; with ``enough``, no more than that are looked for."""
    if not len(a) or not len(b):
        return 0
    x, y = _words(a), _words(b)
    # what differs in more bits of the first word differs in more of all
    i, j = np.nonzero(np.bitwise_count(x[:, None, 0] ^ y[None, :, 0]) <= MAX_DISTANCE)
    d = _distance(x[i], y[j])
    order = np.lexsort((j, d, i))[: len(i)]
    order = order[d[order] <= MAX_DISTANCE]
    order = order[np.append(True, np.diff(i[order]) != 0)[: len(order)]]  # the nearest of each
    i, j = i[order], j[order]
    if len(i) < MIN_INLIERS:
        return 0
    p, q = a[i], b[j]
    best = 0
    turn, size = (q["a"] - p["a"]) % (2 * np.pi), q["s"] - p["s"]
    place = (p["x"] // 4).astype(np.int64) << 32 | (p["y"] // 4).astype(np.int64)
    for k in range(len(i)):
        near = (np.abs((turn - turn[k] + np.pi) % (2 * np.pi) - np.pi) < 0.35) & (np.abs(size - size[k]) < 0.6)
        z = 2.0 ** size[k]
        c, s = z * np.cos(turn[k]), z * np.sin(turn[k])
        dx, dy = p["x"] - p["x"][k], p["y"] - p["y"][k]
        ex, ey = q["x"][k] + c * dx - s * dy - q["x"], q["y"][k] + s * dx + c * dy - q["y"]
        ok = near & (np.hypot(ex, ey) < 3 + 0.15 * np.hypot(dx, dy) * z)
        # a place counts once, however many scales have it
        if ok.sum() > best:
            best = max(best, len(np.unique(place[ok])))
            if enough is not None and best >= enough:
                break
    return best


def _described(images: DataFrame) -> DataFrame:
    """id, h and descriptors of every row (id, image, h) where it lies: no image is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                got = []
                for raw in batch.column(1).slice(lo, 256).to_pylist():
                    g = read_image(raw)
                    got.append(describe(g).tobytes() if g is not None else b"")
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), batch.column(2).slice(lo, 256), pa.array(got, pa.binary())], names=["id", "h", "desc"])

    return images.mapInArrow(lean(run), "id long, h string, desc binary")


def _buckets(desc: DataFrame) -> DataFrame:
    """key: the Hamming-table buckets of every image, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pydict({"key": pa.array(np.unique(_keys(_words(np.frombuffer(raw, RECORD)))).view(np.int64))})

    return desc.where("length(desc) > 0").select("desc").mapInArrow(lean(run), "key long")


def _entries(desc: DataFrame, shared: DataFrame) -> DataFrame:
    """(key, n, id, bits): the descriptors in the buckets ``shared`` (key, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = np.unique(_words(np.frombuffer(raw, RECORD)), axis=0)
                key, bits = _keys(words).ravel().view(np.int64), np.repeat(words, TABLES, axis=0)
                at = pa.py_buffer(np.arange(0, 32 * len(key) + 1, 32, np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(key), i)), pa.Array.from_buffers(pa.binary(), len(key), [None, at, pa.py_buffer(bits)])], names=["key", "id", "bits"])

    # a Bloom filter of MOST_WORDS rows at most keeps most other entries out of the exact join's shuffle
    words = min(MOST_WORDS, 1 << max(6, (shared.count() // 8).bit_length()))
    place = F.pmod(F.xxhash64(F.lit(77), "key"), F.lit(64 * words))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_h").bitwiseAND(F.lit(63).cast("long")).cast("int"))
    word = F.shiftright("_h", 6).alias("_w")
    filt = shared.select(place.alias("_h")).select(word, bit.alias("_b")).groupBy("_w").agg(F.bit_or("_b").alias("_bits"))
    rows = desc.where("length(desc) > 0").select("id", "desc").mapInArrow(lean(run), "key long, id long, bits binary")
    near = rows.withColumn("_h", place).withColumn("_w", word).join(F.broadcast(filt), "_w").where(F.col("_bits").bitwiseAND(bit) != 0)
    return near.select("key", "id", "bits").join(shared, "key").select("key", "n", "id", "bits")


def _agree(pairs: DataFrame, desc: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [inliers(np.frombuffer(x, RECORD), np.frombuffer(y, RECORD), MIN_INLIERS) >= MIN_INLIERS for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": batch.column(0).filter(mask), "b": batch.column(1).filter(mask)})

    sided = pairs.join(desc.selectExpr("id a", "desc x"), "a").join(desc.selectExpr("id b", "desc y"), "b")
    return sided.select("a", "b", "x", "y").mapInArrow(lean(run), "a long, b long")


def _meeting(entries: DataFrame, p: int, find: Callable[..., tuple[np.ndarray, np.ndarray]], every: bool = True) -> DataFrame:
    """What ``find`` gives for the ids of descriptors (key, id, bits, comp), those of others, a matrix of what meets, and the
    descriptors' comp: both share a bucket, are near, and in different components. Buckets are cut into blocks of BLOCK. With
    ``every``, what is outside a bucket's largest component is compared with all of the bucket, block by block; else a block with
    itself only."""
    deal = lambda cut: F.pmod(F.xxhash64("id", "bits"), F.col(cut)).cast("int")
    cuts = lambda n: F.ceil(n / BLOCK).cast("int")
    if every:
        sizes = entries.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("key")
        sizes = sizes.agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), cuts(F.sum("m")).alias("cut"), cuts(F.sum("m") - F.max("m")).alias("out")).where("out > 0")
        at = entries.join(sizes, "key")
        each = lambda cut: F.explode(F.sequence(F.lit(0), F.col(cut) - 1))
        asks = at.where("comp <> main").select("key", deal("out").alias("r"), each("cut").alias("c"), "id", "comp", "bits", F.lit(True).alias("asks"))
        rows = asks.union(at.select("key", each("out").alias("r"), deal("cut").alias("c"), "id", "comp", "bits", F.lit(False).alias("asks")))
        rows = rows.select(F.xxhash64("key", "r", "c").alias("block"), "key", "id", "comp", "asks", "bits")
    else:
        at = entries.join(entries.groupBy("key").agg(cuts(F.count(F.lit(1))).alias("cut")), "key")
        rows = at.select(F.xxhash64("key", deal("cut")).alias("block"), "key", "id", "comp", "bits")

    def compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, comp = (t[c].to_numpy() for c in ("id", "comp"))
        words = np.frombuffer(b"".join(t["bits"].to_pylist()), "<u8").reshape(-1, BITS // 64)
        mine = other = np.arange(len(ids))
        if every:
            asks = t["asks"].to_numpy()
            mine, other = np.flatnonzero(asks), np.flatnonzero(~asks)
        other = other[np.argsort(ids[other], kind="stable")]
        step = max(1, (1 << 20) // max(1, len(other)))
        for lo in range(0, len(mine), step):
            m = mine[lo : lo + step]
            met = (_distance(words[m][:, None], words[other][None]) <= MAX_DISTANCE) & (comp[m][:, None] != comp[other][None])
            a, b = find(ids[m], ids[other], met, comp[m])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:  # sorted by block: the last one may go on in the next batch
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, t]) if held is not None else t
            block, key = held["block"].to_numpy(), held["key"].to_numpy()
            cut = np.flatnonzero(np.append(True, (block[1:] != block[:-1]) | (key[1:] != key[:-1])))
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
                yield from compare(held.slice(lo, hi - lo))
            held = held.slice(int(cut[-1]))
        if held is not None:
            yield from compare(held)

    return rows.repartition(p, "block").sortWithinPartitions("block", "key").mapInArrow(lean(run), "a long, b long")


def _first(ids: np.ndarray, others: np.ndarray, met: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One image of each component, with the smallest id that the component meets, if that is a smaller one than the image's."""
    if not len(others):
        return ids[:0], ids[:0]
    b = others[met.argmax(axis=1)]
    ok = np.flatnonzero(met.any(axis=1) & (b < ids))
    ok = ok[np.argsort(b[ok], kind="stable")]
    ok = ok[np.unique(comp[ok], return_index=True)[1]]
    return ids[ok], b[ok]


def _pairs(ids: np.ndarray, others: np.ndarray, met: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.nonzero(met)
    a, b = np.unique(np.stack([np.maximum(ids[i], others[j]), np.minimum(ids[i], others[j])]), axis=1)
    return a, b


def _any(ids: np.ndarray, others: np.ndarray, met: np.ndarray, comp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    met_ = np.union1d(ids[met.any(axis=1)], others[met.any(axis=0)])
    return met_, met_


def _open(entries: DataFrame, comp: DataFrame) -> DataFrame:
    """The entries of buckets of several components, with comp."""
    at = entries.join(comp, "id", "left").select("key", "n", "id", "bits", F.coalesce("component", "id").alias("comp"))
    return at.join(at.groupBy("key").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 <> c2").select("key"), "key")


def _within_groups(ids: DataFrame, desc: DataFrame, comp: DataFrame, p: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) between these images that meet and are in different components. They are dealt into groups of GROUP_BYTES;
    each two groups are compared in one task."""
    at = desc.join(ids, "id", "left_semi").join(comp, "id", "left").select("id", F.coalesce("component", "id").alias("comp"), "desc")
    at = scratch.table(at)
    n = -(-(at.agg(F.sum(F.length("desc"))).first()[0] or 0) // GROUP_BYTES) or 1
    own = at.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(n)))
    both = own.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    rows = both.select((F.least("g", "to") * n + F.greatest("g", "to")).alias("key"), "g", "id", "comp", "desc")

    def buckets(words: np.ndarray, owner: np.ndarray, n_images: int, t: int) -> tuple[np.ndarray, ...]:
        """Of one table: the descriptors in buckets of several, by bucket; for each of them, by image, where its bucket begins and
        ends, and which it is; and where each image's begin. One table at a time, and 32 bits, keep a group's memory low."""
        key = mix(words[:, t] + stream(41, TABLES)[t])
        of = np.argsort(key, kind="stable").astype(np.int32)
        key = key[of]
        several = np.append(False, key[1:] == key[:-1]) | np.append(key[1:] == key[:-1], False)
        of, key = of[several], key[several]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)]).astype(np.int32)
        size = np.diff(np.append(first, np.int32(len(key))))
        at = np.argsort(of, kind="stable").astype(np.int32)
        lo, hi, mine = np.repeat(first, size)[at], np.repeat(first + size, size)[at], of[at]
        return of, lo, hi, mine, np.searchsorted(owner[mine], np.arange(n_images + 1))

    def compare(held: list[tuple]) -> Iterator[tuple[int, int]]:
        recs = [np.frombuffer(r[4], RECORD) for r in held]
        side, root = np.array([r[1] for r in held]), np.array([r[3] for r in held])
        cross = len(np.unique(side)) > 1
        if n > 1 and not cross and held[0][0] != held[0][1] * n + held[0][1]:
            return  # the other group is empty
        words = np.concatenate([_words(r) for r in recs])
        owner = np.repeat(np.arange(len(recs), dtype=np.int32), [len(r) for r in recs])
        tables = [buckets(words, owner, len(recs), t) for t in range(TABLES)]
        for i in range(len(recs)):
            met: set[int] = set()
            for of, lo, hi, mine, ends in tables:
                for e in range(ends[i], ends[i + 1]):
                    others = of[lo[e] : hi[e]]
                    o = owner[others]
                    ok = (o > i) & (root[o] != root[i])
                    if cross:
                        ok &= side[o] != side[i]
                    others = others[ok]
                    met.update(owner[others[_distance(words[others], words[mine[e]]) <= MAX_DISTANCE]].tolist())
            for j in sorted(met):
                if root[i] != root[j] and inliers(recs[i], recs[j], MIN_INLIERS) >= MIN_INLIERS:
                    yield held[i][2], held[j][2]
                    root[root == root[j]] = root[i]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def done() -> pa.RecordBatch:
            got = list(compare(held)) if held else []
            return pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in got], pa.int64()), "b": pa.array([y for _, y in got], pa.int64())})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and held[0][0] != row[0]:
                    yield done()
                    held = []
                held.append(row)
        yield done()

    out = scratch.table(rows.repartition(max(p, n), "key").sortWithinPartitions("key").mapInArrow(lean(run), "a long, b long"))
    scratch.drop(at)
    return out


def copies(images: DataFrame) -> DataFrame:
    """images: id, image. Per row: id, n_corners, and class_id (the smallest id among its copies, itself included)."""
    scratch = Scratch(images.sparkSession)
    p = parts(images.sparkSession)
    own = images.where("id is not null").select(F.col("id").cast("long").alias("id"), "image", F.sha2("image", 256).alias("h"))
    heads = scratch.table(own.select("id", "h"))
    rep = heads.groupBy("h").agg(F.min("id").alias("rep")).where("h is not null")
    ids = scratch.table(heads.join(rep, "h", "left").select("id", F.coalesce("rep", "id").alias("rep")))
    desc = scratch.table(_described(own).select("id", "desc").join(ids.where("id = rep").select("id").distinct(), "id", "left_semi").dropDuplicates(["id"]))
    scratch.drop(heads)
    scratch.tidy()
    shared = scratch.table(_buckets(desc).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    scratch.tidy()
    entries = scratch.table(_entries(desc, shared))
    early = entries.where(F.pmod(F.xxhash64(F.lit(5), "key"), F.lit(EARLY)) == 0).withColumn("comp", F.col("id"))
    smallest = lambda met: met.groupBy("a").agg(F.min("b").alias("b"))
    tried = scratch.table(smallest(_meeting(early, p, _first, every=False)))
    links = scratch.table(_agree(tried, desc))
    scratch.tidy()
    comp = scratch.table(components(links, scratch))
    at = scratch.table(_open(entries, comp))
    scratch.drop(entries, shared)

    def further(pairs: DataFrame) -> None:
        """Compares these pairs, but those compared before."""
        nonlocal tried, links, comp, at
        new = scratch.table(pairs.join(tried, ["a", "b"], "left_anti"))
        more = scratch.table(_agree(new, desc))
        scratch.tidy()
        tried, links = tried.union(new), links.union(more)
        if not more.isEmpty():
            comp, old = scratch.table(components(links, scratch)), at
            at = scratch.table(_open(old.select("key", "n", "id", "bits"), comp))
            scratch.drop(old)

    further(smallest(_meeting(at, p, _first, every=False)))
    further(_meeting(at.where(F.col("n") <= SMALL), p, _pairs).distinct())
    large = scratch.table(_meeting(at.where(F.col("n") > SMALL), p, _any).select(F.col("a").alias("id")).distinct())
    if not large.isEmpty():
        last = _within_groups(large, desc, comp, p, scratch)
        if not last.isEmpty():
            comp = scratch.table(components(links.union(last), scratch))
    corners = desc.select(F.col("id").alias("rep"), (F.length("desc") / RECORD.itemsize).cast("long").alias("n_corners"))
    of = corners.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
    out = ids.join(of, "rep", "left")
    return out.select("id", F.coalesce("n_corners", F.lit(0)).alias("n_corners"), F.coalesce("component", "rep").alias("class_id"))


def rendered(vectors: DataFrame, side: int = 112) -> DataFrame:
    """Vectors as images, one for each row: id and image. A vector's values weigh fixed fields of smooth noise, so like
    vectors give like images."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields: dict[int, np.ndarray] = {}
        for lo, batch in ((lo, b) for b in batches for lo in range(0, b.num_rows, 256)):  # few images at once, in the JVM too
            out = []
            for v in batch.column(1).slice(lo, 256).to_pylist():
                x = np.array([0.0 if a is None else a for a in v or []], np.float32)
                if len(x) not in fields:
                    rng = np.random.default_rng(len(x))
                    fields[len(x)] = np.array([_blur(rng.normal(size=(side, side)).astype(np.float32), 6) for _ in x]).reshape(len(x), -1)
                mixed = x @ fields[len(x)]
                spread = float(mixed.std()) if len(x) else 0.0
                out.append(write_image(128 + 50 * ((mixed - mixed.mean()) / spread).reshape(side, side)) if spread > 0 else None)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, 256), pa.array(out, pa.binary())], names=["id", "image"])

    return vectors.mapInArrow(lean(run), "id long, image binary")

"""Passages that repeat across documents, by a sparse suffix array.

Suffixes are retained at content-selected positions only: a word position stays if the hash of the K words from it is the
least of some WINDOW consecutive ones (a minimiser), so equal passages of K + WINDOW - 1 words or more retain the same
positions. Retained suffixes whose first K words occur once are dropped by their counts. The others are dealt out by those
words and sorted. A match of K words is extended left and right: for each split of the remaining MIN_WORDS - K words, m before
and the rest after, the suffixes are sorted by them and neighbours compared, so no partner of a suffix hides another one. Each
retained suffix so proves runs of MIN_WORDS words by itself, and the runs of successive suffixes join to the whole passage.
Groups of more than HOT suffixes, a passage in a large share of all documents, don't go to one task: their rows and splits are
matched by a shuffle with map-side sums.

Words are compared by hashes: the K words by 64 bits, every other one by 40, so two different words count as equal once in
10^12 comparisons.

Null and empty texts and texts of fewer than MIN_WORDS words have no passages, an empty table gives an empty result, texts of
any length are searched whole. Passages that repeat within one document only are not reported. Rows that share a doc_id are one
document, so what only they share is no repeat; but a row is known by a hash of doc_id and text, so that each is cut by its own
passages. Repeated rows are cut alike and reported once. Of documents with a passage, the smallest doc_id keeps it. Rows without
doc_id are ignored by ``passages`` and kept as they are by ``remove_passages``. Extra columns are ignored or kept, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch, lean, parts
from ._text import Block, blocks, mix

MIN_WORDS = 50
WINDOW = 17
K = MIN_WORDS - WINDOW + 1
CTX = WINDOW - 1  #: words of context on each side
_W = 5  #: bytes of a word's hash in a context
ROWS_PER_PART = 60_000
HOT = 20_000  #: suffixes of one group that a task compares; larger groups are compared through shuffled keys


def _slide(x: np.ndarray, w: int, f, pad) -> np.ndarray:
    """f over x[i : i + w] for each i; past the end, pad."""
    out, have = x, 1
    while have < w:
        step = min(have, w - have)
        out = f(out, np.concatenate([out[step:], np.full(step, pad, x.dtype)]))
        have += step
    return out


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on, by doubling; past the end of the words it means nothing."""
    h, have, out, done, mult = words, 1, None, 0, 0x2545F4914F6CDD1D
    shift = lambda a, n: np.concatenate([a[n:], np.zeros(min(n, len(a)), a.dtype)])[: len(a)]
    while True:
        if k & have:
            out = h if out is None else out * np.uint64(mult) + shift(h, done)
            done += have
        have *= 2
        if have > k:
            break
        h = h * np.uint64(mult) + shift(h, have // 2)
        mult = mult * mult % 2**64
    return mix(out)


def minimisers(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(word index, hash of the K words there) of the retained suffixes of a block's texts."""
    n = len(b.starts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    left = np.repeat(b.bounds[1:], b.n_words) - np.arange(n)  # words from here to the text's end
    g = _grams(b.words, K)
    big = np.uint64(0xFFFFFFFFFFFFFFFF)
    low = _slide(np.where(left >= K, g, big), WINDOW, np.minimum, big)
    low = np.where(left >= MIN_WORDS, low, 0)  # windows that leave their text select nothing
    most = _slide(low[::-1], WINDOW, np.maximum, np.uint64(0))[::-1]
    at = np.flatnonzero((left >= K) & (g == most))
    return at, g[at]


def _row(text: str = "text") -> Column:
    """What a row is known by."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col(text))


def _retained(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, _, b in blocks(batch.column(1)):
                at, h = minimisers(b)
                doc = b.doc_of_word[at]
                yield pa.RecordBatch.from_pydict({"h": pa.array(h.view(np.int64)), "row": pa.array(ids[lo + doc]), "pos": pa.array((at - b.bounds[doc]).astype(np.int32))})

    return docs.select("row", "text").mapInArrow(lean(run), "h long, row long, pos int")


def _contexts(rows: DataFrame) -> DataFrame:
    """rows: doc_id, text, at (the wanted word positions, with their hashes), row. One row per position with its contexts.

    ``rc`` are the CTX words after the K words, ``lc`` those before them, nearest first; shorter at a text's ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2)
            for lo, hi, b in blocks(batch.column(1)):
                w = (b.words >> np.uint64(64 - 8 * _W)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_W]
                out = {"h": [], "row": [], "doc_id": [], "pos": [], "hot": [], "lc": [], "rc": []}
                back = np.ascontiguousarray(w[::-1]).tobytes()
                ahead, n = np.ascontiguousarray(w).tobytes(), len(w)
                for i in range(lo, hi):
                    first, end = int(b.bounds[i - lo]), int(b.bounds[i - lo + 1])
                    here = at.slice(i, 1).flatten()
                    pos, h, hot = (x.to_numpy(zero_copy_only=False) for x in here.flatten())
                    p = first + pos.astype(np.int64)
                    out["h"].append(h)
                    out["hot"].append(hot)
                    out["pos"].append((p - first).astype(np.int32))
                    out["doc_id"].append(np.full(len(p), batch.column(0)[i].as_py(), np.int64))
                    out["row"].append(np.full(len(p), batch.column(3)[i].as_py(), np.int64))
                    out["rc"] += [ahead[_W * (x + K) : _W * min(end, x + K + CTX)] for x in p.tolist()]
                    out["lc"] += [back[_W * (n - x) : _W * (n - max(first, x - CTX))] for x in p.tolist()]
                yield pa.RecordBatch.from_pydict({
                    "h": pa.array(np.concatenate(out["h"])), "row": pa.array(np.concatenate(out["row"])), "doc_id": pa.array(np.concatenate(out["doc_id"])), "pos": pa.array(np.concatenate(out["pos"])),
                    "hot": pa.array(np.concatenate(out["hot"])), "lc": pa.array(out["lc"], pa.binary()), "rc": pa.array(out["rc"], pa.binary()),
                })

    return rows.mapInArrow(lean(run), "h long, row long, doc_id long, pos int, hot boolean, lc binary, rc binary")


def _matrix(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Contexts as rows of CTX words, and their lengths in words."""
    got = col.to_pylist()
    lens = np.fromiter((len(x) // _W for x in got), np.int64, len(got))
    raw = np.zeros((len(got), CTX, 8), np.uint8)
    raw[:, :, :_W] = np.frombuffer(b"".join(x.ljust(_W * CTX, b"\0") for x in got), np.uint8).reshape(-1, CTX, _W)
    return raw.reshape(-1, 8).view("<u8").reshape(-1, CTX), lens


def _prefixes(words: np.ndarray, c: int) -> np.ndarray:
    """Hashes of the first 0, 1, ... CTX words of each context."""
    out = np.zeros((len(words), CTX + 1), np.uint64)
    for m in range(CTX):
        out[:, m + 1] = out[:, m] * np.uint64(c) + mix(words[:, m] + np.uint64(1))
    return out


_OUT = "row long, doc_id long, start long, end long, later boolean"


def _keys(t: pa.Table | pa.RecordBatch) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each split m: hashes of the m words before, the K words, and the CTX - m after; and which suffixes have so many."""
    h = t.column(t.schema.get_field_index("h")).to_numpy().view(np.uint64)
    (L, nl), (R, nr) = _matrix(t.column(t.schema.get_field_index("lc"))), _matrix(t.column(t.schema.get_field_index("rc")))
    HL, HR = _prefixes(L, 0x2545F4914F6CDD1D), _prefixes(R, 0x9E6C63D0876A9A47)
    each = range(CTX + 1)
    return [mix(HL[:, m] ^ mix(HR[:, CTX - m] + h + np.uint64(m))) for m in each], [np.flatnonzero((nl >= m) & (nr >= CTX - m)) for m in each]


def _neighbours(rows: DataFrame) -> DataFrame:
    """The spans that the suffixes of each partition prove; groups lie in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got).combine_chunks()
        doc, own, pos = t["doc_id"].to_numpy(), t["row"].to_numpy(), t["pos"].to_numpy().astype(np.int64)
        found, later = np.zeros((2, len(doc), CTX + 1), bool)
        for m, (key, at) in enumerate(zip(*_keys(t), strict=True)):
            at = at[np.lexsort((doc[at], key[at]))]
            g = np.cumsum(np.concatenate([[False], np.diff(key[at]) != 0]))[: len(at)]
            first, last = np.searchsorted(g, g), np.searchsorted(g, g, side="right") - 1
            found[at, m] = doc[at[first]] != doc[at[last]]
            later[at, m] = doc[at[first]] < doc[at]
        for kind, flag in ((found & ~later, False), (found & later, True)):
            i = np.flatnonzero(kind.any(axis=1))
            most, least = CTX - kind[i][:, ::-1].argmax(axis=1), kind[i].argmax(axis=1)
            yield pa.RecordBatch.from_pydict({"row": pa.array(own[i]), "doc_id": pa.array(doc[i]), "start": pa.array(pos[i] - most), "end": pa.array(pos[i] + K + CTX - least), "later": pa.array(np.full(len(i), flag))})

    return rows.mapInArrow(lean(run), _OUT)


def _hot_spans(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The same for groups of any size, by a shuffle of every split's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                own, doc, pos = (batch.column(batch.schema.get_field_index(c)).to_numpy().astype(np.int64) for c in ("row", "doc_id", "pos"))
                for m, (key, at) in enumerate(zip(*_keys(batch), strict=True)):
                    yield pa.RecordBatch.from_pydict({"key": pa.array(key[at].view(np.int64)), "row": pa.array(own[at]), "doc_id": pa.array(doc[at]), "start": pa.array(pos[at] - m)})

    keys = rows.mapInArrow(lean(run), "key long, row long, doc_id long, start long")
    # stored, so that the join has two shuffles of its own, whose large keys are split
    both = scratch.table(keys.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last"))
    return keys.join(both, "key").select("row", "doc_id", "start", (F.col("start") + MIN_WORDS).alias("end"), (F.col("first") < F.col("doc_id")).alias("later"))


def _union(spans: np.ndarray) -> np.ndarray:
    """Overlapping or adjoining spans (start, end) joined."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    reach = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > reach[:-1]]))
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def _spans(column: pa.Array, i: int) -> tuple[np.ndarray, np.ndarray]:
    """The spans of row i of a column of arrays (start, end, later): all, and the later ones, each joined."""
    start, end, later = (x.to_numpy(zero_copy_only=False) for x in column.slice(i, 1).flatten().flatten())
    both = np.stack([start, end], axis=1).astype(np.int64)
    return _union(both), _union(both[later.astype(bool)])


def _per_row(spans: DataFrame) -> DataFrame:
    return spans.groupBy("row").agg(F.min("doc_id").alias("doc_id"), F.collect_set(F.struct("start", "end", "later")).alias("spans"))


def repeats(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """A table of (row, doc_id, start, end, later), in words, not yet joined; later: an earlier document has the passage too."""
    spark = docs.sparkSession
    ids = docs.where("doc_id is not null").select(_row().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    kept = scratch.table(_retained(ids))
    twice = scratch.table(kept.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", (F.col("n") > HOT).alias("hot")))
    wanted = kept.join(twice, "h")
    at = wanted.groupBy("row").agg(F.collect_set(F.struct("pos", "h", "hot")).alias("at"))
    rows = scratch.table(_contexts(ids.join(at, "row").select("doc_id", "text", "at", "row")))
    n = rows.count()
    scratch.drop(kept, twice)
    scratch.tidy()
    p = max(parts(spark), n // ROWS_PER_PART + 1)
    spans = _neighbours(rows.where("not hot").repartition(p, "h"))
    if not rows.where("hot").isEmpty():
        spans = spans.union(_hot_spans(rows.where("hot"), scratch))
    return scratch.table(spans)


def passages(docs: DataFrame) -> DataFrame:
    """One row per passage of MIN_WORDS words or more that other documents have too: doc_id, start_word, end_word, n_words,
    n_removed (how many of its words an earlier document has, in such passages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_numpy(), []
            for i in range(batch.num_rows):
                every, gone = _spans(batch.column(1), i)
                # a joined span holds whole ones of those that go
                total = np.concatenate([[0], np.cumsum(gone[:, 1] - gone[:, 0])])
                n = total[np.searchsorted(gone[:, 0], every[:, 1])] - total[np.searchsorted(gone[:, 0], every[:, 0])]
                out.append(np.column_stack([np.full(len(every), ids[i]), every, every[:, 1] - every[:, 0], n]))
            if out:
                got = np.concatenate(out)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, j])) for j in range(5)], names=["doc_id", "start_word", "end_word", "n_words", "n_removed"])

    spans = repeats(docs, Scratch(docs.sparkSession))
    return _per_row(spans).select("doc_id", "spans").mapInArrow(lean(run), "doc_id long, start_word long, end_word long, n_words long, n_removed long")


def remove_passages(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` without the passages that an earlier document has (smaller doc_id); a text that loses all its words goes.

    The words of a passage are cut with the white space after them; ``length`` is set anew where the text changes."""
    scratch = Scratch(docs.sparkSession)
    cuts = _per_row(repeats(docs.withColumn("text", F.col(text)), scratch).where("later")).select(F.col("row").alias("_cut_row"), F.col("spans").alias("_cut_spans"))
    names = docs.columns
    t, i = names.index(text), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, texts = batch.column(i), batch.column(t).to_pylist()
            keep = np.ones(batch.num_rows, bool)
            lens = batch.column(names.index(length)).to_pylist() if length in names else None
            for lo, _, b in blocks(batch.column(t)):
                for r in range(b.n):
                    if not spans[lo + r].is_valid:
                        continue
                    first, n = int(b.bounds[r]), int(b.n_words[r])
                    raw, base = b.data[b.off[r] : b.off[r + 1]].tobytes(), int(b.off[r])
                    out, at, gone = [], 0, 0
                    for x, y in _spans(spans, lo + r)[1].tolist():
                        gone += y - x
                        out.append(raw[at : int(b.starts[first + x]) - base])
                        at = int(b.starts[first + y]) - base if y < n else len(raw)
                    keep[lo + r] = gone < n
                    texts[lo + r] = b"".join([*out, raw[at:]]).decode()
                    if lens is not None:
                        lens[lo + r] = len(texts[lo + r])
            cols = [batch.column(j) for j in range(i)]
            cols[t] = pa.array(texts, cols[t].type)
            if lens is not None:
                cols[names.index(length)] = pa.array(lens, cols[names.index(length)].type)
            yield pa.RecordBatch.from_arrays(cols, names=names).filter(pa.array(keep))

    joined = docs.join(cuts, _row(text) == F.col("_cut_row"), "left")
    return joined.select(*[docs[c] for c in names], "_cut_spans").mapInArrow(lean(run), docs.schema)



"""Packing of tokenised documents into training sequences by lexical retrieval.

The inverted index is sharded by content. Over all documents the frequency of every word is counted in a sketch of SLOTS
counters (words that share one add up, so a count is never too low). A document's shard key are two of its words, drawn
by minwise hashing with weights that grow with a word's rarity, so documents that share rare words tend to have the same key.
Documents are range partitioned and sorted by key, and consecutive ones, SHARD rows or SHARD_BYTES, form a shard; neighbouring
keys share a shard, a frequent key has several. A shard's BM25 index weighs words by their frequencies in all documents. A
seed document (what is left of the last one cut, or else the next unused one) asks it with all its words for unused
neighbours, which fill the seed's window in the order of their scores, as many as have one. A document that doesn't fit is cut,
and its rest is the next seed. What does not fill a window at a shard's end goes on to the next shard; only at a partition's
end it is cut into sequences whose lengths are powers of two, so nothing is padded.

Null texts count as empty; an empty document has its end id alone, an empty table gives an empty result. Repeated rows are
packed as often as they come, and are next to each other. Equal scores go by place. Rows of null doc_id are packed too. A text of
any length is tokenised whole and may go over many sequences. Extra columns are ignored, whatever their names. Memory holds a
shard: SHARD rows or SHARD_BYTES of text and one document more.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch, kept, lean, parts
from ._text import Block, blocks, mix

WINDOW, END = 4096, 2
SHARD, SHARD_BYTES = 1024, 16 << 20  #: documents and bytes of a shard
PART_BYTES = 64 << 20  #: bytes of text in a partition, about
SLOTS = 1 << 20  #: counters of document frequencies
K1, B = 1.2, 0.75
RARITY = 3  #: power of the inverse document frequency that weighs words for shard keys
CACHE = 600_000  #: words in each of the two generations of an encoder's memory
SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")  #: of them alone no cut follows but from letters and digits
_SIGN, _SOLID = np.zeros(256, bool), np.zeros(256, bool)
_SIGN[list(SIGNS.encode())] = True
_SOLID[[c for c in range(128) if chr(c).isalnum()]] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[65:91] += 32
_BESIDE = np.arange(64, -1, -8).astype(np.uint64)  #: bits of eight bytes that aren't among the first so many
_FAST = {  # what the encoder of words relies on
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value's number, from 0 in the order of first places, and the values by number."""
    coded = pa.array(values).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy()


class Words:
    """The words of texts, A-Z lower-cased: their hashes (terms), text by text (bounds); and what the tokenizer's ids come from
    (tokens): the words, but letters and digits apart from the signs behind them."""

    def __init__(self, texts: pa.Array):
        terms, n_words, n_tokens, hashes, starts, lens, data = ([np.zeros(0, t)] for t in (np.uint64, np.int64, np.int64, np.uint64, np.int64, np.int64, np.uint8))
        marked, at = [np.zeros(0, bool)], 0
        for _, _, b in blocks(texts, lower=True):
            first, cut, end = b.starts, _signs_from(b), b.ends
            both = np.flatnonzero(cut < end)
            tokens = np.arange(len(first)) + np.searchsorted(both, np.arange(len(first)))  # where each word's first token is
            lo, hi = np.repeat(first, 1 + (cut < end)), np.repeat(end, 1 + (cut < end))
            hi[tokens[both]] = lo[tokens[both] + 1] = cut[both]
            h = b.hashes(lo, hi)
            of = h[tokens]
            of[both] = b.hashes(first[both], end[both])
            terms.append(of)
            hashes.append(h)
            starts.append(lo + at)
            lens.append(hi - lo)
            n_words.append(b.n_words)
            n_tokens.append(b.n_words + b.per_text(cut < end))
            data.append(_SMALL[b.data])
            marked.append(b.per_byte((b.data == 0xCC) | (b.data == 0xCD)) > 0)  # what U+0300 to U+036F begin with
            at += len(b.data)
        self.terms, self.hashes, self.starts, self.lens, self.data, self.marked = (np.concatenate(x) for x in (terms, hashes, starts, lens, data, marked))
        self.bounds, self.token_bounds = (np.concatenate([[0], np.cumsum(np.concatenate(x))]) for x in (n_words, n_tokens))

    def each(self) -> list[np.ndarray]:
        """The terms of every text."""
        return [self.terms[a:b] for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)]

    def distinct(self) -> tuple[np.ndarray, list[str], np.ndarray]:
        """Each token's number, the tokens by number, and which texts have no combining marks and no token that is unlike another
        one of its hash."""
        number, values = numbered(self.hashes)
        first = np.zeros(len(values), np.int64)
        first[number[::-1]] = np.arange(len(number))[::-1]
        unlike = np.zeros(len(number), bool)
        eight = np.ndarray(len(self.data), "<u8", np.append(self.data, np.zeros(8, np.uint8)), 0, (1,))  # those from each byte on
        for lo in range(0, len(number), 1 << 15):
            part = slice(lo, lo + (1 << 15))
            n, a, of = self.lens[part].copy(), self.starts[part].copy(), first[number[part]]
            b, left = self.starts[of], np.flatnonzero(n == self.lens[of])
            unlike[part] = n != self.lens[of]
            while len(left):  # eight bytes of each at a time
                differs = (eight[a[left]] ^ eight[b[left]]) << _BESIDE[np.minimum(n[left], 8)]
                unlike[lo + left[differs != 0]] = True
                left = left[n[left] > 8]
                n[left], a[left], b[left] = n[left] - 8, a[left] + 8, b[left] + 8
        n = self.lens[first] + 1
        raw = np.full(n.sum(), 32, np.uint8)
        at = np.arange(len(raw)) + np.repeat(self.starts[first] - np.cumsum(n) + n, n)
        ends = np.cumsum(n) - 1
        raw[:] = self.data[np.minimum(at, len(self.data) - 1)] if len(raw) else raw
        raw[ends] = 32
        total = np.concatenate([[0], np.cumsum(unlike)])
        return number, raw.tobytes().decode().split(" ")[: len(first)], ~self.marked & (total[self.token_bounds[1:]] == total[self.token_bounds[:-1]])


def _signs_from(b: Block) -> np.ndarray:
    """Where in each word the signs behind its last letter or digit begin; its end, if that is none that is known here."""
    out = b.ends.copy()
    left = np.arange(len(out))
    for _ in range(16):
        left = left[_SIGN[b.data[out[left] - 1]] & (out[left] - 1 > b.starts[left])]
        out[left] -= 1
    last, before = b.data[out - 1], b.data[np.maximum(out - 2, 0)]
    # a letter of U+00C0 to U+027F; × and ÷ are none, and İ is lower-cased to a letter and a mark
    latin = (before >= 0xC3) & (before <= 0xC9) & (last >= 0x80) & (last < 0xC0) & ~((before == 0xC3) & ((last == 0x97) | (last == 0xB7))) & ~((before == 0xC4) & (last == 0xB0))
    return np.where(_SOLID[last] | latin, out, b.ends)


class Encoder(dict):
    """word -> its ids as little-endian unsigned 32-bit bytes, all of them the library's.

    A tokenizer that normalises to NFC, lower-cases, drops white space and cuts at it, and cuts between letters and other
    characters, gives a text the ids of its words with A-Z lower-cased, and letters or digits with signs behind them the ids
    of both. So the distinct ones of many texts are found at once, encoded by the library together, and remembered. Texts with one of the
    tokenizer's own added tokens or with combining marks (which may compose with one case of a letter only), and all texts of
    tokenizers of other kinds, go to the library whole."""

    MARK = "\x01"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tok = Tokenizer.from_file(path)
        self.old: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        mark = self.tok.encode(self.MARK, add_special_tokens=False).ids
        self.fast = spec.get("normalizer") == _FAST["normalizer"] and pre[0].get("pattern") == {"Regex": _FAST["pattern"]} and len(mark) == 1 and not any(t.get("normalized") for t in spec.get("added_tokens") or [])
        self.mark = mark[0] if mark else -1
        # the signs that the model sees for the bytes of letters up to U+024F, from the library
        self.signs: dict[int, str] = {}
        for c in map(chr, range(0x80, 0x250)) if self.fast else ():
            self.signs.update(zip(c.encode(), ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0], strict=True))
        model = spec["model"]
        end = model.get("end_of_word_suffix")
        # which ids end a word: letters only are one piece, so such words need no mark between them
        self.ends = np.zeros(max(model["vocab"].values(), default=0) + 1, bool) if end and isinstance(model["vocab"], dict) else None
        if self.ends is not None:
            self.ends[[i for t, i in model["vocab"].items() if t.endswith(end)]] = True

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        out = self.old.get(word)
        self[word] = out = self._whole(word) if out is None else out
        return out

    def learn(self, words: list[str]) -> None:
        """Takes in new words, A-Z lower-cased, together."""
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
        new = [w for w in words if w not in self]
        if self.old:
            known = {w: ids for w in new if (ids := self.old.get(w)) is not None}
            self.update(known)
            new = [w for w in new if w not in known]
        plain = [w for w in new if w.isascii() and w.isalpha()] if self.ends is not None else []
        other: list[str] = []
        made: list[tuple[str, str]] = []
        for w in new if len(plain) < len(new) else []:
            if self.ends is None or not w.isalpha() or "Σ" in w or "İ" in w or not (low := w.lower()).isalpha() or not unicodedata.is_normalized("NFC", w):
                if self.MARK not in w:
                    other.append(w)
            elif low != w:
                made.append((w, low))
            elif not w.isascii():
                plain.append(w)
        plain += {low for _, low in made if low not in self and low not in self.old} - set(plain if made else ())
        latin = [w for w in plain if w.isascii() or max(w) < "\u0250"] if self.fast else []
        others = [w for w in plain if not w.isascii() and max(w) >= "\u0250"] if self.fast else plain
        for between, kind in (("", latin), (" ", others)):
            for part, ids in self._together(kind, between):
                self._take(part, ids, np.flatnonzero(self.ends[ids]) + 1, 0)
        for part, ids in self._together(other, f" {self.MARK} "):
            self._take(part, ids, np.append(np.flatnonzero(ids == self.mark), len(ids)), 1)
        for w, low in made:
            ids = self.get(low) or self.old.get(low)
            if ids:
                self[w] = ids

    def _together(self, words: list[str], between: str) -> Iterator[tuple[list[str], np.ndarray]]:
        """The ids of some words at once. With nothing between them, of lower-case Latin letters only, by the library's model: its
        other steps leave such words as they are."""
        model = self.tok.model
        for lo in range(0, len(words), 8192):
            part = words[lo : lo + 8192]
            if between:
                yield part, np.array(self.tok.encode_batch_fast([between.join(part)], add_special_tokens=False)[0].ids, "<u4")
            else:
                seen = (w if w.isascii() else w.encode().decode("latin-1").translate(self.signs) for w in part)
                yield part, np.array([t.id for w in seen for t in model.tokenize(w)], "<u4")

    def _take(self, words: list[str], ids: np.ndarray, ends: np.ndarray, gap: int) -> None:
        if len(ends) == len(words):  # else they are encoded one by one when they come
            raw, ends = ids.tobytes(), ends.tolist()
            self.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(words, [0, *(e + gap for e in ends)], ends, strict=False))

    def ids(self, text: str) -> bytes:
        return self.batch([text])[0]

    def batch(self, texts: list[str], words: Words | None = None) -> list[bytes]:
        if not self.fast:
            return [self._whole(t) for t in texts]
        words = words or Words(pa.array(texts, pa.large_string()))
        number, distinct, plain = words.distinct()
        self.learn(distinct)
        each = list(map(self.__getitem__, distinct))
        size = np.fromiter(map(len, each), np.int64, len(each)) // 4
        at = np.cumsum(size) - size
        n = size[number]
        before = np.concatenate([[0], np.cumsum(n)])
        flat = np.frombuffer(b"".join(each), "<u4")[np.repeat(at[number] - before[:-1], n) + np.arange(before[-1])]
        ends = before[words.token_bounds].tolist()
        return [flat[a:b].tobytes() if ok and not any(x in t for x in self.added) else self._whole(t) for t, ok, a, b in zip(texts, plain.tolist(), ends, ends[1:], strict=False)]


def encoder(path: str) -> Encoder:
    """One for each worker process, so that its memory serves all tasks that come there, until one of another kind comes."""
    encoders = kept("packing")
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def _terms(texts: pa.Array) -> list[np.ndarray]:
    return Words(texts).each()


def _slots(terms: np.ndarray, slots: int) -> np.ndarray:
    return (terms.astype(np.uint64) % np.uint64(slots)).astype(np.int64)


class Statistics:
    """Document frequencies (by slot), the number of documents and their mean length in words."""

    def __init__(self, df: np.ndarray, n: int, mean: float):
        self.df, self.n, self.mean = df, n, mean

    @classmethod
    def of(cls, terms: list[np.ndarray], slots: int = SLOTS) -> Statistics:
        df = np.zeros(slots, np.int64)
        for t in terms:
            df[np.unique(_slots(t, slots))] += 1
        return cls(df, len(terms), float(np.mean([len(t) for t in terms])) if terms else 0.0)

    def idf(self, terms: np.ndarray) -> np.ndarray:
        df = np.minimum(self.df[_slots(terms, len(self.df))], self.n)
        return np.log(1 + (self.n - df + 0.5) / (df + 0.5))

    @cached_property
    def _weight(self) -> np.ndarray:
        """What a slot's words weigh for shard keys; nothing, if no two documents have one."""
        df = np.minimum(self.df, self.n)
        return np.where(self.df > 1, np.maximum(np.log(1 + (self.n - df + 0.5) / (df + 0.5)), 1e-9) ** RARITY, 1e-300)

    def keys(self, b: Block) -> np.ndarray:
        """Two words of each text by weighted minwise hashing: of texts that share words the more likely equal, the rarer those
        are. 0 without words that others have."""
        u = ((mix(b.words ^ np.uint64(0x7C1D)) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53
        clock = -np.log(u) / self._weight[_slots(b.words, len(self.df))]
        out = np.zeros((b.n, 2), np.int64)
        has = np.flatnonzero(b.n_words > 0)
        for j in range(2 if len(has) else 0):
            least = np.minimum.reduceat(clock, b.bounds[has])
            of = np.repeat(least, b.n_words[has])
            at = np.flatnonzero((clock == of) & (clock < 1e200))
            text = b.doc_of_word[at]
            out[text, j] = mix(b.words[at]).view(np.int64)
            clock[at] = np.inf  # all places of the word
        return np.where(out[:, 1:] == 0, out[:, :1], out) if len(out) else out


class Index:
    """BM25 over the documents of one shard, with the statistics of all; terms are given as hashes, each document's in one array."""

    def __init__(self, terms: list[np.ndarray], stats: Statistics | None = None):
        n = len(terms)
        stats = stats or Statistics.of(terms)
        size = np.array([len(t) for t in terms], np.int64)
        lens = size.astype(float)
        number, self.vocab = numbered(np.concatenate(terms) if n else np.zeros(0, np.int64))
        # each document's words with their counts, in the order of documents
        both = np.sort(np.repeat(np.arange(n), size) * max(len(self.vocab), 1) + number)
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
        doc, inv = np.divmod(both[first], max(len(self.vocab), 1))
        tf = np.diff(np.append(first, len(both))).astype(float)
        df = np.bincount(inv, minlength=len(self.vocab))
        weight = stats.idf(self.vocab)[inv] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lens[doc] / max(stats.mean, 1)))
        order = np.argsort(inv, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        self.at = np.concatenate([[0], np.cumsum(df)])
        self.n, self.df = n, df
        ends = np.searchsorted(doc, np.arange(n + 1))
        self.queries = []
        for i in range(n):  # a document's words that others have as well
            t = inv[ends[i] : ends[i + 1]]
            self.queries.append(t[df[t] > 1])

    def neighbours(self, i: int, unused: np.ndarray) -> np.ndarray:
        """All unused documents with a score, by score, ties by place."""
        q = self.queries[i]
        if not len(q):
            return q
        first, n = self.at[q], self.df[q]
        at = np.arange(n.sum()) + np.repeat(first - np.cumsum(n) + n, n)
        score = np.bincount(self.doc[at], self.weight[at], self.n) * unused
        found = np.flatnonzero(score)
        return found[np.argsort(-score[found], kind="stable")]


def fill(lengths: list[int], index: Index, window: int = WINDOW, last: bool = True) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a shard; what fills no window is left out but for the
    last shard."""
    n = len(lengths)
    unused = np.ones(n, bool)
    total = sum(lengths)
    tail = total - total % window
    if not last:
        total = tail
    sizes: list[int] = [1 << k for k in range(window.bit_length() - 1, -1, -1) if (total - tail) >> k & 1]
    seq, off, room, done = 0, 0, window if tail else (sizes.pop(0) if sizes else 0), 0
    rest: tuple[int, int] | None = None
    queue: list[int] = []  # best last
    nxt = 0
    seed = None
    while done < total:
        if rest is None:
            while queue and not unused[queue[-1]]:
                queue.pop()
            if not queue and seed is not None:
                queue = index.neighbours(seed, unused)[::-1].tolist()
                seed = None
            if queue:
                i = queue.pop()
            else:
                while not unused[nxt]:
                    nxt += 1
                i = seed = nxt
            unused[i] = False
            rest = (i, 0)
            continue
        i, start = rest
        take = min(lengths[i] - start, room)
        yield i, start, take, seq, off
        off, room, done = off + take, room - take, done + take
        rest = (i, start + take) if start + take < lengths[i] else None
        if not room:
            seq, off = seq + 1, 0
            room = window if done < tail else (sizes.pop(0) if sizes else 0)
            queue = []
            seed = rest[0] if rest else None


def statistics(docs: DataFrame, slots: int = SLOTS) -> Statistics:
    """Of all documents; no more than ``slots`` sums reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, words = np.zeros(slots, np.int64), 0, 0
        for batch in batches:
            for _, _, b in blocks(batch.column(0), lower=True):
                slot = (b.words % np.uint64(slots)).astype(np.int64)
                own = b.doc_of_word * slots + slot
                own = np.sort(own.astype(np.uint32) if b.n * slots < 1 << 32 else own)
                own = own[np.append(True, own[1:] != own[:-1])[: len(own)]]  # a document's words, each once
                np.add.at(df, (own % slots).astype(np.int64), 1)
                n, words = n + b.n, words + len(slot)
        at = np.flatnonzero(df)
        # two places beyond the slots hold the numbers of documents and words
        yield pa.RecordBatch.from_pydict({"slot": pa.array(np.append(at, [slots, slots + 1])), "n": pa.array(np.append(df[at], [n, words]))})

    sums = docs.select(F.col("text").alias("text")).mapInArrow(lean(run), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    got = sums.toArrow()
    df = np.zeros(slots + 2, np.int64)
    df[got["slot"].to_numpy()] = got["n"].to_numpy()
    return Statistics(df[:slots].astype(np.int32 if df.max() < 2**31 else np.int64), int(df[slots]), df[slots + 1] / max(int(df[slots]), 1))


def _keyed(docs: DataFrame, stats: Statistics) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.concatenate([np.zeros((0, 2), np.int64), *(stats.keys(b) for _, _, b in blocks(batch.column(1), lower=True))])
            yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), *batch.columns], names=["k1", "k2", "h", "text", "doc_id", "size"])

    rows = docs.select(F.xxhash64("doc_id", "text").alias("h"), F.coalesce("text", F.lit("")).alias("text"), F.col("doc_id").cast("long").alias("doc_id"))
    return rows.withColumn("size", F.octet_length("text").cast("long")).mapInArrow(lean(run), "k1 long, k2 long, h long, text string, doc_id long, size long")


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard: int = SHARD, end: int = END, slots: int = SLOTS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the piece's ids as bytes."""
    scratch = Scratch(docs.sparkSession)
    stats = statistics(docs, slots)
    keyed = scratch.table(_keyed(docs, stats))
    size = keyed.agg(F.coalesce(F.sum(F.col("size") + 64), F.lit(0))).first()[0]
    tail = np.array([end], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        first = TaskContext.get().partitionId() << 40
        # per document in hand: doc_id, ids, ids packed before, terms
        held: list[tuple[int | None, bytes, int, np.ndarray]] = []

        def take(ids: list, texts: list[str]):
            words = Words(pa.array(texts, pa.large_string()))
            held.extend(zip(ids, (x + tail for x in enc.batch(texts, words)), [0] * len(ids), words.each(), strict=True))

        def done(last: bool):
            nonlocal first, held
            if not held:
                return
            out = list(fill([len(x) // 4 - at for _, x, at, _ in held], Index([t for *_, t in held], stats), window, last))
            packed = np.zeros(len(held), np.int64)
            for lo in range(0, len(out), 5000):
                i, start, length, seq, off = (np.array(x, np.int64) for x in zip(*out[lo : lo + 5000], strict=True))
                np.add.at(packed, i, length)
                docs_ = [held[k] for k in i.tolist()]
                start += np.array([at for _, _, at, _ in docs_])
                piece = [d[1][4 * a : 4 * (a + n)] for d, a, n in zip(docs_, start.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([d[0] for d in docs_], pa.int64()), "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array([zlib.crc32(x) for x in piece], pa.int64()),
                    "doc_tokens": pa.array([len(d[1]) // 4 for d in docs_], pa.int64()), "sequence_id": pa.array(first + seq), "offset": pa.array(off), "ids": pa.array(piece, pa.binary()),
                })
            first += out[-1][3] + 1 if out else 0
            held = [(d, x, at + n, t.copy()) for (d, x, at, t), n in zip(held, packed.tolist(), strict=True) if at + n < len(x) // 4]

        ids: list = []
        texts: list[str] = []
        size = 0
        for batch in batches:
            for text, doc_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if texts and (len(texts) >= shard or size + len(text) > SHARD_BYTES):
                    take(ids, texts)
                    ids, texts, size = [], [], 0
                    yield from done(False)
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
        take(ids, texts)
        yield from done(True)

    # as many partitions as the bytes need, and no more than keep the cores busy on small inputs
    p = max(1, -(-size // PART_BYTES), min(parts(docs.sparkSession), -(-size // (PART_BYTES >> 4))))
    ranged = keyed.repartitionByRange(p, "k1", "k2", "h").sortWithinPartitions("k1", "k2", "h", "doc_id", "text")
    return ranged.select("text", "doc_id").mapInArrow(
        lean(run, "packing"), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"
    )

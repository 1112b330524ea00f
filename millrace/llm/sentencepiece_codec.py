"""SentencePiece encoding and decoding for vocabularies of merge type, without the library's encoder.

A text is normalised (the dummy prefix, spaces as U+2581) and starts as its characters. An agenda holds the adjacent symbol
pairs whose concatenation is a piece, best score first, of equal scores the leftmost; the first is merged and its new
neighbours enter the agenda. Characters that no piece has become byte pieces. As no piece holds U+2581 after another
character, and characters without a piece merge with nothing, a text falls into segments that are encoded on their own; a
segment's result is remembered. Short segments that an Arrow batch brings anew go through their agendas in lock step, as
rows of one matrix; long ones have a heap.

The segments that a batch brings anew are checked against the sentencepiece library, their ids and what these decode to, and a
difference is an error. A model of another kind, or with line ends within pieces, is refused.

Null and empty texts have no ids and decode to nothing, an empty table gives an empty result. Texts of any length are encoded
whole; memory holds one batch. Of equal scores the leftmost pair goes first. Repeated rows give repeated results. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._agenda import Merges

SPACE = "▁"
CACHE = 600_000  #: segments in each of the two generations of a codec's memory
SHORT = 24
_CUT = ""


class Model:
    """Pieces, scores and merges of a vocabulary."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte.items()}
        self.special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.special}
        self.score = [sp.get_score(i) for i in range(n)]
        chars = {c for p in self.ids for c in p}
        if len(self.byte) != 256 or any(SPACE in p.lstrip(SPACE) for p in self.ids) or not chars <= set(self.ids) or any("\n" in p and p != "\n" for p in self.ids):
            raise ValueError("not a merge-type vocabulary with byte fallback, word-initial spaces and no line ends within pieces")
        #: rank 0 is the best score; equal scores share a rank
        order = sorted({self.score[i] for i in self.ids.values()}, reverse=True)
        rank = {s: r for r, s in enumerate(order)}
        self.rank = {i: rank[self.score[i]] for i in self.ids.values()}
        pairs = {(self.ids[p[:k]], self.ids[p[k:]]): i for p, i in self.ids.items() for k in range(1, len(p)) if p[:k] in self.ids and p[k:] in self.ids}
        self.pairs = pairs
        self.merges = Merges({k: (self.rank[i], i) for k, i in pairs.items()})
        self.surface = [b"" if i in self.special else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]
        for i, b in self.byte_of.items():
            self.surface[i] = bytes([b])
        self.decimal = [b"%d," % i for i in range(n)]
        #: the piece of each code point, or -2 less the code point
        self.of_char = -2 - np.arange(0x110000, dtype=np.int64)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.of_char[ord(p)] = i

    def fallback(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.encode()]

    def agenda(self, segment: str) -> list[int]:
        """Encodes one segment with a heap of adjacent pairs."""
        sym: list = [self.ids.get(c, c) for c in segment]
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (to := self.pairs.get((sym[i], sym[j]))) is not None:
                heapq.heappush(heap, (self.rank[to], i, j, sym[i], sym[j], to))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b, to = heapq.heappop(heap)
            if sym[i] != a or sym[j] != b or right[i] != j:
                continue  # one of the two has been merged meanwhile
            sym[i], sym[j] = to, None
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            offer(left[i], i)
            offer(i, right[i])
        return [x for s in sym if s is not None for x in ([s] if isinstance(s, int) else self.fallback(s))]

    def agendas(self, segments: list[str]) -> list[list[int]]:
        """Encodes short segments in lock step: every round merges the first pair of each one's agenda."""
        out: list = [None] * len(segments)
        live = np.array(sorted(range(len(segments)), key=lambda i: len(segments[i])))
        for part in np.array_split(live, max(1, len(live) // 4096)):
            if not len(part):
                continue
            chosen = [segments[i] for i in part.tolist()]
            sizes = np.array([len(s) for s in chosen])
            width = int(sizes.max())
            sym = np.full((len(part), width + 1), -1, np.int64)
            codes = np.frombuffer("".join(chosen).encode("utf-32-le", "surrogatepass"), "<u4")
            sym[:, :width][np.arange(width) < sizes[:, None]] = self.of_char[codes]
            self.merges.run(sym)
            plain = (sym >= -1).all(axis=1)
            for i, row, n, ok in zip(part.tolist(), sym.tolist(), (sym != -1).sum(axis=1).tolist(), plain.tolist(), strict=True):
                out[i] = row[:n] if ok else [y for x in row[:n] for y in ([x] if x >= 0 else self.fallback(chr(-2 - x)))]
        return out


class Codec(dict):
    """segment -> ids as decimal text, each with a comma after it. ``odd`` has what a segment's ids decode to where that isn't
    the segment itself; for all others decoding has been found to give it back."""

    def __init__(self, path: str):
        self.model = Model(path)
        self.old: dict[str, bytes] = {}
        self.odd: dict[str, bytes] = {}

    def segments(self, text: str) -> list[str]:
        text = SPACE + text.replace(" ", SPACE)
        if _CUT in text or SPACE + SPACE in text:
            return re.findall(rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+", text)
        return [s for s in text.replace("\n", f"{_CUT}\n{_CUT}").replace(SPACE, _CUT + SPACE).split(_CUT) if s]

    def learn(self, segments: set[str]) -> None:
        new = []
        for s in segments:
            if s not in self:
                got = self.old.get(s)
                if got is None:
                    new.append(s)
                else:
                    self[s] = got
        short, long_ = [s for s in new if len(s) <= SHORT], [s for s in new if len(s) > SHORT]
        new = short + long_
        mine = self.model.agendas(short) + [self.model.agenda(s) for s in long_]
        # the library starts a text with a space of its own, which a line end parts from the segment
        theirs = self.model.sp.encode(["\n" + s for s in new], num_threads=1)
        back = self.model.sp.decode(theirs, num_threads=1) if theirs else []
        decimal, surface = self.model.decimal.__getitem__, self.model.surface.__getitem__
        for s, ids, checked, text in zip(new, mine, theirs, back, strict=True):
            if checked[2:] != ids:
                raise AssertionError(f"the library encodes {s!r} as {checked[2:]}, not as {ids}")
            self[s] = b"".join(map(decimal, ids))
            raw = b"".join(map(surface, ids))
            if text != text_of(b"\n" + raw):
                raise AssertionError(f"the library decodes {ids} to {text[1:]!r}, not to {text_of(raw)!r}")
            if raw != s.replace(SPACE, " ").encode():
                self.odd[s] = raw

    def decoded(self, seg: list[str]) -> bytes:
        """What the ids of a text's segments decode to, the dummy prefix left out."""
        if self.odd and not self.odd.keys().isdisjoint(seg):
            return b"".join([self.odd.get(s) or s.replace(SPACE, " ").encode() for s in seg])[1:]
        return "".join(seg).replace(SPACE, " ").encode()[1:]

    def encode(self, text: str) -> list[int]:
        seg = self.segments(text) if text else []
        self.learn(set(seg))
        return [int(x) for s in seg for x in self[s].split(b",")[:-1]]

    def decode(self, ids: list[int]) -> str:
        """The first piece loses the dummy prefix; bytes that aren't UTF-8 become U+FFFD each."""
        raw = b"".join(self.model.surface[i] for i in ids)
        return text_of(raw[1:] if ids and self.model.pieces[ids[0]].startswith(SPACE) else raw)

    def turn(self) -> None:
        if len(self) >= CACHE:
            self.old = dict(self)
            self.clear()
            self.odd = {s: x for s, x in self.odd.items() if s in self.old}


_codecs: dict[str, Codec] = {}


def codec_of(path: str) -> Codec:
    """One for each worker process, so that its memory serves all tasks that come there."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def text_of(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[i : i + n].decode())
                    i += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


def encode_texts(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas) and decoded, of every row."""

    def one(codec: Codec, seg: list[str]) -> tuple[int, bytes, bytes]:
        ids = b"".join(map(codec.__getitem__, seg))
        return ids.count(b","), ids[:-1], codec.decoded(seg)

    return _run(docs, model, one, "doc_id long, n_tokens long, ids string, decoded string", lambda r: [r[0], r[1].decode(), text_of(r[2])])


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, of every row."""

    def one(codec: Codec, seg: list[str]) -> tuple[int, str, str]:
        ids, raw = b"".join(map(codec.__getitem__, seg)), codec.decoded(seg)
        try:
            raw.decode()
        except UnicodeDecodeError:
            raw = text_of(raw).encode()
        return ids.count(b","), hashlib.sha256(ids[:-1]).hexdigest(), hashlib.sha256(raw).hexdigest()

    return _run(docs, model, one, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", list)


def _run(docs: DataFrame, model: str, one, schema: str, final) -> DataFrame:
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.int64() if c.endswith(" long") else pa.string() for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                texts = batch.column(1).slice(lo, 512).to_pylist()
                segs = [codec.segments(t) if t else [] for t in texts]
                codec.learn(set().union(*segs))
                rows = [final(one(codec, seg)) for seg in segs]
                codec.turn()
                cols = [batch.column(0).slice(lo, 512), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(run, schema)

"""SentencePiece encoding and decoding by a shared-prefix forward pass.

White space marks become U+2581, and the text falls into marked words (a run of marks and
what follows up to the next mark, cut again at characters that no piece holds). The
distinct words of a batch are sorted, which lays them out as a trie in depth-first order:
a word starts from the forward states of the prefix that it shares with the word before
it and only its own tail is computed. A state is the best segmentation of one prefix, kept
as its last piece.

For a unigram model a state keeps the highest score (Viterbi). For a BPE model the best
segmentation of a prefix is the one that merging gives, and it has a forward form, too: it
ends in the only piece t whose left neighbour is the last piece of the shorter prefix and
whose border with it no merge crosses. Whether two pieces can stand side by side follows
from their own merges and is remembered. So the ids are those of the library for either
kind; words where merges tie in rank (runs of marks) are merged directly.

Words are cached in the worker up to ``cache_words`` (beyond it those of the batch at hand
stay; ids do not depend on it). Decoding joins pieces and byte pieces and turns marks into spaces.

Defined cases: null and empty texts have no ids and decode to an empty text; U+2581 in a
text decodes to a space, as in the library; characters without a piece become byte pieces,
so any other text returns exactly; a very long text costs its length, runs of blanks n log n,
and its ids are held at once; null ids and repeated rows are rows of their own; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmill.llm.common import worker_cache

MARK = "▁"
_UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


class Pieces:
    """A vocabulary: ids, ranks or scores, and the forward pass over sorted words."""

    def __init__(self, pieces: dict[str, tuple[int, float]], bytes_: list[int], unknown: int, kind: str, dummy_prefix: bool, cache_words: int = 400_000):
        self.pieces, self.bytes, self.unknown, self.kind, self.dummy = pieces, bytes_, unknown, kind, dummy_prefix
        self.longest = max(map(len, pieces), default=1)
        self.words: dict[str, bytes] = {}
        self.limit = cache_words
        self.valid: dict[tuple[str, str], bool] = {}
        self.double = MARK * 2
        self.blobs = {p: np.array([i], dtype="<i4").tobytes() for p, (i, _) in pieces.items()}
        self.floor = min((s for _, s in pieces.values()), default=0.0) - 10.0
        if kind == "bpe":
            order: dict[float, int] = {s: r for r, s in enumerate(sorted({s for _, s in pieces.values()}, reverse=True))}
            self.rank = {p: order[s] for p, (_, s) in pieces.items()}
            seen: dict[int, int] = {}
            for p, r in self.rank.items():
                if len(p) > 1:
                    seen[r] = seen.get(r, 0) + 1
            self.tied = {p for p, r in self.rank.items() if len(p) > 1 and seen[r] > 1}
            if any(set(p) != {MARK} for p in self.tied):
                raise ValueError("pieces other than runs of marks tie in rank")
            self.split: dict[str, tuple[str, str]] = {}
            for p in pieces:
                if len(p) > 1:
                    got, last = self.merge(p)
                    if len(got) == 1 and last:
                        self.split[p] = last
            self.by_end = self._ends()

    def _ends(self) -> dict[str, tuple[int, ...]]:
        """Lengths of the pieces that end in given characters, longest first, single characters last.

        Keys are the last three characters, or whole texts of up to two; lengths above one
        belong to pieces that merging can make.
        """
        ends: dict[str, set[int]] = {}
        for p in self.split:
            ends.setdefault(p[-3:] if len(p) > 2 else p, set()).add(len(p))
        pairs = {k: v for k, v in ends.items() if len(k) == 2}
        return {k: tuple(sorted(v | pairs.get(k[-2:], set()) | {1}, reverse=True)) for k, v in ends.items()}

    def merge(self, word: str) -> tuple[list[str], tuple[str, str] | None]:
        """Plain BPE: merge the best pair, leftmost first, until none is left; and the last merge.

        Pairs wait in a heap by rank and place, so a long word costs n log n.
        """
        n = len(word)
        size = [1] * n  # of the part that starts here; 0 inside of a part
        before = list(range(-1, n - 1))
        heap = [(r, i, 1, 1) for i in range(n - 1) if (r := self.rank.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        last = None
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = i + left
            if size[i] != left or j >= n or size[j] != right:
                continue
            last = (word[i:j], word[j : j + right])
            size[i], size[j] = left + right, 0
            end = j + right
            if end < n:
                before[end] = i
            for a, b in ((before[i], i), (i, end)):
                if a >= 0 and b < n:
                    r = self.rank.get(word[a : b + size[b]])
                    if r is not None:
                        heapq.heappush(heap, (r, a, size[a], size[b]))
        return [word[i : i + k] for i, k in enumerate(size) if k], last

    def fits(self, a: str, b: str) -> bool:
        """Whether BPE of a + b is [a, b]: no merge of either side's history reaches across."""
        known = self.valid.get((a, b))
        if known is None:
            if len(self.valid) > 1_000_000:
                self.valid.clear()
            known = a not in self.rank or b not in self.rank or self._fits(a, b)
            self.valid[a, b] = known
        return known

    def _fits(self, a: str, b: str) -> bool:
        rank, split = self.rank, self.split
        none = 1 << 60
        limit = none
        while True:
            r = rank.get(a + b)
            if r is not None and r < limit:
                return False
            ra, rb = rank[a] if len(a) > 1 else -1, rank[b] if len(b) > 1 else -1
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, a = ra, split[a][1]
            else:
                limit, b = rb + 1, split[b][0]

    def _tail(self, word: str, states: list) -> None:
        """Extend ``states`` (one per prefix length) to the end of ``word``."""
        if self.kind != "bpe":
            return self._scored_tail(word, states)
        pieces, valid, by_end, fits = self.pieces, self.valid, self.by_end, self.fits
        for i in range(len(states), len(word) + 1):
            # Candidate lengths, longest first, by the last characters.
            for n in by_end.get(word[i - 3 : i] if i > 2 else word[:i], by_end.get(word[i - 2 : i], (1,)) if i > 2 else (1,)):
                if n > i:
                    continue
                t = word[i - n : i]
                if n > 1 and t not in pieces:
                    continue
                before = states[i - n]
                if before is None:
                    states.append(t)
                    break
                ok = valid.get((before, t))
                if fits(before, t) if ok is None else ok:
                    states.append(t)
                    break

    def _scored_tail(self, word: str, states: list) -> None:
        pieces = self.pieces
        for i in range(len(states), len(word) + 1):
            chosen = None
            for n in range(min(self.longest, i), 0, -1):
                t = word[i - n : i]
                if n == 1 or t in pieces:
                    score = (states[i - n][1] if i > n else 0.0) + (pieces[t][1] if t in pieces else self.floor)
                    if chosen is None or score > chosen[1]:
                        chosen = (t, score)
            states.append(chosen)

    def _blob(self, parts: list[str]) -> bytes:
        """Ids of pieces as little-endian 32-bit integers; unknown characters become byte pieces."""
        blobs, out = self.blobs, []
        for p in parts:
            if p not in blobs:
                known = [self.bytes[b] for b in p.encode("utf-8", "replace")] if self.bytes else [self.unknown]
                out.append(np.array(known, dtype="<i4").tobytes())
            else:
                out.append(blobs[p])
        return b"".join(out)

    def learn(self, words: set[str]) -> None:
        """Put the ids of ``words`` into the cache, walking them in sorted order."""
        states: list = [None]
        before, bpe, blobs = "", self.kind == "bpe", self.blobs
        for word in sorted(words):
            if bpe and word[:2] == self.double and self.tied:
                self.words[word] = self._blob(self.merge(word)[0])
                continue
            n, least = 0, min(len(before), len(word))
            while n < least and before[n] == word[n]:
                n += 1
            del states[n + 1 :]
            self._tail(word, states)
            before = word
            parts, i = [], len(word)
            while i:
                p = states[i] if bpe else states[i][0]
                parts.append(p)
                i -= len(p)
            parts.reverse()
            try:
                self.words[word] = b"".join([blobs[p] for p in parts])
            except KeyError:
                self.words[word] = self._blob(parts)

    def units(self, text: str) -> list[str]:
        if not text:
            return []
        marked = text.replace(" ", MARK)
        return _UNIT.findall(MARK + marked if self.dummy else marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers."""
        split = [self.units(t) for t in texts]
        seen = set().union(*split)
        if len(self.words) > self.limit:  # frequent words are among those of any batch
            self.words = {w: self.words[w] for w in seen if w in self.words}
        fresh = {w for w in seen if w not in self.words}
        self.learn(fresh)
        get = self.words.__getitem__
        return [b"".join(map(get, units)) for units in split]


def load_pieces(model_path: str) -> Pieces:
    """The vocabulary of a SentencePiece model file, kept by this worker."""
    cache = worker_cache("pieces")
    if model_path not in cache:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        n = sp.get_piece_size()
        normal = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        codes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        codes = codes if all(sp.is_byte(c) for c in codes) else []
        # A BPE model scores its pieces by rank, in whole numbers; a unigram model by log chance.
        kind = "bpe" if all(float(s).is_integer() for _, s in normal.values()) else "unigram"
        cache[model_path] = Pieces(normal, codes, sp.unk_id(), kind, sp.encode("a", out_type=str)[0].startswith(MARK))
        cache[model_path].decoder = decoder(sp, codes)
    return cache[model_path]


def decoder(sp, codes: list[int]) -> list[bytes]:
    """The bytes that each id stands for."""
    table = []
    raw = {c: bytes([b]) for b, c in enumerate(codes)}
    for i in range(sp.get_piece_size()):
        table.append(raw.get(i, b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else sp.id_to_piece(i).replace(MARK, " ").encode()))
    return table


def _batches(batch: pa.RecordBatch, column: int, rows: int = 512) -> Iterator[tuple[pa.RecordBatch, list]]:
    for i in range(0, batch.num_rows, rows):
        part = batch.slice(i, rows)
        yield part, part.column(column).to_pylist()


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_crc32, ids) for every row; text_crc32 is of the source text's UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_pieces(model_path)
        for batch in batches:
            for part, texts in _batches(batch, 1):
                texts = [t or "" for t in texts]
                blobs = model.encode(texts)
                ends = np.cumsum([0, *(len(b) // 4 for b in blobs)], dtype=np.int64)
                flat = pa.array(np.frombuffer(b"".join(blobs), dtype="<i4"))
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), flat)
                yield pa.record_batch([part.column(0), pa.array([zlib.crc32(t.encode("utf-8", "replace")) for t in texts], pa.int64()), ids], names=["id", "text_crc32", "ids"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "id long, text_crc32 long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(id, text_crc32, ids, decoded): the text that the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_pieces(model_path)
        table, dummy = model.decoder, model.dummy
        for batch in batches:
            texts = []
            for ids in batch.column(2):
                raw = b"".join(map(table.__getitem__, ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []))
                texts.append((raw[1:] if dummy and raw[:1] == b" " else raw).decode("utf-8", "replace"))
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=["id", "text_crc32", "ids", "decoded"])

    return encoded.select("id", "text_crc32", "ids").mapInArrow(run, "id long, text_crc32 long, ids array<int>, decoded string")

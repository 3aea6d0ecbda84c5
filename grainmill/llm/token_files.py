"""Token ids in binary files, with keyed access through one minimal perfect hash.

Documents are range partitioned by id and sorted, so files hold them in ascending order.
``payload`` holds the ids, Parquet with one row per record of up to ``docs_per_record``
documents (fewer where texts are long):

    part, seq        the shard and the record's place in it: parts ascend by id, records within a part
    part_start       ids in the same part before this record
    n_ids            ids in the payload
    payload          all ids as raw little-endian unsigned 32-bit integers
    doc_keys         the key of each document (little-endian 64-bit), the first null_keys documents have none
    bounds           where each document starts in the payload, and the payload's end

``index`` holds a minimal perfect hash over all keys. A key's hash names its *cell* (one
row, about ``CELL`` keys), and in the cell:

    seeds            a key is hashed to a bucket, the bucket's seed hashes it to its slot
    fingerprints     16 bits of each slot's key, which tell most keys that are not there
    parts, seqs      the record that holds each slot's document
    starts, sizes    the document's offset in the record's payload and its number of ids

So a key takes a fixed number of steps, without search: its cell, its slot, one record, one
offset; the record's own key settles what a fingerprint lets through. Cells are built
apart from each other; buckets of a cell are placed by descending size and take the first
seed that leaves their keys on free slots (hash and displace).

Encoding: the tokenizer cuts texts before every single space that a visible character
follows, so ids of such words do not depend on their neighbours. A word is cut as the
tokenizer's expression cuts it, the library's model encodes each piece once per worker, and
words are kept (up to ``cache_words``). Texts are taken in slices of about ``SLICE_BYTES``; only
the distinct words of a slice are looked up, Arrow finds them and puts their ids in place. Words with characters beyond `_PLAIN` are encoded by
the library as they are; texts with other white space around spaces, or with strings of
special tokens, go to it whole. Texts are never cut otherwise.

Defined cases: null text counts as empty and yields the end id alone; null ids come first
and are not in the index; repeated ids keep all their rows (next to each other, by a hash of
the text) and the index names the first of them; rows equal in id and text are interchangeable
and are spread over ranges, however many there are; a very long text is a record of its own,
held as a whole while it is encoded; an empty table writes no records; other columns are not
read.
"""

from __future__ import annotations

import gc
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grainmill.llm.common import shuffle_width, worker_cache

#: Keys in a cell of the index.
CELL = 1 << 15
#: UTF-8 bytes of the texts that are encoded at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 24
#: Distinct words of a slice that Python holds at once, so that the cache grows by so many beyond its limit.
LOOKED_UP = 1 << 16
#: Characters that go to the library in one call, with 64 more for each text.
LIBRARY_CHARS = 1 << 19
SCHEMA = "part int, seq int, part_start long, n_ids long, null_keys int, payload binary, doc_keys binary, bounds binary"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
INDEX = "cell long, cells long, n_keys int, seeds binary, fingerprints binary, parts binary, seqs binary, starts binary, sizes binary"
#: A space that the tokenizer may join to white space instead of what follows it.
_ODD_SPACE = re.compile(r" (?![!-~¡-ɏ])")
#: Words of characters whose classes no version of Unicode disputes.
_PLAIN = re.compile(r"[\n!-~¡-ɏ]*")
_LETTERS, _NUMBERS = ("".join(re.escape(chr(c)) for c in range(0x21, 0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN")
#: Plain characters that are neither letters, numbers nor white space; the tokenizer does not cut between them.
_MARKS = "".join(c for c in map(chr, range(0x21, 0x250)) if _PLAIN.fullmatch(c) and unicodedata.category(c)[0] not in "LN")
#: How the tokenizer cuts plain words.
_CUT = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+")
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(keys: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """A 64-bit finaliser of keys and seeds."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.asarray(seed, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x2545F4914F6CDD1D)
        x = (x ^ (x >> np.uint64(33))) * _M1
        x = (x ^ (x >> np.uint64(33))) * _M2
        return x ^ (x >> np.uint64(33))


def build_index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(seeds, fingerprints, positions) of a minimal perfect hash over distinct int64 ``keys``."""
    n = len(keys)
    if not n:
        return np.zeros(0, "<u4"), np.zeros(0, "<u2"), np.zeros(0, "<u4")
    buckets = -(-n // 3)
    home = (_mix(keys, 0) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(home, kind="stable")
    sizes = np.bincount(home, minlength=buckets)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    seeds, positions, taken = np.zeros(buckets, "<u4"), np.zeros(n, "<u4"), np.zeros(n, bool)
    for b in np.argsort(-sizes, kind="stable"):
        members = order[starts[b] : starts[b + 1]]
        if not len(members):
            break
        seed = 1
        while True:
            span = np.arange(seed, seed + 64, dtype=np.uint64)
            slots = (_mix(keys[members][None, :], span[:, None]) % np.uint64(n)).astype(np.int64)
            free = ~taken[slots].any(axis=1)
            if len(members) > 1:
                ranked = np.sort(slots, axis=1)
                free &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if free.any():
                at = int(np.argmax(free))
                seeds[b], taken[slots[at]] = seed + at, True
                positions[slots[at]] = members
                break
            seed += 64
    prints = np.zeros(n, "<u2")
    prints[_slots(keys, seeds)] = _prints(keys)
    return seeds, prints, positions


def _prints(keys: np.ndarray) -> np.ndarray:
    return (_mix(keys, 0xF1F1) >> np.uint64(48)).astype("<u2")


def _slots(keys: np.ndarray, seeds: np.ndarray, n: int | None = None) -> np.ndarray:
    bucket = (_mix(keys, 0) % np.uint64(len(seeds))).astype(np.int64)
    return (_mix(keys, seeds[bucket]) % np.uint64(n or len(keys))).astype(np.int64)


def find(keys: np.ndarray, seeds: np.ndarray, fingerprints: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The position of each key, -1 where the fingerprint says that it is not there."""
    if not len(positions):
        return np.full(len(keys), -1)
    slots = _slots(keys, seeds, len(positions))
    return np.where(fingerprints[slots] == _prints(keys), positions[slots].astype(np.int64), -1)


class Encoder:
    """Ids of whole texts by the tokenizers library, with words between spaces kept."""

    def __init__(self, tokenizer_path: str, cache_words: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        cut = str(self.tokenizer.pre_tokenizer)
        self.plain = self.tokenizer.normalizer is None and "ByteLevel(add_prefix_space=False" in cut and "use_regex=True" in cut and isinstance(self.tokenizer.model, BPE)
        self.limit = cache_words
        if self.plain:
            # The file's own model; its cache is off, since only new pieces come here.
            with open(tokenizer_path, encoding="utf-8") as file:
                held = json.load(file)["model"]
            merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in held["merges"]]
            self.tokenize = BPE(held["vocab"], merges, cache_capacity=0, ignore_merges=bool(held.get("ignore_merges"))).tokenize
            self.plain = not held.get("dropout")
        # The model writes a byte as one character: itself if it can be seen, else one from U+0100 on.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = iter(range(256, 512))
        self.letters = {b: b if b in shown else next(hidden) for b in range(256)}
        self.space = chr(self.letters[32])
        self.blobs = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.after: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        """The library's own ids, a few texts at a time: what it returns takes far more memory than the ids."""
        out, start, held = [], 0, 0
        for i, t in enumerate(texts):
            held += len(t) + 64
            if held >= LIBRARY_CHARS or i + 1 == len(texts):
                out += [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch(texts[start : i + 1], add_special_tokens=False)]
                start, held = i + 1, 0
        return out

    def _piece(self, piece: str) -> bytes:
        """The ids of what the tokenizer does not cut further."""
        blobs = self.blobs
        shown = piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        return b"".join([blobs[t.id] for t in self.tokenize(shown)])

    def _word(self, text: str) -> bytes:
        """The ids of a text of plain characters, with at most a space before it."""
        out = []
        for p in _CUT.findall(text):
            spaced = p[0] == " " and len(p) > 1
            known, key = (self.after, p[1:]) if spaced else (self.bare, p)
            blob = known.get(key)
            if blob is None:
                blob = known[key] = self._piece(p)
            out.append(blob)
        return b"".join(out)

    def _learn(self, fresh: list[str]) -> None:
        """Put the ids of words, each with a space before it, into the cache."""
        odd, after, bare, blobs, tokenize, space = [], self.after, self.bare, self.blobs, self.tokenize, self.space
        for w in fresh:
            if w.isascii() and w.isalpha():
                after[w] = b"".join([blobs[t.id] for t in tokenize(space + w)])
            elif _PLAIN.fullmatch(w):
                # Letters are one piece, and so are marks that end the word.
                letters = w.rstrip(_MARKS)
                if not letters.isalpha():
                    after[w] = self._word(f" {w}")
                    continue
                blob = after.get(letters)
                if blob is None:
                    blob = after[letters] = self._piece(f" {letters}")
                if marks := w[len(letters) :]:
                    tail = bare.get(marks)
                    if tail is None:
                        tail = bare[marks] = self._piece(marks)
                    after[w] = blob + tail
            else:
                odd.append(w)
        after.update(zip(odd, self._library([f" {w}" for w in odd]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; nothing here is cyclic, so the collector of cycles rests."""
        rests = gc.isenabled()
        gc.disable()
        try:
            return self._encode(texts)
        finally:
            if rests:
                gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, t in enumerate(texts) if not self.plain or _ODD_SPACE.search(t) or any(s in t for s in self.special)]
        done = dict(zip(whole, self._library([texts[i] for i in whole]), strict=True))
        cut = [i for i in range(len(texts)) if i not in done]
        done.update(zip(cut, self._by_words([texts[i] for i in cut]), strict=True))
        return [done[i] for i in range(len(texts))]

    def _looked_up(self, words: list[str]) -> pa.Array:
        """The ids of words, each with a space before it."""
        if len(self.after) + len(self.bare) > self.limit:
            self.after.clear()
            self.bare.clear()
        got = list(map(self.after.get, words))
        fresh = [i for i, g in enumerate(got) if g is None]
        self._learn([words[i] for i in fresh])
        for i in fresh:
            got[i] = self.after[words[i]]
        return pa.array(got, pa.large_binary())

    def _by_words(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that may be cut before every space."""
        if not texts:
            return []
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)])
        coded = split.flatten().dictionary_encode()
        # What stands before the first space has no space before it, so each text has its own.
        at, n = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)
        at[bounds[:-1]] = n + np.arange(len(texts))
        used = np.zeros(n + len(texts), bool)
        used[at] = True
        distinct = coded.dictionary.filter(pa.array(used[:n]))
        parts = [self._looked_up(distinct.slice(i, LOOKED_UP).to_pylist()) for i in range(0, len(distinct), LOOKED_UP)]
        got = []
        for t in texts:
            head = t.partition(" ")[0]
            got.append(b"" if not head else self._word(head) if _PLAIN.fullmatch(head) else self._library([head])[0])
        ids = pa.concat_arrays([*parts, pa.array(got, pa.large_binary())]).take(pa.array((np.cumsum(used) - 1)[at]))
        _, offsets, data = ids.buffers()
        edges = np.frombuffer(offsets, np.int64)[bounds].tolist()
        view = memoryview(data) if data else b""
        return [bytes(view[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def load_encoder(tokenizer_path: str, cache_words: int = 800_000) -> Encoder:
    cache = worker_cache("encoders")
    if tokenizer_path not in cache:
        cache[tokenizer_path] = Encoder(tokenizer_path, cache_words)
    return cache[tokenizer_path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, cut so that a slice has one row or at most ``SLICE_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > SLICE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if sizes:
        yield batch.slice(start)


def _record(part: int, seq: int, start: int, keys: list[int | None], blobs: list[bytes]) -> pa.RecordBatch:
    real = np.array([k for k in keys if k is not None], dtype="<i8")
    bounds = np.cumsum([0, *(len(b) // 4 for b in blobs)], dtype="<i8")
    row = (part, seq, start, int(bounds[-1]), len(keys) - len(real), b"".join(blobs), real.tobytes(), bounds.tobytes())
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 3]
    return pa.record_batch([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=_NAMES)


def _cell(keys: np.ndarray, cells: int) -> np.ndarray:
    return (_mix(keys, 0xCE11) % np.uint64(cells)).astype(np.int64)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, docs_per_record: int = 512, ids_per_record: int = 1 << 20) -> None:
    """Encode all of ``docs`` and write payloads and index, as described above, under ``path``."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(tokenizer_path)
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        keys: list[int | None] = []
        blobs: list[bytes] = []
        held = 0
        for batch in batches:
            for piece in _slices(batch):
                for key, blob in zip(piece.column(0).to_pylist(), encoder.encode([t or "" for t in piece.column(1).to_pylist()]), strict=True):
                    keys.append(key)
                    blobs.append(blob + end)
                    held += len(blob) // 4 + 1
                    if len(keys) >= docs_per_record or held >= ids_per_record:
                        yield _record(part, seq, start, keys, blobs)
                        seq, start, keys, blobs, held = seq + 1, start + held, [], [], 0
        if keys:
            yield _record(part, seq, start, keys, blobs)

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    # Row numbers of the plan split what ties on id and text, which is interchangeable.
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), F.monotonically_increasing_id().alias("row")).withColumn("tie", F.xxhash64("text"))
    ranged = rows.repartitionByRange(shuffle_width(docs.sparkSession), "id", "tie", "row").sortWithinPartitions("id", "tie").select("id", "text")
    ranged.mapInArrow(run, SCHEMA).write.option("compression", "zstd").parquet(f"{path}/payload")
    write_index(docs.sparkSession, path)


def write_index(spark: SparkSession, path: str) -> None:
    """Build the index over the keys of the payloads under ``path``, one cell at a time."""
    records = spark.read.schema(SCHEMA).parquet(f"{path}/payload").select("part", "seq", "null_keys", "doc_keys", "bounds")
    keys = records.agg(F.sum(F.octet_length("doc_keys") / 8)).first()[0] or 0
    cells = max(1, -(-int(keys) // CELL))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, nulls, keys, bounds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                real, limits = np.frombuffer(keys, "<i8"), np.frombuffer(bounds, "<i8")[nulls:]
                first = np.flatnonzero(np.diff(real, prepend=real[:1] - 1))
                real, starts, sizes = real[first], limits[:-1][first], np.diff(limits)[first]
                one = lambda v: pa.array(np.full(len(real), v, np.int32))  # noqa: B023, E731
                yield pa.record_batch([pa.array(_cell(real, cells)), pa.array(real), one(part), one(seq), pa.array(starts), pa.array(sizes)], names=["cell", "key", "part", "seq", "start", "size"])

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("key", "part", "seq")])
        distinct, first = np.unique(table.column("key").to_numpy(), return_index=True)  # the first row of a key
        seeds, prints, positions = build_index(distinct)
        at = first[positions]
        place = [table.column(c).to_numpy()[at].astype(d).tobytes() for c, d in (("part", "<u4"), ("seq", "<u4"), ("start", "<i8"), ("size", "<i8"))]
        row = (table.column("cell")[0].as_py(), cells, len(distinct), seeds.tobytes(), prints.tobytes(), *place)
        return pa.table([pa.array([v], t) for v, t in zip(row, [pa.int64(), pa.int64(), pa.int32(), *[pa.binary()] * 6], strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])

    placed = records.mapInArrow(places, "cell long, key long, part int, seq int, start long, size long")
    placed.groupBy("cell").applyInArrow(build, INDEX).write.option("compression", "zstd").parquet(f"{path}/index")


def _with_base(records: DataFrame) -> DataFrame:
    """Adds ``base``: the ids in all parts before the record's (one row per part, so at most the shuffle width)."""
    totals = records.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return records.join(F.broadcast(totals.select("part", before.alias("base"))), "part")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, read from the payloads in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache()
        for batch in batches:
            for base, start, nulls, payload, keys, bounds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                limits, view = np.frombuffer(bounds, "<i8"), memoryview(payload)
                at, to = limits[:-1], limits[1:]
                crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at.tolist(), to.tolist(), strict=True)]
                ids = pa.array([None] * nulls + np.frombuffer(keys, "<i8").tolist(), pa.int64())
                yield pa.record_batch([ids, pa.array(base + start + at), pa.array(to - at), pa.array(crcs, pa.int64())], names=["id", "start", "n_tokens", "ids_crc32"])

    records = _with_base(spark.read.schema(SCHEMA).parquet(f"{path}/payload"))
    return records.select("base", "part_start", "null_keys", "payload", "doc_keys", "bounds").mapInArrow(run, "id long, start long, n_tokens long, ids_crc32 long")


def locate(spark: SparkSession, path: str, keys: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(key, part, seq, start, size) by the index, of keys whose fingerprint is there; opens one cell for each key at most."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    any_cell = index.select("cells").first()
    if not any_cell:
        return []
    wanted = np.array(sorted(set(keys)), dtype="<i8")
    home = _cell(wanted, any_cell["cells"])
    out = []
    for row in index.where(F.col("cell").isin(sorted(set(home.tolist())))).toLocalIterator():
        mine = wanted[home == row["cell"]]
        seeds, prints = np.frombuffer(row["seeds"], "<u4"), np.frombuffer(row["fingerprints"], "<u2")
        slots = find(mine, seeds, prints, np.arange(len(prints)))
        place = [np.frombuffer(row[c], d) for c, d in (("parts", "<u4"), ("seqs", "<u4"), ("starts", "<i8"), ("sizes", "<i8"))]
        out += [(k, *(int(p[i]) for p in place)) for k, i in zip(mine.tolist(), slots.tolist(), strict=True) if i >= 0]
    return out


def lookup(spark: SparkSession, path: str, keys: list[int]) -> DataFrame:
    """(id, ids) of those of the given keys that are there: one record is opened for each key at most."""
    places: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for key, part, seq, start, size in locate(spark, path, keys):
        places.setdefault((part, seq), []).append((key, start, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, nulls, payload, stored, bounds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                real, limits, ids = np.frombuffer(stored, "<i8"), np.frombuffer(bounds, "<i8")[nulls:], np.frombuffer(payload, "<u4")
                hits = [(k, ids[a : a + n].astype(np.int64)) for k, a, n in places.get((part, seq), []) if real[np.searchsorted(limits, a)] == k]
                yield pa.record_batch([pa.array([k for k, _ in hits], pa.int64()), pa.array([x for _, x in hits], pa.list_(pa.int64()))], names=["id", "ids"])

    near = F.lit(False)
    for part, seq in sorted(places):
        near = near | ((F.col("part") == part) & (F.col("seq") == seq))
    records = spark.read.schema(SCHEMA).parquet(f"{path}/payload").where(near)
    return records.select("part", "seq", "null_keys", "payload", "doc_keys", "bounds").mapInArrow(run, "id long, ids array<long>")

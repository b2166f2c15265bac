"""Sequence packing along a space-filling curve.

1. **Tokenise** (map side): byte-level BPE ids plus one end id per document; at the same
   time a hashed document vector is projected to ``DIMS`` dimensions (a fixed random
   direction per hashed token id, averaged over the document) and put on a Hilbert curve.
   Ids go as 16-bit integers to a table below ``spark.checkpoint.dir``: tokenising is the
   dear step and is done once.
2. **Range sort** by (Hilbert key, hash of the text, doc_id): neighbours on the curve are
   similar documents. The later sort columns split a key that many documents share, so a
   large group of copies spreads over tasks.
3. **Pack**: every range partition cuts its stream of ids into sequences of ``max_tokens``;
   documents are cut freely, so full sequences hold no padding. What is left at the end of
   a partition is cut into sequences whose lengths are powers of two (its binary digits),
   which need no padding either. State in a task is one sequence.

Null text counts as empty: its document is the end id alone. Repeated rows are packed as
often as they occur. An empty table gives an empty result.
"""
from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import cut, ranges, release

MAX_TOKENS = 2048
END_ID = 1
DIMS = 3
BITS = 10
#: pieces of text kept with their ids in one Python worker; batches of pieces with a longer one aren't kept
CACHE_ENTRIES, CACHE_BYTES = 200_000, 256
#: bytes of ids that a task of the range sort reads
TASK_BYTES = 64 << 20
SEQUENCE_SHIFT = 40
#: a blank that white space or the text's end follows: the vocabulary's split rule may not cut before it
OPEN_BLANK = r" (?:[\s\v\x{85}\x{1c}-\x{1f}\p{Z}]|\z)"


class ByteBpe:
    """The ids of a byte-level BPE vocabulary (``tokenizers`` JSON), without special tokens.

    Before a blank that a character other than white space follows, the vocabulary's own
    split rule always cuts, so texts are cut there and each distinct piece of a batch is
    encoded once: looked up among the first ``CACHE_ENTRIES`` pieces met, or encoded together with
    the batch's other new pieces by the rank form of the same merges. Texts with other blanks are encoded whole
    by the rank form, and texts that spell a special token by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as fh:
            parts = json.load(fh)
        self.path, self.full = path, None
        self.special = [t["content"] for t in parts["added_tokens"]]
        to_byte = _byte_alphabet()
        ranks = {bytes(to_byte[c] for c in t): i for t, i in parts["model"]["vocab"].items() if t not in self.special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.ranks = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.size = np.zeros(1 << 16, dtype=np.int64)          # bytes of each id
        self.size[list(ranks.values())] = [len(t) for t in ranks]
        # ids of the pieces met first, one after another, and where each piece's are
        self.known: dict[str, int] = {}
        self.pool = np.zeros(0, dtype="<u2")
        self.first, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, text: str) -> bytes:
        """By the vocabulary's own library, which is loaded only for texts that need it."""
        if self.full is None:
            from tokenizers import Tokenizer
            self.full = Tokenizer.from_file(self.path)
        return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian 16-bit ids of one text."""
        if any(s in text for s in self.special):
            return self._whole(text)
        return np.array(self.ranks.encode_ordinary(text), dtype="<u2").tobytes()

    def pieces(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first, length): where among ``ids`` those of each distinct piece, with the blank before it, are."""
        words = distinct.to_numpy(zero_copy_only=False).tolist()        # much faster than to_pylist
        slot = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(slot < 0)
        first, length = self.first[slot] if len(self.first) else slot.copy(), self.length[slot] if len(self.first) else slot.copy()
        if not len(new):
            return self.pool, first, length
        # encoded as one text and cut where the pieces end
        told = [words[i] for i in new.tolist()]
        ids = np.array(self.ranks.encode_ordinary(" " + " ".join(told)), dtype="<u2")
        size = pc.binary_length(distinct).to_numpy()[new]
        ends = np.searchsorted(np.cumsum(self.size[ids]), np.cumsum(size + 1)) + 1
        length[new] = np.diff(ends, prepend=0)
        first[new] = len(self.pool) + ends - length[new]
        ids = np.concatenate([self.pool, ids])
        if len(self.known) + len(new) <= CACHE_ENTRIES and size.max() <= CACHE_BYTES:
            self.known.update(zip(told, range(len(self.known), len(self.known) + len(told))))
            self.pool = ids
            self.first, self.length = np.concatenate([self.first, first[new]]), np.concatenate([self.length, length[new]])
        return ids, first, length

    def needs_whole(self, texts: pa.Array) -> np.ndarray:
        """Texts that can't be cut at blanks."""
        hard = pc.match_substring_regex(texts, OPEN_BLANK)
        for s in self.special:
            hard = pc.or_(hard, pc.match_substring(texts, s))
        return hard.to_numpy(zero_copy_only=False)

    def encode_cut(self, texts: pa.Array, towards: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, each with the end id; their ends; sum of the ids' directions a text) of texts that can be cut."""
        lists = pc.split_pattern(texts, " ")
        offsets, flat = np.asarray(lists.offsets, dtype=np.int64), lists.flatten()
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        at = coded.indices.to_numpy().astype(np.int64)
        ids, first, length = self.pieces(coded.dictionary)
        # a text's first piece has no blank before it; its end id is one more piece
        openings = flat.take(pa.array(offsets[:-1])).dictionary_encode()
        others = [np.array(self.ranks.encode_ordinary(t), dtype="<u2") for t in openings.dictionary.to_pylist()]
        others.append(np.array([END_ID], dtype="<u2"))
        sizes = np.fromiter(map(len, others), np.int64, len(others))
        at[offsets[:-1]] = len(first) + openings.indices.to_numpy()
        at = np.insert(at, offsets[1:], len(first) + len(others) - 1)
        first = np.concatenate([first, len(ids) + np.cumsum(sizes) - sizes])
        length, ids = np.concatenate([length, sizes]), np.concatenate([ids, *others])
        n = length[at]
        ends = np.cumsum(n)
        taken = ids[np.repeat(first[at] - (ends - n), n) + np.arange(ends[-1])]
        text_ends = ends[offsets[1:] + np.arange(len(texts))]
        starts = np.concatenate([[0], text_ends[:-1]])
        sums = np.stack([np.add.reduceat(towards[:, k][taken], starts, dtype=np.float64) for k in range(towards.shape[1])], axis=1)
        return taken, text_ends, sums


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of byte-level BPE: printable Latin-1 for itself, others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


_tokenizers: dict[str, ByteBpe] = {}


def tokenizer(path: str) -> ByteBpe:
    if path not in _tokenizers:
        _tokenizers[path] = ByteBpe(path)
    return _tokenizers[path]


def directions(dims: int = DIMS) -> np.ndarray:
    """A fixed direction for each 16-bit id: uniform in [-1, 1) from a multiplicative hash."""
    ids = np.arange(1 << 16, dtype=np.uint64)
    cols = [((ids + np.uint64(1)) * np.uint64(m) * (ids + np.uint64(12345)) >> np.uint64(20)) & np.uint64(0xFFFF)
            for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)[:dims]]
    return (np.stack(cols, 1).astype(np.float32) / 32768.0) - 1.0


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of integer cells (n, dims): Skilling's axes-to-transpose, interleaved."""
    x = [c.copy() for c in cells.astype(np.int64).T]
    n, q = len(x), 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            hit = (x[i] & q) != 0
            t = np.where(hit, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | (((x[i] ^ t) >> b) & 1)
    return key


def curve_key(vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert key of projected vectors in [-1, 1]; the centre, where texts crowd, is spread out."""
    spread = np.tanh(vectors * 6.0) * 0.5 + 0.5
    return hilbert_key(np.clip((spread * (1 << bits)).astype(np.int64), 0, (1 << bits) - 1), bits)


def _rows(batch: pa.RecordBatch, ids: np.ndarray, ends: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """Output rows for (id, text, tie) rows whose ids end at ``ends``."""
    n = np.diff(ends, prepend=0)
    offsets = np.concatenate([[0], 2 * ends]).astype(np.int32)
    data = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u2").tobytes())])
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(curve_key(sums / n[:, None])), batch.column(2), pa.array(n), data],
                                      names=["id", "key", "tie", "n", "ids"])


def tokenised(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, tie, n, ids): 16-bit ids with the end id and their number, Hilbert key, tie-break hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, towards, end = tokenizer(path), directions(), np.array([END_ID], dtype="<u2").tobytes()
        for whole in batches:
            texts = pc.fill_null(whole.column(1).cast(pa.string()), "")
            for i, j in ranges(pc.utf8_length(texts).to_pylist()):
                batch, part = whole.slice(i, j - i), texts.slice(i, j - i)
                hard = bpe.needs_whole(part)
                easy = pa.array(~hard)
                if not hard.all():
                    yield _rows(batch.filter(easy), *bpe.encode_cut(part.filter(easy), towards))
                if hard.any():
                    ids = [np.frombuffer(bpe.encode(t) + end, dtype="<u2") for t in part.filter(pa.array(hard)).to_pylist()]
                    sums = np.stack([towards[x].sum(0, dtype=np.float64) for x in ids])
                    yield _rows(batch.filter(pa.array(hard)), np.concatenate(ids), np.cumsum(list(map(len, ids))), sums)
            release()
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie")) \
        .mapInArrow(run, f"id {kind}, key long, tie long, n long, ids binary")


def binary_lengths(n: int) -> list[int]:
    """Powers of two that sum to ``n``, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Cuts one partition's stream of documents into sequences."""

    def __init__(self, max_tokens: int, first_sequence: int):
        self.max, self.sequence, self.fill = max_tokens, first_sequence, 0
        self.open: list[tuple] = []   # pieces of the sequence being filled, with their ids

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        while start < len(ids):
            n = min(len(ids) - start, self.max - self.fill)
            self.open.append((doc, start, ids[start:start + n], len(ids)))
            start, self.fill = start + n, self.fill + n
            if self.fill == self.max:
                yield from self.close([self.max])

    def close(self, lengths: list[int]) -> Iterator[tuple]:
        """Emit the open pieces, cut again at the borders of sequences of these lengths."""
        left, offset = list(lengths), 0
        for doc, start, ids, total in self.open:
            done = 0
            while done < len(ids):
                n = min(len(ids) - done, left[0] - offset)
                part = ids[done:done + n]
                yield (doc, start + done, n, zlib.crc32(part.astype("<u4").tobytes()), total, self.sequence, offset)
                done, offset = done + n, offset + n
                if offset == left[0]:
                    left.pop(0)
                    offset, self.sequence = 0, self.sequence + 1
        self.open, self.fill = [], 0


PIECE_COLUMNS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text",
         max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Pieces (id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents."""
    written = cut(tokenised(docs, path, id_col, text), "packing-ids")
    size = 2 * (written.agg(F.sum("n")).first()[0] or 0)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    ordered = written.drop("n").repartitionByRange(tasks, "key", "tie", "id") \
        .sortWithinPartitions("key", "tie", "id").select("id", "ids")
    kind = docs.schema[id_col].dataType.simpleString()
    doc_type = pa.int64() if kind == "bigint" else None
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in PIECE_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(max_tokens, TaskContext.get().partitionId() << SEQUENCE_SHIFT)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*found)) or [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], doc_type), *(pa.array(c, pa.int64()) for c in cols[1:])],
                names=["id", *PIECE_COLUMNS])
        for batch in batches:
            found: list[tuple] = []
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1)):
                found += packer.add(doc, np.frombuffer(ids.as_py(), dtype="<u2"))
            yield rows(found)
        yield rows(list(packer.close(binary_lengths(packer.fill))))
    return ordered.mapInArrow(run, schema).withColumnRenamed("id", id_col)

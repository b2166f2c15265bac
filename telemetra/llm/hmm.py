"""Hidden Markov language model over words: Baum-Welch training and exact scoring.

**Tokens.** ASCII-lower-cased words and one end token a document.

**Counts.** Word counts of the training documents are gathered from the whole corpus by a
shuffle (partial counts a task, bounded), and written below ``spark.checkpoint.dir``.

**Ids and symbols.** Every frequent word (relative frequency over ``FREQUENT``: fewer than
1 / FREQUENT words whatever the corpus) and the end have an id that all tasks know; the other
words of a document are numbered in the document. While the rounds run, words of relative
frequency over ``OWN`` have a symbol of their own and others share that of their ending (a
hash of the last three bytes, ``CLASSES`` of them), so that states settle on few parameters.

**Training.** Every round reads all training documents: each task runs a scaled
forward-backward pass over its symbol sequences (in segments of ``SEGMENT`` tokens; a later
segment starts from the state occupancy, not from the start distribution) and emits its
expected counts; Spark adds them up and the new parameters are broadcast. ``STATES``, ``ROUNDS`` are parameters. The last round takes the expected counts of
every word by state, without ties: those of rare words are a table over the whole vocabulary
that is combined by batch, written and shuffled by word; it never reaches the driver. They
are whole numbers of 1 / ``UNIT``, as many states to a 64-bit number as the largest count allows.

**Emissions.** With expected counts E, word counts c, N training tokens, V distinct words and
``SHRINK`` = a, a state s emits a known word w with probability (N r + 0.1) / (N + 0.1 (V + CLASSES)),
r = (E(s,w) + a c(w)) / (E(s) + a N). An unknown word of ending k has
0.1 CLASSES g(s,k) / (N + 0.1 (V + CLASSES)), g being the state's shares of the endings of tied
words, plus one each. A state's probabilities add up to one, one slot an ending for unknown words.

**Scoring.** The rare words of each document meet their expected counts in a shuffled join
that is written, and come back to their document; a table is deleted when the next one has been written; the scaled forward recursion over the whole sequence gives
its exact likelihood, many documents advanced one token at a time side by side.

Null text counts as empty (the end token alone); repeated rows keep one row each; null ids
count as training documents; words of equal count are taken in byte order; other columns,
whatever their names, are left aside; a very long text is one sequence of its task. With no
training token at all only the end and unknown slots are left, all equally likely; an empty table gives no rows.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from telemetra.llm.common import ranges, release, staged
from telemetra.session import delete_path

STATES = 6
ROUNDS = 3
CLASSES = 256
SEGMENT = 256
LANES = 1024            # sequences advanced side by side
FREQUENT = 2e-6
OWN = 1e-4              # fewer than 1 / OWN words have a symbol of their own
SMOOTH = 0.1
SHRINK = 0.01           # pull of a word's state shares towards its plain count
UNIT = 1 << 9           # expected counts of rare words are added up in these fractions
TOKENS_AT_ONCE = 500_000
CHARS_SPLIT = 3_000_000  # characters whose words a task splits and counts at once
END = b"\n"              # never a word
LOG10 = math.log(10.0)


def words(text: str | None) -> list[bytes]:
    """ASCII-lower-cased words; bytes.split cuts at exactly x20 and x09-x0D."""
    return (text or "").encode("utf-8", "replace").lower().split()


def word_batch(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words`` of every text, laid end to end, and their number by text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat, whole = lists.flatten().cast(pa.binary()), pc.list_value_length(lists).to_numpy()
    # a text that begins or ends with white space, or has none but that, has empty parts
    word = pc.greater(pc.binary_length(flat), 0)
    of = np.repeat(np.arange(len(texts)), whole)
    return flat.filter(word), np.bincount(of[word.to_numpy(zero_copy_only=False)], minlength=len(texts))


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, c): counts of all tokens of ``docs``, the end token included."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(0)), 0).to_pylist()
            for first, last in ranges(sizes, CHARS_SPLIT):
                found = word_batch(batch.column(0).slice(first, last - first))[0].value_counts()
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([found.field("values"), pa.array([END], pa.binary())]),
                     pa.concat_arrays([found.field("counts"), pa.array([last - first], pa.int64())])], names=["word", "c"])
            release()
    return docs.select(text).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Packed:
    """Expected counts of a word by state as a few 64-bit numbers that can be added up.

    ``most`` is the largest count of any word, so that no state's sum leaves its bits. The states'
    units add up to exactly UNIT times the count.
    """

    def __init__(self, most: int, states: int = STATES):
        self.states, self.bits = states, max(1, int(most * UNIT).bit_length())
        self.each = max(1, 63 // self.bits)
        self.names = [f"p{i}" for i in range(-(-states // self.each))]

    def pack(self, n: np.ndarray, e: np.ndarray) -> list[np.ndarray]:
        units = np.rint(e * UNIT).astype(np.int64)
        units[np.arange(len(units)), units.argmax(1)] += n * UNIT - units.sum(1)
        out = [np.zeros(len(units), dtype=np.int64) for _ in self.names]
        for s in range(self.states):
            out[s // self.each] += units[:, s] << (s % self.each * self.bits)
        return out

    def unpack(self, numbers: list[np.ndarray]) -> np.ndarray:
        """Units by (word, state)."""
        mask = (1 << self.bits) - 1
        return np.stack([(numbers[s // self.each] >> (s % self.each * self.bits)) & mask for s in range(self.states)], axis=1)


class Vocabulary:
    """Broadcast part of the counts: frequent words with their symbols and counts, totals."""

    def __init__(self, frequent: dict[bytes, int], total: int, distinct: int, most_rare: int):
        self.total, self.distinct, self.packed = total, distinct, Packed(most_rare)
        own = sorted((w for w in frequent if w != END), key=lambda w: (-frequent[w], w))
        self.own = {w: i for i, w in enumerate([END, *own])}
        self.c = np.array([frequent.get(w, 0) for w in self.own], dtype=float)
        #: symbol of each id: the words above OWN come first, since ids go by falling count
        alone = 1 + sum(frequent[w] > total * OWN for w in own)
        self.symbol = np.array([i if i < alone else alone + class_of(w) for w, i in self.own.items()], dtype=np.int64)
        self.alone = alone
        self.base_log = math.log(total + SMOOTH * (distinct + 1))


def vocabulary(counts: DataFrame) -> Vocabulary:
    total = counts.agg(F.sum("c"), F.count("*")).first()
    n, v = total[0] or 0, total[1]
    # fewer than 1 / FREQUENT rows by definition; long strings stay in the shuffled part
    frequent = counts.filter(((F.col("c") > n * FREQUENT) & (F.length("word") <= 64)) | (F.col("word") == F.lit(END)))
    found = frequent.select("word", "c").toArrow()
    # the largest count of the others: only long words are above the threshold there
    rest = counts.filter((F.col("c") <= n * FREQUENT) | (F.length("word") > 64)).agg(F.max("c")).first()[0] or 0
    return Vocabulary(dict(zip(found["word"].to_pylist(), found["c"].to_pylist())), n, v, rest)


def _binary(parts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """One binary value a row: ``parts`` cut into runs of ``lengths`` items."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * parts.itemsize
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets.astype("<i4").tobytes()),
                                                             pa.py_buffer(parts.tobytes())])


def symbolise(docs: DataFrame, vocab, id_col: str, text: str, train: str) -> DataFrame:
    """One row per document: ``ids`` (32 bit: a symbol of its own, or after those the place of a
    rare word in ``rare``), sums over its frequent words, its rare words with their classes."""
    kind = docs.schema[id_col].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v: Vocabulary = vocab.value
        log_c = np.log(v.c + SMOOTH)
        for whole in batches:
            sizes = pc.fill_null(pc.utf8_length(whole.column("text")), 0).to_pylist()
            for first, last in ranges(sizes, CHARS_SPLIT):
                yield one(whole.slice(first, last - first), v, log_c)
            release()

    def one(batch: pa.RecordBatch, v: Vocabulary, log_c: np.ndarray) -> pa.RecordBatch:
        flat, length = word_batch(batch.column("text"))
        n, own = len(length), len(v.own)
        coded = flat.dictionary_encode()
        spelled = [*coded.dictionary.to_pylist(), END]
        # the end token follows the words of each document
        code = np.full(len(flat) + n, len(spelled) - 1)
        code[np.arange(len(flat)) + np.repeat(np.arange(n), length)] = coded.indices.to_numpy()
        length = length + 1
        symbol = np.fromiter((v.own.get(w, -1) for w in spelled), np.int64, len(spelled))
        ids, doc = symbol[code], np.repeat(np.arange(n), length)
        known = ids >= 0
        rare, place = np.unique(doc[~known] * len(spelled) + code[~known], return_inverse=True)
        per_doc = np.bincount(rare // len(spelled), minlength=n)
        opening = np.cumsum(per_doc) - per_doc
        ids[~known] = own + place - opening[doc[~known]]
        rare_code = rare % len(spelled)
        cls = np.fromiter((class_of(w) if k < 0 else 0 for w, k in zip(spelled, symbol)), np.uint8, len(spelled))
        offsets = pa.array(np.concatenate([opening, [len(rare)]]).astype(np.int32))
        columns = {
            "ids": _binary(ids.astype("<u4"), length), "n_tokens": pa.array(length),
            "n_frequent": pa.array(np.bincount(doc, weights=known & (v.c[np.where(known, ids, 0)] > 0), minlength=n).astype(np.int64)),
            "sum_log": pa.array(np.bincount(doc[known], weights=log_c[ids[known]], minlength=n).astype(float)),
            "rare": pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(rare_code))),
            "rare_cls": _binary(cls[rare_code], per_doc)}
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("train"), *columns.values()],
                                          names=["id", "train", *columns])
    return docs.select(F.col(id_col).alias("id"), F.col(train).alias("train"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind.simpleString()}, train boolean, ids binary, n_tokens long, n_frequent long, sum_log double, "
             "rare array<binary>, rare_cls binary")


class Sequences:
    """The documents of a batch as flat arrays: ``ids`` with rare words numbered through the batch."""

    def __init__(self, batch: pa.RecordBatch, symbol: np.ndarray, alone: int):
        ids, cls = (batch.column(c).to_pylist() for c in ("ids", "rare_cls"))
        self.cls = np.frombuffer(b"".join(cls), dtype=np.uint8).astype(np.int64)
        flat = np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int64)
        self.lengths = np.fromiter((len(b) // 4 for b in ids), np.int64, len(ids))
        n_rare = np.fromiter(map(len, cls), np.int64, len(cls))
        rare = flat >= len(symbol)
        flat[rare] += np.repeat(np.cumsum(n_rare) - n_rare, self.lengths)[rare]
        self.ids, self.own = flat, len(symbol)
        #: occurrences of each rare word, and its document
        self.times = np.bincount(flat, minlength=self.own + len(self.cls))[self.own:]
        self.n_rare, self.doc_of_rare = n_rare, np.repeat(np.arange(len(ids)), n_rare)
        #: symbol of each id of the batch
        self.symbol_of = np.concatenate([symbol, alone + self.cls])

    @property
    def symbols(self) -> np.ndarray:
        return self.symbol_of[self.ids]


def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a part has at most TOKENS_AT_ONCE tokens (or one document)."""
    for whole in batches:
        sizes = [len(b) // 4 for b in whole.column("ids").to_pylist()]
        for first, last in ranges(sizes, TOKENS_AT_ONCE):
            yield whole.slice(first, last - first)
        release()


class Parameters:
    """Start, transition and emission probabilities; ``occupancy`` starts later segments."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray, occupancy: np.ndarray):
        self.start, self.step, self.emit, self.occupancy = start, step, emit, occupancy

    @classmethod
    def first(cls, symbols: int, states: int = STATES, seed: int = 7) -> "Parameters":
        rng = np.random.default_rng(seed)
        emit = rng.dirichlet(np.full(symbols, 2.0), states)
        step = np.full((states, states), 0.3 / states) + np.eye(states) * 0.7
        even = np.full(states, 1.0 / states)
        return cls(even, step, emit, even)

    @classmethod
    def from_counts(cls, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> "Parameters":
        norm = lambda x: x / x.sum(-1, keepdims=True)
        return cls(norm(start + 0.1), norm(step + 0.1), norm(emit + 0.01), norm(emit.sum(1) + 0.1))


def lanes(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Groups of at most LANES sequence numbers, longest first."""
    order = np.argsort(-lengths, kind="stable")
    for i in range(0, len(order), LANES):
        yield order[i:i + LANES]


def log_likelihood(p: Parameters, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each symbol sequence by the scaled forward recursion."""
    lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
    return forward(p, np.ascontiguousarray(p.emit.T), np.concatenate(sequences) if sequences else np.zeros(0, np.int64), lengths)


def forward(p: Parameters, emit: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The same for sequences laid end to end, of ids with the emissions ``emit`` (a row an id)."""
    out = np.zeros(len(lengths))
    starts = np.cumsum(lengths) - lengths
    for group in lanes(lengths):
        size, at = lengths[group], starts[group]
        live = np.searchsorted(-size, -np.arange(size[0]), side="left") if len(size) and size[0] else []
        alpha = np.tile(p.start, (len(group), 1))
        total = np.zeros(len(group))
        for t, n in enumerate(live):
            a = (alpha[:n] if t == 0 else alpha[:n] @ p.step) * emit.take(flat.take(at[:n] + t), axis=0)
            scale = a.sum(1)
            total[:n] += np.log(scale)
            alpha[:n] = a / scale[:, None]
        out[group] = total
    return out


def expected_counts(p: Parameters, emit: np.ndarray, seqs: Sequences, start_sum: np.ndarray, step_sum: np.ndarray) -> np.ndarray:
    """Expected counts of the sequences by (id, state); starts and transitions are added to the sums."""
    k, lengths, ids = len(p.start), seqs.lengths, seqs.ids
    flat = seqs.symbols
    out = np.zeros((len(seqs.symbol_of), k))
    blocks = -(-lengths // SEGMENT)
    of = np.repeat(np.arange(len(lengths)), blocks)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    seg_at = np.repeat(np.cumsum(lengths) - lengths, blocks) + nth * SEGMENT
    seg_len = np.minimum(SEGMENT, np.repeat(lengths, blocks) - nth * SEGMENT)
    for group in lanes(seg_len):
        size, at, opening = seg_len[group], seg_at[group], nth[group] == 0
        steps = int(size[0])
        live = np.searchsorted(-size, -np.arange(steps), side="left")
        alphas, seen, scales = [], [], []
        prior = np.where(opening[:, None], p.start, p.occupancy)
        for t, n in enumerate(live):
            e = emit.take(flat.take(at[:n] + t), axis=0)
            a = (prior if t == 0 else alphas[-1][:n] @ p.step) * e
            scale = a.sum(1, keepdims=True)
            alphas.append(a / scale)
            seen.append(e)
            scales.append(scale)
        beta = np.ones((len(group), k))
        gammas, seen_ids = [], []
        for t in range(steps - 1, -1, -1):
            n = live[t]
            gamma = alphas[t] * beta[:n]
            gammas.append(gamma)
            seen_ids.append(ids.take(at[:n] + t))
            if t:
                ahead = seen[t] * beta[:n] / scales[t]
                step_sum += p.step * (alphas[t - 1][:n].T @ ahead)
                beta[:n] = ahead @ p.step.T
            else:
                start_sum += gamma[opening].sum(0)
        gamma, of_id = np.concatenate(gammas), np.concatenate(seen_ids)
        for s in range(k):
            out[:, s] += np.bincount(of_id, weights=gamma[:, s], minlength=len(out))
    return out


def _cell_key(i: int) -> bytes:
    """Key of a parameter row: never a word, since it begins with the end token."""
    return END + i.to_bytes(4, "big")


def baum_welch(sequences: DataFrame, symbol: np.ndarray, alone: int, states: int = STATES,
               rounds: int = ROUNDS, packed: Packed | None = None) -> tuple[Parameters, np.ndarray, DataFrame]:
    """Train on all rows of ``sequences`` (``ids``, ``rare``, ``rare_cls``).

    ``symbol`` gives each id its symbol, of which ``alone`` are single words, the others classes.
    Returns the parameters over symbols, the last round's expected counts of ids and of the classes
    of rare words, by state, and those of all rare words (key, numbers of ``packed``).
    """
    packed = packed or Packed(1, states)
    own, symbols = len(symbol), alone + CLASSES
    p = Parameters.first(symbols, states)
    names = [f"e{s}" for s in range(states)]
    for r in range(rounds):
        shared, last = sequences.sparkSession.sparkContext.broadcast((p, symbol)), r == rounds - 1
        # counted by symbol, and in the last round by id
        cell_of = symbol if not last else np.arange(own)
        n_cells = symbols if not last else own + CLASSES

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last, cell_of=cell_of,
                n_cells=n_cells) -> Iterator[pa.RecordBatch]:
            p, symbol = shared.value
            emit = np.ascontiguousarray(p.emit.T)
            # rows: symbols (or ids and classes of rare words), the start, transitions from each state
            sums = np.zeros((n_cells + 1 + states, states))
            for part in in_parts(batches):
                seqs = Sequences(part, symbol, alone)
                found = expected_counts(p, emit, seqs, sums[n_cells], sums[n_cells + 1:])
                for s in range(states):
                    sums[:n_cells, s] += np.bincount(cell_of, weights=found[:own, s], minlength=n_cells)
                    sums[n_cells - CLASSES:n_cells, s] += np.bincount(seqs.cls, weights=found[own:, s], minlength=CLASSES)
                if last and len(seqs.cls):
                    word = part.column("rare").flatten().dictionary_encode()
                    code, size = word.indices.to_numpy(), len(word.dictionary)
                    n = np.bincount(code, weights=seqs.times, minlength=size).astype(np.int64)
                    e = [np.bincount(code, weights=found[own:, s], minlength=size) for s in range(states)]
                    yield rows(word.dictionary, None, packed.pack(n, np.stack(e, axis=1)))
            used = np.flatnonzero(sums.any(1))
            yield rows(pa.array([_cell_key(int(i)) for i in used], pa.binary()), sums[used].T, None)

        def rows(key: pa.Array, e, numbers) -> pa.RecordBatch:
            nothing = [None] * len(key)
            return pa.RecordBatch.from_arrays(
                [key, *(pa.array(nothing if e is None else e[s], pa.float64()) for s in range(states)),
                 *(pa.array(nothing if numbers is None else numbers[i], pa.int64()) for i in range(len(packed.names)))],
                names=["key", *names, *packed.names])
        cells = sequences.select("ids", "rare_cls", *(("rare",) if last else ())).mapInArrow(
            run, "key binary, " + ", ".join([f"{e} double" for e in names] + [f"{x} long" for x in packed.names]))
        if last:
            cells, cells_at = staged(cells, "hmm-cells")
        # fewer rows than 1 / FREQUENT + CLASSES + STATES + 2
        found = cells.filter("e0 IS NOT NULL").groupBy("key").agg(*(F.sum(x).alias(x) for x in names)).toArrow()
        at = np.array([int.from_bytes(k[1:], "big") for k in found["key"].to_pylist()], dtype=np.int64)
        sums = np.zeros((n_cells + 1 + states, states))
        sums[at] = np.stack([found[e].to_numpy() for e in names], axis=1)
        to = np.arange(symbols) if not last else np.concatenate([symbol, alone + np.arange(CLASSES)])
        by_symbol = np.stack([np.bincount(to, weights=sums[:n_cells, s], minlength=symbols) for s in range(states)])
        p = Parameters.from_counts(sums[n_cells], sums[n_cells + 1:], by_symbol)
        shared.unpersist()
    words_seen = cells.filter("p0 IS NOT NULL").groupBy("key").agg(*(F.sum(x).alias(x) for x in packed.names))
    words_seen, _ = staged(words_seen, "hmm-known")
    delete_path(sequences.sparkSession, cells_at)
    return p, sums[:n_cells], words_seen


class Emissions:
    """Probabilities of words by state, from the expected counts without ties."""

    def __init__(self, v: Vocabulary, cells: np.ndarray, shrink: float = SHRINK):
        self.n, self.shrink = v.total, shrink
        self.slots = v.total + SMOOTH * (max(v.distinct, 1) + CLASSES)    # the end is known without training, too
        self.state = np.maximum(cells.sum(0) + shrink * v.total, 1e-300)
        own = len(v.own)
        self.own = self.known(v.c, cells[:own])
        classes = cells[own:].copy()
        tied = v.symbol >= v.alone
        np.add.at(classes, v.symbol[tied] - v.alone, cells[:own][tied])
        classes += shrink * classes.sum(1, keepdims=True) + 1
        self.unknown = SMOOTH * CLASSES * classes / classes.sum(0) / self.slots

    def known(self, c: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Emissions of words with counts ``c`` and expected counts ``e`` by state."""
        return (self.n * (e + self.shrink * c[:, None]) / self.state + SMOOTH) / self.slots

    def rows(self, cls: np.ndarray, at: np.ndarray, c: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Emissions of rare words of classes ``cls``; those numbered ``at`` are known."""
        out = self.unknown[cls]
        out[at] = self.known(c, e)
        return out


def score(docs: DataFrame, train: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, train, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    ``train`` is the boolean column that marks training rows. Scores are log10.
    """
    sc = docs.sparkSession.sparkContext
    counts, counts_at = staged(word_counts(docs.filter(F.col(train)), text), "hmm-counts")
    v = vocabulary(counts)
    delete_path(docs.sparkSession, counts_at)
    vocab = sc.broadcast(v)
    rows, _ = staged(symbolise(docs, vocab, id_col, text, train).withColumn("row", F.monotonically_increasing_id()), "hmm-rows")
    packed = v.packed
    p, sums, known = baum_welch(rows.filter("train"), v.symbol, v.alone, packed=packed)
    model = sc.broadcast((p, Emissions(v, sums), v.symbol, v.alone))
    # written before the second shuffle, so that the two don't lie on disk together
    met, _ = staged(rows.select("row", F.posexplode("rare").alias("j", "key")).join(known, "key")
                    .select("row", "j", *packed.names), "hmm-met")
    met = met.groupBy("row").agg(F.collect_list(F.struct("j", *packed.names)).alias("met"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, emissions, symbol, alone = model.value
        for part in in_parts(batches):
            seqs = Sequences(part, symbol, alone)
            met, here = part.column("met"), pc.fill_null(pc.list_value_length(part.column("met")), 0).to_numpy()
            j, *numbers = (x.to_numpy() for x in met.flatten().flatten())
            at = j + np.repeat(np.cumsum(seqs.n_rare) - seqs.n_rare, here)
            e, c = packed.unpack(numbers) / UNIT, np.zeros(len(seqs.cls))
            c[at] = e.sum(1)
            emit = np.concatenate([emissions.own, emissions.rows(seqs.cls, at, c[at], e)])
            rare_known = np.bincount(seqs.doc_of_rare, weights=seqs.times * (c > 0), minlength=part.num_rows).astype(np.int64)
            rare_log = np.bincount(seqs.doc_of_rare, weights=seqs.times * np.log(c + SMOOTH), minlength=part.num_rows).astype(float)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in kept), pa.array(rare_known), pa.array(rare_log),
                 pa.array(forward(p, emit, seqs.ids, seqs.lengths))], names=[*kept, "rare_known", "rare_log", "ll"])
    kept = ["id", "train", "n_tokens", "n_frequent", "sum_log"]
    scored = rows.select("row", *kept, "ids", "rare_cls").join(met, "row", "left").drop("row").mapInArrow(
        run, f"id {docs.schema[id_col].dataType.simpleString()}, train boolean, n_tokens long, n_frequent long, "
             "sum_log double, rare_known long, rare_log double, ll double")
    logs = F.col("sum_log") + F.col("rare_log")
    return scored.select(
        F.col("id").alias(id_col), "train", "n_tokens",
        (F.col("n_frequent") + F.col("rare_known")).alias("n_known"),
        F.lit(v.total).cast("long").alias("train_tokens"),
        ((logs - F.col("n_tokens") * F.lit(v.base_log)) / LOG10).alias("base_score"),
        (F.col("ll") / LOG10).alias("score"))

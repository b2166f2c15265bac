"""Language identification by cross-parsing entropy (Ziv-Merhav) with suffix automata.

**Training.** Per language a bounded, hash-chosen sample of labelled text (``SAMPLE_CHARS``
characters out of at most ``SAMPLE_ROWS`` rows, both parameters) becomes a suffix
automaton: the smallest automaton that reads exactly the substrings of the sample. Its
transitions are laid out as one dense table per language. The tables have a fixed bound
(languages x 2 x SAMPLE_CHARS states x letters) and are broadcast.

**Scoring.** A text is parsed from left to right into the longest phrases that the
automaton can read; the phrase count, normalised by text length and by the logarithm of
the sample length, estimates the cross entropy to that language. The language with the
fewest normalised phrases wins. Every whole text is parsed, in blocks of ``BLOCK`` letters
(a phrase ends at a block's border in every language alike), and many blocks are walked
side by side with numpy, one letter a step, so the cost is linear in the text.

Letters are folded to lower case; a run of anything else counts as one separator. Null
texts and texts without a letter are ``und`` with score 0. With no labelled text at all
everything is ``und``. Ties go to the language that sorts first. Rows are scored one by
one: repeated rows, null ids and further columns pass through untouched.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from telemetra.llm.common import code_points, release, slices

SAMPLE_ROWS = 400        # labelled rows a language
SAMPLE_CHARS = 20_000    # characters a language
PIECE_CHARS = 600        # characters of one row in the sample
MAX_LETTERS = 94         # distinct letters with a class of their own
BLOCK = 1024
UNDETERMINED = "und"


@dataclass
class Model:
    languages: list[str]
    letters: str             # class 2 + i; 0 separator, 1 any other letter
    table: np.ndarray        # int32: target offset << 2 | phrases that end on this step
    roots: np.ndarray        # offset of each language's start state
    log_size: np.ndarray     # log2 of each sample's length
    width: int


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a code sequence (state 0 is the start)."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        cur = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


def fold(text: str) -> str:
    """Lower case with separators: one blank for every run of non-letters."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def build(samples: dict[str, list[str]]) -> Model | None:
    """Model from labelled sample texts per language."""
    folded = {lang: " ".join(filter(None, map(fold, texts))) for lang, texts in sorted(samples.items())}
    folded = {lang: t for lang, t in folded.items() if t}
    if not folded:
        return None
    seen = Counter(c for t in folded.values() for c in t if c != " ")
    letters = "".join(sorted(c for c, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:MAX_LETTERS]))
    code = {c: i + 2 for i, c in enumerate(letters)} | {" ": 0}
    width = len(letters) + 2
    tables, roots, offset = [], [], 0
    for text in folded.values():
        step = suffix_automaton([code.get(c, 1) for c in text])
        rows = np.repeat(np.arange(len(step)), [len(s) for s in step])
        cols = np.fromiter((c for s in step for c in s), np.int64)
        to = np.fromiter((t for s in step for t in s.values()), np.int64)
        first = np.full(width, -1, dtype=np.int64)
        for c, t in step[0].items():
            first[c] = t
        # no transition: the phrase ends and the letter starts the next one (or is one by itself)
        again = np.where(first >= 0, (first * width + offset) << 2 | 1, offset << 2 | 2)
        table = np.tile(again, (len(step), 1))
        table[0] = np.where(first >= 0, (first * width + offset) << 2, offset << 2 | 1)
        table[rows, cols] = (to * width + offset) << 2
        if int(table.max()) >= 1 << 31:
            raise ValueError(f"the automata of {len(folded)} languages don't fit 32-bit tables: lower the sample a language")
        tables.append(table.astype(np.int32).ravel())
        roots.append(offset)
        offset += table.size
    sizes = np.array([max(2, len(t)) for t in folded.values()], dtype=np.float64)
    return Model(list(folded), letters, np.concatenate(tables), np.array(roots, dtype=np.int32), np.log2(sizes), width)


_classes: dict[str, np.ndarray] = {}


def letter_classes(letters: str) -> np.ndarray:
    """Class of every code point: 0 for non-letters, 1 for letters without an own class."""
    if letters not in _classes:
        lut = np.fromiter((chr(i).isalpha() for i in range(0x110000)), np.uint8, 0x110000)
        for i, c in enumerate(letters):
            lut[ord(c)] = i + 2
            if len(c.upper()) == 1:
                lut[ord(c.upper())] = i + 2
        _classes[letters] = lut
    return _classes[letters]


def parse(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(phrases per text and language, letters and separators per text)."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), lengths)
    cls = letter_classes(model.letters)[code_points("".join(texts))]
    first = np.zeros(len(cls), dtype=bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    before = np.concatenate([[0], cls[:-1]]) if len(cls) else cls
    kept = (cls != 0) | ((before != 0) & ~first)
    cls, owner = cls[kept].astype(np.int32), owner[kept]
    n = np.bincount(owner, minlength=len(texts))
    phrases = np.zeros((len(texts), len(model.languages)), dtype=np.int64)
    if not len(cls):
        return phrases, n
    # blocks of BLOCK letters, longest first, so that the blocks still running are a prefix
    blocks = -(-n // BLOCK)
    of = np.repeat(np.arange(len(texts)), blocks)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = np.repeat(np.cumsum(n) - n, blocks) + nth * BLOCK
    size = np.minimum(BLOCK, np.repeat(n, blocks) - nth * BLOCK)
    order = np.argsort(-size, kind="stable")
    of, start, size = of[order], start[order], size[order]
    running = np.searchsorted(-size, -np.arange(size[0]), side="left")
    state = np.tile(model.roots[:, None], (1, len(of)))
    count = np.zeros(state.shape, dtype=np.int32)
    for t in range(int(size[0])):
        live = running[t]
        x = model.table.take(state[:, :live] + cls.take(start[:live] + t))
        count[:, :live] += x & 3
        state[:, :live] = x >> 2
    count += state != model.roots[:, None]     # the phrase still open at the end
    for g in range(len(model.languages)):
        phrases[:, g] = np.bincount(of, weights=count[g], minlength=len(texts)).astype(np.int64)
    return phrases, n


def predict(model: Model | None, texts: list[str]) -> pd.DataFrame:
    """lang_pred and score of each text."""
    lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if model is not None:
        has_letter = letter_classes(model.letters)
        for a, b in slices(texts):
            phrases, n = parse(model, texts[a:b])
            bits = phrases * model.log_size / np.maximum(n, 1)[:, None]
            best = bits.argmin(1)
            weight = np.exp2(-4.0 * (bits - bits.min(1, keepdims=True)))
            share = 1.0 / weight.sum(1)
            for i in range(b - a):
                if has_letter[code_points(texts[a + i])].any():
                    lang[a + i], score[a + i] = model.languages[best[i]], share[i]
    return pd.DataFrame({"lang_pred": lang, "score": score})


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model | None:
    """Fit on a bounded sample of ``labelled``: per language the rows of the smallest id hashes.

    Two scans: counts per language (three small columns), then the rows below each
    language's hash threshold. At most about 2 x ``rows`` pieces a language reach the driver.
    """
    usable = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = {r["lang"]: r["n"] for r in usable.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64(F.col(key), F.col(lang)), F.lit(1 << 30))
    chosen = F.lit(False)
    for name, n in counts.items():
        chosen = chosen | ((F.col(lang) == name) & (draw < int((1 << 30) * min(1.0, 1.3 * rows / n))))
    at = F.floor(F.greatest(F.length(text) - PIECE_CHARS, F.lit(0)) * F.pmod(draw, F.lit(1000)) / 1000).cast("int") + 1
    picked = usable.filter(chosen).select(F.col(lang).alias("lang"), draw.alias("draw"),
                                          F.substring(F.col(text), at, F.lit(PIECE_CHARS)).alias("piece"))
    samples: dict[str, list[str]] = {}
    sizes: Counter[str] = Counter()
    for r in sorted(picked.collect(), key=lambda r: (r["lang"], r["draw"], r["piece"])):
        if len(samples.setdefault(r["lang"], [])) < rows and sizes[r["lang"]] < chars:
            samples[r["lang"]].append(r["piece"][:chars - sizes[r["lang"]]])
            sizes[r["lang"]] += len(samples[r["lang"]][-1])
    return build(samples)


def identify(spark: SparkSession, model: Model | None, text: Column) -> Column:
    """Struct column (lang_pred, score) of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in batches:
            yield predict(shared.value, ["" if t is None else t for t in s])
            release()
    # a filter on the result is not pushed below it, where it would be computed a second time
    return run.asNondeterministic()(text)

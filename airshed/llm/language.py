"""Language identification by a linear-chain conditional random field over words.

Each word has affix, character n-gram and lexicon features; their weights and the transition
weights between the languages of neighbouring words are learned together, on word sequences in which
passages of several documents are spliced, so that the chain learns how often languages switch.
Forward-backward gives every word of a text its marginal probabilities, in code-switched text as
well; the language of the text is the one with the largest sum over its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import category
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airshed.llm.common import as_id, as_text

TRAIN_ROWS = 150  # labelled documents per language, the bound of the training sample
BYTES_AT_ONCE = 2_000_000
EPOCHS = 25
LEAST = 5  # occurrences in the sample that put a word into the lexicon
UNKNOWN = "und"

#: ASCII bytes that are not letters become spaces; line ends stay.
_TO_WORDS = bytes(c if c == 10 or 65 <= c <= 90 or 97 <= c <= 122 or c >= 128 else 32
                  for c in range(256))
#: Feature numbers: 2-grams as they are, the others hashed into tables of their own.
_TWO, _THREE, _AFFIX, _WORD = 1 << 16, 1 << 17, 1 << 16, 1 << 18
SIZE = _TWO + _THREE + 2 * _AFFIX + _WORD


@dataclass
class Words:
    """The words of a buffer of letters, spaces and line ends, and their features: ``char2`` and
    ``char3`` per letter (the 2-gram that ends and the 3-gram that has its middle there, word
    borders included), ``first`` (number of the word's first letter), and per word ``last2``, ``prefix``,
    ``suffix`` (three letters and the border) and ``word``."""

    start: np.ndarray
    end: np.ndarray
    line: np.ndarray  # number of the word's line
    first: np.ndarray
    char2: np.ndarray
    char3: np.ndarray
    last2: np.ndarray
    prefix: np.ndarray
    suffix: np.ndarray
    word: np.ndarray

    def per_word(self) -> tuple[np.ndarray, ...]:
        return self.last2, self.prefix, self.suffix, self.word


def read_words(buffer: bytes) -> Words:
    raw = np.frombuffer(b"  " + buffer + b"   ", np.uint8)
    newline = raw == 10
    c = np.where(newline, np.uint8(32), raw).astype(np.uint32)
    letter = c != 32
    start = np.flatnonzero(letter[1:] & ~letter[:-1]) + 1
    end = np.flatnonzero(letter[:-1] & ~letter[1:]) + 1
    at = np.flatnonzero(letter)
    size = end - start
    first = np.cumsum(size) - size
    line = np.cumsum(newline)[start]
    # hashes: letters times odd numbers, modulo 2**32
    here, before = c[at], c[at - 1]
    three = ((before * 40503 + here * 9973 + c[at + 1]) * _ODD >> 9) % _THREE + _TWO
    affix = lambda x, y, z: ((x * 65599 + y * 40503 + z) * _ODD >> 11) % _AFFIX
    prefix = affix(c[start], c[start + 1], np.where(size > 1, c[start + 2], 32).astype(np.uint32))
    suffix = affix(c[end - 1], c[end - 2], np.where(size > 1, c[end - 3], 32).astype(np.uint32))
    place = np.minimum(at - np.repeat(start, size), len(_POWERS) - 1)
    word = np.add.reduceat(here * _POWERS.take(place), first) if len(at) else here
    word = ((word ^ word >> 15) * _ODD >> 12) % _WORD
    base = _TWO + _THREE
    return Words(start - 2, end - 2, line, first, before * 256 + here, three,
                 c[end - 1] * 256 + 32, prefix + base, suffix + (base + _AFFIX),
                 word + (base + 2 * _AFFIX))


_ODD = np.uint32(2654435761)
_POWERS = np.cumprod(np.full(256, 0x9E3779B1, np.uint32), dtype=np.uint32)


def marginals(emission: np.ndarray, transition: np.ndarray,
              lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over sequences that stand one after the other in ``emission`` (words x
    languages): marginals of words, expected transitions, log of the partition function."""
    n, k = emission.shape
    if not n:
        return emission, np.zeros((k, k)), 0.0
    t = np.exp(transition).astype(emission.dtype)
    # words by step, longest sequence first: the words of a step stand together
    order = np.argsort(-lengths, kind="stable")
    steps = np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    active = np.bincount(steps)
    begin = np.cumsum(active) - active
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths))
    to = begin[steps] + np.repeat(rank, lengths)  # place of each word
    top = emission.max(axis=1, keepdims=True)
    e = np.empty_like(emission)
    e[to] = np.exp(emission - top)
    a, b, scale = np.empty_like(e), np.ones_like(e), np.empty((n, 1), e.dtype)
    for step, m in enumerate(active):
        i = begin[step]
        now = e[i:i + m] if step == 0 else (a[begin[step - 1]:begin[step - 1] + m] @ t) * e[i:i + m]
        scale[i:i + m] = total = now.sum(axis=1, keepdims=True)
        a[i:i + m] = now / total
    for step in range(len(active) - 1, 0, -1):
        i, j, m = begin[step], begin[step - 1], active[step]
        b[j:j + m] = ((b[i:i + m] * e[i:i + m]) @ t.T) / scale[i:i + m]
    post = a * b
    post /= post.sum(axis=1, keepdims=True)
    pair = np.zeros((k, k))
    for step in range(1, len(active)):
        i, j, m = begin[step], begin[step - 1], active[step]
        pair += (a[j:j + m] / scale[i:i + m]).T @ (b[i:i + m] * e[i:i + m])
    return post[to], pair * t, float(np.log(scale).sum() + top.sum())


@dataclass
class Tagger:
    languages: list[str]
    weights: np.ndarray  # features x languages; zero for words outside the lexicon
    transition: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        if not len(words.start):
            return np.zeros((0, len(self.languages)), self.weights.dtype)
        by_char = self.weights.take(words.char2, axis=0)
        by_char += self.weights.take(words.char3, axis=0)
        total = np.add.reduceat(by_char, words.first, axis=0)
        for part in words.per_word():
            total += self.weights.take(part, axis=0)
        return total


def letters(text: str | None) -> bytes:
    """A text as the bytes of its lower-cased letters, spaces and line ends. Marks that combine with
    letters count as letters. Characters are looked at singly only in texts with others than ASCII."""
    text = (text or "").lower()
    if not text.isascii():
        odd = {x for x in set(text) if x > "\x7f" and not (x.isalpha() or category(x)[0] == "M")}
        if odd:
            text = text.translate(dict.fromkeys(map(ord, odd), " "))
    return text.encode("utf-8", "replace").translate(_TO_WORDS)


def _splice(docs: list[tuple[list[bytes], int]], rng) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Training sequences, one per line: passages of documents, each followed by passages of others.
    Returns the buffer, the language of each word and the lengths."""
    passages = []
    for words, label in docs:
        i = 0
        while i < len(words):
            n = int(rng.integers(4, 60))
            passages.append((words[i:i + n], label))
            i += n
    order = rng.permutation(len(passages))
    lines, gold, lengths = [], [], []
    for i in range(0, len(order), 3):
        chosen = [passages[j] for j in order[i:i + 3]]
        lines.append(b" ".join(w for words, _ in chosen for w in words))
        for words, label in chosen:
            gold += [label] * len(words)
        lengths.append(sum(len(words) for words, _ in chosen))
    return b"\n".join(lines), np.array(gold, np.int64), np.array(lengths, np.int64)


def train(rows: list[tuple[str, str]], seed: int = 1) -> Tagger:
    """Fits the field on (text, language) rows by gradient steps on the log-likelihood."""
    languages = sorted({lang for _, lang in rows})
    index = {x: i for i, x in enumerate(languages)}
    docs = [(letters(text).split(), index[lang]) for text, lang in rows]
    buffer, gold, lengths = _splice([d for d in docs if d[0]], np.random.default_rng(seed))
    k = len(languages)
    weights, transition = np.zeros((SIZE, k)), np.zeros((k, k))
    if not len(gold) or k < 2:
        return Tagger(languages, weights, transition)
    words = read_words(buffer)
    rare = np.bincount(words.word, minlength=SIZE) < LEAST
    rare[:SIZE - _WORD] = False
    owner = np.repeat(np.arange(len(words.first)),
                      np.diff(np.append(words.first, len(words.char2))))
    inner = np.ones(len(gold), bool)
    inner[np.cumsum(lengths) - lengths] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[at - 1], gold[at]), 1.0)
    step_w, step_t = np.full_like(weights, 1e-8), np.full((k, k), 1e-8)
    n = len(gold)
    for _ in range(EPOCHS):
        post, pair, _ = marginals(Tagger(languages, weights, transition).emissions(words),
                                  transition, lengths)
        post[np.arange(n), gold] -= 1.0
        grad = np.empty_like(weights)
        for j in range(k):
            by_char = post[owner, j]
            grad[:, j] = (np.bincount(words.char2, by_char, SIZE)
                          + np.bincount(words.char3, by_char, SIZE)
                          + sum(np.bincount(x, post[:, j], SIZE) for x in words.per_word()))
        grad[rare] = 0.0
        grad = grad / n + 1e-7 * weights
        grad_t = (pair - seen) / n
        step_w += grad**2
        step_t += grad_t**2
        weights -= 0.3 * grad / np.sqrt(step_w)
        transition -= 0.3 * grad_t / np.sqrt(step_t)
    return Tagger(languages, weights.astype(np.float32), transition)


def read(texts: list[str | None], tagger: Tagger) -> np.ndarray:
    """Per text the summed marginals per language; zeros if it has no letter."""
    sums = np.zeros((len(texts), len(tagger.languages)))
    parts: list[bytes] = []
    held = first = 0
    for i, text in enumerate(texts):
        parts.append(letters(text))
        held += len(parts[-1]) + 1
        if held >= BYTES_AT_ONCE or i == len(texts) - 1:
            _add(sums, parts, first, tagger)
            parts, held, first = [], 0, i + 1
    return sums


def _add(sums: np.ndarray, parts: list[bytes], first: int, tagger: Tagger) -> None:
    words = read_words(b"\n".join(parts))
    if not len(words.start) or not tagger.languages:
        return
    ends = np.cumsum([len(x) + 1 for x in parts])
    doc = np.searchsorted(ends, words.start, side="right")
    # chains: the words of a line
    new = np.append(True, words.line[1:] != words.line[:-1])
    lengths = np.diff(np.append(np.flatnonzero(new), len(new)))
    post, _, _ = marginals(tagger.emissions(words), tagger.transition, lengths)
    for j in range(post.shape[1]):
        sums[:, j] += np.bincount(doc + first, post[:, j], len(sums))


def sample(docs: DataFrame, learn, rows: int = TRAIN_ROWS) -> list[tuple[str, str]]:
    """At most ``rows`` texts of each language, those with the smallest hash of the id."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "text")
    got = (docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
           .select("doc_id", "lang", "text").withColumn("_rank", F.row_number().over(order))
           .where(F.col("_rank") <= rows).collect())
    return [(r["text"], r["lang"]) for r in sorted(got, key=lambda r: (r["lang"], r["_rank"]))]


def identify(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, lang_pred, score (share of the language among the words' marginals) for each row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lang, score = [], []
            for sums in read(batch["text"].tolist(), tagger):
                total = sums.sum() if len(sums) else 0.0
                best = int(sums.argmax()) if total else 0
                lang.append(tagger.languages[best] if total else UNKNOWN)
                score.append(round(min(1.0, float(sums[best] / total)), 9) if total else 0.0)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": lang,
                                "score": score})

    return docs.select(as_text("doc_id"), "text").mapInPandas(
        run, "doc_id string, lang_pred string, score double").select(
        as_id("doc_id"), "lang_pred", "score")


def filter_texts(docs: DataFrame, tagger: Tagger, least: float) -> DataFrame:
    """``docs`` without the texts that have no letter or no language with a score of ``least``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = read(batch.column("text").to_pylist(), tagger)
            total = sums.sum(axis=1)
            best = sums.max(axis=1, initial=0.0)
            yield batch.filter(pa.array((total > 0) & (best >= least * total)))

    return docs.mapInArrow(run, docs.schema)


def identify_documents(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out (crc32 of the id as text, mod 4, is 2), lang_pred, score. Learns from
    rows that are not held out. Texts that are null or have no letter are ``und`` with score 0."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    tagger = train(sample(docs, ~held))
    return identify(docs, tagger).select("doc_id", held.alias("held_out"), "lang_pred", "score")

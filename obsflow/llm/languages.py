"""Language identification by language-bitmask n-gram filters (operator 9).

Character n-grams that are usual in a language are put into a bit-sliced Bloom
filter: an array of slots whose bits are languages. Looking an n-gram up means
reading a few slots and AND-ing them, which gives all languages containing it at
once. Per document the bits are counted per language; the count is corrected by
the share of wrong positives that the filling of that language's slice lets
expect, and the largest corrected count decides.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.llm.common import arrow_map, documents, groups_of, mixed, record_batch
from obsflow.llm.registry import query

GRAM = 4
SLOT_BITS = 18
PROBES = 3
#: The bound of the training sample: about so many documents of each language, by a hash of the id.
SAMPLE_PER_LANGUAGE = 2000
#: An n-gram is learned for a language if this share of its sampled documents has it.
USUAL = 0.005
MAX_LANGUAGES = 1024
#: Below this share of n-grams known in the best language a text is taken for no language at all.
MIN_SCORE = 0.2
UNDETERMINED = "und"
_CHARS_AT_ONCE = 1 << 18


@lru_cache
def _folded() -> np.ndarray:
    """By code point: the letter in lower case, 0 for all that is no letter."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def _pieces(text: str) -> Iterator[np.ndarray]:
    """The folded code points of a text, in overlapping pieces; between texts and at their ends lie non-letters."""
    margin = GRAM - 1
    for begin in range(0, len(text), _CHARS_AT_ONCE):
        some = text[max(0, begin - margin) : begin + _CHARS_AT_ONCE]
        codes = _folded()[np.frombuffer(some.encode("utf-32-le", "replace"), np.uint32)]
        ends = (margin if begin == 0 else 0, margin if begin + _CHARS_AT_ONCE >= len(text) else 0)
        yield np.pad(codes, ends)


def gram_hashes(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each window of GRAM code points: a 64-bit hash, and whether it holds a letter."""
    windows = len(codes) - GRAM + 1
    total, letters = np.zeros(max(windows, 0), np.uint64), np.zeros(max(windows, 0), bool)
    with np.errstate(over="ignore"):
        for i in range(GRAM):
            some = codes[i : i + windows]
            total = total * np.uint64(0x100000001B3) + some
            letters |= some > 0
    return mixed(total), letters


def grams(texts: Sequence[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts: the number of the first, the hashes of their n-grams, and each one's place in the run.

    A long text may come in several runs.
    """
    texts = [t or "" for t in texts]
    for begin, end in groups_of((len(t) + GRAM for t in texts), _CHARS_AT_ONCE):
        several = end - begin > 1
        pieces = [p for t in texts[begin:end] for p in _pieces(t) or [np.zeros(0, np.uint32)]] if several else None
        if several:
            sizes = [len(t) + 2 * (GRAM - 1) if t else 0 for t in texts[begin:end]]
            codes = np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)
            hashes, letters = gram_hashes(codes)
            owner = np.repeat(np.arange(end - begin), sizes)[: len(hashes)]
            yield begin, hashes[letters], owner[letters]
        else:
            for codes in _pieces(texts[begin]):
                hashes, letters = gram_hashes(codes)
                yield begin, hashes[letters], np.zeros(int(letters.sum()), np.int64)


@dataclass(frozen=True)
class LanguageFilter:
    """The filter: slots by 64 languages each, and the languages by bit."""

    languages: tuple[str, ...]
    slots: np.ndarray

    def probes(self, hashes: np.ndarray) -> list[np.ndarray]:
        return [(hashes >> np.uint64(SLOT_BITS * i) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for i in range(PROBES)]

    def wrong_share(self) -> np.ndarray:
        """By language: the share of n-grams it lacks that look contained."""
        return np.array([self._bit(self.slots, i).mean() ** PROBES for i in range(len(self.languages))])

    @staticmethod
    def _bit(masks: np.ndarray, language: int) -> np.ndarray:
        return (masks[language // 64] >> np.uint64(language % 64) & np.uint64(1)).astype(np.int64)

    def counts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: its n-grams with a letter, and by language those that it seems to contain."""
        known = np.zeros((len(texts), len(self.languages)), np.int64)
        total = np.zeros(len(texts), np.int64)
        for begin, hashes, owner in grams(texts):
            if not len(hashes):
                continue
            masks = np.bitwise_and.reduce([self.slots[:, p] for p in self.probes(hashes)])
            size = int(owner[-1]) + 1
            total[begin : begin + size] += np.bincount(owner, minlength=size)
            for i in range(len(self.languages)):
                known[begin : begin + size, i] += np.bincount(owner[self._bit(masks, i) > 0], minlength=size)
        return total, known

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ties go to the first language by code point."""
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        total, known = self.counts(texts)
        wrong = self.wrong_share()
        corrected = (known - total[:, None] * wrong) / np.maximum(1 - wrong, 1e-9)
        best = corrected.argmax(axis=1)
        score = np.clip(corrected.max(axis=1) / np.maximum(total, 1), 0, 1)
        names = [self.languages[b] if n else UNDETERMINED for b, n in zip(best, total)]
        return names, np.where(total > 0, score, 0.0)


_GRAM_ROWS = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("docs", pa.int64())])


def _document_frequencies(batches):
    for batch in batches:
        texts, langs = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), dtype=object)
        for lang in sorted(set(langs)):
            found = [np.zeros(0, np.uint64)]
            own = [t for t, l in zip(texts, langs) if l == lang]
            for text in own:
                parts = [h for _, h, _ in grams([text])]
                found.append(np.unique(np.concatenate(parts)) if parts else found[0])
            gram, docs = np.unique(np.concatenate(found), return_counts=True)
            yield record_batch(_GRAM_ROWS, [lang] * len(gram), gram.view(np.int64), docs)


def learn(labelled: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE, usual: float = USUAL) -> LanguageFilter:
    """The filter from (doc_id, text, lang); rows without text or lang teach nothing.

    Learns from about ``sample_per_language`` documents of each language, chosen
    by a hash of the id. What comes to the driver is bounded: a row per
    language, of which there may be 1,024, and the slots of the filter.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()}
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = tuple(sorted(sizes, key=lambda name: name.encode()))
    slots = np.zeros((max(1, -(-len(languages) // 64)), 1 << SLOT_BITS), np.uint64)
    if not languages:
        return LanguageFilter((), slots)

    def by_language(value) -> Column:
        return F.create_map(*(F.lit(x) for name in languages for x in (name, value(name))))[F.col("lang")]

    kept = by_language(lambda name: min(1.0, sample_per_language / sizes[name]))
    chance = F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.filter(chance < kept).select("text", "lang")
    found = arrow_map(sample, _document_frequencies, "lang string, gram bigint, docs bigint")
    at_least = by_language(
        lambda name: max(1 if sizes[name] < 3 else 2, round(usual * min(sizes[name], sample_per_language)))
    )
    learned = found.groupBy("lang", "gram").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= at_least)
    number = by_language(languages.index)
    probes = F.array(
        *(F.shiftrightunsigned("gram", SLOT_BITS * i).bitwiseAND(F.lit((1 << SLOT_BITS) - 1)) for i in range(PROBES))
    )
    sliced = (
        learned.select(F.explode(probes).alias("slot"), (number / 64).cast("int").alias("word"), (number % 64).alias("bit"))
        .groupBy("slot", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask")).toArrow()
    )
    slots[sliced["word"].to_numpy(), sliced["slot"].to_numpy()] = sliced["mask"].to_numpy().view(np.uint64)
    return LanguageFilter(languages, slots)


def language_column(text, known: LanguageFilter) -> Column:
    """struct<lang, score> of a text column.

    ``und`` with score 0 for a null text, one without letters, and every text if
    nothing was learned. The score is the share of the text's n-grams that the
    chosen language contains, corrected for wrong positives.
    """

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        lang, score = known.predict([t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang": lang, "score": score})

    return of(F.col(text))


def held_out(doc_id) -> Column:
    """The quarter of the documents that nothing is learned from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def learn_from_documents(docs: DataFrame) -> LanguageFilter:
    return learn(docs.filter(~held_out("doc_id")))


def identify(docs: DataFrame, known: LanguageFilter) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text; other columns are not looked at).

    Repeated rows give a row each, a null doc_id stays null, an empty table
    gives no rows, long texts are read whole. ``language_column`` has the rest.
    """
    found = docs.select("doc_id", language_column("text", known).alias("found"))
    return found.select("doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


def in_a_language(docs: DataFrame, known: LanguageFilter, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is in one of the learned languages."""
    found = language_column("text", known)
    return docs.filter((found["lang"] != UNDETERMINED) & (found["score"] >= min_score))


@query("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = identify(docs, learn_from_documents(docs))
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")

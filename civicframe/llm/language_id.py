"""Language ID with language-bitmask n-gram filters.

Each learned language has a Bloom filter of its characteristic letter trigrams. The filters are stored bit-sliced: row i
of a table holds bit i of every language's filter as one bitmask, so that the AND of the few rows an n-gram hashes to
names all languages that contain the n-gram. The bits are counted per language over the n-grams of a text, corrected for
the filters' false positives, and the largest corrected count decides.

Learning reads a bounded sample of labelled rows (``per_language``, a parameter; all labelled rows below that). The
table has a fixed size (ROWS masks of 8 bytes a 64 languages), which is what is sent to the executors. Prediction reads every whole text.

Defined cases: ``und`` with score 0 for a null text, a text without letters, or if nothing was learned; a text whose
n-grams no language contains gets the language with most training rows and score 0; ties go to the first language by
code point; repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicframe.llm.common import bound_arrow_batches, mix, with_id

ROWS = 1 << 16
HASHES = 3
#: n-grams that a language's filter holds at most, and documents of a language that are read to choose them.
TOP, PER_LANGUAGE = 6000, 5000
#: A language contains an n-gram if its share there is at least this part of the largest share in any language.
CONTRAST = 0.35
PIECE = 1 << 19


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigrams as 64-bit numbers, the text of each, letters of each text): lower case, other characters as blanks, at least two letters."""
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("".join(x + "\n\n" for x in low).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter((len(x) + 2 for x in low), np.int64, len(low))
    alpha = _letters()[code]
    ends = np.cumsum(sizes)
    total = np.concatenate(([0], np.cumsum(alpha)))
    letters = total[ends] - total[ends - sizes]
    if len(code) < 3:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), letters
    c = np.where(alpha, code, 32).astype(np.uint64)
    fine = np.flatnonzero(alpha[:-2].view(np.int8) + alpha[1:-1].view(np.int8) + alpha[2:].view(np.int8) >= 2)
    key = c[fine] | c[fine + 1] << np.uint64(21) | c[fine + 2] << np.uint64(42)
    return key, np.searchsorted(ends, fine, side="right"), letters


def _pieces(texts: list) -> Iterator[list]:
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n < PIECE):
            n += len(texts[j] or "")
            j += 1
        yield texts[i:j]
        i = j


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            for part in _pieces([t for t, x in zip(texts, langs, strict=True) if x == lang]):
                keys, n = np.unique(grams(part)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"])


class Model:
    """Languages by code point, the bit-sliced filters (ROWS x masks), the false positive rate and the training rows of each."""

    def __init__(self, langs: list[str], table: np.ndarray, wrong: np.ndarray, common: int):
        self.langs, self.table, self.wrong, self.common = langs, table, wrong, common

    @classmethod
    def build(cls, counts: dict[str, list[tuple[int, int, int]]], rows: dict[str, int]) -> Model:
        """counts: for each language its (n-gram, count, count of all its n-grams)."""
        langs = sorted(rows)
        best: dict[int, float] = {}
        for grams_of in counts.values():
            for g, n, total in grams_of:
                best[g] = max(best.get(g, 0.0), n / total)
        table = np.zeros((ROWS, max(1, -(-len(langs) // 64))), np.uint64)
        fill = np.zeros(len(langs))
        for i, lang in enumerate(langs):
            mine = np.array([g for g, n, total in counts.get(lang, []) if n / total >= CONTRAST * best[g]], np.int64).view(np.uint64)
            at = np.unique(cls.places(mine))
            table[at, i // 64] |= np.uint64(1) << np.uint64(i % 64)
            fill[i] = len(at) / ROWS
        return cls(langs, table, fill**HASHES, max(range(len(langs)), key=lambda i: (rows[langs[i]], -i)) if langs else -1)

    @staticmethod
    def places(keys: np.ndarray) -> np.ndarray:
        h = mix(keys)
        return np.stack([(h >> np.uint64(16 * k) & np.uint64(ROWS - 1)).astype(np.int64) for k in range(HASHES)])

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        keys, of, letters = grams(texts)
        at = self.places(keys)
        masks = self.table[at[0]]
        for k in range(1, HASHES):
            masks &= self.table[at[k]]
        n = np.bincount(of, minlength=len(texts)).astype(float)
        right = np.zeros((len(texts), len(self.langs)))
        for i in range(len(self.langs)):
            bit = masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)
            hits = np.bincount(of, weights=bit, minlength=len(texts))
            right[:, i] = np.maximum(0, (hits - n * self.wrong[i]) / (1 - self.wrong[i]))
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        total, top = right.sum(1), right.argmax(1)
        score = np.where(total > 0, right[np.arange(len(texts)), top] / np.where(total > 0, total, 1), 0.0)
        top = np.where(total > 0, top, self.common)
        score = np.where(letters > 0, score, 0.0)
        return [self.langs[k] if x else "und" for k, x in zip(top, letters, strict=True)], score


def held_out() -> Column:
    """The documents that nothing is learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learns from text and non-null lang of documents that aren't held out."""
    labelled = docs.where("doc_id is not null and lang is not null and text is not null").where(~held_out())
    rows = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not rows:
        return Model.build({}, {})
    rate = F.create_map(*[x for lang, n in rows.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))])
    place = (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(2)), F.lit(1 << 30)) / float(1 << 30)).cast("double")
    sample = labelled.where(place < F.element_at(rate, F.col("lang"))).select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("total", total).withColumn("place", place).where(F.col("place") <= TOP)
    found: dict[str, list[tuple[int, int, int]]] = {}
    for r in top.select("lang", "gram", "n", "total").collect():  # at most TOP for each language
        found.setdefault(r["lang"], []).append((r["gram"], r["n"], r["total"]))
    return Model.build(found, rows)


def annotate(docs: DataFrame, per_language: int = PER_LANGUAGE, lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """All rows and columns of ``docs``, and the predicted language and its score under the given names. No shuffle."""
    bound_arrow_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, per_language))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], [np.zeros(0)]
            for part in _pieces(batch.column(0).field(place).to_pylist()):
                got, own = model.value.predict(part)
                langs += got
                scores.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(np.concatenate(scores))], ["row", "lang", "score"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    found = rows.mapInArrow(run, T.StructType([T.StructField("row", rows.schema["row"].dataType), T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns], F.col("lang").alias(lang), F.col("score").alias(score))


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = annotate(docs.where("doc_id is not null").select("doc_id", "text", "lang"), per_language)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "lang_pred", "score")

"""Language ID: one Kneser-Ney model of characters per language; the lowest cross-entropy wins, with calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .charlm import Mixture, fitted, letters
from .frames import filter_texts, map_texts, session, slim
from .textbuf import chunks

#: Labelled rows of a language that are learned from, chosen by a hash of their id: the bound of the model's size (about 1.5 times as a most).
SAMPLE_PER_LANGUAGE = 1500
#: Characters of a language's sample: where its texts are so long that SAMPLE_PER_LANGUAGE of them have more, fewer rows are taken.
SAMPLE_CHARS = 8_000_000
#: One in so many of them is kept from the models, to calibrate the score and the rejection.
HELD_BACK = 5
#: Held-back texts from which a language has its own bound of rejection; one of fewer has the bound pooled over all languages.
OWN_BOUND = 20
#: The robust upper end of held-back cross-entropies: this quantile and so many interquartile ranges of all, whichever is less.
QUANTILE, RANGES = 0.99, 6.0
#: So many times as far above the median as that end is still accepted: ordinary texts lie beyond a quantile too, those of no language far beyond.
BEYOND = 3.0
#: Code points a model spreads its last share of probability over.
ALPHABET = 20_000
#: Bytes of text that one vectorised step handles.
STEP_BYTES = 1 << 19
UNDETERMINED = "und"


class Identifier:
    """Languages, their models and the calibration."""

    def __init__(self, languages: list[str], mixture: Mixture) -> None:
        self.languages, self.mixture = languages, mixture
        self.sharpness, self.mean, self.spread, self.slack = 1.0, np.zeros(len(languages)), np.full(len(languages), np.inf), np.zeros(len(languages))

    def entropies(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(characters of each text, bits a character under each language)."""
        x, doc = letters(data, off)
        n = np.bincount(doc, minlength=len(off) - 1)
        total = np.zeros((len(n), len(self.languages)))
        if len(x):
            begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            total[doc[begin]] = np.add.reduceat(self.mixture.score(x, doc), begin, axis=0, dtype=np.float64)
        return n, -total / np.maximum(n, 1)[:, None] * np.log2(10)

    def odds(self, n: np.ndarray, bits: np.ndarray, sharpness: float) -> np.ndarray:
        away = bits - bits.min(axis=1, keepdims=True)
        p = np.exp(-sharpness * np.sqrt(n)[:, None] * away)
        return p / p.sum(axis=1, keepdims=True)

    def calibrate(self, n: np.ndarray, bits: np.ndarray, truth: np.ndarray) -> None:
        """The sharpness of least loss, and how far above its median a language's cross-entropy goes: BEYOND times that is still accepted.

        Texts that another language's model reads better than the labelled one's, or that lie far beyond the rest, are taken for
        mislabelled or junk and don't lift the bound. A language of few held-back texts has the bound of all languages' texts.
        """
        some = n > 0
        n, bits, truth = n[some], bits[some], truth[some]
        if not len(n):
            return
        loss = {s: -np.log(np.maximum(self.odds(n, bits, s)[np.arange(len(n)), truth], 1e-9)).sum() for s in 2.0 ** np.arange(-6, 7)}
        self.sharpness = min(loss, key=loss.get)
        best, h = bits.argmin(axis=1) == truth, bits[np.arange(len(n)), truth]
        if not best.any():
            return
        away, members = np.zeros(len(n)), [np.flatnonzero((truth == c) & best) for c in range(len(self.languages))]
        middle = np.median(h[best])
        for c, own in enumerate(members):
            self.mean[c] = np.median(h[own]) if len(own) >= OWN_BOUND else middle
            away[own] = h[own] - self.mean[c]
        pooled = self._bound(away[best], n[best])
        for c, own in enumerate(members):
            self.spread[c], self.slack[c] = self._bound(away[own], n[own]) if len(own) >= OWN_BOUND else pooled

    @staticmethod
    def _bound(away: np.ndarray, n: np.ndarray) -> tuple[float, float]:
        """BEYOND times the robust upper end of distances above the median: times the root of the length, and as they are."""

        def upper(x: np.ndarray) -> float:
            low, middle, high = np.quantile(x, (0.25, 0.5, 0.75))
            return float(min(np.quantile(x, QUANTILE), middle + RANGES * (high - low)))

        return BEYOND * max(1.0, upper(away * np.sqrt(n))), BEYOND * max(0.2, upper(away))

    def decide(self, n: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(best language, score, rejected)."""
        best, at = bits.argmin(axis=1), np.arange(len(n))
        h = bits[at, best]
        far = h - self.mean[best] > np.maximum(self.slack[best], self.spread[best] / np.sqrt(np.maximum(n, 1)))
        return best, self.odds(n, bits, self.sharpness)[at, best], far | (n == 0)


def learn(labelled: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Identifier | None:
    """An Identifier from (doc_id, text, lang). Every language is counted over all rows; the models are fitted on a bounded sample of each."""
    seen = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text").cast("bigint")), F.lit(0)).alias("chars")).collect()  # a row for each language
    size = {r["lang"]: r["n"] for r in seen}
    if not size:
        return None
    languages, scale = sorted(size), 1 << 30
    share = {r["lang"]: min(1.0, per_language / r["n"], SAMPLE_CHARS / max(1, r["chars"])) for r in seen}
    limit = F.create_map(*[F.lit(v) for k in languages for v in (k, min(scale, int(scale * share[k]) + 1))])
    sample = labelled.withColumn("_h", F.pmod(F.xxhash64("doc_id"), F.lit(scale))).where(F.col("_h") < limit[F.col("lang")])
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(HELD_BACK)) == 0
    few = [k for k in languages if size[k] < 4 * HELD_BACK]  # too few to keep any back
    sample = sample.withColumn("back", fold & ~F.col("lang").isin(few)).select("lang", "back", "text")

    models = fitted(sample.where("not back"), "lang", ALPHABET)
    languages = [k for k in languages if models.get(k)]
    if not languages:
        return None
    out = Identifier(languages, Mixture([models[k] for k in languages], ALPHABET))
    shared = labelled.sparkSession.sparkContext.broadcast(out)  # its size is bounded by the sample's distinct windows

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = [shared.value.entropies(data, off) for _, _, data, off in chunks(batch.column(1), STEP_BYTES)]
                yield pa.record_batch([batch.column(0), pa.array(np.concatenate([n for n, _ in made])), pa.array([b.tobytes() for _, m in made for b in m], pa.binary())], names=["lang", "n", "bits"])

    back = [r for r in sample.where("back").select("lang", "text").mapInArrow(weigh, "lang string, n bigint, bits binary").collect() if r["lang"] in languages]
    shared.unpersist()
    if back:
        out.calibrate(np.array([r["n"] for r in back]), np.stack([np.frombuffer(r["bits"], np.float64) for r in back]), np.array([languages.index(r["lang"]) for r in back]))
    return out


def identify(df: DataFrame, learned: Identifier | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected, cross_entropy) of every row, in one pass.

    `lang_pred` is the language of the lowest cross-entropy over all letters of the whole text; `score` its calibrated probability
    among those learned; `rejected` tells that its cross-entropy (bits a character) is above what held-back texts show: the language's
    own, or those of all languages where it has few. A null text, or one without a letter, is `und` with score 0 and rejected; so is every text if nothing was learned.
    Ids may be null or repeat. Other columns are ignored; no rows give none.
    """
    shared = df.sparkSession.sparkContext.broadcast(learned)

    def body(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, n_rows = shared.value, batch.num_rows
        if own is None:
            lang, score, rejected, bits = [UNDETERMINED] * n_rows, np.zeros(n_rows), np.ones(n_rows, bool), np.zeros(n_rows)
        else:
            made = [own.entropies(data, off) for _, _, data, off in chunks(batch.column(1), STEP_BYTES)]
            n, h = np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])
            best, score, rejected = own.decide(n, h)
            lang = [own.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), n.tolist(), strict=True)]
            score, bits = np.where(n > 0, score, 0.0), np.where(n > 0, h.min(axis=1), 0.0)
        return pa.record_batch([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(rejected), pa.array(bits)], names=["doc_id", "lang_pred", "score", "rejected", "cross_entropy"])

    return map_texts(slim(df, id_col, text_col), body, "doc_id bigint, lang_pred string, score double, rejected boolean, cross_entropy double")


def fold(df: DataFrame, id_col: str = "doc_id"):
    """Which rows are held out: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def _learned(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> Identifier | None:
    session(df)
    known = df.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull() & ~fold(df, id_col))
    return learn(known.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")))


def languages_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """identify() of all rows, learned from those rows that aren't held out and have a language and an id, with `held_out`."""
    found = identify(df, _learned(df, id_col, text_col, lang_col), id_col, text_col)
    return found.select("doc_id", fold(found, "doc_id").alias("held_out"), "lang_pred", "score", "rejected", "cross_entropy")


def keep_identified(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of `df` that languages_of() doesn't reject, with all their columns. If nothing was learned, none is kept."""
    shared = df.sparkSession.sparkContext.broadcast(_learned(df, id_col, text_col, lang_col))

    def keep(texts: pa.Array) -> pa.Array:
        if shared.value is None:
            return pa.array(np.zeros(len(texts), bool))
        made = [shared.value.entropies(data, off) for _, _, data, off in chunks(texts, STEP_BYTES)]
        return pa.array(~shared.value.decide(np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made]))[2])

    return filter_texts(df, text_col, keep)

"""Toxicity: disguised words are restored by a noisy channel, then words and word beginnings learned from labels score the text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .charlm import BLANK, Mixture, fitted, folded, letters
from .deobfuscate import Decoder, Outlines, suspects
from .frames import filter_texts, map_texts, session, slim, written
from .textbuf import chunks, mix, spans, value_hashes

#: Lengths of the word beginnings that are features beside whole words.
PREFIXES = (4, 5)
#: A feature stands if, of the texts that no better one explains, LEAST_NEW toxic ones have it and the lower bound of its share of toxic ones is at least
#: LEAST_SHARE; or if among all texts its share is at least PURE and the bound at least SURE.
LEAST_SHARE, LEAST_NEW, SURE, PURE, Z = 0.5, 3, 0.85, 0.98, 1.64
THRESHOLD = 0.7
#: What a text of which there is no near copy weighs; weights are whole numbers, so that no sum depends on its order.
WHOLE = 1 << 32
#: Orders of words' hashes whose smallest ones texts must share to weigh one text together: texts that only have a word in common seldom do.
ORDERS = 4
#: Groups of near copies at most that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
ALPHABET = 20_000
#: Bytes of text that one vectorised step handles.
STEP_BYTES = 1 << 19
_WHITE = np.zeros(0x110000, bool)
_WHITE[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = True


def words_of(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of letter streams begin and end; none crosses a text's end."""
    edge = np.concatenate([[0], np.flatnonzero(doc[1:] != doc[:-1]) + 1, [len(x)]])
    start, end, _ = spans(x != BLANK, edge)
    return start, end


def features_of(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, text) of every word of letter streams: the word, and its beginnings if it is longer than they are."""
    start, end = words_of(x, doc)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = mix(x.astype(np.uint64))
    out, texts = [value_hashes(value, start, end)], [doc[start]]
    for k in PREFIXES:
        long = end - start > k
        out.append(mix(value_hashes(value, start[long], start[long] + k) + np.uint64(k)))
        texts.append(doc[start[long]])
    return np.concatenate(out), np.concatenate(texts)


def spelled(x: np.ndarray, doc: np.ndarray) -> list[str]:
    """What each feature of features_of() is, in its order."""
    start, end = words_of(x, doc)
    text = x.astype("<u4").tobytes().decode("utf-32-le")
    words = [text[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
    return words + [w[:k] for k in PREFIXES for w in words if len(w) > k]


def stream(words: list[str]) -> np.ndarray:
    return folded()[np.frombuffer((" ".join(words) + " ").encode("utf-32-le"), "<u4")]


class Found:
    """Features of a chunk's texts and their texts, as they stand, then those of the words restored, which are numbered; `owner` has each one's text."""

    def __init__(self, data: np.ndarray, off: np.ndarray, decoder: Decoder | None, outlines: Outlines | None = None) -> None:
        self.restored, self.owner = [], np.zeros(0, np.int64)
        self.feature, self.text = features_of(*letters(data, off))
        self.more, self.word = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        if decoder is None or not len(data):
            return
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
        begin = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        start, end, doc = suspects(points, *spans(~_WHITE[points], np.searchsorted(begin, off)))
        if outlines is not None and len(start):
            may = outlines.may_hold(points, start, end)
            start, end, doc = start[may], end[may], doc[may]
        owner = []
        for a, b, d in zip(start.tolist(), end.tolist(), doc.tolist(), strict=True):
            words = decoder.restore(points[a:b].tobytes().decode("utf-32-le"))
            self.restored += words
            owner += [d] * len(words)
        if owner:
            self.owner = np.array(owner)
            self.more, self.word = features_of(*self._stream())

    def _stream(self) -> tuple[np.ndarray, np.ndarray]:
        return stream(self.restored), np.repeat(np.arange(len(self.restored)), [len(w) + 1 for w in self.restored])

    def spelled_more(self) -> list[str]:
        return spelled(*self._stream()) if self.restored else []

    def both(self) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([self.feature, self.more]), np.concatenate([self.text, self.owner[self.word]])


def distinct(f: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of a feature and a text, by feature."""
    order = np.lexsort((t, f))
    f, t = f[order], t[order]
    new = np.ones(len(f), bool)
    new[1:] = (f[1:] != f[:-1]) | (t[1:] != t[:-1])
    return f[new], t[new]


class Reader:
    """A character model and, in a worker, its decoder."""

    def __init__(self, model: Mixture | None) -> None:
        self.model = model

    def decoder(self) -> Decoder | None:
        if self.model is not None and not hasattr(self, "_decoder"):
            self._decoder = Decoder(self.model)
        return getattr(self, "_decoder", None)

    def __getstate__(self) -> dict:
        return {"model": self.model}


class Scorer:
    """Sorted feature hashes with their shares of toxic texts, the share of toxic texts without any, what reads disguised words, and which strings it reads."""

    def __init__(self, keys: np.ndarray, share: np.ndarray, rest: float, reader: Reader, outlines: Outlines) -> None:
        self.keys, self.share, self.rest, self.reader, self.outlines = keys, share, rest, reader, outlines

    def _among(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, f)
        at[at == len(self.keys)] = 0
        return at, self.keys[at] == f

    def score(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score of each text, words restored in it that a feature stands for)."""
        clean, restored = np.full(len(off) - 1, 1.0 - self.rest), np.zeros(len(off) - 1, np.int64)
        if not len(self.keys):
            return 1.0 - clean, restored
        found = Found(data, off, self.reader.decoder(), self.outlines)
        at, hit = self._among(found.feature)
        more, again = self._among(found.more)
        words = np.unique(found.word[again])
        np.add.at(restored, found.owner[words], 1)
        t, at = np.concatenate([found.text[hit], found.owner[found.word[again]]]), np.concatenate([at[hit], more[again]])
        pair = np.unique(np.stack([t, at]), axis=1)
        np.multiply.at(clean, pair[0], 1.0 - self.share[pair[1]])
        return 1.0 - clean, restored


def _weighed(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(toxic, weight, text) of all labelled rows. Texts of a class that share the smallest of their words' hashes under ORDERS orders, as near copies do, weigh WHOLE together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = []
            for at, to, data, off in chunks(batch.column(1), STEP_BYTES):
                f, t = features_of(*letters(data, off))
                alike = np.zeros(to - at, np.uint64)
                for k in range(ORDERS):
                    least = np.full(to - at, np.iinfo(np.int64).max)
                    np.minimum.at(least, t, mix(f + np.uint64(k)).view(np.int64))
                    alike = mix(alike * np.uint64(3) + least.view(np.uint64))
                made.append(alike.view(np.int64))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(np.concatenate(made))], names=["toxic", "text", "likeness"])

    # labels grow with the documents, so they are never broadcast; hash tables took an executor beyond its memory, sorts spill
    rows = docs.where("text is not null").join(marked.hint("merge"), "doc_id").select("toxic", "text").mapInArrow(run, "toxic boolean, text string, likeness bigint")
    rows = written(rows, "labelled")
    alike = written(rows.groupBy("toxic", "likeness").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "alike")
    few = alike.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(alike) if few else alike, ["toxic", "likeness"], "left").select("toxic", F.expr(f"{WHOLE} div coalesce(n, 1)").alias("weight"), "text")


def _toxic_features(toxic: DataFrame, reader: Reader) -> DataFrame:
    """(weight, features, words) of every text: its distinct features, as it stands or restored, and what each is."""
    shared = toxic.sparkSession.sparkContext.broadcast(reader)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, data, off in chunks(batch.column(1), STEP_BYTES) if batch.num_rows else ():
                found = Found(data, off, shared.value.decoder())
                f, t = found.both()
                names = spelled(*letters(data, off)) + found.spelled_more()
                first = np.lexsort((f, t))
                first = first[np.append(True, (f[first][1:] != f[first][:-1]) | (t[first][1:] != t[first][:-1]))] if len(f) else first
                cuts = pa.array(np.searchsorted(t[first], np.arange(to - at + 1)).astype(np.int32))
                words = pa.array([names[i] for i in first.tolist()], pa.string())
                yield pa.record_batch([batch.column(0).slice(at, to - at), pa.ListArray.from_arrays(cuts, pa.array(f[first].view(np.int64))), pa.ListArray.from_arrays(cuts, words)], names=["weight", "features", "words"])

    return toxic.select("weight", "text").mapInArrow(run, "weight bigint, features array<bigint>, words array<string>")


def _clean_features(clean: DataFrame, reader: Reader | None, only: np.ndarray | None, outlines: Outlines | None) -> DataFrame:
    """(feature, weight): what the texts with each feature weigh; of texts as they stand where no reader is given, of all features where `only` isn't."""
    shared = clean.sparkSession.sparkContext.broadcast((reader, only, outlines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, wanted, outline = shared.value
        for batch in batches:
            for at, to, data, off in chunks(batch.column(1), STEP_BYTES) if batch.num_rows else ():
                f, t = Found(data, off, own and own.decoder(), outline).both()
                if wanted is not None:
                    here = np.isin(f, wanted)
                    f, t = f[here], t[here]
                f, t = distinct(f, t)
                new = np.flatnonzero(np.append(True, f[1:] != f[:-1])) if len(f) else np.zeros(0, np.int64)
                weight = batch.column(0).slice(at, to - at).to_numpy()[t]
                total = np.add.reduceat(weight, new) if len(new) else weight
                yield pa.record_batch([pa.array(f[new].view(np.int64)), pa.array(total)], names=["feature", "weight"])

    return clean.select("weight", "text").mapInArrow(run, "feature bigint, weight bigint")


def _reader(texts: DataFrame) -> Reader:
    """A character model of all distinct texts."""
    levels = fitted(texts.select(F.lit("toxic").alias("one"), "text").distinct(), "one", ALPHABET).get("toxic")
    return Reader(Mixture([levels], ALPHABET) if levels else None)


def _array(rows: list, name: str, kind: type) -> np.ndarray:
    return np.array([r[name] for r in rows], kind)


def _texts(weight: np.ndarray) -> np.ndarray:
    """Weights as numbers of texts; rounded, so that parts of a text that add up to it do so."""
    return np.round(np.asarray(weight, float) / WHOLE, 6)


def lower_bound(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Wilson's lower bound of a share."""
    p, z = good / n, Z * Z
    return (p + z / (2 * n) - Z * np.sqrt(p * (1 - p) / n + z / (4 * n * n))) / (1 + z / n)


def learn(docs: DataFrame, labels: DataFrame) -> Scorer:
    """A Scorer from (doc_id, text) and (doc_id, toxic): from all labelled rows and their whole texts.

    Copies and near copies weigh one text together. Features are taken by falling lower bound of their share of toxic texts, each only if it
    explains toxic texts that none before does or its bound is beyond doubt, so that the other words of toxic texts teach nothing.
    Disguised words are read in all toxic texts. In clean ones they only lower a bound, so they are read there for features that stand
    without them. The driver gets those features, and the distinct sets of them that toxic texts have, up to the first that is beyond doubt.
    """
    session(docs)
    marked = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    rows = _weighed(docs, marked)
    clean = rows.where("not toxic")
    reader = _reader(rows.where("toxic"))
    toxic = written(_toxic_features(rows.where("toxic"), reader), "toxic_features")
    named = toxic.select("weight", F.explode(F.arrays_zip("features", "words")).alias("f")).select(F.col("f.features").alias("feature"), F.col("f.words").alias("word"), F.col("weight").alias("bad"), F.lit(0).cast("bigint").alias("good"))
    plain = _clean_features(clean, None, None, None).select("feature", F.lit(None).cast("string").alias("word"), F.lit(0).cast("bigint").alias("bad"), F.col("weight").alias("good"))
    summed = named.union(plain).groupBy("feature").agg(F.min("word").alias("word"), F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    bad, every = F.round(F.col("bad") / WHOLE, 6), F.round(F.col("bad") / WHOLE, 6) + F.round(F.col("good") / WHOLE, 6)
    p = bad / every
    bound = (p + Z * Z / (2 * every) - Z * F.sqrt(p * (1 - p) / every + Z * Z / (4 * every * every))) / (1 + Z * Z / every)
    might = summed.where(bad >= LEAST_NEW).where(bound >= LEAST_SHARE - 1e-9).orderBy("feature").collect()
    names, words, b = _array(might, "feature", np.int64), [r["word"] for r in might], _texts(_array(might, "bad", np.int64))
    key = np.sort(names.view(np.uint64))
    good = {r["feature"]: r["good"] for r in _clean_features(clean, reader, key, Outlines(words)).groupBy("feature").agg(F.sum("weight").alias("good")).collect()}
    n = b + _texts(np.array([good.get(k, 0) for k in names.tolist()], np.int64))
    bound = lower_bound(b, n)
    order = np.lexsort((names, -bound))
    order = order[bound[order] >= LEAST_SHARE]
    names, words, b, n, bound = names[order], [words[j] for j in order.tolist()], b[order], n[order], bound[order]
    whole = (b + 0.5) / (n + 1)
    pure = (whole >= PURE) & (bound >= SURE)
    by = np.argsort(names)
    shared = docs.sparkSession.sparkContext.broadcast((names[by], by, pure))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place, sure = shared.value
        for batch in batches:
            out = []
            for features in batch.column(1):
                f = features.values.to_numpy()
                near = np.minimum(np.searchsorted(known, f), max(0, len(known) - 1))
                own = np.sort(place[near[known[near] == f]]) if len(known) else place
                doubtless = np.flatnonzero(sure[own])
                out.append(own[: doubtless[0] + 1] if len(doubtless) else own)  # it explains the text whatever stands before it
            yield pa.record_batch([batch.column(0), pa.array([v.astype(np.int32) for v in out], pa.list_(pa.int32()))], names=["weight", "found"])

    sets = toxic.select("weight", "features").mapInArrow(held, "weight bigint, found array<int>").groupBy("found").agg(F.sum("weight").alias("weight")).orderBy("found").collect()
    shared.unpersist()
    size, explained = _texts(_array(sets, "weight", np.int64)), np.zeros(len(sets), bool)
    at: dict[int, list[int]] = {}
    for i, r in enumerate(sets):
        for j in r["found"]:
            at.setdefault(j, []).append(i)
    kept, share = [], []
    for j in range(len(names)):
        own = np.array(at.get(j, []), np.int64)
        new, other = float(np.round(size[own[~explained[own]]].sum(), 6)), n[j] - b[j]
        rest = (new + 0.5) / (new + other + 1)
        if pure[j] or (new >= LEAST_NEW and lower_bound(new, new + other) >= LEAST_SHARE):
            explained[own] = True
            kept.append(j)
            share.append(whole[j] if pure[j] else min(whole[j], rest))
    total = rows.agg(F.sum("weight").alias("n")).first()["n"]
    left = float(size[~explained].sum()) / max(1.0, float(_texts(total or 0)))
    key = names[np.array(kept, np.int64)].view(np.uint64)
    by = np.argsort(key)

    return Scorer(key[by], np.array(share)[by], min(0.5, left), reader, Outlines([words[j] for j in kept]))


def score(df: DataFrame, learned: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted, restored_words) of every row, in one pass.

    Disguised words are read wherever a feature may be hidden; `restored_words` counts those that a feature stands for. The score is the chance that at least one of the features found, in the text as it is or as restored, makes it toxic. A null or
    empty text has the share of toxic texts that have no feature. Ids may be null or repeat. Other columns are ignored; no rows give none.
    """
    shared = df.sparkSession.sparkContext.broadcast(learned)

    def body(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [shared.value.score(data, off) for _, _, data, off in chunks(batch.column(1), STEP_BYTES)]
        value = np.concatenate([m[0] for m in made])
        return pa.record_batch([batch.column(0), pa.array(value), pa.array((value >= THRESHOLD).astype(np.int32)), pa.array(np.concatenate([m[1] for m in made]))], names=["doc_id", "score", "predicted", "restored_words"])

    return map_texts(slim(df, id_col, text_col), body, "doc_id bigint, score double, predicted int, restored_words bigint")


def held_out(key: Column) -> Column:
    """Which rows are held out: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def _learned(df: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> Scorer:
    session(df)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(~held_out(F.col("doc_id")))
    return learn(slim(df, id_col, text_col).where(~held_out(F.col("doc_id"))), known)


def toxicity_of(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """score() of all rows with `held_out`, learned from `labels` (doc_id, toxic) of the rows that aren't held out."""
    found = score(df, _learned(df, labels, id_col, text_col), id_col, text_col)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "restored_words")


def keep_civil(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `df` that toxicity_of() doesn't predict to be toxic, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(_learned(df, labels, id_col, text_col))

    def keep(texts: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([shared.value.score(data, off)[0] for _, _, data, off in chunks(texts, STEP_BYTES)]) < THRESHOLD)

    return filter_texts(df, text_col, keep)

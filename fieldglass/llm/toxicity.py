"""Toxicity: class-conditional Kneser-Ney models of expressions, compared by length-normalised log-likelihood.

An expression is a word (ASCII letters and digits, and all longer characters), lower-cased.  Each class c has

    P_c(word) = max(n_c(word) - D, 0) / N_c + D T_c / N_c * P_c(stem) * P(word | stem)
    P_c(stem) = max(m_c(stem) - D, 0) / M_c + D U_c / M_c * P(stem)

n_c are counts in the class, m_c(stem) the number of its distinct words with that stem (the first ``STEM`` bytes: the
continuation count of Kneser-Ney), T_c and U_c the numbers of distinct words and stems.  The backoff P(stem) and
P(word | stem) come from counts that both classes share: those of all documents, with labels or without.  A document's
evidence is the difference of the mean log-likelihoods of its words, and besides, what the words' log-ratios have beyond
``MARGIN``, as a mean and as a sum over the root of the length.  A logistic curve in the three, with an offset, gives the
score; by the difference alone, what rare words show by chance hides a few toxic ones (figures in the README).

Counting is one pass: tasks count distinct words by hash and one shuffle adds them up, exactly and over all documents.
The backoff is the same in both models but for factors of the stem, so the log-ratio of a word that no labelled document
has is that of its stem, and of such a stem a constant.  Scoring thus needs the words and stems of labelled documents
alone, one number each, and no bucket is shared: what is broadcast grows with the vocabulary of at most ``LABELLED``
documents.
Labels of at most ``LABELLED`` rows, those of the least hashes if there are more, are broadcast as sorted ids.  All of them
count, and all fit the curve, by halves: the evidence of the documents of one half comes from models of the other half's
labels, so no document tells of itself, however few there are.  The curve is found by Newton's method, whose sums are
aggregates of the stored evidence.  No evidence counts against what it tells of: a term whose weight would be negative is
left out.  If a half lacks a class, only the other half's documents fit; if neither has evidence of both classes, the curve
is the difference of the mean log-likelihoods as it is, with the odds of the labels.

Defined results: null and empty texts have no evidence and get the curve's value there; very long texts are worked on whole,
a text at a time; repeated rows get the same score; of several labels of a doc_id the highest counts, null ones don't; without
labels of both classes every score is 0; columns of docs named as the query's own are replaced, others are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.llm import _kernels as K
from fieldglass.llm._shared import Tables, quoted, slices

STEM = 6
DISCOUNT = 0.75
MARGIN = 2.0
LABELLED = 1_000_000
CUT = 0.3
_CLASSES = ("toxic", "ordinary")
#: Counts by half of the labels and class: ordinary and toxic ones of the first half, then of the second.
_KINDS = ("ordinary_0", "toxic_0", "ordinary_1", "toxic_1")
_COUNTS = ", ".join(f"{c} long" for c in ("word", "stem", "total", *_KINDS))


def expressions(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words and of their stems, and the texts' offsets."""
    data, at = K.text_bytes(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    start, end = K.word_spans(data, at, K.PUNCTUATION)
    word, stem = K.span_hashes(data, (start, end), (start, np.minimum(end, start + STEM)))
    return word, stem, np.searchsorted(start, at)


class Labels:
    """Kinds of label by doc_id, by their place in ``_KINDS``; -1 none."""

    def __init__(self, ids: np.ndarray, toxic: np.ndarray, half: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.kind = ids[order], (toxic + 2 * half)[order].astype(np.int8)

    def of(self, doc_ids: pa.Array) -> np.ndarray:
        if not len(self.ids):
            return np.full(len(doc_ids), -1)
        ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
        k = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        known = (self.ids[k] == ids) & doc_ids.is_valid().to_numpy(zero_copy_only=False)
        return np.where(known, self.kind[k], -1)


def labelled(labels: DataFrame) -> Labels:
    """Labels of at most LABELLED rows of labels (doc_id, toxic), dealt out in halves."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    n = known.count()
    if n > LABELLED:
        # A threshold that ten deviations more than LABELLED hashes are under, so that no more than these are sorted.
        share = min(1.0, (LABELLED + 10 * LABELLED**0.5) / n)
        known = known.where(F.xxhash64("doc_id") < F.lit(int(share * 2**64) - 2**63 - 1))
    got = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))).toArrow()
    return Labels(*(got.column(c).to_numpy() for c in ("doc_id", "toxic", "half")))


def counts(docs: DataFrame, labels: Labels) -> DataFrame:
    """_COUNTS: how often each word occurs in all documents, and in those of each kind of label."""
    shared = docs.sparkSession.sparkContext.broadcast(labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def rows() -> pa.RecordBatch:
            word, stem, kind, n = (np.concatenate([x[k] for x in held]) for k in range(4))
            distinct, first, which = np.unique(word, return_index=True, return_inverse=True)
            total = np.bincount(which, n, len(distinct))
            each = [np.bincount(which[kind == k], n[kind == k], len(distinct)) for k in range(len(_KINDS))]
            held.clear()
            return pa.RecordBatch.from_arrays([K.i64(distinct), K.i64(stem[first]), *(pa.array(x.astype(np.int64)) for x in (total, *each))], ["word", "stem", "total", *_KINDS])

        for batch in batches:
            for part in slices(batch, "text", 1 << 23):
                word, stem, at = expressions(part.column("text"))
                kind = np.repeat(shared.value.of(part.column("doc_id")), np.diff(at))
                for k in range(-1, len(_KINDS)):
                    own = word[kind == k]
                    distinct, first, n = np.unique(own, return_index=True, return_counts=True)
                    held.append((distinct, stem[kind == k][first], np.full(len(distinct), k), n))
                    size += len(distinct)
                if size > 1 << 19:
                    yield rows()
                    size = 0
        if held:
            yield rows()

    each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _COUNTS)
    return each.groupBy("word").agg(F.min("stem").alias("stem"), *(F.sum(c).alias(c) for c in ("total", *_KINDS)))


def _sorted(got: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    key, value = got.column(0).to_numpy().view(np.uint64), got.column(1).to_numpy()
    order = np.argsort(key)
    return key[order], value[order]


def _found(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values of the keys, whether they are in the table)."""
    at = np.minimum(np.searchsorted(table[0], keys), len(table[0]) - 1)
    return table[1][at].astype(np.float64), table[0][at] == keys


class Model:
    """The log-ratios of the two models by word, exactly, and the curve."""

    def __init__(self, counted: DataFrame, halves: tuple[int, ...] = (0, 1)) -> None:
        """counted: stored ``counts``; halves: those whose labels count."""
        of = {c: sum(F.col(f"{c}_{h}") for h in halves) for c in _CLASSES}
        with Tables(counted.sparkSession) as own:
            self._learn(counted.select("word", "stem", "total", *(x.alias(c) for c, x in of.items())), own)

    def _learn(self, kept: DataFrame, own: Tables) -> None:
        by_stem = kept.groupBy("stem").agg(F.sum("total").alias("stem_total"), *(F.count_if(F.col(c) > 0).alias(f"stem_{c}") for c in _CLASSES))
        stems = own.stored(by_stem.where("stem_toxic + stem_ordinary > 0"), "stem-counts")
        n = kept.agg(F.sum("total").alias("total"), *(F.sum(c).alias(c) for c in _CLASSES), *(F.count_if(F.col(c) > 0).alias(f"{c}_words") for c in _CLASSES)).first()
        u = stems.agg(*(F.count_if(F.col(f"stem_{c}") > 0).alias(c) for c in _CLASSES)).first()
        self.known = bool(n["toxic"] and n["ordinary"])
        self.curve = np.array([-9.0, 0, 0, 0])
        if not self.known:
            return
        # Without the factor that a word or stem has in both models: what words and stems get that no label knows.
        rest = {c: (DISCOUNT * n[f"{c}_words"] / n[c], DISCOUNT * u[c] / n[f"{c}_words"]) for c in _CLASSES}
        self.other = float(np.log(np.prod(rest["toxic"]) / np.prod(rest["ordinary"])))
        low = {c: rest[c][0] * (F.greatest(F.col(f"stem_{c}") - DISCOUNT, F.lit(0.0)) / n[f"{c}_words"] + rest[c][1] * F.col("stem_total") / n["total"]) for c in _CLASSES}
        high = {c: F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) / n[c] + low[c] * F.col("total") / F.col("stem_total") for c in _CLASSES}
        ratio = lambda p: (F.log(p["toxic"]) - F.log(p["ordinary"])).cast("float").alias("ratio")
        self.stems = _sorted(stems.select("stem", ratio(low)).toArrow())
        self.words = _sorted(kept.where("toxic + ordinary > 0").join(stems, "stem").select("word", ratio(high)).toArrow())

    def ratios(self, word: np.ndarray, stem: np.ndarray) -> np.ndarray:
        """log P_toxic - log P_ordinary of each word."""
        distinct, first, which = np.unique(word, return_index=True, return_inverse=True)
        out, there = _found(self.words, distinct)
        by_stem, held = _found(self.stems, stem[first])
        return np.where(there, out, np.where(held, by_stem, self.other))[which]

    def evidence(self, column: pa.Array) -> np.ndarray:
        """(texts, 3): the difference of the mean log-likelihoods of a text's words; of the ratios beyond the margin the
        mean, and the sum over the root of the length."""
        word, stem, at = expressions(column)
        ratio, n = self.ratios(word, stem), np.maximum(np.diff(at), 1)
        beyond = K.runs(np.maximum(ratio - MARGIN, 0), at)
        return np.stack((K.runs(ratio, at) / n, beyond / n * 10, beyond / np.sqrt(n)), axis=1)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.curve[0] + evidence @ self.curve[1:], -40, 40)))

    def fit(self, told: DataFrame) -> None:
        """The curve from evidence (x, y, z, toxic), by Newton's method with a slight pull to 0; without evidence of both
        classes, the mean difference as it is, with the odds of the labels."""
        n, toxic = told.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
        if not 0 < toxic < n:
            self.curve = np.array([np.log(self.odds), 1.0, 0, 0])
            return
        terms = [1, 2, 3]
        while True:
            w = self._newton(told, terms)
            if w.min() >= 0:
                break
            terms.remove(1 + int(w.argmin()))
        self.curve = np.concatenate(([self.start], w))

    def _newton(self, told: DataFrame, terms: list[int]) -> np.ndarray:
        """Weights of the evidence, 0 of that which isn't among terms; start gets the constant."""
        on = [0, *terms]
        x = [F.lit(1.0), F.col("x"), F.col("y"), F.col("z")]
        pull = np.array([1e-6, 1e-2, 1e-2, 1e-2])[on]
        w = np.zeros(len(on))
        for _ in range(40):
            level = sum(F.lit(float(v)) * x[k] for v, k in zip(w, on, strict=True))
            p = 1 / (1 + F.exp(-F.greatest(F.least(level, F.lit(40.0)), F.lit(-40.0))))
            row = told.select("*", p.alias("p")).agg(
                *(F.sum((F.col("toxic") - F.col("p")) * x[i]).alias(f"g{i}") for i in on),
                *(F.sum(F.col("p") * (1 - F.col("p")) * x[i] * x[j]).alias(f"h{i}_{j}") for i in on for j in on if i <= j),
            ).first()
            slope = np.array([row[f"g{i}"] for i in on])
            bend = np.array([[row[f"h{min(i, j)}_{max(i, j)}"] for j in on] for i in on])
            step = np.linalg.solve(bend + np.diag(pull) + 1e-9 * np.eye(len(on)), slope - pull * w)
            w += step
            if np.abs(step).max() < 1e-5:
                break
        self.start = w[0]
        return np.array([w[on.index(k)] if k in on else 0.0 for k in (1, 2, 3)])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The models of docs (doc_id, text) by labels (doc_id, toxic)."""
    known = labelled(labels)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Tables(docs.sparkSession) as own:
        kept = own.stored(counts(keyed, known), "word-counts")
        told = [own.stored(told_by(keyed, known, half, Model(kept, (1 - half,))), f"evidence-{half}") for half in (0, 1)]
        model = Model(kept)
        if model.known:
            model.odds = max(int((known.kind % 2 == 1).sum()), 1) / max(int((known.kind % 2 == 0).sum()), 1)
            model.fit(told[0].unionByName(told[1]))
    return model


def told_by(docs: DataFrame, labels: Labels, half: int, model: Model) -> DataFrame:
    """(x, y, z, toxic): the evidence of the labelled documents of a half by a model of the other half's labels; none if
    that knows only one class."""
    if not model.known:
        return docs.sparkSession.createDataFrame([], "x double, y double, z double, toxic int")
    chosen = docs.sparkSession.sparkContext.broadcast((labels, model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels, model = chosen.value
        for batch in batches:
            kind = labels.of(batch.column("doc_id"))
            own = batch.filter(pa.array((kind >= 0) & (kind // 2 == half)))
            for part in slices(own, "text"):
                x = model.evidence(part.column("text"))
                yield pa.RecordBatch.from_arrays([*map(pa.array, x.T.copy()), pa.array((labels.of(part.column("doc_id")) % 2).astype(np.int32))], ["x", "y", "z", "toxic"])

    return docs.mapInArrow(run, "x double, y double, z double, toxic int")


def rate(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """docs' columns, or those in keep, with score and predicted added; columns of these names are replaced."""
    rest = [c for c in keep or docs.columns if c not in ("score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Plain names on the way: Arrow functions look columns up by name and take a dot for a field.
    plain = {c: "text" if c == "text" else f"c{k}" for k, c in enumerate(dict.fromkeys([*rest, "text"]))}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                own = shared.value
                score = own.score(own.evidence(part.column("text"))) if own.known else np.zeros(part.num_rows)
                yield pa.RecordBatch.from_arrays([*(part.column(plain[c]) for c in rest), pa.array(score)], [*(plain[c] for c in rest), "score"])

    own = docs.select(*(quoted(c).alias(n) for c, n in plain.items()))
    scored = own.mapInArrow(run, own.select(*(plain[c] for c in rest)).schema.add("score", "double")).toDF(*rest, "score")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out()).select("doc_id", "toxic")
    return rate(docs.withColumn("held_out", held_out()), train(docs, labels), keep=["doc_id", "held_out"])

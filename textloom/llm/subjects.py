"""Problem 9: subject areas of each document.

Method: classifier chains. The terms of the documents (stems of their words) get
weights for the subjects; a sentence's terms are evidence for the subjects. The
shares of sentences that speak most for a subject are the term features of a
document; its source and its structure (number and length of sentences, share
without a subject) are added. A chain of logistic regressions predicts the
subjects one after the other, the most frequent first, each also from those before
it, so that subjects that come together are modelled; every link is calibrated by
cross-fitting on all labelled documents that are fitted, and all evidence has the
same penalty. Beam search decodes the label combination with the greatest joint
probability; the beam also gives the probability of every subject.

By definition a subject needs a fifth of the sentences. They are counted by what the
chain says: a sentence is about the subject for which its own evidence and the
document's log odds from the beam together are greatest, if they are above zero;
so ambiguous sentences follow their document, and stray ones don't count. A subject
of the decoded combination that has a fifth of the sentences in this count is a row.

Few documents are labelled, so the terms are counted in rounds: those of the labelled
documents first, then, ``ROUNDS`` times, also those of all other documents
that the weights so far place without doubt (``SURE`` of their sentences), if most of
what they say is in words that labelled documents have (else a chance term could
draw in another language whole).

Texts are cut into sentences and stems once, in the JVM, and kept as numbers in a
table that all later steps read.

Bounds of the fit: the ``fit_documents`` labelled documents with the least hash of
their id (all, where there are fewer). Every document is counted and classified, whole.

Defined results: null and blank texts, texts in which no sentence is about a
subject, and English texts (none of their terms has weight) have no row; a missing
or unknown source is simply no evidence; repeated rows give each pair once; with
no labels at all the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.terms import plain
from textloom.session import cut

FIT_DOCUMENTS = 6000
SURE = 0.6
ROUNDS = 3
STEM = 5
LEAST_SEEN = 3
#: A term speaks for a subject if its share among the subjects is above this.
LEAST_SHARE = 0.5
#: The share of sentences that a subject needs.
FULL = 0.2
BEAM = 8
#: The penalty of every weight but the constant's, and the most that the chain's log odds can tell a sentence.
RIDGE = 1.0
MOST_ODDS = 3.0
#: Parts of the labelled documents for the calibration, and the penalty of moving away from none.
FOLDS = 5
SHRINK = 2.0
#: The least share of its stems that a document without a label has in common with the labelled ones, if it is to be counted.
LEAST_KNOWN = 0.3
STEMS = rf"(?<![\p{{L}}\p{{N}}])\p{{L}}[\p{{L}}\p{{N}}]{{2,{STEM - 1}}}"
SENTENCE = r"[.!?…]+\s+|\n+|\s:\)\s*"


def stem_table(docs: DataFrame) -> DataFrame:
    """(doc_id, source, stems) of the documents with a text: for every sentence of at least two stems their numbers."""
    of = lambda s: F.transform(F.array_distinct(F.regexp_extract_all(s, F.lit(STEMS), F.lit(0))), lambda w: F.hash(w))
    stems = F.filter(F.transform(F.split(plain(F.col("text")), SENTENCE), of), lambda s: F.size(s) >= 2)
    return docs.where("text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", stems.alias("stems"))


@dataclass
class Texts:
    """A batch of documents: all stems in a row, the sentence of each, the document of each sentence."""

    stems: np.ndarray
    sentence: np.ndarray
    document: np.ndarray
    n: int

    @classmethod
    def of(cls, column: pa.Array) -> Texts:
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        inner = column.flatten()
        per_doc = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        per_sentence = inner.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        return cls(inner.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(per_sentence)), per_sentence), np.repeat(np.arange(len(per_doc)), per_doc), len(per_doc))


@dataclass
class Model:
    subjects: list[str]
    sources: list[str]
    order: list[int]
    #: Sorted stems that speak for a subject, that subject, and the logarithm of the odds.
    terms: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    speaks_for: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    odds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: Sorted stems of the labelled documents.
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    links: list[np.ndarray] = field(default_factory=list)
    calibration: list[tuple[float, float]] = field(default_factory=list)

    def evidence(self, t: Texts) -> np.ndarray:
        """(sentences, subjects): the sum of the log odds of a sentence's terms."""
        k = len(self.subjects)
        out = np.zeros(len(t.document) * k)
        if len(self.terms):
            place = np.minimum(np.searchsorted(self.terms, t.stems), len(self.terms) - 1)
            hit = np.flatnonzero(self.terms[place] == t.stems)
            place = place[hit]
            out = np.bincount(t.sentence[hit] * k + self.speaks_for[place], self.odds[place], len(out))
        return out.reshape(-1, k)

    def shares(self, t: Texts, score: np.ndarray) -> np.ndarray:
        """(documents, subjects): the share of sentences whose score is greatest for a subject and above zero; ties are shared."""
        top = score.max(1, initial=0.0)
        best = (score >= top[:, None] - 1e-9) & (top > 0)[:, None]
        vote = best / np.maximum(best.sum(1), 1)[:, None]
        out = np.zeros((t.n, score.shape[1]))
        np.add.at(out, t.document, vote)
        return out / np.maximum(np.bincount(t.document, minlength=t.n), 1)[:, None]

    def features(self, t: Texts, source: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(evidence, shares, features): how far each share is towards FULL, and what source and structure tell."""
        evidence = self.evidence(t)
        share = self.shares(t, evidence)
        n = np.bincount(t.document, minlength=t.n)
        words = np.bincount(t.document[t.sentence], minlength=t.n)
        origin = np.array([[float(x == s) for s in self.sources] for x in source]).reshape(t.n, len(self.sources))
        reached = np.clip((share - FULL / 2) / (FULL / 2), 0.0, 1.0)
        votes = np.log1p(share * n[:, None]) / 2
        structure = np.stack([1 - np.minimum(1.0, share.sum(1)), np.log1p(n) / 5, words / np.maximum(n, 1) / 20], 1)
        return evidence, share, np.hstack([reached, votes, structure, origin, np.ones((t.n, 1))])

    def inputs(self, x: np.ndarray, j: int) -> np.ndarray:
        """The features for one subject: its own share and number of sentences, the most that another has, structure and source."""
        k = len(self.subjects)
        others = np.delete(x[:, :k], j, 1).max(1, initial=0.0)
        return np.column_stack([4 * x[:, j], x[:, k + j], others, x[:, 2 * k :]])

    def beam(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores, answers) of the best label combinations of every row: (n, BEAM) and (n, BEAM, subjects)."""
        n = len(x)
        score, paths = np.zeros((n, 1)), np.zeros((n, 1, len(self.order)))
        for link, w in enumerate(self.links):
            a, b = self.calibration[link]
            own = self.inputs(x, self.order[link])
            f = own.shape[1]
            z = np.clip(a * ((own @ w[:f])[:, None] + paths[:, :, :link] @ w[f:]) + b, -30, 30)
            score = np.concatenate([score - np.log1p(np.exp(-z)), score - np.log1p(np.exp(z))], 1)
            paths = np.concatenate([paths, paths], 1)
            paths[:, : z.shape[1], link] = 1.0
            best = np.argsort(-score, axis=1, kind="stable")[:, :BEAM]
            score, paths = np.take_along_axis(score, best, 1), np.take_along_axis(paths, best[:, :, None], 1)
        out = np.zeros(paths.shape)
        out[:, :, self.order] = paths
        return score, out

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(answers, log odds): the best combination, and for every subject its log odds over the beam."""
        score, answers = self.beam(x)
        p = np.exp(score - score.max(1, keepdims=True))
        p = (answers * (p / p.sum(1, keepdims=True))[:, :, None]).sum(1)
        p = np.clip(p, 1e-9, 1 - 1e-9)
        return answers[:, 0] > 0, np.clip(np.log(p / (1 - p)), -MOST_ODDS, MOST_ODDS)

    def classify(self, t: Texts, source: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(which subjects, shares by what the chain says of every sentence)."""
        evidence, _, x = self.features(t, source)
        yes, odds = self.decode(x)
        share = self.shares(t, np.where(evidence > 0, evidence + odds[t.document], 0.0))
        return yes & (share >= FULL - 1e-9), share


def logistic(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, steps: int = 25, offset: np.ndarray | float = 0.0) -> np.ndarray:
    """Weights of a logistic regression with a ridge penalty for each, by Newton's method; ``offset`` is added to every score."""
    w = np.zeros(x.shape[1])
    penalty = np.asarray(ridge, float)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrated(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, fold: np.ndarray) -> tuple[float, float]:
    """(a, b) of the calibration by cross-fitting: every row is scored by a fit without its fold."""
    z = np.zeros(len(x))
    for f in np.unique(fold):
        z[fold == f] = x[fold == f] @ logistic(x[fold != f], y[fold != f], ridge)
    if not 0 < y.sum() < len(y):
        return 1.0, 0.0
    # Shrunk towards no change (a = 1, b = 0), the more the fewer documents there are.
    step = logistic(np.stack([z, np.ones(len(z))], 1), y, np.full(2, SHRINK), offset=z)
    return max(1.0 + float(step[0]), 0.2), float(step[1])


def set_terms(model: Model, counts: DataFrame, size: dict[str, float]) -> None:
    """Gives the model the stems that speak for one subject, out of (stem, subject, n); only these come to the driver."""
    total = [size[s] for s in model.subjects]
    n = counts.where("stem is not null").groupBy("stem").agg(*(F.round(F.sum(F.when(F.col("subject") == s, F.col("n")).otherwise(F.lit(0.0))), 6).alias(f"n{j}") for j, s in enumerate(model.subjects)))
    every = lambda c: sum((F.col(f"{c}{j}") for j in range(1, len(total))), F.col(f"{c}0"))
    q = n.where(every("n") >= LEAST_SEEN).select("stem", *(((F.col(f"n{j}") + 0.1) / F.lit(t + 1.0)).alias(f"q{j}") for j, t in enumerate(total)))
    q = q.withColumn("all", every("q"))
    best = F.greatest(*(F.struct((F.col(f"q{j}") / F.col("all")).alias("q"), F.lit(-j).alias("j")) for j in range(len(total)))) if len(total) > 1 else F.struct((F.col("q0") / F.col("all")).alias("q"), F.lit(0).alias("j"))
    rows = q.select("stem", best.alias("b")).where(F.col("b.q") > LEAST_SHARE).select("stem", "b.q", "b.j").toArrow()
    stems = rows.column("stem").to_numpy()
    order = np.argsort(stems)
    p = rows.column("q").to_numpy()[order]
    model.terms, model.speaks_for = stems[order], -rows.column("j").to_numpy()[order].astype(np.int64)
    model.odds = np.log(p / np.maximum(1 - p, 1e-12) * len(total))


def sure_counts(others: DataFrame, model: Model) -> DataFrame:
    """(stem, subject, n) of documents that the model places without doubt; stem null for their number."""
    sent = others.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        k = len(m.subjects)
        documents, parts = np.zeros(k, np.int64), []
        for b in batches:
            t = Texts.of(b.column("stems"))
            share = m.shares(t, m.evidence(t))
            sure = (np.bincount(t.document, minlength=t.n) >= 3) & (share.max(1, initial=0.0) >= SURE)
            place = np.minimum(np.searchsorted(m.known, t.stems), max(len(m.known) - 1, 0))
            doc = t.document[t.sentence]
            common = np.bincount(doc, m.known[place] == t.stems if len(m.known) else None, t.n)
            sure &= common >= LEAST_KNOWN * np.bincount(doc, minlength=t.n)
            of = share.argmax(1)
            documents += np.bincount(of[sure], minlength=k)
            used = sure[doc]
            # Every stem once a document, then by stem and subject.
            pairs = np.unique((doc[used].astype(np.int64) << 32) | t.stems[used].view(np.uint32).astype(np.int64))
            parts.append(np.unique(((pairs & 0xFFFFFFFF) << 8) | of[pairs >> 32], return_counts=True))
            if len(parts) >= 32:
                parts = [merged(parts)]
        keys, n = merged(parts)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.append((keys >> 8).astype(np.uint32).view(np.int32), np.zeros(k, np.int32)), pa.int32(), mask=np.append(np.zeros(len(keys), bool), np.ones(k, bool))),
            pa.array([m.subjects[j] for j in (*(keys & 0xFF), *range(k))], pa.string()), pa.array(np.append(n, documents).astype(float)),
        ], names=["stem", "subject", "n"])

    return others.select("stems").mapInArrow(count, "stem int, subject string, n double")


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and their counts added up."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), len(keys)).astype(np.int64)


def fit(texts: DataFrame, labels: DataFrame, subjects: list[str], fit_documents: int = FIT_DOCUMENTS) -> Model | None:
    """The model of the labelled documents of a stem table; null when none has a text."""
    spark = texts.sparkSession
    hand = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "subject").where(F.col("doc_id").isNotNull() & F.col("subject").isin(subjects)).distinct()
    hand = hand.groupBy("doc_id").agg(F.sort_array(F.collect_list("subject")).alias("subjects"))
    chosen = cut(hand.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_documents), "chosen")
    fitted = cut(texts.join(F.broadcast(chosen), "doc_id"), "fitted")  # at most fit_documents rows in the broadcast
    others = texts.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_anti")
    size: dict[str, float] = dict.fromkeys(subjects, 0.0)
    for r in chosen.select("subjects").collect():
        for s in r.subjects:
            size[s] += 1 / len(r.subjects)
    counts = fitted.select(F.explode(F.array_distinct(F.flatten("stems"))).alias("stem"), "subjects").select("stem", F.explode("subjects").alias("subject"), (1 / F.size("subjects")).alias("n"))
    counts = cut(counts.groupBy("stem", "subject").agg(F.sum("n").alias("n")), "labelled-counts")
    order = sorted(range(len(subjects)), key=lambda j: (-size[subjects[j]], subjects[j]))
    sources = [r[0] for r in fitted.groupBy("source").count().where("source is not null").orderBy(F.desc("count"), "source").limit(32).select("source").collect()]
    model = Model(subjects, sources, order)
    # As many stems as the fitted documents have.
    model.known = np.sort(counts.select("stem").distinct().toArrow().column("stem").to_numpy())
    set_terms(model, counts, size)
    for _ in range(ROUNDS):
        more = cut(sure_counts(others, model).groupBy("stem", "subject").agg(F.sum("n").alias("n")), "counts")
        grown = {r.subject: r.n for r in more.where("stem is null").collect()}
        set_terms(model, counts.unionByName(more.where("stem is not null")), {s: size[s] + grown.get(s, 0.0) for s in subjects})
    sent = spark.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, _, x = sent.value.features(Texts.of(b.column("stems")), b.column("source").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(list(x), pa.list_(pa.float64())), b.column("subjects")], names=["doc_id", "x", "subjects"])

    rows = fitted.select("doc_id", "stems", "source", "subjects").mapInArrow(features, "doc_id bigint, x array<double>, subjects array<string>").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.doc_id, r.x))
    x = np.array([r.x for r in rows])
    y = np.array([[float(s in r.subjects) for s in subjects] for r in rows])[:, order]
    fold = np.arange(len(rows)) % FOLDS
    for k in range(len(order)):
        own = model.inputs(x, order[k])
        full = np.hstack([own, y[:, :k]])
        ridge = np.full(full.shape[1], RIDGE)
        ridge[own.shape[1] - 1] = 0.01  # the constant
        model.links.append(logistic(full, y[:, k], ridge))
        model.calibration.append(calibrated(full, y[:, k], ridge, fold))
    return model


def classify(docs: DataFrame, labels: DataFrame, subjects: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> DataFrame:
    """(doc_id, subject, share) of every subject of every document."""
    spark = docs.sparkSession
    schema = "doc_id bigint, subject string, share double"
    names = sorted(r.subject for r in subjects.select("subject").where("subject is not null").distinct().collect())
    texts = cut(stem_table(docs), "stems") if names else None
    model = fit(texts, labels, names, fit_documents) if names else None
    if model is None:
        return spark.createDataFrame([], schema)
    sent = spark.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            yes, share = m.classify(Texts.of(b.column("stems")), b.column("source").to_pylist())
            row, j = np.nonzero(yes)
            ids = b.column("doc_id").take(pa.array(row))
            yield pa.RecordBatch.from_arrays([ids, pa.array([m.subjects[k] for k in j], pa.string()), pa.array(np.round(share[row, j], 6), pa.float64())], names=["doc_id", "subject", "share"])

    found = texts.where("doc_id is not null").select("doc_id", "source", "stems").mapInArrow(of, schema)
    return found.groupBy("doc_id", "subject").agg(F.max("share").alias("share"))


def found(docs: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    return classify(docs, labels, subjects).select("doc_id", "subject")


def composition(docs: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """(source, subject, documents, chars) of the corpus; documents without a subject count under null."""
    of = classify(docs, labels, subjects)
    size = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", F.length("text").cast("bigint").alias("chars")).dropDuplicates(["doc_id"])
    return size.join(of, "doc_id", "left").groupBy("source", "subject").agg(F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("chars"))

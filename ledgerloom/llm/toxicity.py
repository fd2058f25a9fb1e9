"""Toxicity scores from non-negative positive-unlabelled learning.

Only confirmed toxic documents are used as examples; everything else is unlabelled text that holds toxic documents at the
class prior. With the logistic loss l, examples P, unlabelled U and prior p the risk of a score g is
p E_P l(g) + max(0, E_U l(-g) - p E_P l(-g)): the second part estimates the loss on clean text, and where it would turn
negative (the model has learned the unlabelled toxic documents by heart) the step goes the other way. Its minimiser is the
probability of being toxic, so the scores are probabilities without a second fit.

A document is the set of its words and word beginnings (ASCII letters folded, punctuation cut off) hashed to `1 << BITS`
features. Only features clearly more frequent in examples than in unlabelled text (a z score) enter a model, so that rare
words are not learned by heart. The classifiers are linear, trained in numpy from bounded samples: at most `positives` examples and
`unlabelled` documents, those whose hashed ids are smallest, each as its feature ids. The sample bound is a parameter and the same
at every size; one task gathers the sample and fits the models, and the driver receives their weights alone. Scoring reads every
whole text. `classifiers` models see different parts of the unlabelled sample and their probabilities are averaged.

Labels, language, source and id are no input of a score. Defined cases: null and empty texts get the score of a text
without words; repeated rows are scored alike; a document with several label rows is an example if one says so; rows
without an id are scored but never used for training; without any example every score is 0; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.order_minhash import chunks
from ledgerloom.llm.words import Words

BITS = 20
LIMIT = 0.3  # from this score on a document counts as toxic
BEGINNINGS = (4, 6)  # bytes of a word's beginning that are features of their own
_OTHER = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature ids of each text, end to end, and where each text begins."""
    words = Words(texts, _OTHER, _FOLD)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(words.first))
    begins = [words.beginnings(n) for n in BEGINNINGS]
    owner = np.concatenate([owner, *[owner[at] for at, _ in begins]])
    hashes = np.concatenate([words.hashes, *[h for _, h in begins]])
    pairs = np.unique((owner << BITS) | (hashes >> np.uint64(64 - BITS)).astype(np.int64))
    return (pairs & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(pairs, np.arange(len(texts) + 1) << BITS)


def sums(weights: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the weights of each text."""
    total = np.concatenate([[0.0], np.cumsum(weights[ids], dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


@dataclass
class Model:
    """Averaged linear classifiers over the features in `known` (sorted): weights (classifiers x features) and biases."""

    known: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def score(self, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not len(self.bias):
            return np.zeros(len(first) - 1)
        used = np.flatnonzero(np.isin(ids, self.known))
        column, begins = np.searchsorted(self.known, ids[used]), np.searchsorted(used, first)
        each = [1 / (1 + np.exp(-np.clip(b + sums(w, column, begins), -30, 30))) for w, b in zip(self.weights, self.bias)]
        return np.mean(each, axis=0)


def fit(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, classifiers: int = 3, steps: int = 150,
    rate: float = 0.05, decay: float = 0.01, least: float = 4.0, seed: int = 11,
) -> Model:
    """Full-batch Adam on the non-negative risk. Features whose z score of examples over unlabelled is below `least` get no weight."""
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0))
    rng, out, biases = np.random.default_rng(seed), [], []
    parts = np.array_split(rng.permutation(len(unlabelled)), min(classifiers, len(unlabelled)))
    for part in parts:
        docs = positive + [unlabelled[i] for i in part]
        n_p, n_u = len(positive), len(part)
        flat = np.concatenate(docs)
        split = sum(map(len, positive))
        in_p, in_u = (np.bincount(x, minlength=1 << BITS) for x in (flat[:split], flat[split:]))
        mean = (in_p + in_u + 1) / (n_p + n_u + 2)
        known = np.flatnonzero((in_p / n_p - in_u / n_u) >= least * np.sqrt(mean * (1 - mean) * (1 / n_p + 1 / n_u)))
        place = np.full(1 << BITS, -1)
        place[known] = np.arange(len(known))
        used = place[flat] >= 0
        column = place[flat[used]]
        owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])[used]
        first = np.searchsorted(owner, np.arange(len(docs) + 1))
        is_p = np.arange(len(docs)) < len(positive)
        size = len(known)
        w, b = np.zeros(size), float(np.log(prior / (1 - prior)))
        m, v = np.zeros(size + 1), np.zeros(size + 1)
        for t in range(1, steps + 1):
            g = b + sums(w, column, first)
            p = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            loss = np.logaddexp(0, g)  # of calling a document clean
            clean = loss[~is_p].mean() - prior * loss[is_p].mean()
            slope = np.where(is_p, -prior * p / n_p, p / n_u)  # of the second part
            if clean < 0:
                slope = -slope
            else:
                slope = slope + np.where(is_p, prior * (p - 1) / n_p, 0.0)
            grad = np.bincount(column, slope[owner], minlength=size) + decay * w / len(docs)
            grad = np.append(grad, slope.sum())
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            w, b = w - step[:-1], b - step[-1]
        out.append((known, w))
        biases.append(b)
    every = np.unique(np.concatenate([k for k, _ in out]))
    weights = np.zeros((len(out), len(every)))
    for row, (known, w) in zip(weights, out):
        row[np.searchsorted(every, known)] = w
    return Model(every, weights, np.array(biases))


def sampled(docs: DataFrame, ids: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(example, h, f): kind of a sampled document, hash of its id and its feature ids, for a bounded table (id, example)."""

    def extract(batches):
        for batch in batches:
            for low, high in chunks(batch.column("text")):
                found, first = features(batch.column("text").slice(low, high - low))
                lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(found))
                kept = [batch.column(c).slice(low, high - low) for c in ("example", "h")]
                yield pa.RecordBatch.from_arrays([*kept, lists], names=["example", "h", "f"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(ids), "id").select("example", F.xxhash64("id").alias("h"), "text")
    return rows.mapInArrow(extract, "example boolean, h bigint, f array<int>")


def fitted(sample: DataFrame, prior: float, **options) -> Model:
    """`fit` on a sample, in one task: only the model comes back."""

    def learn(batches):
        held: dict[bool, list[np.ndarray]] = {True: [], False: []}
        for batch in batches:
            flat, first = batch.column("f").flatten().to_numpy(), batch.column("f").offsets.to_numpy()
            first = first - first[0] if len(first) else first
            for i, example in enumerate(batch.column("example").to_pylist()):
                held[example].append(flat[first[i] : first[i + 1]])
        model = fit(held[True], held[False], prior, **options)
        cells = [pa.array([x.tobytes()], pa.binary()) for x in (model.known.astype(np.int64), model.weights, model.bias)]
        yield pa.RecordBatch.from_arrays(cells, names=["known", "weights", "bias"])

    order = sample.repartition(1).sortWithinPartitions("example", "h", "f")  # the same order on every run
    row = order.mapInArrow(learn, "known binary, weights binary, bias binary").first()
    if row is None:
        return fit([], [], prior)
    known, weights, bias = (np.frombuffer(row[c], t) for c, t in (("known", np.int64), ("weights", np.float64), ("bias", np.float64)))
    return Model(known, weights.reshape(len(bias), len(known)), bias)


def held_out(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    positives: int = 8_000, unlabelled: int = 18_000, prior: float | None = None, **options,
) -> Model:
    """Fit on the documents that are not held out. `prior`: share of toxic documents, by default that of the labelled ones."""
    ident = F.col(f"`{id_col}`").alias("id")
    seen = labels.filter(~held_out(id_col)).groupBy(ident).agg(F.max(F.col(f"`{label_col}`").cast("int")).alias("toxic"))
    if prior is None:
        prior = seen.filter("id is not null").agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"] or 0.0
    first = F.xxhash64("id")
    examples = seen.filter("toxic = 1 and id is not null").orderBy(first).limit(positives).select("id")
    others = docs.filter(~held_out(id_col)).select(ident).filter("id is not null").distinct().orderBy(first).limit(unlabelled)
    ids = examples.withColumn("example", F.lit(True)).unionByName(others.withColumn("example", F.lit(False)))
    return fitted(sampled(docs, ids, text_col, id_col), prior, **options)


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """`docs` with a score column after its own columns."""

    def rate(batches):
        for batch in batches:
            texts, out = batch.column(batch.num_columns - 1), []
            for low, high in chunks(texts):
                out.append(model.score(*features(texts.slice(low, high - low))))
            columns = batch.columns[:-1] + [pa.array(np.concatenate(out) if out else np.zeros(0))]
            yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("scored", F.coalesce(F.col(f"c{names.index(text_col)}"), F.lit("")))
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    return rows.mapInArrow(rate, f"{fields}, c{len(names)} double").toDF(*names, name)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """The rows of `docs` whose score stays below `limit`."""
    names = docs.columns
    scored = score(docs, model, text_col, "scored").toDF(*[f"c{i}" for i in range(len(names))], "scored")
    return scored.filter(F.col("scored") < limit).drop("scored").toDF(*names)

"""Quality classifier: random Fourier features over document statistics, ridge scores, isotonic calibration.

A ridge regression on D cosines with random frequencies approximates one with a Gaussian kernel over
the statistics. Its normal equations are sums over documents, so each partition adds up its own and
the sums are added up; what reaches the driver is D x D numbers however many labels there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridagro.llm.common import read, row_key, stored
from gridagro.llm.text import Words, joined, slices

#: Cosines, the width of the kernel in standard deviations of the statistics, and the ridge penalty per label.
COSINES, WIDTH, PENALTY = 192, 4.0, 1e-4
#: Steps between scores of 0 and 1 that the calibration tells apart.
STEPS = 500
#: A document is predicted to be good from this score on.
LEAST = 0.3

STATISTICS = (
    "log words", "log bytes", "word length", "symbols", "capitals", "digits", "beyond ASCII", "distinct words", "distinct pairs",
    "commonest word", "lines per word", "words at line end", "words ending in a symbol", "doubled words", "white space", "sentence marks",
)

_CLASS = np.zeros((256, 7))
_CLASS[[*b"#$%&*|!<>@^~=_+\\/{}[]"], 0] = 1  # symbols
_CLASS[65:91, 1] = 1  # capitals
_CLASS[97:123, 2] = 1  # small letters
_CLASS[48:58, 3] = 1  # digits
_CLASS[128:, 4] = 1
_CLASS[[*b" \t\n\v\f\r"], 5] = 1
_CLASS[[*b".,;:?"], 6] = 1
_SYMBOL = _CLASS[:, 0] > 0


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text, from the whole text; zeros for an empty or null one."""
    words = Words(texts, places=True)
    out = np.zeros((words.size, len(STATISTICS)))
    for i in range(words.size):
        a, b = int(words.offsets[i]), int(words.offsets[i + 1])
        if a == b:
            continue
        counts = np.bincount(words.data[a:b], minlength=256)
        symbols, capitals, small, digits, beyond, white, marks = counts @ _CLASS
        size = b - a
        h = words.hashes[words.bounds[i] : words.bounds[i + 1]]
        n = len(h)
        if n == 0:
            out[i, [1, 14]] = np.log1p(size), 1
            continue
        _, times = np.unique(h, return_counts=True)
        pairs = len(np.unique(joined(h[:-1], h[1:]))) / (n - 1) if n > 1 else 1.0
        last = words.data[words.ends[words.bounds[i] : words.bounds[i + 1]] - 1]
        out[i] = (
            np.log1p(n), np.log1p(size), (size - white) / n / 10, symbols / size, capitals / max(1.0, capitals + small), digits / size, beyond / size,
            len(times) / n, pairs, times.max() / n, min(1.0, counts[10] / n), min(1.0, n / (counts[10] + 1) / 100), _SYMBOL[last].mean(),
            (h[1:] == h[:-1]).mean() if n > 1 else 0.0, white / size, marks / size,
        )
    return out


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, key, stats) of every document, written once."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 2)):
            stats = statistics(batch.column(2))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(list(stats), pa.list_(pa.float64()))], ["doc_id", "key", "stats"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), row_key(docs).alias("key"), docs["text"])
    return stored(rows.mapInArrow(measure, "doc_id long, key long, stats array<double>"), "statistics")


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    #: Raw scores and the calibrated ones, to be interpolated.
    raw: np.ndarray
    calibrated: np.ndarray

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        x = (stats - self.mean) / self.spread
        z = np.cos(x @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def ridge(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.ridge(stats), self.raw, self.calibrated)


def isotonic(bins: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over sorted bins: centre and mean of each pool."""
    pools: list[list[float]] = []
    for x, s, n in zip(bins, sums, counts, strict=True):
        pools.append([x * n, s, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
    x, s, n = np.array(pools).T
    return x / n, s / n


def training_label(doc_id: Column) -> Column:
    """Rows to learn from: the CRC-32 of the doc_id as text is not divisible by 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0


def fit(stats: DataFrame, labels: DataFrame, seed: int = 7) -> Model | None:
    """A model from (doc_id, quality) rows that ``training_label`` admits; None if there are none.

    Labels that are null are left out; a doc_id with several labels counts with their mean.
    """
    known = labels.filter("quality is not null").filter(training_label(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("label"))
    rows = stored(stats.join(known, "doc_id").select("stats", "label"), "labelled")
    d = len(STATISTICS)
    moments = stats.agg(*[f(F.get("stats", i)).alias(f"{k}{i}") for i in range(d) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if moments["m0"] is None or rows.isEmpty():
        return None
    mean = np.array([moments[f"m{i}"] for i in range(d)])
    spread = np.maximum([moments[f"s{i}"] for i in range(d)], 1e-6)
    random = np.random.default_rng(seed)
    none = np.zeros(0)
    model = Model(mean, spread, random.normal(0, 1 / WIDTH, (d, COSINES)), random.uniform(0, 2 * np.pi, COSINES), none, none, none)
    m = COSINES + 1

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((m, m + 2))
        for batch in batches:
            if len(batch):
                z, y = model.cosines(np.stack(batch["stats"].to_numpy())), batch["label"].to_numpy()
                total += np.concatenate([z.T @ z, (z.T @ y)[:, None], np.full((m, 1), len(y) / m)], axis=1)
        yield pd.DataFrame({"sums": [total.tobytes()]})

    def merge(key, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"sums": [sum(np.frombuffer(x) for x in parts["sums"]).tobytes()]})

    # two levels, so that neither a task nor the driver gets the sums of all partitions
    sums = rows.mapInPandas(add_up, "sums binary").withColumn("part", F.spark_partition_id())
    sums = sums.groupBy(F.floor(F.sqrt("part")).alias("some")).applyInPandas(merge, "sums binary")
    total = sum(np.frombuffer(r["sums"]) for r in sums.toLocalIterator()).reshape(m, m + 2)
    n = total[:, -1].sum()
    penalty = np.eye(m) * PENALTY * n
    penalty[-1, -1] = 0
    model.weights = np.linalg.solve(total[:, :m] + penalty, total[:, m])

    def ridge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"raw": model.ridge(np.stack(batch["stats"].to_numpy())), "label": batch["label"]})

    step = F.floor(F.least(F.greatest(F.col("raw"), F.lit(-0.5)), F.lit(1.5)) * STEPS)
    binned = rows.mapInPandas(ridge, "raw double, label double").groupBy(step.alias("step")).agg(F.sum("label").alias("s"), F.count("*").alias("n")).orderBy("step").collect()
    x, s, k = (np.array([r[c] for r in binned], float) for c in ("step", "s", "n"))
    model.raw, model.calibrated = isotonic((x + 0.5) / STEPS, s, k)
    return model


def score(stats: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, key, score); without a model every document scores 0.5."""

    def rate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.stack(batch["stats"].to_numpy()) if len(batch) else np.zeros((0, len(STATISTICS)))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "key": batch["key"], "score": np.round(model.score(x), 6) if model else np.full(len(x), 0.5)})

    return stats.mapInPandas(rate, "doc_id long, key long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, key (see ``row_key``) and score, from 0 to 1, higher for better.

    Only the text is an input of the score; empty and null texts get one too. Documents without a
    label are scored like any other; repeated rows get equal scores.
    """
    stats = document_statistics(docs)
    return score(stats, fit(stats, labels))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents that are predicted to be good, with all their columns. Nothing is shuffled but statistics."""
    model = fit(document_statistics(docs), labels)
    if model is None:
        return docs
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, at)):
            yield batch.filter(pa.array(np.round(model.score(statistics(batch.column(at))), 6) >= least, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    held_out = F.coalesce(~training_label(F.col("doc_id")), F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= LEAST).cast("int").alias("predicted"))

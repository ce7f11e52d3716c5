"""Quality classifier (operator 1): ridge regression on random Fourier features of document statistics.

Statistics of every whole text come from numpy over Arrow batches and are written once. Labelled rows give the mean and
spread of each statistic; cosines of random projections of the standardised statistics approximate a Gaussian kernel;
each partition sums its normal equations, Spark adds the sums row by row, and the driver solves a system of fixed size.
A quarter of the training rows is kept from the fit and calibrates the scores by isotonic regression.

The model sees statistics of the text alone. Results for odd rows: a null or empty text has statistics of zero and is
scored like any other; a null id counts as held out; repeated rows are scored alike; equal scores share a calibration bin;
with no labelled row each score is 0.5; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from niaga.llm import calibration, words
from niaga.llm.common import batch, cut, held_out, slices, text_buffer, texts

FEATURES = 384  # random Fourier features
RIDGE = 1e-3  # per labelled row
STATISTICS = 22


def _classes() -> np.ndarray:
    """0 other control, 1 a-z, 2 A-Z, 3 digit, 4 blank, 5 line end, 6 . , ; : ' ", 7 other ASCII sign, 8 above ASCII."""
    kind = np.zeros(256, np.uint8)
    kind[33:127], kind[128:] = 7, 8
    kind[97:123], kind[65:91], kind[48:58] = 1, 2, 3
    kind[[32, 9]], kind[[10, 13]] = 4, 5
    kind[[ord(c) for c in ".,;:'\""]] = 6
    return kind


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(values: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many distinct values, and how often its most frequent one occurs."""
    if not len(values):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((values, text))
    v, t = values[order], text[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (t[1:] != t[:-1])])
    at = np.flatnonzero(new)
    most = np.zeros(n)
    np.maximum.at(most, t[at], np.diff(np.append(at, len(v))))
    return np.bincount(t[at], minlength=n).astype(float), most


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS numbers for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    text = np.repeat(np.arange(n), np.diff(offsets))
    kinds = np.bincount(text * 9 + _classes()[data], minlength=n * 9).reshape(n, 9).astype(float)
    found = words.split(data, offsets)
    count = np.diff(found.bounds).astype(float)
    of = np.repeat(np.arange(n), np.diff(found.bounds))
    length = (found.last - found.first).astype(float)
    per_text = lambda x: np.bincount(of, weights=x, minlength=n)
    mean = _share(per_text(length), count)
    spread = np.sqrt(np.maximum(_share(per_text(length**2), count) - mean**2, 0))
    hashed = words.hashes(data, found, lower=True)
    same = np.zeros(len(hashed))
    same[1:] = (hashed[1:] == hashed[:-1]) & (of[1:] == of[:-1])
    kinds_of = _classes()
    begins, ends = (kinds_of[data[found.first]], kinds_of[data[found.last - 1]]) if len(hashed) else (np.zeros(0), np.zeros(0))
    unlike, top = _distinct(hashed, of, n)
    where, start = words.run_starts(found.bounds, 3)
    triples = words.runs(hashed, 3)[start] if len(start) else np.zeros(0, np.uint64)
    unlike3, top3 = _distinct(triples, where, n)
    total3 = np.bincount(where, minlength=n).astype(float)
    letters = kinds[:, 1] + kinds[:, 2] + kinds[:, 8]
    return np.column_stack([
        np.log1p(size), np.log1p(count), _share(letters, size), _share(kinds[:, 2], letters), _share(kinds[:, 3], size),
        _share(kinds[:, 5], count), _share(kinds[:, 6], count), _share(kinds[:, 7], size), _share(kinds[:, 8], size),
        _share(kinds[:, 0], size), np.log1p(mean), np.log1p(spread), _share(per_text(same), count),
        _share(unlike, np.maximum(count, 1) ** 0.75), _share(top, count), _share(unlike3, np.maximum(total3, 1)),
        _share(top3, total3), _share(per_text((begins == 7).astype(float)), count), _share(per_text((ends == 7).astype(float)), count),
        _share(per_text((length <= 3).astype(float)), count), _share(per_text((length >= 12).astype(float)), count),
        _share(per_text((ends == 6).astype(float)), count),
    ])


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats array<double>)"""
    schema = pa.schema([("doc_id", pa.int64()), ("stats", pa.list_(pa.float64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = statistics(*text_buffer(part.column("text")))
            yield batch(schema, part.column("doc_id"), list(rows))

    return texts(docs, id_col, text_col).mapInArrow(work, "doc_id long, stats array<double>")


class Model:
    """Random projections, standardisation, ridge weights and calibration."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int = FEATURES):
        random = np.random.default_rng(5)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        width = np.sqrt(len(mean))  # of the kernel: the usual distance of standardised rows
        self.project = random.normal(size=(len(mean), features)) / width
        self.phase = random.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.calibration: tuple = (0.0, 1.0, np.full(calibration.BINS, 0.5))

    def lifted(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.spread, -8, 8)
        cosines = np.cos(z @ self.project + self.phase) * np.sqrt(2 / self.project.shape[1])
        return np.column_stack([cosines, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.lifted(stats) @ self.weights


def _rows(part: pa.RecordBatch) -> np.ndarray:
    return part.column("stats").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _normal_equations(labelled: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, int]:
    """X'X, X'y and the row count: summed in each partition, then by matrix row in Spark."""
    schema = pa.schema([("row", pa.int32()), ("sums", pa.list_(pa.float64()))])
    size = model.project.shape[1] + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for part in batches:
            for at in range(0, part.num_rows, 4096):
                x = model.lifted(_rows(part)[at : at + 4096])
                total += x.T @ np.column_stack([x, part.column("label").to_numpy()[at : at + 4096]])
        if total[-1, -2]:
            yield batch(schema, np.arange(size), list(total))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            sums = part.column("sums").flatten().to_numpy().reshape(part.num_rows, -1)
            at, where = np.unique(part.column("row").to_numpy(), return_inverse=True)
            out = np.zeros((len(at), sums.shape[1]))
            np.add.at(out, where, sums)
            yield batch(schema, at, list(out))

    parts = labelled.mapInArrow(work, "row int, sums array<double>")
    total = np.zeros((size, size + 1))
    for r in parts.repartition(8, "row").mapInArrow(added, "row int, sums array<double>").toLocalIterator():
        total[r.row] += r.sums
    return total[:, :-1], total[:, -1], round(total[-1, -2])


def fit(stats: DataFrame, labels: DataFrame, bound: int = calibration.LABELS) -> Model:
    """A model from the statistics of all documents and (doc_id, label) rows; see ``calibration.training_labels``."""
    labelled = cut(stats.join(labels, "doc_id").withColumn("held", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0))
    columns = [F.col("stats")[i] for i in range(STATISTICS)]
    moments = labelled.agg(*[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns], F.avg("label")).first()
    if moments[-1] is None:
        return Model(np.zeros(STATISTICS), np.ones(STATISTICS))
    model = Model(np.array(moments[:STATISTICS]), np.array(moments[STATISTICS:-1]))
    squares, products, n = _normal_equations(labelled.filter(~F.col("held")), model)
    model.weights = np.linalg.solve(squares + RIDGE * max(n, 1) * np.eye(len(squares)) / len(squares), products)
    checked = labelled.filter("held")
    model.calibration = calibration.fit(raw_scores(checked, model, ("label",)), "raw")
    return model


def raw_scores(stats: DataFrame, model: Model, extra: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, extra columns, raw, score)"""
    kinds = [("doc_id", pa.int64()), *[(c, pa.int64()) for c in extra], ("raw", pa.float64()), ("score", pa.float64())]
    schema = pa.schema(kinds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            raw = model.raw(_rows(part)) if part.num_rows else np.zeros(0)
            others = [part.column(c).cast(pa.int64()) for c in extra]
            yield batch(schema, part.column("doc_id"), *others, raw, calibration.apply(raw, model.calibration))

    fields = "doc_id long, " + "".join(f"{c} long, " for c in extra) + "raw double, score double"
    return stats.select("doc_id", *extra, "stats").mapInArrow(work, fields)


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = calibration.LABELS) -> DataFrame:
    """(doc_id, held_out, raw, score) of every document; score is the calibrated share of good documents."""
    stats = cut(document_statistics(docs))
    model = fit(stats, calibration.training_labels(labels, label, bound))
    return raw_scores(stats, model).select("doc_id", held_out().alias("held_out"), "raw", "score")

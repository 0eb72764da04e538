"""Sums of products of model columns from one pass, by category and fold.

Least squares sees a table only through the sums of products of its columns. One pass collects these for the plain
features (all products of up to two of them, where a model has degree 2), apart for each combination of the categories
and the fold. Everything that training needs follows from that on the driver: category frequencies, hence indexes; means and
spreads, hence scales; the sums of products of any model's scaled and expanded features, as these are linear in the
plain products within a category; and, sums being additive, those of all rows outside a fold.

Its size depends on the number of features and of categories, not on the rows. Tasks send one matrix for each category
and fold they meet.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wayfare import schema as S

#: Index features and the categories that they number.
CATEGORY_OF = {"vendor_idx": "vendor_id", "cluster_idx": "pickup_cluster"}

Key = tuple


def _products(numeric: list[str], keys: list[str], label: str, degree: int):
    """Sums over a task's rows; refers to nothing of this package, so workers need not import it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            plain = [np.asarray(batch[c].cast(pa.float64()).fill_null(float("nan"))) for c in numeric]
            plain = np.column_stack([*plain, np.ones(batch.num_rows)])
            i, j = np.triu_indices(plain.shape[1])
            basis = plain[:, i] * plain[:, j] if degree > 1 else plain
            rows = np.column_stack([basis, np.asarray(batch[label].cast(pa.float64()).fill_null(float("nan")))])
            code, values = np.zeros(batch.num_rows, np.int64), [()]
            for key in keys:
                coded = pc.dictionary_encode(batch[key], null_encoding="encode")
                words = coded.dictionary.to_pylist()
                code = code * len(words) + np.asarray(coded.indices, np.int64)
                values = [(*v, w) for v in values for w in words]
            for c in np.unique(code):
                mine = rows[code == c]
                sums[values[c]] = sums.get(values[c], 0) + mine.T @ mine
        if sums:
            upper = np.triu_indices(len(next(iter(sums.values()))))
            columns = [[k[n] for k in sums] for n in range(len(keys))]
            flat = pa.array([s[upper].tolist() for s in sums.values()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), flat], [*keys, "sums"])

    return run


def product_sums(df: DataFrame, numeric: list[str], keys: list[str], label: str, degree: int) -> DataFrame:
    """A row for each place in the upper triangle of the sums of products, for each combination of ``keys``."""
    columns = [*(F.col(c).cast("double").alias(c) for c in (*numeric, label)), *(F.col(k).cast("long").alias(k) for k in keys)]
    kinds = ", ".join(f"{k} long" for k in keys)
    tasks = df.select(*columns).mapInArrow(_products(numeric, keys, label, degree), f"{kinds}{', ' if keys else ''}sums array<double>")
    each = tasks.select(*keys, F.posexplode("sums").alias("place", "value"))
    return each.groupBy(*keys, "place").agg(F.sum("value").alias("value"))


@dataclass
class Moments:
    """Sums of products by category (and fold, the last key): basis products, then the label."""

    numeric: list[str]
    categories: list[str]
    degree: int
    sums: dict[Key, np.ndarray]

    @property
    def folds(self) -> list[int]:
        return sorted({k[-1] for k in self.sums})

    def part(self, keep) -> Moments:
        """Only the rows of the folds that ``keep`` accepts."""
        return Moments(self.numeric, self.categories, self.degree, {k: s for k, s in self.sums.items() if keep(k[-1])})

    def _at(self, i: int, j: int) -> int:
        """Place of the product of plain columns i and j (the last one is the unit) in the basis."""
        p = len(self.numeric) + 1
        i, j = min(i, j), max(i, j)
        return i * p - i * (i - 1) // 2 + j - i if self.degree > 1 else i

    def rows(self) -> float:
        unit = self._at(len(self.numeric), len(self.numeric))
        return float(sum(s[unit, unit] for s in self.sums.values()))

    def labels(self, feature: str) -> list[str]:
        """Values of the category behind an index feature: the most frequent first, ties in the order of their text; no NULL."""
        n, unit = self.categories.index(CATEGORY_OF[feature]), self._at(len(self.numeric), len(self.numeric))
        counts: dict = {}
        for key, s in self.sums.items():
            if key[n] is not None:
                counts[str(key[n])] = counts.get(str(key[n]), 0) + s[unit, unit]
        return sorted(counts, key=lambda v: (-counts[v], v))

    def _forms(self, features: Iterable[str], key: Key, labels: dict[str, list[str]]) -> np.ndarray:
        """Each feature within a category as a linear form in the plain columns and the unit."""
        features, p = list(features), len(self.numeric)
        out = np.zeros((len(features), p + 1))
        for row, f in zip(out, features, strict=True):
            if f in CATEGORY_OF:
                value, known = key[self.categories.index(CATEGORY_OF[f])], labels[f]
                row[p] = known.index(str(value)) if str(value) in known else len(known)
            else:
                row[self.numeric.index(f)] = 1.0
        return out

    def _plain(self, forms: np.ndarray) -> np.ndarray:
        """Linear forms in the plain columns, as rows over the basis and the label."""
        p = len(self.numeric)
        out = np.zeros((len(forms), len(next(iter(self.sums.values())))))
        for i in range(p + 1):
            out[:, self._at(i, p)] = forms[:, i]
        return out

    def _product(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(next(iter(self.sums.values()))))
        both = np.outer(a, b)
        for i in range(len(a)):
            for j in range(len(a)):
                if both[i, j]:
                    out[self._at(i, j)] += both[i, j]
        return out

    def _gram(self, rows_of) -> np.ndarray:
        total = 0.0
        for key, s in self.sums.items():
            rows = rows_of(key)
            total = total + rows @ s @ rows.T
        return total

    def _ends(self) -> np.ndarray:
        """Rows for the label and the unit."""
        p, size = len(self.numeric), len(next(iter(self.sums.values())))
        out = np.zeros((2, size))
        out[0, -1] = out[1, self._at(p, p)] = 1.0
        return out

    def scale(self, features: tuple[str, ...], labels: dict[str, list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Mean and sample spread of each feature; a constant one has spread 0."""
        gram = self._gram(lambda key: np.vstack([self._plain(self._forms(features, key, labels)), self._ends()]))
        if not np.isfinite(gram).all():
            raise ValueError(f"a NULL or a value that is not finite among {', '.join(features)} or the label")
        n = gram[-1, -1]
        mean = gram[:-2, -1] / n
        square = np.diag(gram)[:-2]
        spread = square - n * mean**2
        spread[spread <= 1e-12 * square] = 0.0
        return mean, np.sqrt(spread / max(n - 1, 1))

    def gram(
        self, features: tuple[str, ...], degree: int, labels: dict[str, list[str]], mean: np.ndarray, spread: np.ndarray
    ) -> np.ndarray:
        """Sums of products of (scaled and expanded features, label, 1), features in the order of Spark's expansion."""
        factor = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread > 0)

        def rows_of(key: Key) -> np.ndarray:
            forms = self._forms(features, key, labels)
            forms[:, -1] -= mean
            forms *= factor[:, None]
            plain = self._plain(forms)
            if degree == 1:
                return np.vstack([plain, self._ends()])
            rows = []
            for j in range(len(forms)):
                rows += [plain[j], *(self._product(forms[i], forms[j]) for i in range(j + 1))]
            return np.vstack([*rows, self._ends()])

        return self._gram(rows_of)


def collect_moments(df: DataFrame, features: Iterable[str], degree: int = 1, fold: str | None = None, label: str = S.LABEL) -> Moments:
    """One pass over ``df`` for models over any of ``features``; without ``fold`` all rows are of fold 0."""
    features = list(dict.fromkeys(features))
    numeric = [f for f in features if f not in CATEGORY_OF]
    categories = [CATEGORY_OF[f] for f in features if f in CATEGORY_OF]
    df = df.withColumn("_fold", F.col(fold) if fold else F.lit(0))
    keys = [*categories, "_fold"]
    found = product_sums(df, numeric, keys, label, degree).toArrow().sort_by([(c, "ascending") for c in (*keys, "place")])
    if not found.num_rows:
        raise ValueError("no rows to fit on")
    cells = found["place"].to_numpy().max() + 1
    size = int(np.sqrt(2 * cells))
    sums = {}
    for n, flat in enumerate(found["value"].to_numpy().reshape(-1, cells)):
        full = np.zeros((size, size))
        full[np.triu_indices(size)] = flat
        sums[tuple(found[k][n * int(cells)].as_py() for k in keys)] = full + np.triu(full, 1).T
    return Moments(numeric, categories, degree, sums)


@dataclass(frozen=True)
class MomentRows:
    """A few equally weighted rows with the sums of products of a whole table."""

    x: np.ndarray
    y: np.ndarray
    weight: float

    def rmse(self, model: LinearRegressionModel) -> float:
        error = self.y - self.x @ model.coefficients.toArray() - model.intercept
        return float(np.sqrt(np.mean(error**2)))

    def table(self, spark: SparkSession, features: str, label: str = S.LABEL) -> DataFrame:
        rows = [(Vectors.dense(x), float(y), self.weight) for x, y in zip(self.x, self.y, strict=True)]
        schema = T.StructType(
            [
                T.StructField(features, VectorUDT()),
                T.StructField(label, T.DoubleType()),
                T.StructField("trips", T.DoubleType()),
            ]
        )
        return spark.createDataFrame(rows, schema).coalesce(1)


def moment_rows(gram: np.ndarray) -> MomentRows:
    """Rows R with R'R = gram, turned so that the unit column is the same in each.

    Least squares sees a table only through these sums, so a fit on the rows is
    the fit on the table.
    """
    size, n = len(gram), gram[-1, -1]
    values, vectors = np.linalg.eigh(gram)
    rows = np.sqrt(np.clip(values, 0.0, None))[:, None] * vectors.T
    # Reflect the unit column onto the diagonal direction.
    target = np.full(size, 1 / np.sqrt(size))
    axis = rows[:, -1] / np.sqrt(n) - target
    if axis @ axis > 1e-24:
        rows = rows - 2.0 * np.outer(axis, axis @ rows) / (axis @ axis)
    rows = rows / np.sqrt(n / size)
    # A constant column stays constant: rounding must not give it a spread.
    mean = gram[:, -1] / n
    constant = np.diag(gram) / n - mean**2 <= 1e-12 * np.diag(gram) / n
    rows[:, constant] = mean[constant]
    return MomentRows(rows[:, :-2], rows[:, -2], float(n / size))

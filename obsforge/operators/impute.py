"""Chained-equation imputation from sufficient statistics.

Every imputed cell is an affine function of the observed cells of its row, and the function depends only on which cells
are missing. Counts, sums and cross products per missing-cell pattern therefore carry all the information the rounds of
regressions need: one scan gathers them, the rounds run on small matrices, and one narrow projection fills the table.
Where there are more patterns than the driver can hold matrices for, the most frequent ones are treated so, and the rows of
the rest add their products to each round by one scan of a narrow table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.functions.columns import no_nan
from obsforge.session import new_path, removed, written

MATRIX_CELLS = 8_000_000
# Rounds after which the rest's values are written anew, so that a scan has few rounds to repeat.
ROUNDS_PER_COPY = 10
PRIOR = 1e-6


def mice(
    df: DataFrame,
    columns: Sequence[str],
    max_iter: int = 1000,
    tol: float = 1e-4,
    estimator: str = "bayes",
    matrix_cells: int | None = None,
) -> DataFrame:
    """Fill nulls of `columns` by round-robin regression on the other columns; observed cells keep their value.

    Starts from column means, goes from the least to the most incomplete column, and stops when no column's imputed
    cells move by more than `tol` standard deviations (root mean square) or after `max_iter` rounds. `estimator`:
    "bayes" (Bayesian ridge, evidence maximisation) or "ols". A column without any value is filled with 0.

    `matrix_cells` bounds the numbers the driver holds for patterns of missing cells. Rows of the patterns beyond it take part in a
    round's regressions with their values from the round's start, which changes the way to the result but not the result.
    """
    columns = list(columns)
    matrix_cells = MATRIX_CELLS if matrix_cells is None else matrix_cells
    clean = df.withColumns({c: no_nan(F.col(c).cast("double")) for c in columns})
    k = len(columns)
    stats = clean.agg(
        F.count("*").alias("n"),
        F.approx_count_distinct(_pattern(columns)).alias("patterns"),
        *[F.count(c).alias(f"c{i}") for i, c in enumerate(columns)],
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    means = np.array([stats[f"m{i}"] or 0.0 for i in range(k)])
    scales = np.array([stats[f"s{i}"] or 1.0 for i in range(k)])
    missing = [stats["n"] - stats[f"c{i}"] for i in range(k)]
    order = sorted((i for i in range(k) if missing[i]), key=lambda i: missing[i])
    if not order:
        return clean
    fit = {"bayes": bayesian_ridge, "ols": least_squares}[estimator]
    most = int(matrix_cells / (k + 1) ** 2)
    if stats["patterns"] * 1.2 <= most:
        patterns, rest = _Patterns(clean, columns, means, scales, order), None
        _iterate(patterns, rest, scales, order, fit, max_iter, tol)
        return patterns.filled(clean)
    counted = clean.groupBy(_pattern(columns).alias("__pattern")).agg(F.count("*").alias("__n"))
    top = counted.orderBy(F.desc("__n"), "__pattern").limit(most).select("__pattern") if most else counted.limit(0).select("__pattern")
    top = F.broadcast(df.sparkSession.createDataFrame(top.collect(), "__pattern string"))
    marked = clean.withColumn("__pattern", _pattern(columns))
    often = marked.join(top, "__pattern", "left_semi").drop("__pattern")
    patterns = _Patterns(often, columns, means, scales, order)
    rest = _Rest(marked.join(top, "__pattern", "left_anti").drop("__pattern"), columns, means, scales, order)
    _iterate(patterns, rest, scales, order, fit, max_iter, tol)
    return patterns.filled(often).unionByName(rest.filled())


def _pattern(columns) -> Column:
    return F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])


def _scaled(column, mean, scale) -> Column:
    return F.coalesce((F.col(column) - F.lit(float(mean))) / F.lit(float(scale)), F.lit(0.0))


def _moment_sums(values: Sequence[Column]) -> list[Column]:
    k = len(values)
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(values)]
    return [F.count("*").alias("n"), *sums, *[F.sum(values[i] * values[j]).alias(f"x{i}_{j}") for i in range(k) for j in range(i, k)]]


def _moment_matrix(row, k: int) -> np.ndarray:
    """(k+1) x (k+1) sums of products of the values and the constant 1, which comes last."""
    out = np.zeros((k + 1, k + 1))
    for i in range(k):
        out[i, k] = out[k, i] = row[f"s{i}"] or 0.0
        for j in range(i, k):
            out[i, j] = out[j, i] = row[f"x{i}_{j}"] or 0.0
    out[k, k] = row["n"]
    return out


def least_squares(xx, xy, yy, n) -> np.ndarray:
    return np.linalg.lstsq(xx, xy, rcond=1e-12)[0]


def bayesian_ridge(xx, xy, yy, n) -> np.ndarray:
    """Ridge whose noise and weight precisions maximise the evidence, from centred second moments."""
    spectrum, basis = np.linalg.eigh(xx)
    spectrum, projected = np.clip(spectrum, 0.0, None), basis.T @ xy
    noise, weight = n / max(yy, 1e-300), 1.0
    previous = None
    for _ in range(300):
        w = basis @ (projected / (spectrum + weight / noise))
        rest = max(yy - 2 * w @ xy + w @ xx @ w, 0.0)
        if previous is not None and np.abs(w - previous).sum() < 1e-3:
            break
        effective = float(np.sum(noise * spectrum / (weight + noise * spectrum)))
        weight = (effective + 2 * PRIOR) / (float(w @ w) + 2 * PRIOR)
        noise = (n - effective + 2 * PRIOR) / (rest + 2 * PRIOR)
        previous = w
    return w


def _regress(moments: np.ndarray, target: int, scales: np.ndarray, fit) -> np.ndarray:
    """Weights of [other columns, constant] for the target, in scaled units; fitted in the original units."""
    k = len(scales)
    others = [i for i in range(k) if i != target]
    n = moments[k, k]
    out = np.zeros(k + 1)
    if n == 0:
        return out
    centre = moments[:k, k] / n
    spread = (moments[:k, :k] - n * np.outer(centre, centre)) * np.outer(scales, scales)
    w = fit(spread[np.ix_(others, others)], spread[others, target], spread[target, target], n)
    out[others] = w * scales[others] / scales[target]
    out[k] = centre[target] - out[others] @ centre[others]
    return out


class _Patterns:
    """Sums of products per pattern, and the affine map of each pattern from observed to current values."""

    def __init__(self, df, columns, means, scales, order):
        self.columns, self.means, self.scales, self.order, self.k = columns, means, scales, order, len(columns)
        self.scaled = [_scaled(c, means[i], scales[i]) for i, c in enumerate(columns)]
        tally = df.groupBy(_pattern(columns).alias("__pattern")).agg(*_moment_sums(self.scaled)).collect()
        self.observed = {r["__pattern"]: _moment_matrix(r, self.k) for r in tally}
        self.maps = {p: np.diag([0.0 if bit == "1" else 1.0 for bit in p] + [1.0]) for p in self.observed}
        self.gaps = {j: [p for p in self.observed if p[j] == "1"] for j in order}

    def products(self, j: int) -> np.ndarray:
        """Sums of products of the current values over the rows that know column j."""
        known = np.zeros((self.k + 1, self.k + 1))
        for p, m in self.observed.items():
            if p[j] == "0":
                known += self.maps[p] @ m @ self.maps[p].T
        return known

    def apply(self, j: int, rule: np.ndarray) -> tuple[float, float]:
        """Set the gaps of column j by the rule: sum of squares they moved by, and their number."""
        change, rows = 0.0, 0.0
        for p in self.gaps[j]:
            new = rule @ self.maps[p]
            step = new - self.maps[p][j]
            change += max(float(step @ self.observed[p] @ step), 0.0)
            rows += self.observed[p][self.k, self.k]
            self.maps[p][j] = new
        return change, rows

    def filled(self, df: DataFrame) -> DataFrame:
        k, rules = self.k, []
        for p, m in self.maps.items():
            rules.append((p, *[(self.means[j] * (np.arange(k + 1) == k) + self.scales[j] * m[j]).tolist() for j in self.order]))
        schema = "__pattern string, " + ", ".join(f"__w{j} array<double>" for j in self.order)
        table = F.broadcast(df.sparkSession.createDataFrame(rules, schema))
        joined = df.withColumn("__pattern", _pattern(self.columns)).join(table, "__pattern")
        filled = {}
        for j in self.order:
            value = F.col(f"__w{j}")[k]
            for i in range(k):
                value = value + F.col(f"__w{j}")[i] * self.scaled[i]
            filled[self.columns[j]] = F.coalesce(F.col(self.columns[j]), value)
        return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in df.columns])


class _Rest:
    """Rows of rare patterns: their current values in a narrow table, from which the rounds since its last copy are repeated."""

    def __init__(self, df, columns, means, scales, order):
        self.spark, self.columns, self.means, self.scales, self.order, self.k = df.sparkSession, columns, means, scales, order, len(columns)
        self.names = df.columns
        self.wide = written(df.withColumn("__id", F.monotonically_increasing_id()), "imputed-rest")
        values = F.array(*[_scaled(c, means[i], scales[i]) for i, c in enumerate(columns)])
        gaps = F.array(*[F.col(c).isNull() for c in columns])
        self.path = new_path(self.spark, "imputed-values")
        self.wide.select("__id", values.alias("x"), gaps.alias("g")).write.parquet(self.path)
        self.rules: list[list[np.ndarray]] = []

    def _values(self) -> DataFrame:
        return self.spark.read.schema("__id long, x array<double>, g array<boolean>").parquet(self.path)

    def products(self) -> tuple[dict[int, np.ndarray], dict[int, tuple[float, float]]]:
        """One scan: for each column with gaps the sums of products over the rows that know it, and (sum of squares, number) of
        what its gaps moved by in the last round."""
        k, order = self.k, self.order
        parts = self._values().mapInArrow(_rest_products(k, order, self.rules), "j int, i int, w array<double>")
        cells = parts.select("j", "i", F.posexplode("w").alias("at", "v")).groupBy("j", "i", "at").agg(F.sum("v").alias("v"))
        grams, moves = {j: np.zeros((k + 1, k + 1)) for j in order}, {j: [0.0, 0.0] for j in order}
        for r in cells.toLocalIterator():
            if r["i"] < 0:
                moves[r["j"]][r["at"]] = r["v"]
            else:
                grams[r["j"]][r["i"], r["at"]] = r["v"]
        return grams, {j: tuple(m) for j, m in moves.items()}

    def apply(self, rules: list[np.ndarray]) -> None:
        self.rules.append(rules)
        if len(self.rules) > ROUNDS_PER_COPY:
            # All but the last round, whose moves the next scan counts.
            path, old = new_path(self.spark, "imputed-values"), self.path
            self._moved(self.rules[:-1]).write.parquet(path)
            self.path, self.rules = path, self.rules[-1:]
            removed(self.spark, old)

    def _moved(self, rules: list[list[np.ndarray]]) -> DataFrame:
        return self._values().mapInArrow(_rest_values(self.k, self.order, rules), "__id long, x array<double>, g array<boolean>")

    def filled(self) -> DataFrame:
        done = self._moved(self.rules).select(F.col("__id").alias("__of"), "x")
        joined = self.wide.join(done, F.col("__id") == F.col("__of"))
        filled = {self.columns[j]: F.coalesce(F.col(self.columns[j]), F.lit(float(self.means[j])) + F.lit(float(self.scales[j])) * F.col("x")[j]) for j in self.order}
        return joined.select(*[filled.get(c, F.col(c)).alias(c) for c in self.names])


def _rest_batch(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Values with the constant 1 in the last column, and gaps."""
    x = np.ones((batch.num_rows, k + 1))
    x[:, :k] = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
    return x, batch.column("g").flatten().to_numpy(zero_copy_only=False).astype(bool).reshape(-1, k)


def _repeat(x: np.ndarray, g: np.ndarray, order: list[int], rules: list[np.ndarray]) -> list[float]:
    """One round on the values, in place; the sum of squares each column moved by."""
    moves = []
    for j, rule in zip(order, rules):
        at = g[:, j]
        new = x[at] @ rule
        moves.append(float(np.square(new - x[at, j]).sum()))
        x[at, j] = new
    return moves


def _rest_products(k: int, order: list[int], rounds: list[list[np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, moves = np.zeros((len(order), k + 1, k + 1)), np.zeros((len(order), 2))
        for batch in batches:
            x, g = _rest_batch(batch, k)
            last = [0.0] * len(order)
            for rules in rounds:
                last = _repeat(x, g, order, rules)
            moves[:, 0] += last
            moves[:, 1] += [g[:, j].sum() for j in order]
            for at, j in enumerate(order):
                known = x[~g[:, j]]
                grams[at] += known.T @ known
        rows = [(j, i, grams[at, i].tolist()) for at, j in enumerate(order) for i in range(k + 1)]
        rows += [(j, -1, moves[at].tolist()) for at, j in enumerate(order)]
        columns = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.list_(pa.float64()))], ["j", "i", "w"])

    return run


def _rest_values(k: int, order: list[int], rounds: list[list[np.ndarray]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, g = _rest_batch(batch, k)
            for rules in rounds:
                _repeat(x, g, order, rules)
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(x) + 1) * k, k, dtype=np.int32)), pa.array(x[:, :k].ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), values, batch.column("g")], ["__id", "x", "g"])

    return run


def _iterate(patterns: _Patterns, rest: _Rest | None, scales, order, fit, max_iter: int, tol: float) -> None:
    """Rounds of regressions until no column's gaps move by more than `tol`; what the rest moved by is known a scan later."""
    moved: dict[int, tuple[float, float]] = {}
    for at in range(max_iter):
        grams, late = rest.products() if rest else ({}, {})
        if rest and at and _largest(moved, late) < tol:
            break
        rules, moved = [], {}
        for j in order:
            products = patterns.products(j)
            rule = _regress(products + grams[j] if rest else products, j, scales, fit)
            moved[j] = patterns.apply(j, rule)
            rules.append(rule)
        if rest:
            rest.apply(rules)
        elif _largest(moved, {}) < tol:
            break


def _largest(moved: dict[int, tuple[float, float]], late: dict[int, tuple[float, float]]) -> float:
    """Root mean square of what a column's gaps moved by, of the column that moved most."""
    both = [(c + late.get(j, (0.0, 0.0))[0], n + late.get(j, (0.0, 0.0))[1]) for j, (c, n) in moved.items()]
    return max((c / n) ** 0.5 for c, n in both if n)

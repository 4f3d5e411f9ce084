"""Forest fit and scoring with stored state."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.functions.columns import label_text
from obsforge.operators.clean import align, binary_map, drop_columns, fill_median, fill_mode, missing_flags
from obsforge.operators.encode import apply_codes, apply_scaler, assemble
from obsforge.operators.feed import read_or_none
from obsforge.operators.outliers import apply_fences
from obsforge.schema import FOREST, LABEL, LABELS

TABLES = ("modes", "codes", "fences", "medians", "scaler")
MANIFEST = "save long, folder string, forest boolean, features array<string>, flagged array<string>, labels array<string>, fence_mode string"
FLAG = "_missing"
KEEP = "__kept"


def fit_forest(df: DataFrame, label: str = LABEL, features: str = "features", params: Mapping[str, Any] = FOREST) -> RandomForestClassificationModel:
    """Random forest on an assembled, complete feature vector."""
    forest = RandomForestClassifier(featuresCol=features, labelCol="__label", **params)
    return forest.fit(df.select(features, F.col(label).cast("double").alias("__label")))


def predict(df: DataFrame, model: RandomForestClassificationModel) -> DataFrame:
    """Add prediction (0 / 1) and probability of class 1."""
    kept = df.columns
    scored = model.transform(df)
    return scored.select(
        *kept,
        F.col(model.getPredictionCol()).cast("int").alias("prediction_class"),
        vector_to_array(model.getProbabilityCol())[1].alias("probability"),
    ).withColumnRenamed("prediction_class", "prediction")


def importances(spark: SparkSession, model: RandomForestClassificationModel, names: Sequence[str], n: int | None = 5) -> DataFrame:
    """(position, feature, importance), largest first; the first `n`."""
    pairs = sorted(zip(names, model.featureImportances.toArray().tolist()), key=lambda p: -p[1])
    rows = [(i + 1, name, float(value)) for i, (name, value) in enumerate(pairs if n is None else pairs[:n])]
    return spark.createDataFrame(rows, "position int, feature string, importance double")


@dataclass
class ScoringState:
    """Everything fitted on training data that scoring needs, as tables, plus the forest."""

    features: list[str]
    flagged: list[str]
    modes: DataFrame
    codes: DataFrame
    fences: DataFrame
    medians: DataFrame
    scaler: DataFrame
    fence_mode: str = "clip"
    model: RandomForestClassificationModel | None = None
    labels: list[str] = field(default_factory=lambda: list(LABELS))

    @property
    def vector(self) -> list[str]:
        return self.features + [f"{c}{FLAG}" for c in self.flagged]

    def save(self, path: str) -> str:
        """Store the state below `path`. Tables and forest go to a folder of their own; the manifest's row, written last, names it.

        Readers follow the manifest only, so a save that is cut short is never seen, and one that replaces another leaves
        whoever reads the former undisturbed. Saves into one path must not run at the same time.
        """
        spark = self.scaler.sparkSession
        before = [r["save"] for r in _saves(spark, path)]
        number, folder = max(before, default=0) + 1, f"files-{uuid.uuid4().hex}"
        for name in TABLES:
            getattr(self, name).write.parquet(f"{path}/{folder}/{name}")
        if self.model is not None:
            self.model.write().save(f"{path}/{folder}/forest")
        row = (number, folder, self.model is not None, self.features, self.flagged, self.labels, self.fence_mode)
        # One file, which a single rename makes visible.
        spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str, with_model: bool = True, save: int | None = None) -> ScoringState:
        """The state of the last complete save, or of the one numbered `save`."""
        saves = {r["save"]: r for r in _saves(spark, path)}
        row = saves.get(max(saves, default=0) if save is None else save)
        if row is None:
            raise ValueError(f"no complete state{'' if save is None else f' {save}'} in {path}")
        if with_model and not row["forest"]:
            raise ValueError(f"the state in {path} was stored without a forest")
        kept = f"{path}/{row['folder']}"
        tables = {name: spark.read.parquet(f"{kept}/{name}") for name in TABLES}
        model = RandomForestClassificationModel.load(f"{kept}/forest") if with_model else None
        return cls(list(row["features"]), list(row["flagged"]), **tables, fence_mode=row["fence_mode"], model=model, labels=list(row["labels"]))


def _saves(spark: SparkSession, path: str) -> list:
    """Rows of the manifest, one per complete save; none if there is no manifest yet."""
    manifest = read_or_none(spark, f"{path}/manifest")
    return [] if manifest is None else manifest.collect()


def to_features(df: DataFrame, state: ScoringState, keep: Sequence[str] = (), unseen: str = "keep") -> DataFrame:
    """Raw rows -> aligned, filled, scaled features and their vector, with the stored state only: narrow and row by row.

    Columns named in `keep` travel along with their raw values in one struct. (A copy per column would double the
    constraints the optimizer derives from a filter on the input, once for every column.)
    """
    out = df.withColumn(KEEP, F.struct(*keep)) if keep else df
    modes = state.modes.where(F.col("column").isin([c for c in out.columns]))
    out = binary_map(out, state.labels, passthrough=True)
    out = fill_mode(out, modes)
    text = [c for c in state.features if c in out.columns and dict(out.dtypes)[c] == "string"]
    out = apply_codes(out, state.codes, text, unseen) if text else out
    out = apply_fences(out, state.fences, state.fence_mode)
    out = align(drop_columns(out, [LABEL]), state.features, keep=[KEEP] if keep else [])
    out = out.withColumns({c: F.col(c).cast("double") for c in state.features})
    return finish_features(out, state)


def finish_features(df: DataFrame, state: ScoringState) -> DataFrame:
    """Prepared feature columns -> missing flags, median fill, standardised values, vector."""
    out = missing_flags(df, state.flagged, FLAG) if state.flagged else df
    out = fill_median(out, state.medians)
    return assemble(apply_scaler(out, state.scaler), state.vector)


def score(df: DataFrame, state: ScoringState, keep: Sequence[str] = (), unseen: str = "keep", version: int | None = None) -> DataFrame:
    """Raw rows -> kept columns with their raw values, prediction, probability, label text and model version."""
    return _scored(to_features(df, state, keep, unseen), state, keep, version)


def score_prepared(df: DataFrame, state: ScoringState, keep: Sequence[str] = (), version: int | None = None) -> DataFrame:
    """The same for rows whose text columns are codes already; absent features are missing values."""
    out = df.withColumn(KEEP, F.struct(*keep)) if keep else df
    out = align(out, state.features, keep=[KEEP] if keep else [])
    out = out.withColumns({c: F.col(c).cast("double") for c in state.features})
    return _scored(finish_features(out, state), state, keep, version)


def _scored(ready: DataFrame, state: ScoringState, keep: Sequence[str], version: int | None) -> DataFrame:
    scored = predict(ready.select(*([KEEP] if keep else []), "features"), state.model)
    return scored.select(
        *[F.col(KEEP)[c].alias(c) for c in keep],
        "prediction",
        "probability",
        label_text(F.col("prediction")).alias("prediction_label"),
        F.lit(version).cast("long").alias("model_version"),
    )

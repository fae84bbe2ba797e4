"""Rows with their folds, and the preprocessing of each fold's training rows, without a copy of the rows per fold."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import features
from tallyfold.operators.folds import Cell, cells_of, complement_categories, complement_quartiles, fold_array
from tallyfold.runtime import stage


@dataclass(frozen=True)
class TableSpec:
    """Which columns of a table are key, target and features."""

    key: str
    nums: tuple[str, ...]
    cats: tuple[str, ...] = ()
    y: str = "y"
    scaler: str = "robust"


@dataclass
class FoldSet:
    """``rows`` (staged: key, y, the feature columns, ``folds``) and what the training rows of each (repeat, fold) fit to.

    A fold's training rows are those of the other folds. Iterating gives one encoded frame per cell, computed from ``rows`` by
    expressions when it is read: key, y, features, part ('train' or 'valid'), repeat, fold.
    """

    rows: DataFrame
    spec: TableSpec
    cells: list[Cell]
    numbers: dict[Cell, dict[str, tuple[float, list[float]]]]
    categories: dict[Cell, dict[str, tuple[str, list[str]]]]
    _pipelines: dict[Cell, PipelineModel] = field(default_factory=dict)

    def pipeline(self, cell: Cell) -> PipelineModel:
        """The stages that :func:`features.preprocessing` would fit on the cell's training rows; fitting them reads no rows."""
        if cell not in self._pipelines:
            self._pipelines[cell] = self._build(cell)
        return self._pipelines[cell]

    def _build(self, cell: Cell) -> PipelineModel:
        spec, numbers, categories = self.spec, self.numbers[cell], self.categories[cell]
        stages: list = []
        if spec.nums:
            stages.append(features.MedianImputerModel(cols=list(spec.nums), state={c: m for c, (m, _) in numbers.items()}))
            if spec.scaler == "robust":
                stages.append(features.RobustScalerModel(cols=list(spec.nums), state={c: quart for c, (_, quart) in numbers.items()}))
            elif spec.scaler != "none":  # other scalers have no counts in common and read the training rows
                train = stages[0].transform(self.training_rows(cell))
                stages.append(features.preprocessing(list(spec.nums), [], spec.scaler).getStages()[1].fit(train))
        hot = [features.onehot_name(c) for c in spec.cats]
        if spec.cats:
            index = [features.index_name(c) for c in spec.cats]
            stages.append(features.ModeImputerModel(cols=list(spec.cats), state={c: mode for c, (mode, _) in categories.items()}))
            indexers = [
                StringIndexerModel.from_labels(categories.get(c, ("", []))[1], c, i, "keep") for c, i in zip(spec.cats, index)
            ]
            # The encoder takes its sizes from the labels, which the indexers write into the columns.
            sized = PipelineModel(indexers).transform(self.rows.limit(0))
            stages += [*indexers, OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True).fit(sized)]
        stages.append(VectorAssembler(inputCols=[*spec.nums, *hot], outputCol="features"))
        return PipelineModel(stages)

    def training_rows(self, cell: Cell) -> DataFrame:
        return self.rows.where(F.col("folds")[cell[0] - 1] != cell[1])

    def frame(self, cell: Cell) -> DataFrame:
        repeat, fold = cell
        encoded = self.pipeline(cell).transform(self.rows)
        return encoded.select(
            "key", "y", "features", F.when(F.col("folds")[repeat - 1] == fold, "valid").otherwise("train").alias("part"),
            F.lit(repeat).alias("repeat"), F.lit(fold).alias("fold"),
        )

    def __iter__(self) -> Iterator[DataFrame]:
        return map(self.frame, self.cells)

    def __len__(self) -> int:
        return len(self.cells)


def _fold_set(marked: DataFrame, spec: TableSpec, cells: list[Cell]) -> FoldSet:
    columns = [F.col(spec.key).alias("key"), F.col(spec.y).cast("int").alias("y"), *[F.col(f"`{c}`") for c in (*spec.nums, *spec.cats)], "folds"]
    rows = stage(marked.select(*columns), "folds")
    return FoldSet(
        rows, spec, cells, complement_quartiles(rows, list(spec.nums), cells), complement_categories(rows, list(spec.cats), cells)
    )


def fold_set(df: DataFrame, spec: TableSpec, k: int, repeats: int = 1, seed: int = 42) -> FoldSet:
    """Stratified folds; a column of the table must not be called key, y or folds unless it is the key or the target."""
    return _fold_set(fold_array(df, [spec.key], spec.y, k, repeats, seed), spec, cells_of(k, repeats))


def holdout_set(train: DataFrame, test: DataFrame, spec: TableSpec) -> FoldSet:
    """One cell: the test rows are its fold, the preprocessing is that of the training rows."""
    columns = [spec.key, spec.y, *[f"`{c}`" for c in (*spec.nums, *spec.cats)]]
    marked = train.select(*columns, F.array(F.lit(2)).alias("folds")).unionByName(test.select(*columns, F.array(F.lit(1)).alias("folds")))
    return _fold_set(marked, spec, [(1, 1)])

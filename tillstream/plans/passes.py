"""Scans of the feature rows that serve many models at once.

Rows are packed into blocks, arrays of one line per feature, and kept. Tasks
answer with arrays, and a scan adds them up in the order of the tasks, so that
the same rows give the same bits.

Tasks get the functions of these scans with their code, so that workers need
numpy and pyarrow, but not this package.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.schema import FEATURE_COLUMNS

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = np.stack([column.to_numpy(zero_copy_only=False) for column in batch.columns])
            yield pa.RecordBatch.from_pydict({"block": [x.tobytes()]})


class Blocks:
    """The five numbers of every row, in the order and the partitions rows have.

    Blocks are kept until the end of the ``with`` they are made for.
    """

    def __init__(self, vectors: DataFrame):
        columns = [F.col(name).cast("double").alias(name) for name in FEATURE_COLUMNS]
        self.rows = vectors.select(*columns)
        self.context = vectors.sparkSession.sparkContext
        self.kept = self.rows.mapInArrow(_pack, "block binary")

    def __enter__(self) -> Blocks:
        self.kept.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def __exit__(self, *_) -> None:
        self.kept.unpersist()

    def gather(self, work: Callable[[int, Iterator[np.ndarray]], Iterable]) -> list:
        """What ``work`` yields for the number and the blocks of each task, in their order."""
        width = len(FEATURE_COLUMNS)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = (
                np.frombuffer(block.as_buffer()).reshape(width, -1)
                for batch in batches
                for block in batch.column(0)
            )
            for answer in work(TaskContext.get().partitionId(), blocks):
                yield pa.RecordBatch.from_pydict({"answer": [pickle.dumps(answer)]})

        found = self.kept.mapInArrow(task, "answer binary").collect()
        return [pickle.loads(row.answer) for row in found]

    def add_up(self, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum of ``work`` over all blocks."""

        def task(_: int, blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
            total = None
            for x in blocks:
                part = work(x)
                total = part if total is None else total + part
            if total is not None:
                yield total

        parts = self.gather(task)
        if not parts:
            raise ValueError("no invoices to train on")
        return sum(parts[1:], parts[0])


def cluster_sums(x: np.ndarray, place: np.ndarray, size: int, *more: np.ndarray) -> np.ndarray:
    """Count and feature sums of each of ``size`` clusters, as lines, and sums of ``more``."""
    weights = [None, *x, *more]
    return np.stack([np.bincount(place, weights=w, minlength=size) for w in weights])


def squared_gap(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its center, or to one for all."""
    gap = x - center
    return np.einsum("dn,dn->n", gap, gap)

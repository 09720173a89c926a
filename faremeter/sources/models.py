"""Saving and loading fitted models."""
from __future__ import annotations

from typing import TypeVar

M = TypeVar("M")


def save_model(model, path: str) -> None:
    """Write a fitted MLlib model, replacing one already there."""
    model.write().overwrite().save(path)


def load_model(kind: type[M], path: str) -> M:
    """Load a model of the given class, for instance `LinearRegressionModel`."""
    return kind.load(path)

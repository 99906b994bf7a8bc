"""Typed options for every step; the defaults are the documented ones."""

from __future__ import annotations

from dataclasses import dataclass

K2_METHODS = ("ratio", "sqrt", "fixed", "default")
VECTOR_TYPES = {"int8": "tinyint", "int16": "smallint", "int32": "int", "int64": "bigint"}


@dataclass(frozen=True)
class FingerprintOptions:
    delimiter: str = " "
    smiles_index: int = 0
    name_index: int = 1
    skip_header: bool = True
    fp_type: str = "qgram"
    radius: int = 2
    n_bits: int = 256
    use_features: bool = False
    fp_dtype: str = "int8"

    def __post_init__(self):
        if not self.delimiter:
            raise ValueError("delimiter must not be empty")
        if min(self.smiles_index, self.name_index) < 0:
            raise ValueError("column indexes are 0-based and not negative")
        if self.radius < 0:
            raise ValueError("radius must be >= 0")
        if not 1 <= self.n_bits <= 65536:
            raise ValueError("n_bits must be in 1..65536")
        if self.fp_dtype not in VECTOR_TYPES:
            raise ValueError(f"fp_dtype must be one of {sorted(VECTOR_TYPES)}")


@dataclass(frozen=True)
class KMeansOptions:
    """Settings of one k-means run.

    Training reads all rows; ``max_points_per_centroid`` limits it to about so many rows for each
    centroid, by a hash of the row id, where a sample is enough.

    Sums and means are exact and results do not depend on partitioning or on re-run tasks. With ``scale``
    None coordinates are taken as they are, whatever their spread. A ``scale`` puts coordinates and centroids on an
    integer grid of width ``1/scale``, for results that SQL can follow value for value.

    The budgets choose between equal ways of doing the work, never the result:
    ``local_bytes`` / ``local_flops`` bound a group handled inside one task (fewer operations when
    there are fewer groups than cores, down to a twentieth),
    ``broadcast_bytes`` bounds a model sent to every executor, and ``slice_bytes`` bounds the
    rows one task holds once the model is too large for that.
    """

    n_init: int = 1
    max_iter: int = 25
    seed: int = 42
    max_points_per_centroid: int | None = None
    scale: float | None = None
    local_bytes: int = 512 << 20
    local_flops: float = 4e12
    broadcast_bytes: int = 128 << 20
    slice_bytes: int = 64 << 20

    def __post_init__(self):
        for name in ("n_init", "max_iter", "max_points_per_centroid", "slice_bytes"):
            if getattr(self, name) is not None and getattr(self, name) < 1:
                raise ValueError(f"{name} must be >= 1")
        if self.scale is not None and not self.scale > 0:
            raise ValueError("scale must be positive")


@dataclass(frozen=True)
class HierarchyOptions:
    k1: int
    method: str = "ratio"
    value: float = 8.0
    base_k: int = 2
    stage1: KMeansOptions = KMeansOptions()
    stage2: KMeansOptions = KMeansOptions()

    def __post_init__(self):
        if self.k1 < 1:
            raise ValueError("k1 must be >= 1")
        check_k2_rule(self.method, self.base_k)


def check_k2_rule(method: str, base_k: int) -> None:
    if method not in K2_METHODS:
        raise ValueError(f"method must be one of {K2_METHODS}, got {method!r}")
    if base_k < 1:
        raise ValueError("base_k must be >= 1")

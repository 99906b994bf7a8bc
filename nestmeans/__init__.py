"""Normalise, fingerprint, cluster in two stages and pick representative rows, on Spark."""

from nestmeans.options import FingerprintOptions, HierarchyOptions, KMeansOptions

__all__ = ["FingerprintOptions", "HierarchyOptions", "KMeansOptions"]

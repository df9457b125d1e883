"""seqcal: profile-search screening and score calibration as Spark DataFrame operations."""

import importlib

__version__ = "0.1.0"
__all__ = [
    "DomainHit", "confusion_at_threshold", "load_hmms", "roc_auc", "roc_curve", "scan_fasta", "scan_records", "select_zero_observed_false_positive_cutoff", "wilson_interval",
]


def __getattr__(name: str):
    """The library's entry points, imported when they are asked for: Python workers need few of them."""
    if name in __all__:
        return getattr(importlib.import_module(".api", __name__), name)
    raise AttributeError(name)

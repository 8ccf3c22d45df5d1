"""lading — supply-chain warehouse jobs on Spark.

Every public job takes and returns DataFrames.  The layers are the
reference's raw -> clean -> analytics -> quality; the source contract is
derived from the driver's TPC-H-style tables by ``lading.sources.contract``.

Common entry points (imported lazily)::

    from lading import build_session, read_extracts, Warehouse, build_warehouse
"""

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": "lading.session",
    "read_extracts": "lading.sources.extracts",
    "SourceContract": "lading.sources.contract",
    "Warehouse": "lading.plans.warehouse",
    "build_warehouse": "lading.plans.build",
    "keep_latest": "lading.operators.dedup",
    "merge_into": "lading.operators.merge",
}


def __getattr__(name):
    if name in _EXPORTS:
        import importlib
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(name)


__all__ = sorted(_EXPORTS)
